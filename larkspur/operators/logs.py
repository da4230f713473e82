"""Behaviour-log layer: parse, dirty path, ``is_new`` repair, start/page
split and display explode (JSN2-JSN4, STA1, SPL1, SPL2, ARR1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import json as J

VARIANT_COL = "_v"


def parse_app_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON text once into typed columns (keeps ``_v`` VARIANT).

    ``dirty`` is true for malformed text, non-object values and records
    without ``common.mid`` or ``ts`` (these fail the job in a strict
    pipeline; here they go to the dirty output)."""
    x = J.with_parsed(lines, value, VARIANT_COL)
    v = F.col(VARIANT_COL)
    mid = J.path(v, "$.common.mid", "string")
    ts = J.path(v, "$.ts", "bigint")
    return (x
            .withColumn("mid", mid)
            .withColumn("is_new", J.path(v, "$.common.is_new", "string"))
            .withColumn("ts_ms", ts)
            .withColumn("is_start", J.has_path(v, "$.start"))
            .withColumn("page_id", J.path(v, "$.page.page_id", "string"))
            .withColumn("last_page_id", J.path(v, "$.page.last_page_id", "string"))
            .withColumn("has_last_page", J.has_path(v, "$.page.last_page_id"))
            .withColumn("dirty", F.coalesce(~J.is_json_object(v) | mid.isNull() | ts.isNull(), F.lit(True))))


def split_dirty(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JSN2: (main, dirty); dirty keeps only the raw text and its rec_id."""
    main = parsed.where(~F.col("dirty"))
    dirty = parsed.where(F.col("dirty")).drop(VARIANT_COL)
    return main, dirty


def repair_is_new(logs: DataFrame, key: str = "mid", flag: str = "is_new",
                  order: Sequence[str] = ("rec_id",), out: str = "is_new") -> DataFrame:
    """STA1: per key, the first record (in ``order``) claiming ``"1"`` keeps it;
    every later ``"1"`` becomes ``"0"``; ``"0"`` records are untouched.

    Plan: a partial aggregate (min order per key over ``"1"`` rows, map-side
    combined) joined back on the key.  A hot key is split by AQE's skew join
    rather than sent through one window task."""
    # of one column plainly: a minimum of structs would need a sorted aggregate
    o = F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
    first = (logs.where(F.col(flag) == "1")
             .groupBy(key).agg(F.min(o).alias("_first_new")))
    joined = logs.join(first, key, "left")
    fixed = F.when((F.col(flag) == "1") & (o > F.col("_first_new")), F.lit("0")).otherwise(F.col(flag))
    return joined.withColumn(out, fixed).drop("_first_new")


def start_logs(logs: DataFrame) -> DataFrame:
    """SPL1: records with a ``start`` key (even JSON null)."""
    return logs.where(F.col("is_start"))


def page_logs(logs: DataFrame) -> DataFrame:
    """SPL1: every other record; complementary to ``start_logs``."""
    return logs.where(~F.col("is_start"))


def display_logs(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """SPL2 / ARR1: one row per ``displays`` element of a page log, stamped
    with the page's ``page_id`` (the page row itself stays in page_logs).

    A non-array ``displays`` yields no rows."""
    arr = F.try_variant_get(F.col(VARIANT_COL), "$.displays", "array<variant>")
    x = pages.select(*keep, "page_id", F.explode(arr).alias("_d"))
    d = F.col("_d")
    stamped = F.to_variant_object(J.set_field(J.as_map(d), "page_id", F.col("page_id")))
    return x.select(
        *keep, "page_id",
        J.path(d, "$.item", "string").alias("item"),
        J.path(d, "$.pos", "bigint").alias("pos"),
        F.to_json(stamped).alias("value"))


def with_repaired_json(logs: DataFrame, flag: str = "is_new") -> DataFrame:
    """JSN4 + JSN7: re-encode each record with ``common.is_new`` replaced by
    the repaired flag (keys come out sorted)."""
    v = J.set_nested_field(F.col(VARIANT_COL), "common", "is_new", F.col(flag))
    return logs.withColumn("out_value", F.to_json(v))
