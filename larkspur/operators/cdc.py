"""Change-data-capture normalisation (CDC1, STR2, JSN5, SRC2 filter)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import json as J
from larkspur.functions import text as TX

# Public change-event op codes -> operation names (fixed values).
OP_NAMES = {"c": "create", "u": "update", "d": "delete", "r": "read"}
DATA_TYPE = "map<string,variant>"


def normalize_change_events(df: DataFrame, value: str = "value", topic: str | None = "topic", parsed: str | None = None) -> DataFrame:
    """CDC1: ``{before, after, op, source}`` -> ``data`` (``after`` or an empty
    map), ``operation`` (lower-case name), ``dbname``, ``table``.

    ``before`` is ignored; a delete therefore carries empty ``data``.  The
    database / table come from ``source`` and fall back to the topic
    ``<server>.<db>.<table>``.  ``parsed`` names the parsed value where ``df`` has it."""
    x = df.withColumnRenamed(parsed, "_cv") if parsed else J.with_parsed(df, value, "_cv")
    v = F.col("_cv")
    after = F.try_variant_get(v, "$.after", DATA_TYPE)
    names = F.create_map(*[F.lit(x) for pair in OP_NAMES.items() for x in pair])
    name = F.element_at(names, F.lower(J.path(v, "$.op", "string")))   # one look-up: a chain of whens reads the op anew in each branch
    db = J.path(v, "$.source.db", "string")
    tb = J.path(v, "$.source.table", "string")
    if topic:
        tdb, ttb = TX.topic_db_table(topic)
        db, tb = F.coalesce(db, tdb), F.coalesce(tb, ttb)
    return (x.withColumn("data", F.coalesce(after, F.create_map().cast(DATA_TYPE)))
             .withColumn("operation", name)
             .withColumn("dbname", db)
             .withColumn("table", tb)
             .drop("_cv"))


BAD_TEXT, NO_OP, UNKNOWN_OP = "bad_text", "no_op", "unknown_op"


def split_dirty_changes(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """CDC1's dirty path: (change events, dirty records with ``reason``).  Dirty are texts that are no JSON object, and
    events whose ``op`` is missing or none of ``OP_NAMES``."""
    x = tag_dirty_changes(df, value)
    return x.where(F.col("reason").isNull()).drop("reason"), x.where(F.col("reason").isNotNull())


def tag_dirty_changes(df: DataFrame, value: str = "value", keep: str | None = None) -> DataFrame:
    """``df`` with ``reason``: null for a change event, else why it is dirty (one parse, one pass), and the parsed value
    under the name ``keep``."""
    x = J.with_parsed(df, value, "_cv")
    op = F.lower(J.path(F.col("_cv"), "$.op", "string"))
    reason = (F.when(~J.is_json_object(F.col("_cv")), F.lit(BAD_TEXT)).when(op.isNull(), F.lit(NO_OP))
              .when(~op.isin(*OP_NAMES), F.lit(UNKNOWN_OP)))
    x = x.withColumn("reason", reason)
    return x.withColumnRenamed("_cv", keep) if keep else x.drop("_cv")


def snapshot_events(rows: DataFrame, db: str, table: str, server: str = "snapshot") -> DataFrame:
    """SRC3's read phase: every row of a table as a change event ``op = r`` (``topic, value``), ready for CDC1."""
    rec = F.struct(F.lit(None).cast("string").alias("before"), F.struct(*rows.columns).alias("after"), F.lit("r").alias("op"),
                   F.struct(F.lit(db).alias("db"), F.lit(table).alias("table")).alias("source"))
    return rows.select(F.lit(f"{server}.{db}.{table}").alias("topic"),
                       F.to_json(rec, {"ignoreNullFields": "false"}).alias("value"))


def parse_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """Read normalised envelopes ``{data, operation, dbname, table}`` (the
    output of CDC1 as JSON text) back into the columns routing expects."""
    x = J.with_parsed(df, value, "_ev")
    v = F.col("_ev")
    return (x.withColumn("data", F.coalesce(F.try_variant_get(v, "$.data", DATA_TYPE),
                                            F.create_map().cast(DATA_TYPE)))
             .withColumn("operation", J.path(v, "$.operation", "string"))
             .withColumn("dbname", J.path(v, "$.dbname", "string"))
             .withColumn("table", J.path(v, "$.table", "string"))
             .drop("_ev"))


def envelope_json(norm: DataFrame) -> DataFrame:
    """JSN7: encode the normalised envelope as JSON text."""
    rec = F.struct("data", "operation", "dbname", "table")
    return norm.withColumn("envelope", F.to_json(rec))


def filter_has_data(df: DataFrame, value: str = "value") -> DataFrame:
    """JSN5: keep envelopes whose ``data`` key is present."""
    return with_data(df, value).drop("_dv")


def with_data(df: DataFrame, value: str = "value") -> DataFrame:
    """``filter_has_data`` with the parsed envelope ``_dv``, so that what reads it next need not parse again."""
    return J.with_parsed(df, value, "_dv").where(F.coalesce(J.has_path(F.col("_dv"), "$.data"), F.lit(False)))


def from_timestamp(df: DataFrame, ts_col: str, from_ms: int) -> DataFrame:
    """SRC2 on files: records at or after ``from_ms`` (epoch ms).  The bound is
    a literal on the raw timestamp column so it reaches the parquet scan."""
    t = _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=from_ms)
    return df.where(F.col(ts_col) >= F.expr(f"TIMESTAMP_NTZ'{t.isoformat(sep=' ')}'"))
