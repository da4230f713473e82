"""Daily unique visitors (STA2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.time import epoch_to_day
from larkspur.plans import segmented as S


def uv_entries(pages: DataFrame, zone: str = "UTC") -> DataFrame:
    """Entry pages for unique visits: ``last_page_id`` absent.  An empty
    string or JSON null is a present key, so not an entry.  Days are those of
    ``zone``."""
    return pages.where(~F.col("has_last_page")).withColumn("day", epoch_to_day(F.col("ts_ms"), zone))


def unique_visit(pages: DataFrame, key: str = "mid", order: Sequence[str] = ("arrival_ms", "rec_id"),
                 payload: Sequence[str] = ("rec_id", "ts_ms"), zone: str = "UTC") -> DataFrame:
    """In-order form: the first entry (in arrival order) per key and day.

    One partial aggregate (min of an ordered struct): map-side combine keeps
    a hot key cheap, no window over the key."""
    e = uv_entries(pages, zone)
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_p_{c}") for c in payload]))
    g = e.groupBy(key, "day").agg(best.alias("_b"))
    return g.select(key, "day", *[F.col(f"_b._p_{c}").alias(c) for c in payload])


def unique_visit_exact(pages: DataFrame, key: str = "mid", order: Sequence[str] = ("arrival_ms", "rec_id"),
                       order_value: str = "arrival_ms", payload: Sequence[str] = ("rec_id", "ts_ms"),
                       max_rows: int | None = None, zone: str = "UTC") -> DataFrame:
    """Exact state-machine form: keep an entry when its day differs from the
    day of the previous entry of the key in arrival order (the stored day is
    always the last entry's day).  Runs on the segmented plan."""
    e = uv_entries(pages, zone)
    x = S.assign_segments(e, [key], list(order), max_rows)
    x = S.with_neighbors(x, [key], list(order), ["day"], n_prev=1)
    keep = F.col("prev_1").isNull() | (F.col("prev_1.day") != F.col("day"))
    return S.drop_segments(x.where(keep)).select(key, "day", *payload)
