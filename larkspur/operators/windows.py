"""Event-time windows, watermarks and late data (WMK1-2, WIN1-7, MTH1).

Batch forms follow the watermark rules of a bounded-out-of-orderness
source: the watermark seen by a record is ``max(ts of records that arrived
before it) - delay - 1 ms``.  A window ``[start, end)`` fires when the
watermark reaches ``end - 1``; a record is *late* (side output) when
``end - 1 + lateness <= watermark``; a record that is neither on time nor
late re-fires its window with the updated result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions import text as TX
from larkspur.functions import time as TM
from larkspur.plans import segmented as S

ON_TIME, REFIRE, LATE = "on_time", "refire", "late"


def parse_scores(lines: DataFrame, value: str = "value") -> DataFrame:
    """STR1: ``name,score,epoch_ms`` lines -> typed columns (+ ``ts`` instant)."""
    return (lines
            .withColumn("name", TX.csv_field(value, 0))
            .withColumn("score", TX.csv_field(value, 1).cast("bigint"))
            .withColumn("ts_ms", TX.csv_field(value, 2).cast("bigint"))
            .withColumn("ts", TM.ms_to_ts(F.col("ts_ms"))))


def with_event_time(df: DataFrame, ts_ms: str = "ts_ms", delay: str | None = None) -> DataFrame:
    """WMK1 / WMK2: event-time column (+ watermark on streaming frames).
    ``delay=None`` or ``'0 seconds'`` is the monotonous watermark."""
    x = df.withColumn("ts", TM.ms_to_ts(F.col(ts_ms)))
    if delay is not None and df.isStreaming:
        x = x.withWatermark("ts", delay)
    return x


def window_sum(df: DataFrame, size: str, slide: str | None = None, key: str = "name",
               ts: str = "ts", value: str = "score") -> DataFrame:
    """WIN1 / WIN6 / WIN7 + MTH1: tumbling (or sliding) window sum per key,
    epoch-aligned.  Partial aggregation happens map-side."""
    w = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    g = df.groupBy(w.alias("w"), key).agg(F.sum(F.col(value).cast("bigint")).alias("score_sum"),
                                         F.count(F.lit(1)).alias("n"))
    return g.select(key, TM.ts_to_ms(F.col("w.start")).alias("window_start_ms"),
                    TM.ts_to_ms(F.col("w.end")).alias("window_end_ms"), "score_sum", "n")


def window_sum_last(df: DataFrame, size: str, key: str = "name", ts: str = "ts",
                    value: str = "score", arrival: Sequence[str] = ("arrival_ms", "seq")) -> DataFrame:
    """WIN2: incremental sum plus the key and event time of the element added
    last (in arrival order)."""
    last = F.max_by(F.col("ts_ms"), F.struct(*[F.col(c) for c in arrival]))
    g = df.groupBy(F.window(F.col(ts), size).alias("w"), key).agg(
        F.sum(F.col(value).cast("bigint")).alias("score_sum"), last.alias("last_ts"))
    return g.select(key, TM.ts_to_ms(F.col("w.start")).alias("window_start_ms"),
                    TM.ts_to_ms(F.col("w.end")).alias("window_end_ms"), "score_sum", "last_ts",
                    TM.format_event_time("last_ts", millis=False).alias("last_time"))


def bounds_text(sum_last: DataFrame, key: str = "name") -> DataFrame:
    """WIN3: ``start-end,key,sum,last_time`` with 12-hour display times."""
    return sum_last.withColumn("text", F.concat(
        TM.format_event_time("window_start_ms", millis=False), F.lit("-"),
        TM.format_event_time("window_end_ms", millis=False), F.lit(","),
        F.col(key), F.lit(","), F.col("score_sum").cast("string"), F.lit(","), F.col("last_time")))


def fired_text(fired: DataFrame, size_ms: int, key: str = "name") -> DataFrame:
    """WIN3 on firing results (key, window_start_ms, fire_no, score_sum, n_rows, last_ts): the display ``text`` added."""
    x = (fired.withColumn("window_end_ms", F.col("window_start_ms") + F.lit(size_ms))
         .withColumn("last_time", TM.format_event_time("last_ts", millis=False)))
    return bounds_text(x, key).drop("window_end_ms", "last_time")


def max_before(df: DataFrame, ts: str = "ts_ms", order: Sequence[str] = ("arrival_ms", "seq"),
               max_rows: int | None = None, out: str = "_maxprev") -> DataFrame:
    """The largest event time of the records that arrived strictly before each record (null for the first)."""
    x = S.assign_segments(df, [], list(order), max_rows)
    x = S.with_running(x, [], [F.col(c) for c in order], F.col(ts), out, how="max", inclusive=False)
    return S.drop_segments(x)


def watermarks(df: DataFrame, delay_ms: int, ts: str = "ts_ms", order: Sequence[str] = ("arrival_ms", "seq"),
               max_rows: int | None = None) -> DataFrame:
    """WMK1 / WMK2 (batch): the watermark after each record, for monotone times (``wm_monotone``) and for times out of
    order by up to ``delay_ms`` (``wm_bounded``)."""
    seen = F.greatest(F.col("_maxprev"), F.col(ts))
    return (max_before(df, ts, order, max_rows).withColumn("wm_monotone", seen - F.lit(1))
            .withColumn("wm_bounded", seen - F.lit(delay_ms + 1)).drop("_maxprev"))


def classify_lateness(df: DataFrame, size_ms: int, delay_ms: int, lateness_ms: int,
                      ts: str = "ts_ms", order: Sequence[str] = ("arrival_ms", "seq"),
                      order_value: str = "arrival_ms", max_rows: int | None = None,
                      initial_max_ts: int | None = None) -> DataFrame:
    """WIN5 (batch): ``wm_before`` (watermark seen by each record) and
    ``class`` in {on_time, refire, late} for tumbling windows of
    ``size_ms``.  The running max over arrival order is a segmented global
    scan: per-segment maxima are carried across segments, so no task holds
    more than one segment.  ``initial_max_ts`` is the max event time of
    records that arrived before ``df`` (a micro-batch's carried state)."""
    x = max_before(df, ts, order, max_rows)
    start = F.floor(F.col(ts) / F.lit(size_ms)).cast("long") * F.lit(size_ms)
    prev = F.col("_maxprev")
    if initial_max_ts is not None:
        prev = F.greatest(prev, F.lit(int(initial_max_ts)))
    wm = prev - F.lit(delay_ms) - F.lit(1)
    max_ts = F.col("window_start_ms") + F.lit(size_ms - 1)
    cls = (F.when(F.col("wm_before").isNull() | (max_ts > F.col("wm_before")), F.lit(ON_TIME))
           .when(max_ts + F.lit(lateness_ms) <= F.col("wm_before"), F.lit(LATE))
           .otherwise(F.lit(REFIRE)))
    return (x.withColumn("window_start_ms", start).withColumn("wm_before", wm)
             .withColumn("class", cls).drop("_maxprev"))


def refire_results(classified: DataFrame, key: str = "name", value: str = "score",
                   order: Sequence[str] = ("arrival_ms", "seq"),
                   max_rows: int | None = None) -> DataFrame:
    """WIN4 (batch): the firing sequence of every window.  ``fire_no = 0`` is
    the on-time firing (sum of on-time records); each allowed-late record
    re-fires with the running result.  Late records are excluded.

    One keyed running pass per window over on-time records first, then
    re-fire records in arrival order: the running sum at a re-fire record is
    its firing result, so no join back to the on-time totals is needed."""
    g = [key, "window_start_ms"]
    is_re = (F.col("class") == REFIRE).cast("long")
    r = classified.where(F.col("class") != LATE).withColumn("_re", is_re).withColumn("_v", F.col(value).cast("bigint"))
    r = S.assign_segments(r, g, ["_re", *order], max_rows)
    o = [F.col("_re")] + [F.col(c) for c in order]
    r = S.drop_segments(S.with_running(r, g, o, aggs=[("_v", "_sum", "sum"), (F.lit(1).cast("long"), "_rows", "sum"), ("_re", "fire_no", "sum")]))
    # One aggregate for both: all on-time records share number 0, every re-fire has its own.
    first = F.col("fire_no") == 0
    return (r.groupBy(*g, "fire_no").agg(F.sum("_v").alias("_s0"), F.count(F.lit(1)).alias("_n0"), F.max("_sum").alias("_sum"), F.max("_rows").alias("_rows"))
            .select(*g, "fire_no", F.when(first, F.col("_s0")).otherwise(F.col("_sum")).alias("score_sum"),
                    F.when(first, F.col("_n0")).otherwise(F.col("_rows")).alias("n_rows")))
