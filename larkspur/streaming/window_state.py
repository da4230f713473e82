"""WIN2-WIN5 as one streaming operator: windows with allowed lateness under one watermark a record.

A micro-batch is classified record by record with the watermark that stands before it (the largest event time of all that
arrived earlier, in earlier batches or in this one, less the delay and 1 ms).  On-time and allowed-late records go into the
accumulators of their window, (sum, rows, firings, last element); late ones to the late output.  Every record takes one of these ways, by one
watermark.  A window fires once the watermark has passed its end, and again for each allowed-late record; it is purged once its
lateness has passed, which is also when its records begin to be late.

State: the accumulators of the open windows and the largest event time.  Both are written with the outputs under the batch's
commit record, so a batch that fails leaves none of them, and a replay starts from the state of the batch before.
A busy key or window is summed map-side and, for the running results of allowed-late records, cut into segments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.operators import windows as W
from larkspur.plans import segmented as S
from larkspur.sources import commits as CM

KEY = ["name", "window_start_ms"]
OPEN = "name string, window_start_ms long, score_sum long, n_rows long, fires long, fired boolean, last_at struct<{0}>, last_ts long"
RESULTS, LATE, STATE, MARK = "results", "late", "open_windows", "watermark"


def _before(spark: SparkSession, root: str, batch_id: int, order: Sequence[str]) -> tuple[DataFrame, int | None]:
    """(open windows, largest event time) of the last batch committed before this one."""
    last = CM.commits(spark, root).where(F.col("batch_id") < batch_id).orderBy(F.desc("batch_id")).first()
    if last is None:
        if batch_id:
            raise RuntimeError(f"no state before batch {batch_id} at {root}")
        return spark.createDataFrame([], OPEN.format(", ".join(f"{c}: long" for c in order))), None
    at = f"batch_id={last.batch_id}/attempt={last.attempt}"
    return spark.read.parquet(f"{root}/{STATE}/{at}"), spark.read.parquet(f"{root}/{MARK}/{at}").first()["max_ts"]


def advance(x: DataFrame, opened: DataFrame, max_ts: int | None, size_ms: int, delay_ms: int, lateness_ms: int,
            order: Sequence[str] = ("arrival_ms", "seq")) -> tuple[DataFrame, DataFrame, DataFrame, int | None]:
    """One step: (results, late rows, open windows, largest event time) from a classified batch (name, score, ts_ms, *order;
    the order in longs) and the state before it."""
    top = x.agg(F.max("ts_ms")).first()[0]
    top = max((t for t in (top, max_ts) if t is not None), default=None)
    mark = (top if top is not None else -(1 << 62)) - delay_ms - 1
    at = F.struct(*[F.col(c).cast("long").alias(c) for c in order])
    end = F.col("window_start_ms") + F.lit(size_ms - 1)
    score = F.col("score").cast("bigint")

    def summed(cls: str) -> DataFrame:
        return x.where(F.col("class") == cls).groupBy(*KEY).agg(
            F.sum(score).alias("score_sum"), F.count(F.lit(1)).alias("n_rows"), F.max(F.struct(at.alias("at"), "ts_ms")).alias("last"))

    def merged(a: DataFrame, b: DataFrame, fires, fired) -> DataFrame:
        """Accumulators ``a`` with the sums ``b`` of a class added."""
        own = a.select(*KEY, "score_sum", "n_rows", F.struct(F.col("last_at").alias("at"), F.col("last_ts").alias("ts_ms")).alias("last"), "fires", "fired")
        both = own.unionByName(b.select(*KEY, "score_sum", "n_rows", "last", fires.alias("fires"), fired.alias("fired")))
        return both.groupBy(*KEY).agg(F.sum("score_sum").alias("score_sum"), F.sum("n_rows").alias("n_rows"), F.sum("fires").alias("fires"),
                                      F.max("fired").alias("fired"), F.max("last").alias("last")).select(
            *KEY, "score_sum", "n_rows", "fires", "fired", F.col("last.at").alias("last_at"), F.col("last.ts_ms").alias("last_ts"))

    timely = merged(opened, summed(W.ON_TIME), F.lit(0).cast("long"), F.lit(False))
    due = timely.where(~F.col("fired") & (end <= F.lit(mark)))
    first = due.select(*KEY, F.lit(0).cast("long").alias("fire_no"), "score_sum", "n_rows", "last_ts")
    again = x.where(F.col("class") == W.REFIRE).select(*KEY, *order, "ts_ms", score.alias("score"))
    again = S.with_running(S.assign_segments(again, KEY, list(order)), KEY, [F.col(c) for c in order],
                           aggs=[("score", "_sum", "sum"), (F.lit(1).cast("long"), "_n", "sum")])
    base = timely.select(*KEY, F.col("score_sum").alias("_s0"), F.col("n_rows").alias("_n0"), F.col("fires").alias("_f0"))
    again = S.drop_segments(again).join(base, KEY, "left").select(
        *KEY, (F.coalesce("_f0", F.lit(0)) + F.col("_n")).alias("fire_no"), (F.coalesce("_s0", F.lit(0)) + F.col("_sum")).alias("score_sum"),
        (F.coalesce("_n0", F.lit(0)) + F.col("_n")).alias("n_rows"), F.col("ts_ms").alias("last_ts"))
    results = W.fired_text(first.unionByName(again), size_ms)
    late = x.where(F.col("class") == W.LATE)
    state = merged(timely, summed(W.REFIRE), F.col("n_rows"), F.lit(True)).withColumn("fired", F.col("fired") | (end <= F.lit(mark)))
    return results, late, state.where(end + F.lit(lateness_ms) > F.lit(mark)), top


def window_batch(batch: DataFrame, batch_id: int, root: str, size_ms: int, delay_ms: int, lateness_ms: int,
                 order: Sequence[str] = ("arrival_ms", "seq"), publish: Callable[[DataFrame, str], None] | None = None) -> None:
    """One micro-batch: outputs ``results`` and ``late``, and the state, under one commit record.  ``publish(rows, name)``
    takes the two outputs (with ``key`` and ``headers`` of ``commits.stamp``) in place of their files."""
    spark, root = batch.sparkSession, root.rstrip("/")

    def write(out: CM.Batch) -> None:
        opened, before = _before(spark, root, batch_id, order)
        x = W.classify_lateness(batch, size_ms, delay_ms, lateness_ms, order=order, initial_max_ts=before).persist()
        try:
            outputs(out, x, opened, before)
        finally:
            x.unpersist()

    def outputs(out: CM.Batch, x: DataFrame, opened: DataFrame, before: int | None) -> None:
        results, late, state, top = advance(x, opened, before, size_ms, delay_ms, lateness_ms, order)
        for name, rows, identity in ((RESULTS, results, [*KEY, "fire_no"]), (LATE, late, [*order])):
            if publish:
                publish(CM.stamp(rows, batch_id, name, identity), name)
                out.published(name)
            else:
                out.write(rows, name)
        out.write(state, STATE)
        out.write(spark.range(1).select(F.lit(top).cast("long").alias("max_ts")), MARK)

    CM.write_all(spark, root, batch_id, write)
    CM.retire(spark, root, (STATE, MARK), batch_id - 1)


def window_query(scores: DataFrame, root: str, checkpoint: str, size_ms: int, delay_ms: int, lateness_ms: int,
                 order: Sequence[str] = ("arrival_ms", "seq"), publish: Callable[[DataFrame, str], None] | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """``window_batch`` over a stream of scores whose batches follow arrival order (as a topic or file stream does)."""
    return (scores.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: window_batch(df, bid, root, size_ms, delay_ms, lateness_ms, order, publish))
            .trigger(**(trigger or {"availableNow": True})).start())
