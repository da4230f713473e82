"""Streaming pipelines composed from the batch operators.

* ``base_log_query``  - lenient parse, dirty output, ``is_new`` repair
  (stateful), then start / page / display outputs in one ``foreachBatch``.
* ``unique_visit_stream`` / ``bounce_stream`` - stateful DWM operators.
* ``window_sum_stream`` - built-in event-time windows, update mode
  (re-fires on allowed-late rows), late rows dropped by the watermark.
* ``late_split_query`` - late-record side output with a batch-granular
  watermark kept in a small state table.
* ``route_asof_stream`` - CDC normalisation and as-of routing, config rows and
  data records through one stateful operator; ``routing_query`` routes with a
  config snapshot that is re-read every micro-batch instead.

Checkpoints and state go under ``spark.checkpoint.dir`` (see
``larkspur.session.checkpoint_root``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.functions import json as J
from larkspur.functions import text as TX
from larkspur.functions.time import epoch_to_day, ms_to_ts
from larkspur.operators import cdc as CDC
from larkspur.operators import logs as L
from larkspur.operators import patterns as P
from larkspur.operators import routing as RT
from larkspur.operators import windows as W
from larkspur.sources import commits as CM
from larkspur.sources import sinks as SK
from larkspur.streaming import processors as PR

REPAIR_SCHEMA = "rec_id long, mid string, is_new string, ts_ms long, day string, value string"
UV_SCHEMA = "mid string, day string, rec_id long, ts_ms long, value string"
BOUNCE_SCHEMA = "mid string, rec_id long, ts_ms long, page_id string, kind string, value string"


def _schema(spark: SparkSession, ddl: str):
    return spark.createDataFrame([], ddl).schema


# ------------------------------------------------------------------ base log
def parse_log_stream(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean records without the VARIANT column, dirty records)."""
    parsed = L.parse_app_log(lines)
    clean, dirty = L.split_dirty(parsed)
    clean = clean.select("rec_id", "mid", "is_new", "ts_ms", epoch_to_day("ts_ms").alias("day"), "value")
    return clean, dirty.select("rec_id", "value")


def repair_is_new_stream(clean: DataFrame, order=("rec_id",), ttl_ms: int | None = None) -> DataFrame:
    """STA1 (stream): keyed ``transformWithState``, no timers.  State never
    expires by default (as in the source); ``ttl_ms`` bounds its growth with
    a processing-time TTL (then drive the query with a processing-time
    trigger)."""
    schema = _schema(clean.sparkSession, REPAIR_SCHEMA)
    mode = "None" if ttl_ms is None else "ProcessingTime"
    clean = clean.select(schema.fieldNames())
    claims = F.coalesce(F.col("is_new") == "1", F.lit(False))
    fixed = clean.where(claims).groupBy("mid").transformWithState(
        PR.IsNewRepairProcessor(schema, order=order, ttl_ms=ttl_ms), schema, "Append", mode)
    return clean.where(~claims).unionByName(fixed)      # only records that claim to be new meet the state


def split_log_outputs(batch: DataFrame, write: Callable[[DataFrame, str], None]) -> None:
    """SPL1 / SPL2 + JSN4 for one micro-batch: the repaired records are
    re-encoded and handed to ``write(frame, name)`` as ``start``, ``page``
    and ``display`` outputs (the batch is parsed once and persisted)."""
    p = L.parse_app_log(batch.select("rec_id", "value", F.col("is_new").alias("_fixed")))
    p = L.with_repaired_json(p.withColumn("is_new", F.col("_fixed"))).persist()
    try:
        write(L.start_logs(p).select("rec_id", F.col("out_value").alias("value")), "start")
        pages = L.page_logs(p)
        write(pages.select("rec_id", F.col("out_value").alias("value")), "page")
        write(L.display_logs(pages, keep=("rec_id",)), "display")
    finally:
        p.unpersist()


def write_log_outputs(batch: DataFrame, batch_id: int, out_root: str) -> None:
    """``split_log_outputs`` into idempotent per-batch files under ``out_root``."""
    split_log_outputs(batch, lambda df, name: SK.write_batch(df, f"{out_root}/{name}", batch_id))


def base_log_query(lines: DataFrame, out_root: str, checkpoint: str,
                   trigger: dict | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """Entry A: (main query, dirty-output query)."""
    clean, dirty = parse_log_stream(lines)
    repaired = repair_is_new_stream(clean)
    t = trigger or {"availableNow": True}
    main = (repaired.writeStream.option("checkpointLocation", f"{checkpoint}/main")
            .foreachBatch(lambda df, bid: write_log_outputs(df, bid, out_root)).trigger(**t).start())
    dq = (dirty.writeStream.format("parquet").option("checkpointLocation", f"{checkpoint}/dirty")
          .option("path", f"{out_root}/dirty").trigger(**t).start())
    return main, dq


# --------------------------------------------------------------------- DWM
def _with_text(pages: DataFrame) -> DataFrame:
    """Pages with the record's text ``value`` (null where the source has typed columns only)."""
    return pages if "value" in pages.columns else pages.withColumn("value", F.lit(None).cast("string"))


def unique_visit_stream(pages: DataFrame, ttl_ms: int | None = PR.DAY_MS, zone: str = "UTC") -> DataFrame:
    """STA2 (stream): entry pages, processing-time TTL on the stored day.

    TTL needs ``timeMode="ProcessingTime"``; such a query keeps running
    no-data batches to expire state, so drive it with a processing-time
    trigger, not ``availableNow``.  ``ttl_ms=None`` keeps state forever
    (time mode "None")."""
    e = _with_text(pages).where(~F.col("has_last_page")).withColumn("day", epoch_to_day("ts_ms", zone))
    schema = _schema(pages.sparkSession, UV_SCHEMA)
    mode = "None" if ttl_ms is None else "ProcessingTime"
    return e.groupBy("mid").transformWithState(
        PR.UniqueVisitProcessor(schema, ttl_ms=ttl_ms), schema, "Append", mode)


def unique_visit_dedup_stream(pages: DataFrame, delay: str = "1 day") -> DataFrame:
    """STA2 in-order form (stream), without a custom processor: one row per
    (mid, day) via ``dropDuplicatesWithinWatermark``.  The delay must be at
    least a day plus the arrival disorder, or a key is forgotten and a
    same-day repeat is emitted again.  Which of several same-day rows inside
    one micro-batch is kept is not defined."""
    e = (pages.where(~F.col("has_last_page")).withColumn("day", epoch_to_day("ts_ms"))
         .withColumn("ts", ms_to_ts(F.col("ts_ms"))).withWatermark("ts", delay))
    return e.dropDuplicatesWithinWatermark(["mid", "day"]).select("mid", "day", "rec_id", "ts_ms")


def bounce_stream(pages: DataFrame, window_ms: int = 10_000) -> DataFrame:
    """CEP1-CEP3 (stream): monotonous watermark on ``ts``, event-time timers."""
    x = (_with_text(pages).withColumn("ts", ms_to_ts(F.col("ts_ms"))).withWatermark("ts", "0 seconds")
         .withColumn("is_entry", P.bounce_entry(pages))
         .select("mid", "rec_id", "ts_ms", "page_id", "is_entry", "value", "ts"))
    schema = _schema(pages.sparkSession, BOUNCE_SCHEMA)
    return x.groupBy("mid").transformWithState(
        PR.BounceProcessor(window_ms), schema, "Append", "EventTime")


STRICT_SCHEMA = "key string, kind string, length int, first_seq long, first_ts long, last_ts long, ts_list string"


def strict_times_stream(events: DataFrame, cond, n: int, key: str, ts: str = "ts_ms",
                        seq: str = "seq", within_ms: int | None = None, bucket_ms: int = 1000) -> DataFrame:
    """CEP4 / CEP5 / CEP6 (stream): monotonous watermark, event-time timers; timed-out partial matches are rows of
    ``kind`` timeout."""
    x = (events.withColumn("_ts", ms_to_ts(F.col(ts))).withWatermark("_ts", "0 seconds")
         .select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(seq).alias("seq"),
                 F.coalesce(cond, F.lit(False)).alias("c"), "_ts"))
    schema = _schema(events.sparkSession, STRICT_SCHEMA)
    return x.groupBy("key").transformWithState(PR.StrictTimesProcessor(n, within_ms, bucket_ms), schema, "Append", "EventTime")


# ------------------------------------------------------------------ windows
def window_sum_stream(scores: DataFrame, size: str, delay_ms: int, lateness_ms: int,
                      slide: str | None = None) -> DataFrame:
    """WIN1 / WIN4 / WIN7 (stream): run with ``outputMode("update")``; the
    watermark delay is out-of-orderness + allowed lateness, so allowed-late
    rows update (re-fire) their window and later rows are dropped."""
    s = scores.withWatermark("ts", f"{delay_ms + lateness_ms} milliseconds")
    return W.window_sum(s, size, slide)


ARRIVAL_WINDOW = "name string, window_start_ms long, window_end_ms long, score_sum long, n_rows long, last_ts long"


def arrival_window_stream(scores: DataFrame, size_ms: int, order=("arrival_ms", "seq")) -> DataFrame:
    """WIN6 (stream): windows of processing time, closed by timers; drive it with a processing-time trigger, as such a
    query keeps running batches without data until its timers have fired."""
    x = scores.select("name", F.col("score").cast("long").alias("score"), "ts_ms", *order)
    return x.groupBy("name").transformWithState(PR.ArrivalWindowProcessor(size_ms, order), _schema(scores.sparkSession, ARRIVAL_WINDOW),
                                                "Append", "ProcessingTime")


def late_split_batch(batch: DataFrame, batch_id: int, state_path: str, out_root: str,
                     size_ms: int, delay_ms: int, lateness_ms: int,
                     order=("arrival_ms", "seq"), order_value: str = "arrival_ms") -> None:
    """WIN5 for one micro-batch with the per-record watermark rule: a
    record's watermark is the max event time of everything that arrived
    before it (earlier batches, carried in the one row of the batch before,
    and earlier records of this batch in ``order``) minus delay minus 1 ms.
    A missing state fails the batch, except for the first.
    Late records go to the ``late`` output.  Batches must follow arrival
    order (as a topic / file stream does)."""
    spark = batch.sparkSession
    prev = spark.read.parquet(f"{state_path}/batch_id={batch_id - 1}").first()["max_ts"] if batch_id else None
    x = W.classify_lateness(batch, size_ms, delay_ms, lateness_ms, order=order, order_value=order_value,
                            initial_max_ts=prev).persist()
    try:
        SK.write_batch(x.where(F.col("class") != W.LATE), f"{out_root}/main", batch_id)
        SK.write_batch(x.where(F.col("class") == W.LATE), f"{out_root}/late", batch_id)
        SK.write_batch(x.agg(F.greatest(F.max("ts_ms"), F.lit(prev).cast("long")).alias("max_ts")), state_path, batch_id)
    finally:
        x.unpersist()


def late_split_query(scores: DataFrame, out_root: str, checkpoint: str, size_ms: int, delay_ms: int,
                     lateness_ms: int, trigger: dict | None = None, order=("arrival_ms", "seq"),
                     order_value: str = "arrival_ms") -> StreamingQuery:
    state = f"{checkpoint}/watermark"
    return (scores.writeStream.option("checkpointLocation", f"{checkpoint}/query")
            .foreachBatch(lambda df, bid: late_split_batch(df, bid, state, out_root, size_ms, delay_ms,
                                                           lateness_ms, order, order_value))
            .trigger(**(trigger or {"availableNow": True})).start())


# ----------------------------------------------------------------- handover
CHANGE_SCHEMA = "seq long, topic string, value string"


def handover_stream(changes: DataFrame, chunks: DataFrame, pk: str, ttl_ms: int | None = None) -> DataFrame:
    """SRC3 (stream): change events (seq, topic, value) and the chunk rows of a snapshot (low, topic, value: events of
    ``cdc.snapshot_events`` with their chunk's low mark) as one feed of change events.  ``pk`` names the primary key in
    the events' ``after`` (or ``before``); events without one pass as they are."""
    def keyed(df: DataFrame, at: str, side: int) -> DataFrame:
        x = J.with_parsed(df, "value", "_hv")
        own = F.coalesce(*[J.path(F.col("_hv"), f"$.{part}.{pk}") for part in ("after", "before")])
        name = F.concat_ws(".", *TX.topic_db_table("topic"))
        return x.select(F.when(own.isNull(), F.concat(F.lit("#"), F.xxhash64("value").cast("string"))).otherwise(F.concat_ws("=", name, own)).alias("key"),
                        F.lit(side).alias("side"), F.col(at).alias("at"), "topic", "value")

    schema = _schema(changes.sparkSession, CHANGE_SCHEMA)
    return keyed(changes, "seq", 0).unionByName(keyed(chunks, "low", 1)).groupBy("key").transformWithState(
        PR.HandoverProcessor(ttl_ms), schema, "Append", "None" if ttl_ms is None else "ProcessingTime")


# ------------------------------------------------------------------ routing
def write_routed(routed: DataFrame, batch_id: int, out_root: str, order: str = "seq",
                 publish: Callable[[DataFrame], None] | None = None) -> None:
    """The outputs of one routed micro-batch (tagged by sink): topic records, dimension rows and counts, under one
    commit record (``sources.commits``).  ``publish`` takes the topic records (``topic, value, key, headers``) in place of
    the topic files.  ``order`` must order the records of a primary key totally: between equal values any one of the rows
    survives an upsert."""
    routed = routed.persist()

    def write(batch: CM.Batch) -> None:
        main = routed.where(F.col("stream") == "main")
        if publish:
            publish(CM.stamp(RT.topic_value(main, keep=(order,)), batch_id, "topics", [order, "topic", "value"]).drop(order))
            batch.published("topics")
        else:
            batch.write(RT.topic_value(main), "topics", partition_by=("topic",), fmt="json")
        side = routed.where(F.col("stream") == "side")
        batch.write(SK.dimension_rows(side, order), "dims", partition_by=SK.LOG_FOLDERS)
        # per-batch counts: routed records and empty payloads the upsert skipped
        batch.write(routed.agg(
            F.sum((F.col("stream") == "main").cast("long")).alias("topic_records"),
            F.sum((F.col("stream") == "side").cast("long")).alias("dimension_records"),
            F.sum(((F.col("stream") == "side") & (F.size("data") == 0)).cast("long")).alias("skipped_empty")), "metrics")

    try:
        CM.write_all(routed.sparkSession, out_root, batch_id, write)
    finally:
        routed.unpersist()


def route_batch(batch: DataFrame, batch_id: int, config: Callable[[SparkSession], DataFrame],
                out_root: str, order: str = "seq", dim_schema: str | None = None,
                envelopes: bool = False, publish: Callable[[DataFrame], None] | None = None) -> None:
    """Entry B for one micro-batch: normalise, route with the current config
    snapshot and ``write_routed``.  With ``dim_schema`` the dimension tables of
    the config are created first.  ``envelopes=True`` reads normalised
    envelopes (a CDC1 topic) instead of raw change events."""
    spark = batch.sparkSession
    latest = RT.latest_config(RT.config_versions(config(spark)))
    if dim_schema:
        RT.create_dimension_tables(spark, latest, schema=dim_schema)
    norm = CDC.parse_envelopes(batch) if envelopes else CDC.normalize_change_events(batch)
    write_routed(RT.tag_by_sink(RT.route_latest(norm, latest)), batch_id, out_root, order, publish)


def routing_query(changes: DataFrame, config: Callable[[SparkSession], DataFrame], out_root: str,
                  checkpoint: str, trigger: dict | None = None, order: str = "seq",
                  dim_schema: str | None = None, envelopes: bool = False,
                  publish: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    return (changes.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, bid: route_batch(df, bid, config, out_root, order, dim_schema, envelopes, publish))
            .trigger(**(trigger or {"availableNow": True})).start())


ROUTED = ("table string, operation string, seq long, value string, "
          + ", ".join(f"{c} string" for c in RT.CFG_FIELDS[2:]) + ", cfg_seq long")


def route_asof_stream(changes: DataFrame, config: DataFrame, delay_ms: int, salts: int = 16, bucket_ms: int = 1000,
                      envelopes: bool = False) -> DataFrame:
    """RTE2 + RTE3 (stream): ``changes`` (seq, topic, value; or envelopes without topic) and the config feed (seq, value)
    through one stateful operator; rows of ROUTED, still with the record's text.

    ``seq`` is the arrival position of both feeds in ms (a record's timestamp).  Feeds and partitions may be ``delay_ms``
    apart; later rows are dropped by the watermark.  No config history is read again: the state holds the config in force
    for each (table, operation) and the rows the watermark has not passed.  A busy table is dealt over ``salts`` keys,
    each of which gets its few config rows."""
    norm = CDC.parse_envelopes(changes) if envelopes else CDC.normalize_change_events(changes)
    fields = RT.CFG_FIELDS[2:]
    data = norm.select("table", "operation", F.pmod(F.xxhash64("value"), F.lit(salts)).cast("int").alias("salt"), "seq", F.lit(0).alias("side"),
                       "value", *[F.lit(None).cast("string").alias(c) for c in fields])
    rows = RT.config_versions(config).select(
        F.col("source_table").alias("table"), F.col("operate_type").alias("operation"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        "seq", F.lit(1).alias("side"), F.lit(None).cast("string").alias("value"), *fields)
    both = data.unionByName(rows).withColumn("ts", ms_to_ts(F.col("seq"))).withWatermark("ts", f"{delay_ms} milliseconds")
    schema = _schema(changes.sparkSession, ROUTED)
    return both.groupBy("table", "operation", "salt").transformWithState(
        PR.AsOfRouteProcessor(fields, bucket_ms), schema, "Append", "EventTime")


def routed_payload(routed: DataFrame, envelopes: bool = False) -> DataFrame:
    """Rows of ROUTED with ``data``, the payload pruned to the configured columns, in place of the text."""
    norm = CDC.parse_envelopes(routed.drop("table", "operation")) if envelopes else CDC.normalize_change_events(
        routed.drop("table", "operation"), topic=None)
    return norm.withColumn("data", J.prune_columns(F.col("data"), F.col("sink_columns"))).drop("value", "dbname")
