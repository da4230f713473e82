"""Runnable streaming applications, one per source pipeline.

    python -m larkspur.apps base-log --source kafka:HOST:PORT/ods_base_log --sink files:/data/dwd ...

A source is ``kafka:<bootstrap>/<topic>[@<epoch ms to start from>]`` or ``files:<path>`` (parquet with a
``value`` column, plus ``topic`` for change feeds); a sink is
``kafka:<bootstrap>`` (topics named after the outputs) or ``files:<root>``.
Checkpoints default to ``<spark.checkpoint.dir>/<app>``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larkspur.functions import time as TM
from larkspur.operators import cdc as CDC
from larkspur.operators import logs as L
from larkspur.operators import routing as RT
from larkspur.operators import windows as W
from larkspur.session import build_session, checkpoint_root
from larkspur.sources import commits as CM
from larkspur.sources import connectors as SC
from larkspur.sources import sinks as SK
from larkspur.streaming import jobs as J
from larkspur.streaming import window_state as WS

LINE_SCHEMA = "rec_id long, value string"
CHANGE_SCHEMA = "seq long, topic string, value string"

# Output names of the log layers (fixed topic names).
TOPICS = {"page": "dwd_page_log", "display": "dwd_display_log", "start": "dwd_start_log",
          "dirty": "dwd_dirty_log", "uv": "dwm_unique_visit", "jump": "dwm_user_jump_detail",
          "uv_dirty": "dwm_unique_visit_dirty", "jump_dirty": "dwm_user_jump_detail_dirty",
          "db": "ods_base_db", "db_dirty": "ods_base_db_dirty", "window": "window_result", "window_late": "window_late",
          "alert": "login_alert"}


def read_source(spark: SparkSession, spec: str, schema: str, starting: str | int = "earliest") -> DataFrame:
    """The records with ``arrival_ms``: a topic's records arrive in the order (arrival_ms, rec_id), that is timestamp,
    partition, offset; a file source without such a column counts its record numbers as arrival."""
    kind, _, rest = spec.partition(":")
    if kind == "kafka":
        bootstrap, _, topic = rest.rpartition("/")
        topic, _, since = topic.partition("@")
        starting = int(since) if since else starting
        df = SC.kafka_text_stream(spark, bootstrap, topic, starting).withColumn("arrival_ms", F.unix_millis("kafka_ts"))
        return df.withColumnRenamed("rec_id", "seq") if "seq" in schema else df
    if kind == "files":
        df = SC.file_text_stream(spark, rest, "parquet", schema)
        number = next((c for c in ("seq", "rec_id") if c in df.columns), None)
        return df if number is None or "arrival_ms" in df.columns else df.withColumn("arrival_ms", F.col(number))
    raise ValueError(f"unknown source {spec!r}")


def write_output(df: DataFrame, batch_id: int, sink: str, name: str) -> None:
    """One named output of a micro-batch: JSON ``value`` records."""
    kind, _, rest = sink.partition(":")
    if kind == "kafka":
        SK.write_kafka_batch(CM.stamp(df.select("value"), batch_id, name, ["value"]), rest, TOPICS[name])
    elif kind == "files":
        SK.write_batch(df, f"{rest.rstrip('/')}/{TOPICS[name]}", batch_id)
    else:
        raise ValueError(f"unknown sink {sink!r}")


def _start(df: DataFrame, name: str, ckpt: str, fn, trigger: dict | None) -> StreamingQuery:
    w = df.writeStream.option("checkpointLocation", f"{ckpt}/{name}").foreachBatch(fn)
    return w.trigger(**(trigger or {"processingTime": "3 seconds"})).start()


def cdc_ingest(spark, source, sink, ckpt, trigger=None, databases=None, tables=None, snapshot=None, pk="id"):
    """Change feed -> normalised envelopes (CDC1) on ``ods_base_db``.  ``snapshot`` is the source of the chunk rows that
    ``connectors.snapshot_in_chunks`` writes; they come first or among the changes, and yield to newer ones."""
    feed = read_source(spark, source, CHANGE_SCHEMA)
    if snapshot:
        feed = J.handover_stream(feed.select("seq", "topic", "value"), read_source(spark, snapshot, "low long, topic string, value string"), pk)

    def split(df, batch_id):
        """Both outputs of a micro-batch from one read and one parse."""
        x = CDC.normalize_change_events(CDC.tag_dirty_changes(df, keep="_cv"), parsed="_cv").persist()
        try:
            good = SC.of_tables(x.where(F.col("reason").isNull()), databases, tables)
            write_output(CDC.envelope_json(good).select("seq", F.col("envelope").alias("value")), batch_id, sink, "db")
            write_output(x.where(F.col("reason").isNotNull()).select("seq", "reason", "value"), batch_id, sink, "db_dirty")
        finally:
            x.unpersist()

    return [_start(feed, "cdc", ckpt, split, trigger)]


def base_log(spark, source, sink, ckpt, trigger=None):
    """Entry A: dirty output, ``is_new`` repair, page / start / display outputs."""
    clean, dirty = J.parse_log_stream(read_source(spark, source, LINE_SCHEMA))
    repaired = J.repair_is_new_stream(clean)

    def split(df, batch_id):
        J.split_log_outputs(df, lambda out, name: write_output(out, batch_id, sink, name))

    return [_start(repaired, "main", ckpt, split, trigger),
            _start(dirty, "dirty", ckpt, lambda df, b: write_output(df, b, sink, "dirty"), trigger)]


def _typed_pages(spark, source):
    """(typed pages with their record's text, dirty records)."""
    clean, dirty = L.split_dirty(L.parse_app_log(read_source(spark, source, LINE_SCHEMA)))
    pages = L.page_logs(clean).select("rec_id", "mid", "ts_ms", "page_id", "last_page_id", "has_last_page", "value",
                                      F.col("rec_id").alias("arrival_ms"))
    return pages, dirty.select("rec_id", "value")


def unique_visit(spark, source, sink, ckpt, trigger=None, ttl_ms=J.PR.DAY_MS, zone="UTC"):
    """The whole record of every daily unique visit, and the dirty records.  The state's time to live (None: forever)
    needs a processing-time trigger."""
    pages, dirty = _typed_pages(spark, source)
    uv = J.unique_visit_stream(pages, ttl_ms=ttl_ms, zone=zone)
    return [_start(uv, "uv", ckpt, lambda df, b: write_output(df, b, sink, "uv"), trigger),
            _start(dirty, "uv-dirty", ckpt, lambda df, b: write_output(df, b, sink, "uv_dirty"), trigger)]


def jump_detail(spark, source, sink, ckpt, trigger=None, window_ms=10_000):
    """The whole record of every bounce, and the dirty records."""
    pages, dirty = _typed_pages(spark, source)
    b = J.bounce_stream(pages, window_ms)
    return [_start(b, "jump", ckpt, lambda df, bid: write_output(df, bid, sink, "jump"), trigger),
            _start(dirty, "jump-dirty", ckpt, lambda df, bid: write_output(df, bid, sink, "jump_dirty"), trigger)]


def base_db(spark, source, sink, ckpt, config_path=None, trigger=None, dim_schema=None, dim_root=None, config_source=None,
            apart_ms=60_000):
    """Entry B: route the normalised envelopes of ``ods_base_db`` (written by ``cdc-ingest``).

    With ``config_source``, the config feed is a stream beside the data (seq, value), and one stateful operator gives each
    record the config that arrived before it; the feeds may be ``apart_ms`` apart.  Else every batch routes with the latest
    config of ``config_path`` (parquet with ``seq, value`` config envelopes).  Topic records go to their own topics
    (``kafka:``) or topic folders (``files:``), dimensions to an upsert log under ``dim_root`` (by default the files
    sink, or a folder beside the checkpoint), all outputs of a batch under one commit record."""
    changes = CDC.filter_has_data(read_source(spark, source, "seq long, value string"))
    kind, _, root = sink.partition(":")
    publish = None
    if kind == "kafka":
        bootstrap, root = root, dim_root or f"{ckpt}/base-db"
        publish = lambda df: SK.write_kafka_batch(df.select("topic", "value", "key", "headers"), bootstrap)
    elif kind != "files":
        raise ValueError(f"unknown sink {sink!r}")
    out = dim_root or root
    if config_source:
        # arrival across two feeds is time: a topic's records by their timestamp, files by their number
        at = lambda df: df.withColumn("seq", F.col("arrival_ms")).select("seq", "value")
        routed = J.route_asof_stream(at(changes), at(read_source(spark, config_source, "seq long, value string")), apart_ms, envelopes=True)
        return [_start(routed, "route", ckpt, lambda df, b: J.write_routed(
            RT.tag_by_sink(J.routed_payload(df, envelopes=True)), b, out, "seq", publish), trigger)]
    q = J.routing_query(changes, lambda s: s.read.parquet(config_path), out, f"{ckpt}/route",
                        trigger or {"processingTime": "3 seconds"}, dim_schema=dim_schema, envelopes=True,
                        publish=publish)
    return [q]


def window_demo(spark, source, sink, ckpt, trigger=None, size="20 seconds", delay_ms=10_000,
                lateness_ms=60_000, arrival=False):
    """Score lines ``name,score,epoch_ms``: every firing of a window as ``start-end,key,sum,last time`` (allowed-late
    records fire again), and the late records, each to its topic or its folder under ``<root>/window-demo``.
    ``arrival=True`` takes windows of processing time instead, which nothing is late for."""
    scores = W.parse_scores(read_source(spark, source, LINE_SCHEMA)).drop("ts")
    size_ms = int(spark.sql(f"SELECT unix_millis(TIMESTAMP'1970-01-01 00:00:00 UTC' + INTERVAL {size})").first()[0])
    order = ("arrival_ms", "rec_id")          # timestamp, partition, offset
    kind, _, root = sink.partition(":")
    if arrival:
        sums = J.arrival_window_stream(scores, size_ms, order)
        text = W.bounds_text(sums.withColumn("last_time", TM.format_event_time("last_ts", millis=False)))
        return [_start(text.withColumnRenamed("text", "value"), "arrival", ckpt, lambda df, b: write_output(df, b, sink, "window"), trigger)]
    if kind == "files":
        return [WS.window_query(scores, f"{root.rstrip('/')}/window-demo", f"{ckpt}/window", size_ms, delay_ms, lateness_ms, order,
                                trigger=trigger or {"processingTime": "3 seconds"})]
    if kind != "kafka":
        raise ValueError(f"unknown sink {sink!r}")

    def publish(df, name):
        value = {WS.RESULTS: ("text", "window"), WS.LATE: ("value", "window_late")}[name]
        SK.write_kafka_batch(df.select(F.col(value[0]).alias("value"), "key", "headers"), root, TOPICS[value[1]])

    return [WS.window_query(scores, f"{ckpt}/window-state", f"{ckpt}/window", size_ms, delay_ms, lateness_ms, order, publish,
                            trigger or {"processingTime": "3 seconds"})]


def login_alert(spark, source, sink, ckpt, trigger=None, n=3):
    """JSON login events ``{userId, ipAddress, eventType, timestamp}``:
    ``n`` consecutive failures per user (strict contiguity)."""
    raw = read_source(spark, source, LINE_SCHEMA)
    ev = raw.select("rec_id", F.from_json("value", "userId string, ipAddress string, eventType string, "
                                                    "timestamp long").alias("e")).select("rec_id", "e.*")
    m = J.strict_times_stream(ev, F.col("eventType") == "fail", n, "userId", ts="timestamp", seq="rec_id")
    alert = m.select("key", "ts_list", F.concat(F.col("key"), F.lit(f" failed to log in {n} times in a row at: "),
                                                F.regexp_replace("ts_list", ",", ", ")).alias("value"))
    return [_start(alert, "alert", ckpt, lambda df, b: write_output(df, b, sink, "alert"), trigger)]


APPS = {"cdc-ingest": cdc_ingest, "base-log": base_log, "unique-visit": unique_visit,
        "jump-detail": jump_detail, "base-db": base_db, "window-demo": window_demo,
        "login-alert": login_alert}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="larkspur.apps")
    ap.add_argument("app", choices=sorted(APPS))
    ap.add_argument("--source", required=True)
    ap.add_argument("--sink", required=True)
    ap.add_argument("--checkpoint")
    ap.add_argument("--config-path", help="base-db: config envelopes (parquet)")
    ap.add_argument("--config-source", help="base-db: source of the config feed, for as-of routing")
    ap.add_argument("--apart-ms", type=int, default=60_000, help="base-db: how far data and config feed may be apart")
    ap.add_argument("--arrival", action="store_true", help="window-demo: windows of processing time")
    ap.add_argument("--window-ms", type=int, default=10_000, help="jump-detail: bounce window")
    ap.add_argument("--databases", nargs="*", help="cdc-ingest: databases to read")
    ap.add_argument("--tables", nargs="*", help="cdc-ingest: tables to read (db.table)")
    ap.add_argument("--snapshot", help="cdc-ingest: source of a snapshot's chunk rows")
    ap.add_argument("--pk", default="id", help="cdc-ingest: primary key of the snapshot's tables")
    ap.add_argument("--dim-root", help="base-db: folder of the dimension log")
    ap.add_argument("--zone", default="UTC", help="unique-visit: time zone of the days")
    ap.add_argument("--lateness-ms", type=int, default=60_000, help="window-demo: allowed lateness")
    ap.add_argument("--available-now", action="store_true", help="process what is there and stop")
    a = ap.parse_args(argv)
    spark = build_session(app=f"larkspur-{a.app}")
    ckpt = a.checkpoint or f"{checkpoint_root(spark)}/{a.app}"
    trigger = {"availableNow": True} if a.available_now else None
    kw = {}
    if a.app == "base-db":
        kw.update(config_path=a.config_path, dim_root=a.dim_root, config_source=a.config_source, apart_ms=a.apart_ms)
    if a.app == "cdc-ingest":
        kw.update(databases=a.databases, tables=a.tables, snapshot=a.snapshot, pk=a.pk)
    if a.app == "unique-visit":
        kw["zone"] = a.zone
    if a.app == "window-demo":
        kw.update(lateness_ms=a.lateness_ms, arrival=a.arrival)
    if a.app == "jump-detail":
        kw["window_ms"] = a.window_ms
    for q in APPS[a.app](spark, a.source, a.sink, ckpt, trigger, **kw):
        q.awaitTermination()


if __name__ == "__main__":
    main()
