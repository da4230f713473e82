"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each reading whole tables.

The matching DuckDB SQL lives in ``larkspur.oracle``; column names and
types are aligned (bigint / string / boolean only, epoch ms for times).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import json as J
from larkspur.functions import text as TX
from larkspur.functions import time as TM
from larkspur.operators import cdc as CDC
from larkspur.operators import handover as HO
from larkspur.operators import logs as L
from larkspur.operators import patterns as P
from larkspur.operators import routing as RT
from larkspur.operators import visits as V
from larkspur.operators import windows as W
from larkspur.sources import connectors as SC
from larkspur.sources import records as R
from larkspur.sources.tables import table

# Test-data scale parameters (the source pipeline uses 10 s; user gaps in
# the generated events are hours, see FIXTURES.md).
BOUNCE_WINDOW_MS = 14_400_000
ZONE = "Asia/Shanghai"
ALERT_RUN, ALERT_WITHIN_MS = 3, 36 * 3_600_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --------------------------------------------------------------- shared inputs
def _events(spark, d):
    return table(spark, d, "events")


def _parsed(spark, d, dirty=False):
    return L.parse_app_log(R.app_log_lines(_events(spark, d), dirty))


def _clean(spark, d):
    return L.split_dirty(_parsed(spark, d))[0]


def _pages(spark, d):
    """dwd_page_log: the typed page-log layer read by the DWM operators."""
    return R.page_log_typed(_events(spark, d))


def _logins(spark, d):
    return R.login_events(_events(spark, d))


# ------------------------------------------------------------------ log layer
@query
def json_dirty_split(spark, d):
    logs = _parsed(spark, d, dirty=True).select(
        F.lit("log").alias("source"), "rec_id",
        F.when(F.col("dirty"), "dirty").otherwise("main").alias("stream"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("rec_id"), F.col("text").alias("value"))
    docs = L.parse_app_log(docs).select(
        F.lit("doc").alias("source"), "rec_id",
        F.when(F.col("dirty"), "dirty").otherwise("main").alias("stream"))
    return logs.unionByName(docs)


@query
def json_extract_paths(spark, d):
    return _clean(spark, d).select("rec_id", "mid", "is_new", "ts_ms", "is_start", "page_id",
                                   "last_page_id", "has_last_page")


@query
def is_new_repair(spark, d):
    x = L.repair_is_new(_clean(spark, d).withColumnRenamed("is_new", "is_new_raw"),
                        flag="is_new_raw", order=("rec_id",), out="is_new")
    return x.select("rec_id", "mid", "is_new_raw", "is_new")


def _repaired(spark, d):
    return L.repair_is_new(_clean(spark, d), order=("rec_id",))


@query
def start_log(spark, d):
    s = L.start_logs(_repaired(spark, d))
    return s.select("rec_id", "mid", "is_new", "ts_ms",
                    F.is_variant_null(F.try_variant_get(F.col(L.VARIANT_COL), "$.start", "variant"))
                    .alias("start_is_null"))


@query
def page_log(spark, d):
    p = L.page_logs(_repaired(spark, d))
    arr = F.try_variant_get(F.col(L.VARIANT_COL), "$.displays", "array<variant>")
    return p.select("rec_id", "mid", "is_new", "ts_ms", "page_id", "last_page_id",
                    F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr)).cast("bigint").alias("n_displays"))


@query
def displays_explode(spark, d):
    return L.display_logs(L.page_logs(_clean(spark, d)))


@query
def log_split_counts(spark, d):
    logs = _clean(spark, d)
    arr = F.try_variant_get(F.col(L.VARIANT_COL), "$.displays", "array<variant>")
    n_disp = F.when(F.col("is_start") | arr.isNull(), F.lit(0)).otherwise(F.size(arr))
    c = logs.agg(F.sum(F.col("is_start").cast("long")).alias("start"),
                 F.sum((~F.col("is_start")).cast("long")).alias("page"),
                 F.sum(n_disp.cast("long")).alias("display"))
    return c.select(F.explode(F.array(*[F.struct(F.lit(s).alias("stream"), F.col(s).alias("n"))
                                        for s in ("start", "page", "display")])).alias("r")).select("r.*")


@query
def json_set_field(spark, d):
    p = L.with_repaired_json(L.page_logs(_repaired(spark, d)))
    return p.select("rec_id", F.col("out_value").alias("value"))


# -------------------------------------------------------------- unique visit
@query
def unique_visit(spark, d):
    return V.unique_visit(_pages(spark, d))


@query
def unique_visit_exact(spark, d):
    return V.unique_visit_exact(_pages(spark, d))


# ------------------------------------------------------------------- bounce
_BOUNCE_COLS = ("mid", "rec_id", "ts_ms", "page_id", "kind", "next_ts")


@query
def bounce_all(spark, d):
    return P.bounce(_pages(spark, d), window_ms=BOUNCE_WINDOW_MS).select(*_BOUNCE_COLS)


@query
def bounce_matched(spark, d):
    m, _ = P.bounce_branches(_pages(spark, d), window_ms=BOUNCE_WINDOW_MS)
    return m.select(*_BOUNCE_COLS)


@query
def bounce_timeout(spark, d):
    _, t = P.bounce_branches(_pages(spark, d), window_ms=BOUNCE_WINDOW_MS)
    return t.select(*_BOUNCE_COLS)


@query
def bounce_branches_union(spark, d):
    b = P.bounce(_pages(spark, d), window_ms=BOUNCE_WINDOW_MS).select(*_BOUNCE_COLS)
    return P.union_of_branches(b, F.col("kind") == P.MATCHED, F.col("kind") == P.TIMEOUT)


@query
def union_overlapping(spark, d):
    """UNI1 over two inputs that share rows: a failed login of a new user comes twice."""
    x = _logins(spark, d).select("user_id", "event_type", "seq")
    new = _pages(spark, d).where(F.col("is_new") == "1").select(
        F.col("mid").alias("user_id"), F.when(F.col("page_id") == R.FAIL_EVENT, F.lit("fail"))
        .otherwise(F.col("page_id")).alias("event_type"), F.col("rec_id").alias("seq"))
    return P.union_branches(x.where(_fail()), new)


# ---------------------------------------------------------- login patterns
def _fail():
    return F.col("event_type") == "fail"


@query
def login_fail_alert(spark, d):
    m = P.strict_times(_logins(spark, d), _fail(), ALERT_RUN, "user_id", "timestamp", "seq")
    t = [F.col(f"e{i}.timestamp") for i in (1, 2, 3)]
    alert = F.concat(F.col("user_id"), F.lit(" failed to log in 3 times in a row at: "),
                     F.concat_ws(", ", *[c.cast("string") for c in t]))
    return m.select("user_id", t[0].alias("t1"), t[1].alias("t2"), t[2].alias("t3"), alert.alias("alert"))


@query
def strict_times_n(spark, d):
    m = P.strict_times(_logins(spark, d), _fail(), ALERT_RUN, "user_id", "timestamp", "seq")
    ts = [F.col(f"e{i}.timestamp").cast("string") for i in range(1, ALERT_RUN + 1)]
    return m.select("user_id", F.col("e1.seq").alias("first_seq"), F.col("e1.timestamp").alias("first_ts"),
                    F.col(f"e{ALERT_RUN}.timestamp").alias("last_ts"), F.concat_ws(",", *ts).alias("ts_list"))


def _within(spark, d, kind):
    m = P.strict_times_within(_logins(spark, d), _fail(), ALERT_RUN, "user_id", "timestamp", "seq", ALERT_WITHIN_MS)
    events = F.filter(F.array(*[F.col(f"e{i}") for i in range(1, ALERT_RUN + 1)]), lambda e: e.isNotNull())
    return m.where(F.col("kind") == kind).select(
        "user_id", F.col("e1.seq").alias("first_seq"), F.col("length").cast("bigint").alias("length"),
        F.array_join(F.transform(events, lambda e: e["timestamp"].cast("string")), ",").alias("ts_list"))


@query
def strict_times_within(spark, d):
    return _within(spark, d, P.MATCHED)


@query
def strict_times_timeout(spark, d):
    return _within(spark, d, P.TIMEOUT)


@query
def strict_runs(spark, d):
    return P.strict_runs(_logins(spark, d), _fail(), "user_id", "timestamp", "seq")


# ------------------------------------------------------- strings and dates
@query
def epoch_to_day(spark, d):
    e = R.events_base(_events(spark, d))
    return e.select("event_id", "ts_ms", TM.epoch_to_day("ts_ms").alias("day"))


@query
def epoch_to_day_zone(spark, d):
    e = R.events_base(_events(spark, d))
    return e.select("event_id", TM.epoch_to_day("ts_ms", ZONE).alias("day"),
                    TM.format_event_time("ts_ms", millis=False, zone=ZONE).alias("event_time"))


@query
def format_event_time(spark, d):
    e = R.events_base(_events(spark, d))
    return e.select("event_id", TM.format_event_time("ts_ms").alias("event_time"),
                    TM.format_event_time("ts_ms", millis=False).alias("event_time_s"))


@query
def csv_parse(spark, d):
    s = R.score_lines(_events(spark, d))
    return s.select("seq", TX.csv_field("value", 0).alias("name"),
                    TX.csv_field("value", 1).cast("bigint").alias("score"),
                    TX.csv_field("value", 2).cast("bigint").alias("epoch_ms"))


# ------------------------------------------------------- CDC and routing

FROM_TS_MS = 1_705_276_800_000  # 2024-01-15 00:00:00 UTC
PRUNE_LISTS = ("o_orderkey,o_custkey,l_orderkey,l_partkey", "o_orderkey, o_custkey,l_quantity, l_partkey",
               "o_totalprice,o_orderstatus,missing,l_shipdate,l_returnflag")


def _ord(seq, shipdate=None, line=None, part=None, supp=None, price=None):
    def n(c, t):
        return F.col(c) if c else F.lit(None).cast(t)
    return F.struct(F.col(seq).alias("seq"), n(shipdate, "timestamp_ntz").alias("l_shipdate"),
                    n(line, "int").alias("l_linenumber"), n(part, "bigint").alias("l_partkey"),
                    n(supp, "bigint").alias("l_suppkey"), n(price, "double").alias("l_extendedprice"))


def _change_feed(spark, d):
    """Raw change events of orders + lineitem with a total arrival order ``ord``."""
    o = R.order_change_events(table(spark, d, "orders")).withColumn("ord", _ord("seq"))
    li = R.lineitem_change_events(table(spark, d, "lineitem"))
    li = li.withColumn("ord", _ord("seq", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
                                   "l_extendedprice")).select("seq", "topic", "value", "ord")
    return o.unionByName(li)


def _normalized(spark, d):
    return CDC.normalize_change_events(_change_feed(spark, d))


def _data_json(c="data"):
    return F.to_json(c)


def _kept(c="data"):
    return F.array_join(F.sort_array(F.map_keys(F.col(c))), ",")


def _versions(spark, d):
    return RT.config_versions(R.config_feed(table(spark, d, "orders")))


@query
def cdc_normalize(spark, d):
    n = _normalized(spark, d)
    return n.select("table", "seq", "operation", "dbname", F.size("data").cast("bigint").alias("n_keys"),
                    _data_json().alias("data_json"))


@query
def cdc_topic_split(spark, d):
    f = R.sharded_topics(table(spark, d, "orders"), table(spark, d, "lineitem"))
    db, tb = TX.topic_db_table("topic")
    return f.select("seq", db.alias("db"), tb.alias("tbl"))


@query
def cdc_dirty_split(spark, d):
    x = CDC.tag_dirty_changes(R.broken_change_events(table(spark, d, "orders")))
    return x.select("seq", F.coalesce("reason", F.lit("main")).alias("stream"))


@query
def cdc_snapshot(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = CDC.normalize_change_events(CDC.snapshot_events(rows, R.CDC_DB, "customer"))
    return n.select("topic", "operation", "dbname", "table", _data_json().alias("data_json"))


def _handover(spark, d):
    items = table(spark, d, "lineitem")
    return HO.handover(R.order_snapshot_chunks(table(spark, d, "orders"), items), R.order_state_changes(items), ["state"])


@query
def cdc_handover(spark, d):
    return _handover(spark, d)


@query
def cdc_handover_state(spark, d):
    return HO.current_rows(_handover(spark, d), ["state"])


@query
def change_feed_tables(spark, d):
    feed = SC.change_feed(_change_feed(spark, d), tables=["shop.lineitem", "shop.customer"])
    return feed.select("seq", "topic")


@query
def filter_has_data(spark, d):
    env = CDC.with_data(R.cdc_envelopes(table(spark, d, "orders")))
    v = F.col("_dv")
    return env.select("seq", F.try_variant_get(v, "$.operation", "string").alias("operation"),
                      F.try_variant_get(v, "$.data.o_orderstatus", "string").alias("status"))


@query
def src_from_timestamp(spark, d):
    e = CDC.from_timestamp(_events(spark, d), "ts", FROM_TS_MS)
    return e.select("event_id", TM.ntz_to_ms(F.col("ts")).alias("ts_ms"))


@query
def decode_config(spark, d):
    return RT.decode_config_feed(R.config_feed(table(spark, d, "orders")))


@query
def config_latest(spark, d):
    return RT.latest_config(_versions(spark, d))


@query
def config_ddl_text(spark, d):
    own = RT.config_versions(R.dimension_config_feed(table(spark, d, "customer")))
    return RT.ddl_text(_versions(spark, d).unionByName(own)).select("seq", "sink_table", "ddl")


_ROUTE_COLS = ("table", "seq", "operation", "sink_type", "sink_table")


def _routed_latest(spark, d):
    return RT.route_latest(_normalized(spark, d), RT.latest_config(_versions(spark, d)))


def _kafka_hbase(routed):
    """Both sink outputs in one pass (a union of the two splits would
    evaluate the routing plan twice)."""
    return routed.where(F.col("sink_type").isin(RT.SINK_KAFKA, RT.SINK_HBASE))


@query
def route_latest(spark, d):
    r = _kafka_hbase(_routed_latest(spark, d))
    return r.select(*_ROUTE_COLS, _kept().alias("kept_keys"), _data_json().alias("data_json"))


@query
def route_asof(spark, d):
    # only what is routed travels with the records: the merge deals all of them out by arrival
    n = _normalized(spark, d).select("table", "seq", "operation", "data")
    r = _kafka_hbase(RT.route_asof(n, _versions(spark, d)))
    return r.select(*_ROUTE_COLS, "cfg_seq", _kept().alias("kept_keys"), _data_json().alias("data_json"))


@query
def route_sink_split(spark, d):
    both = RT.tag_by_sink(_routed_latest(spark, d))
    return both.groupBy("stream", "sink_type", "sink_table").agg(F.count(F.lit(1)).alias("n"))


@query
def route_topic_value(spark, d):
    k, _ = RT.split_by_sink(_routed_latest(spark, d))
    return RT.topic_value(k)


@query
def dim_upsert_latest(spark, d):
    _, h = RT.split_by_sink(_routed_latest(spark, d))
    dims = RT.dim_upsert_latest(h, "ord")
    return RT.dim_columns(dims, R.LINEITEM_DIM_COLUMNS.split(","))


@query
def map_prune_columns(spark, d):
    n = _normalized(spark, d)
    key = (F.col("seq") / 10).cast("bigint")
    lists = F.when(key % 3 == 0, F.lit(PRUNE_LISTS[0])).when(key % 3 == 1, F.lit(PRUNE_LISTS[1])) \
        .otherwise(F.lit(PRUNE_LISTS[2]))
    p = n.select("table", "seq", J.prune_columns(F.col("data"), lists).alias("pruned"))
    return p.select("table", "seq", _kept("pruned").alias("kept_keys"), F.size("pruned").cast("bigint").alias("n_keys"))


@query
def json_strict_parse(spark, d):
    x = J.with_parsed(R.app_log_lines(_events(spark, d)), "value", "v", strict=True)
    v = F.col("v")
    return x.select("rec_id", J.path(v, "$.common.mid").alias("mid"), J.path(v, "$.page.page_id").alias("page_id"),
                    J.path(v, "$.ts", "bigint").alias("ts_ms"))


@query
def json_round_trip(spark, d):
    x = J.with_parsed(R.app_log_lines(_events(spark, d)), "value", "v")
    once = x.select("rec_id", F.to_json(J.set_nested_field(F.col("v"), "common", "ch", F.lit("web"))).alias("text"))
    again = J.with_parsed(once, "text", "v2", strict=True)
    return again.select("rec_id", F.to_json("v2").alias("value"))


@query
def json_object_keys(spark, d):
    lines = R.app_log_lines(_events(spark, d))
    return lines.select("rec_id", F.array_join(F.json_object_keys("value"), ",").alias("keys"))


# ------------------------------------------------------- windows and lateness

DAY_MS, HOUR_MS = 86_400_000, 3_600_000
WINDOW_SIZE, SLIDE = "1 day", "6 hours"          # reference: 20 s, 20 s / 5 s
DELAY_MS, LATENESS_MS = HOUR_MS, 6 * HOUR_MS     # reference: 10 s, 1 min


def _scores(spark, d):
    return W.parse_scores(R.score_lines(_events(spark, d)))


@query
def window_tumbling_sum(spark, d):
    return W.window_sum(_scores(spark, d), WINDOW_SIZE)


@query
def window_sliding_sum(spark, d):
    return W.window_sum(_scores(spark, d), WINDOW_SIZE, SLIDE)


@query
def window_ingest_tumbling(spark, d):
    s = _scores(spark, d).withColumn("ingest_ts", TM.ms_to_ts(F.col("arrival_ms")))
    return W.window_sum(s, WINDOW_SIZE, ts="ingest_ts")


@query
def window_sum_last(spark, d):
    return W.window_sum_last(_scores(spark, d), WINDOW_SIZE)


@query
def window_bounds_text(spark, d):
    t = W.bounds_text(W.window_sum_last(_scores(spark, d), WINDOW_SIZE))
    return t.select("name", "window_start_ms", "text")


def _classified(spark, d):
    return W.classify_lateness(_scores(spark, d), DAY_MS, DELAY_MS, LATENESS_MS)


@query
def late_classify(spark, d):
    return _classified(spark, d).select("seq", "name", "window_start_ms", "wm_before", "class")


@query
def watermark_per_record(spark, d):
    return W.watermarks(_scores(spark, d), DELAY_MS).select("seq", "wm_monotone", "wm_bounded")


@query
def window_refire(spark, d):
    return W.refire_results(_classified(spark, d))


@query
def order_time_parts(spark, d):
    o = table(spark, d, "orders")
    parts = TM.order_time_parts(F.col("o_orderdate"))
    return o.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@query
def cdc_envelope_json(spark, d):
    n = CDC.envelope_json(_normalized(spark, d))
    return n.select("table", "seq", "envelope")
