"""Hand-derived cases (FIXTURES.md section 2) on the batch operators."""

import json

from pyspark.sql import functions as F

from larkspur.functions import json as J
from larkspur.operators import cdc as CDC
from larkspur.operators import logs as L
from larkspur.operators import patterns as P
from larkspur.operators import routing as RT
from larkspur.operators import visits as V
from larkspur.operators import windows as W


def _lines(spark, recs):
    return spark.createDataFrame([(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(recs)],
                                 "rec_id long, value string")


def _log(mid, ts, is_new="0", **kw):
    r = {"common": {"mid": mid, "is_new": is_new}, "ts": ts}
    r.update(kw)
    return r


# ------------------------------------------------------------------ CEP demo
# Two accounts interleaved: "ann" fails three times running, "bob" is interrupted by a success.
LOGINS = [("ann", "10.1.0.1", "fail", 110), ("bob", "10.2.0.1", "fail", 120), ("ann", "10.1.0.1", "fail", 130),
          ("ann", "10.1.0.9", "fail", 170), ("bob", "10.2.0.1", "ok", 180), ("bob", "10.2.0.1", "fail", 190),
          ("bob", "10.2.0.4", "fail", 250)]


def _logins(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                                 "user_id string, ip_address string, event_type string, timestamp long, seq long")


def test_three_failed_logins(spark):
    m = P.strict_times(_logins(spark, LOGINS), F.col("event_type") == "fail", 3, "user_id", "timestamp", "seq")
    got = [(r.user_id, r.e1.timestamp, r.e2.timestamp, r.e3.timestamp) for r in m.collect()]
    assert got == [("ann", 110, 130, 170)]


def test_four_failures_overlap(spark):
    rows = [("u", "ip", "fail", t) for t in (1, 2, 3, 4)]
    m = P.strict_times(_logins(spark, rows), F.col("event_type") == "fail", 3, "user_id", "timestamp", "seq")
    assert sorted((r.e1.timestamp, r.e3.timestamp) for r in m.collect()) == [(1, 3), (2, 4)]


def test_strict_runs(spark):
    runs = P.strict_runs(_logins(spark, LOGINS), F.col("event_type") == "fail", "user_id", "timestamp", "seq")
    got = sorted((r.user_id, r.run_start_ts, r.run_end_ts, r.run_len) for r in runs.collect())
    assert got == [("ann", 110, 170, 3), ("bob", 120, 120, 1), ("bob", 190, 250, 2)]


# ---------------------------------------------------------------- log layer
def test_is_new_repair(spark):
    recs = [_log("a", 1, "1"), _log("a", 2, "0"), _log("a", 3, "1"), _log("a", 4, "1"),
            _log("b", 1, "0"), _log("b", 2, "1"), _log("b", 3, "1")]
    p = L.repair_is_new(L.parse_app_log(_lines(spark, recs)))
    got = [r.is_new for r in p.orderBy("rec_id").collect()]
    assert got == ["1", "0", "0", "0", "0", "1", "0"]


def test_start_null_and_displays(spark):
    recs = ['{"common":{"mid":"a","is_new":"0"},"start":null,"ts":1}',
            _log("a", 2, start={"entry": "icon"}, displays=[{"item": "x"}]),
            _log("a", 3, page={"page_id": "home"}, displays=[{"item": "p"}, {"item": "q"}])]
    p = L.parse_app_log(_lines(spark, recs))
    assert [r.rec_id for r in L.start_logs(p).orderBy("rec_id").collect()] == [0, 1]
    pages = L.page_logs(p)
    assert [r.rec_id for r in pages.collect()] == [2]
    d = L.display_logs(pages).collect()
    assert sorted((r.page_id, r.item) for r in d) == [("home", "p"), ("home", "q")]
    assert json.loads(d[0].value)["page_id"] == "home"


def test_dirty_records(spark):
    recs = ["{bad", "", '{"a":1,"a":2}', "[1,2]", '{"common":{"mid":"a"},"ts":5}',
            '{"common":{"is_new":"1"},"ts":5}']
    p = L.parse_app_log(_lines(spark, recs))
    main, dirty = L.split_dirty(p)
    assert [r.rec_id for r in main.collect()] == [4]
    assert sorted(r.rec_id for r in dirty.collect()) == [0, 1, 2, 3, 5]


# ------------------------------------------------------------ unique visit
def _pages(spark, rows):
    """rows: (mid, ts_ms, last_page) with last_page None = absent."""
    recs = []
    for mid, ts, last in rows:
        page = {"page_id": "p"}
        if last is not None:
            page["last_page_id"] = last
        recs.append(_log(mid, ts, page=page))
    p = L.page_logs(L.parse_app_log(_lines(spark, recs)))
    return p.withColumn("arrival_ms", F.col("rec_id"))


DAY = 86_400_000


def test_unique_visit(spark):
    rows = [("a", 1 * DAY + 5, None), ("a", 1 * DAY + 9, None), ("a", 2 * DAY, None), ("a", 3 * DAY, "home")]
    got = sorted(r.rec_id for r in V.unique_visit(_pages(spark, rows)).collect())
    assert got == [0, 2]
    assert sorted(r.rec_id for r in V.unique_visit_exact(_pages(spark, rows)).collect()) == [0, 2]


def test_unique_visit_out_of_order_exact(spark):
    rows = [("a", 1 * DAY, None), ("a", 2 * DAY, None), ("a", 1 * DAY + 7, None)]
    assert sorted(r.rec_id for r in V.unique_visit_exact(_pages(spark, rows)).collect()) == [0, 1, 2]
    assert sorted(r.rec_id for r in V.unique_visit(_pages(spark, rows)).collect()) == [0, 1]


def test_unique_visit_empty_last_page_is_not_entry(spark):
    assert V.unique_visit(_pages(spark, [("a", DAY, "")])).count() == 0


# ------------------------------------------------------------------- bounce
def _bounce(spark, rows, w=10_000):
    return sorted((r.rec_id, r.kind) for r in P.bounce(_pages(spark, rows), window_ms=w).collect())


def test_bounce_empty_last_page_is_entry(spark):
    assert _bounce(spark, [("a", 0, "")]) == [(0, "timeout")]


def test_bounce_timing(spark):
    assert _bounce(spark, [("a", 0, None), ("a", 9_999, "home")]) == []
    assert _bounce(spark, [("a", 0, None), ("a", 10_000, "home")]) == [(0, "timeout")]


def test_bounce_chain(spark):
    assert _bounce(spark, [("a", 0, None), ("a", 3000, None), ("a", 6000, None)]) == \
        [(0, "matched"), (1, "matched"), (2, "timeout")]


# ------------------------------------------------------------ CDC / routing
def test_cdc_delete_has_empty_data(spark):
    ev = {"before": {"id": 1}, "after": None, "op": "d", "source": {"db": "shop", "table": "t"}}
    df = spark.createDataFrame([("x.shop.t", json.dumps(ev))], "topic string, value string")
    r = CDC.normalize_change_events(df).collect()[0]
    assert (r.operation, r.dbname, r.table, len(r.data)) == ("delete", "shop", "t", 0)


def _cfg_feed(spark, rows):
    recs = []
    for seq, st, op, sink, table, cols in rows:
        data = {"source_table": st, "operate_type": op, "sink_type": sink, "sink_table": table,
                "sink_columns": cols, "sink_pk": None, "sink_extend": None}
        recs.append((seq, json.dumps({"data": data, "type": "insert", "database": "c", "table": "table_process"})))
    return spark.createDataFrame(recs, "seq long, value string")


def _data(spark, rows):
    recs = []
    for seq, table, op, data in rows:
        recs.append((seq, "s.db." + table, json.dumps({"before": None, "after": data, "op": op,
                                                          "source": {"db": "db", "table": table}})))
    return CDC.normalize_change_events(spark.createDataFrame(recs, "seq long, topic string, value string"))


def test_route_miss_and_unknown_sink(spark):
    cfg = RT.config_versions(_cfg_feed(spark, [(1, "t", "create", "clickhouse", "x", "id")]))
    data = _data(spark, [(5, "t", "c", {"id": 1}), (6, "u", "c", {"id": 2})])
    r = RT.route_latest(data, RT.latest_config(cfg))
    k, h = RT.split_by_sink(r)
    assert k.count() == 0 and h.count() == 0


def test_route_arrival_order(spark):
    cfg = RT.config_versions(_cfg_feed(spark, [(15, "t", "create", "kafka", "out", "id")]))
    data = _data(spark, [(10, "t", "c", {"id": 1}), (20, "t", "c", {"id": 2})])
    latest = RT.route_latest(data, RT.latest_config(cfg))
    asof = RT.route_asof(data, cfg)
    assert sorted(r.seq for r in latest.collect()) == [10, 20]
    assert [r.seq for r in asof.collect()] == [20]


def test_column_pruning_no_trim(spark):
    data = _data(spark, [(1, "t", "c", {"id": 1, "name": "n", "z": 0})])
    a = data.select(F.map_keys(J.prune_columns(F.col("data"), F.lit("id,name"))).alias("k")).first().k
    b = data.select(F.map_keys(J.prune_columns(F.col("data"), F.lit("id, name"))).alias("k")).first().k
    assert sorted(a) == ["id", "name"] and b == ["id"]


def test_config_ddl_sample(spark):
    sample = ('{"operate_type":"insert","sink_type":"hbase","sink_table":"dim_warehouse","source_table":"warehouse",'
              '"sink_extend":" SALT_BUCKETS = 2","sink_pk":"code","sink_columns":"code,city,opened"}')
    feed = spark.createDataFrame([(1, '{"data":' + sample + ',"type":"insert"}')], "seq long, value string")
    ddl = RT.ddl_text(RT.config_versions(feed), schema="S").first().ddl
    assert ddl == ("create table if not exists S.dim_warehouse(code varchar primary key,city varchar,opened varchar)"
                   " SALT_BUCKETS = 2")


def test_asof_config_stays_one_entry_a_version(spark):
    """200 keys x 50 versions: the joined config side holds every version once, and each record its own version."""
    feed = [(k * 1000 + v * 10, f"t{k}", v) for k in range(200) for v in range(50)]
    versions = spark.createDataFrame(feed, "seq long, source_table string, v int").selectExpr(
        "seq", "source_table", "'create' operate_type", "'kafka' sink_type", "concat('s', v) sink_table", "'id' sink_columns",
        "'id' sink_pk", "cast(null as string) sink_extend")
    data = _data(spark, [(3 * 1000 + 15, "t3", "c", {"id": 1}), (5 * 1000, "t5", "c", {"id": 2}), (5 * 1000 + 1, "t5", "c", {"id": 3})])
    got = sorted((r["seq"], r.sink_table) for r in RT.route_asof(data, versions).collect())
    assert got == [(3015, "s1"), (5001, "s0")]


def test_strict_config_decode(spark):
    feed = spark.createDataFrame([(1, '{"data":{"source_table":"t","operate_type":"create","bogus":1}}'),
                                  (2, '{"data":{},"type":"delete"}')], "seq long, value string")
    assert [r.accepted for r in RT.decode_config_feed(feed).orderBy("seq").collect()] == [False, False]


# ------------------------------------------------------------------ windows
def test_late_data_classes(spark):
    # 20 s windows, 10 s out-of-orderness, 60 s lateness, arrivals in this order
    arrivals = [1_000, 25_000, 31_000, 5_000, 95_000, 6_000]
    df = spark.createDataFrame([("k", 1, t, i, i) for i, t in enumerate(arrivals)],
                               "name string, score long, ts_ms long, arrival_ms long, seq long")
    c = W.classify_lateness(df, 20_000, 10_000, 60_000)
    got = {r.ts_ms: (r["class"], r.wm_before) for r in c.collect()}
    assert got[5_000] == ("refire", 20_999)
    assert got[6_000] == ("late", 84_999)
    assert got[1_000][0] == "on_time" and got[95_000][0] == "on_time"
    fires = W.refire_results(c).where("window_start_ms = 0").orderBy("fire_no").collect()
    assert [(r.fire_no, r.n_rows) for r in fires] == [(0, 1), (1, 2)]


def test_union_of_branches_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "i long, k string")
    u = P.union_of_branches(df, F.col("k") == "a", F.col("i") >= 1)
    assert sorted(r.i for r in u.collect()) == [1, 1, 2, 3, 3]


def test_typed_schemas_agree_with_variant_parse(spark):
    from larkspur import schemas as SC
    recs = [_log("a", 7, "1", page={"page_id": "home", "last_page_id": "x"}, displays=[{"item": "p"}]),
            '{"name":"n","age":22,"student":{"name":"n","age":22}}']
    df = _lines(spark, recs[:1])
    typed = df.select(F.from_json("value", SC.APP_LOG).alias("r")).select("r.common.mid", "r.ts", "r.page.page_id")
    v = L.parse_app_log(df).select("mid", "ts_ms", "page_id")
    assert tuple(typed.first()) == tuple(v.first()) == ("a", 7, "home")
    st = _lines(spark, recs[1:]).select(F.from_json("value", SC.STUDENT).alias("s")).first().s
    assert (st.name, st.age, st.student.age) == ("n", 22, 22)
    assert _lines(spark, recs[1:]).select(F.array_join(J.object_keys("value"), ",")).first()[0] == "name,age,student"


def test_strict_parse_fails_on_bad_record(spark):
    import pytest
    with pytest.raises(Exception):
        _lines(spark, ["{bad"]).select(J.parse_strict("value")).collect()


def test_insert_alias_is_opt_in(spark):
    feed = _cfg_feed(spark, [(1, "t", "insert", "kafka", "out", "id")])
    data = _data(spark, [(5, "t", "c", {"id": 1})])
    exact = RT.route_latest(data, RT.latest_config(RT.config_versions(feed)))
    alias = RT.route_latest(data, RT.latest_config(RT.config_versions(feed, RT.INSERT_AS_CREATE)))
    assert exact.count() == 0 and alias.count() == 1
