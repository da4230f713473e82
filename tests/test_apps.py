"""The runnable applications on file sources and sinks."""

import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur import apps as A
from larkspur import catalog as C
from larkspur.operators import patterns as P
from larkspur.sources import commits as CM
from larkspur.sources import records as R
from larkspur.sources import sinks as SK
from larkspur.sources.tables import table
from tests.test_streaming import SF, _write_chunks

NOW = {"availableNow": True}


def _wait(qs):
    for q in qs:
        q.awaitTermination(300)
        assert q.exception() is None


def test_base_log_and_jump_detail_apps(spark, scratch):
    lines = R.app_log_lines(table(spark, SF, "events"), dirty=True).select("rec_id", "value")
    _write_chunks(lines, f"{scratch}/ods", ["rec_id"])
    _wait(A.base_log(spark, f"files:{scratch}/ods", f"files:{scratch}/dwd", f"{scratch}/ck1", NOW))
    page = spark.read.parquet(f"{scratch}/dwd/dwd_page_log")
    assert page.count() == C.page_log(spark, SF).where("rec_id % 10 != 0").count()
    assert spark.read.parquet(f"{scratch}/dwd/dwd_dirty_log").count() == lines.where("rec_id % 10 = 0").count()
    # the page topic feeds the bounce application
    os.makedirs(f"{scratch}/pages")
    _write_chunks(page.select("rec_id", "value"), f"{scratch}/pages", ["rec_id"], n=1)
    _wait(A.jump_detail(spark, f"files:{scratch}/pages", f"files:{scratch}/dwm", f"{scratch}/ck2", NOW,
                        window_ms=C.BOUNCE_WINDOW_MS))
    jump = spark.read.parquet(f"{scratch}/dwm/dwm_user_jump_detail")
    # the watermark stops at the last event, so all bounces that are older by the window are out; each is whole
    last = page.selectExpr("max(cast(get_json_object(value, '$.ts') as long))").first()[0]
    kept = R.page_log_typed(table(spark, SF, "events")).where("rec_id % 10 != 0")
    exp = P.bounce(kept.withColumn("arrival_ms", F.col("rec_id")), window_ms=C.BOUNCE_WINDOW_MS)
    done = f"ts_ms < {last - C.BOUNCE_WINDOW_MS}"
    assert sorted(map(tuple, jump.where(done).select("mid", "rec_id", "kind").collect())) == \
        sorted(map(tuple, exp.where(done).select("mid", "rec_id", "kind").collect()))
    texts = {r.rec_id: r.value for r in page.collect()}
    assert all(r.value == texts[r.rec_id] for r in jump.collect())


def test_cdc_ingest_and_base_db_apps(spark, scratch, monkeypatch):
    feed = C._change_feed(spark, SF).select("seq", "topic", "value")
    _write_chunks(feed, f"{scratch}/cdc", ["seq"], n=2)
    _wait(A.cdc_ingest(spark, f"files:{scratch}/cdc", f"files:{scratch}/ods", f"{scratch}/ck", NOW,
                       tables=["shop.orders"]))
    out = spark.read.parquet(f"{scratch}/ods/ods_base_db")
    assert out.count() == table(spark, SF, "orders").count()
    # ods_base_db feeds the routing application
    R.config_feed(table(spark, SF, "orders")).write.parquet(f"{scratch}/config")
    os.makedirs(f"{scratch}/ods_in")
    _write_chunks(out.select("seq", "value"), f"{scratch}/ods_in", ["seq"], n=2)
    _wait(A.base_db(spark, f"files:{scratch}/ods_in", f"files:{scratch}/dwd", f"{scratch}/ck2",
                    f"{scratch}/config", NOW))
    topics = spark.read.json(f"{scratch}/dwd/topics").select("topic", "value")
    exp = C.route_topic_value(spark, SF)
    assert sorted(map(tuple, topics.collect())) == sorted(map(tuple, exp.collect()))
    # the same records through a Kafka sink, whose writer is replaced here
    sent = []
    monkeypatch.setattr(A.SK, "write_kafka_batch", lambda df, bootstrap, topic=None: sent.extend(map(tuple, df.collect())))
    _wait(A.base_db(spark, f"files:{scratch}/ods_in", "kafka:broker:9092", f"{scratch}/ck3", f"{scratch}/config", NOW))
    assert sorted(r[:2] for r in sent) == sorted(map(tuple, exp.collect())) and len({r[2] for r in sent}) == len(sent)


def test_base_db_app_with_a_live_config_feed(spark, scratch):
    """Each record is routed by the config before it, with both feeds as streams; the commit record covers all outputs."""
    env = lambda i: '{"data":{"id":"%d","city":"c%d"},"operation":"create","dbname":"shop","table":"stores"}' % (i, i)
    cfg = lambda sink, cols, to: ('{"data":{"source_table":"stores","operate_type":"create","sink_type":"%s","sink_table":"%s",'  # noqa: E731
                                  '"sink_columns":"%s","sink_pk":"id","sink_extend":null},"type":"insert"}') % (sink, to, cols)
    rows = [(i, env(i)) for i in range(10, 50)] + [(10**6, env(0))]
    spark.createDataFrame(rows, "seq long, value string").repartition(4).write.parquet(f"{scratch}/ods")
    feed = [(15, cfg("kafka", "id", "dwd_store")), (25, cfg("kafka", "id,city", "dwd_store")), (35, cfg("hbase", "id,city", "dim_store"))]
    spark.createDataFrame(feed, "seq long, value string").repartition(3).write.parquet(f"{scratch}/cfg")
    _wait(A.base_db(spark, f"files:{scratch}/ods", f"files:{scratch}/out", f"{scratch}/ck", trigger=NOW,
                    config_source=f"files:{scratch}/cfg", apart_ms=10_000))
    got = {r.value for r in CM.read_output(spark, f"{scratch}/out", "topics", "json").collect()}
    assert got == {'{"id":"%d"}' % i for i in range(16, 26)} | {'{"city":"c%d","id":"%d"}' % (i, i) for i in range(26, 36)}
    dims = {r.pk: r.data for r in SK.read_dimension(spark, f"{scratch}/out/dims").collect()}
    assert set(dims) == {str(i) for i in range(36, 50)} and dims["40"] == {"id": "40", "city": "c40"}


def test_window_demo_app(spark, scratch, monkeypatch):
    lines = R.score_lines(table(spark, SF, "events")).select(F.col("seq").alias("rec_id"), "value", "arrival_ms")
    # files in arrival order, numbered in it: the app's order is that of the record numbers
    _write_chunks(lines.withColumn("rec_id", F.row_number().over(Window.orderBy("arrival_ms", "rec_id")).cast("long")).select("rec_id", "value"),
                  f"{scratch}/in", ["rec_id"], n=4)
    size = dict(size="1 day", delay_ms=C.DELAY_MS, lateness_ms=C.LATENESS_MS)
    _wait(A.window_demo(spark, f"files:{scratch}/in", f"files:{scratch}/out", f"{scratch}/ck", NOW, **size))
    out = CM.read_output(spark, f"{scratch}/out/window-demo", "results")
    late = CM.read_output(spark, f"{scratch}/out/window-demo", "late")
    n_late = C.late_classify(spark, SF).where("class = 'late'").count()
    assert late.count() == n_late > 0 and out.count() > 0
    name, start, text = out.select("name", "window_start_ms", "text").first()
    assert text.split(",")[1] == name and text.split(",")[0].count("-") == 5      # two dates and the dash between
    sent = {}
    monkeypatch.setattr(A.SK, "write_kafka_batch", lambda df, bootstrap, topic=None: sent.setdefault(topic, []).extend(df.collect()))
    _wait(A.window_demo(spark, f"files:{scratch}/in", "kafka:broker:9092", f"{scratch}/ck2", NOW, **size))
    assert len(sent["window_late"]) == n_late and sorted(r.value for r in sent["window_result"]) == sorted(r.text for r in out.collect())
    assert len({r.key for r in sent["window_result"]}) == out.count()


def test_login_alert_app(spark, scratch):
    rows = [(i, '{"userId":"%s","ipAddress":"ip","eventType":"%s","timestamp":%d}' % (u, t, ts))
            for i, (u, t, ts) in enumerate([("ann", "fail", 110), ("bob", "fail", 120), ("ann", "fail", 130), ("bob", "fail", 140),
                                            ("bob", "success", 150), ("ann", "fail", 160), ("bob", "fail", 170), ("zz", "success", 10 ** 9)])]
    spark.createDataFrame(rows, "rec_id long, value string").coalesce(1).write.parquet(f"{scratch}/in")
    _wait(A.login_alert(spark, f"files:{scratch}/in", f"files:{scratch}/out", f"{scratch}/ck", NOW))
    out = [r.value for r in spark.read.parquet(f"{scratch}/out/login_alert").collect()]
    assert out == ["ann failed to log in 3 times in a row at: 110, 130, 160"]


def test_unique_visit_app(spark, scratch):
    lines = R.app_log_lines(table(spark, SF, "events")).select("rec_id", "value")
    pages = lines.where(~F.col("value").contains('"start":'))
    _write_chunks(pages, f"{scratch}/pages", ["rec_id"], n=2)
    _wait(A.unique_visit(spark, f"files:{scratch}/pages", f"files:{scratch}/dwm", f"{scratch}/ck", NOW, ttl_ms=None))
    got = spark.read.parquet(f"{scratch}/dwm/dwm_unique_visit").select("mid", "day")
    # arrival = offset order here, so the in-order and exact forms agree
    from larkspur.operators import visits as V
    exp = V.unique_visit_exact(C._pages(spark, SF).withColumn("arrival_ms", F.col("rec_id"))).select("mid", "day")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
