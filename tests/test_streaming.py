"""Stream == batch: replay derived records through the file-stream source
(several files, one per micro-batch) and compare with the batch operators."""

import os
import tempfile
import time

from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.sources import records as R
from larkspur.sources import sinks as SK
from larkspur.sources.tables import table
from larkspur.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def _write_chunks(df, path, order, n=4):
    """Write ``df`` as ``n`` parquet files in ``order`` with increasing mtimes
    (Spark writes them, so nested types keep their schema)."""
    from pyspark.sql import Window
    os.makedirs(path, exist_ok=True)
    total = df.count()
    size = -(-total // n)
    idx = df.withColumn("_i", F.row_number().over(Window.orderBy(*order)) - 1)  # small test input
    t0 = time.time() - 1000
    for i in range(n):
        tmp = tempfile.mkdtemp(prefix="chunk-", dir=os.path.dirname(path.rstrip("/"))) + "/d"
        idx.where((F.col("_i") >= i * size) & (F.col("_i") < (i + 1) * size)).drop("_i") \
            .coalesce(1).write.parquet(tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
        f = f"{path}/part-{i:03d}.parquet"
        os.rename(f"{tmp}/{part}", f)
        os.utime(f, (t0 + i, t0 + i))
    return df.schema


def _stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _memory(df, name, ckpt, mode="append", available_now=True, n_files=4):
    w = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", ckpt))
    if available_now:
        q = w.trigger(availableNow=True).start()
        q.awaitTermination(300)
    else:
        # processing-time state (TTL) keeps no-data batches running, so an
        # availableNow query would not end: wait for the input, then stop
        q = w.trigger(processingTime="1 second").start()
        deadline = time.time() + 120
        while time.time() < deadline:
            p = q.lastProgress
            if p and p["batchId"] >= n_files:   # one file per data batch, then no-data batches
                break
            time.sleep(1)
        q.stop()
    assert q.exception() is None
    return df.sparkSession.table(name)


def test_is_new_repair_stream(spark, scratch):
    lines = R.app_log_lines(table(spark, SF, "events"))
    schema = _write_chunks(lines, f"{scratch}/in", ["rec_id"])
    clean, _ = J.parse_log_stream(_stream(spark, f"{scratch}/in", schema))
    got = _memory(J.repair_is_new_stream(clean), "repair_s", f"{scratch}/ck")
    exp = C.is_new_repair(spark, SF)
    assert sorted(map(tuple, got.select("rec_id", "is_new").collect())) == \
        sorted(map(tuple, exp.select("rec_id", "is_new").collect()))


def test_base_log_query(spark, scratch):
    lines = R.app_log_lines(table(spark, SF, "events"), dirty=True)
    schema = _write_chunks(lines, f"{scratch}/in", ["rec_id"])
    main, dq = J.base_log_query(_stream(spark, f"{scratch}/in", schema), f"{scratch}/out", f"{scratch}/ck")
    main.awaitTermination(300)
    dq.awaitTermination(300)
    assert main.exception() is None and dq.exception() is None
    out = {k: spark.read.parquet(f"{scratch}/out/{k}") for k in ("start", "page", "display", "dirty")}
    assert out["dirty"].count() == lines.where("rec_id % 10 = 0").count()
    # batch form on the same (clean) records
    clean = C._clean(spark, SF)
    from larkspur.operators import logs as L
    rep = L.with_repaired_json(L.repair_is_new(clean.where("rec_id % 10 != 0"), order=("rec_id",)))
    exp_pages = L.page_logs(rep).select("rec_id", F.col("out_value").alias("value"))
    assert sorted(map(tuple, out["page"].select("rec_id", "value").collect())) == \
        sorted(map(tuple, exp_pages.collect()))
    assert out["start"].count() == L.start_logs(rep).count()
    assert out["display"].count() == L.display_logs(L.page_logs(rep)).count()


def test_unique_visit_stream(spark, scratch):
    pages = C._pages(spark, SF)
    schema = _write_chunks(pages, f"{scratch}/in", ["arrival_ms", "rec_id"])
    got = _memory(J.unique_visit_stream(_stream(spark, f"{scratch}/in", schema), ttl_ms=None), "uv_s",
                  f"{scratch}/ck")
    exp = C.unique_visit_exact(spark, SF)
    assert sorted(map(tuple, got.select("rec_id", "day").collect())) == \
        sorted(map(tuple, exp.select("rec_id", "day").collect()))


def test_unique_visit_dedup_stream(spark, scratch):
    pages = C._pages(spark, SF)
    schema = _write_chunks(pages, f"{scratch}/in", ["arrival_ms", "rec_id"])
    got = _memory(J.unique_visit_dedup_stream(_stream(spark, f"{scratch}/in", schema), "2 days"), "uv_dd",
                  f"{scratch}/ck")
    exp = C.unique_visit(spark, SF)
    assert sorted(map(tuple, got.select("mid", "day").collect())) == \
        sorted(map(tuple, exp.select("mid", "day").collect()))


def test_unique_visit_stream_with_ttl(spark, scratch):
    pages = C._pages(spark, SF)
    schema = _write_chunks(pages, f"{scratch}/in", ["arrival_ms", "rec_id"], n=2)
    got = _memory(J.unique_visit_stream(_stream(spark, f"{scratch}/in", schema)), "uv_ttl", f"{scratch}/ck",
                  available_now=False, n_files=2)
    assert got.count() == C.unique_visit_exact(spark, SF).count()


def test_bounce_stream(spark, scratch):
    pages = C._pages(spark, SF)
    schema = _write_chunks(pages, f"{scratch}/in", ["ts_ms", "rec_id"])
    # far-future sentinel of another key: advances the watermark so pending
    # timeouts fire at the end of the input (dropped from the comparison)
    far = pages.agg(F.max("ts_ms")).first()[0] + 10 * C.BOUNCE_WINDOW_MS
    sentinel = spark.createDataFrame([(-1, far, "~sentinel", "0", far, "click", "home", True)], schema)
    sentinel.coalesce(1).write.parquet(f"{scratch}/_sentinel")
    part = [f for f in os.listdir(f"{scratch}/_sentinel") if f.endswith(".parquet")][0]
    os.rename(f"{scratch}/_sentinel/{part}", f"{scratch}/in/part-999.parquet")
    got = _memory(J.bounce_stream(_stream(spark, f"{scratch}/in", schema), C.BOUNCE_WINDOW_MS),
                  "bounce_s", f"{scratch}/ck")
    exp = C.bounce_all(spark, SF)
    got_rows = sorted(map(tuple, got.where("mid != '~sentinel'").select("rec_id", "kind").collect()))
    assert got_rows == sorted(map(tuple, exp.select("rec_id", "kind").collect()))


def test_strict_times_stream(spark, scratch):
    logins = R.login_events(table(spark, SF, "events"))
    schema = _write_chunks(logins, f"{scratch}/in", ["timestamp", "seq"])
    far = logins.agg(F.max("timestamp")).first()[0] + 10 ** 9
    sentinel = spark.createDataFrame([("~sentinel", "ip", "view", far, -1)], schema)
    sentinel.coalesce(1).write.parquet(f"{scratch}/_sentinel")
    part = [f for f in os.listdir(f"{scratch}/_sentinel") if f.endswith(".parquet")][0]
    os.rename(f"{scratch}/_sentinel/{part}", f"{scratch}/in/part-999.parquet")
    s = _stream(spark, f"{scratch}/in", schema)
    got = _memory(J.strict_times_stream(s, F.col("event_type") == "fail", C.ALERT_RUN, "user_id",
                                        ts="timestamp"), "strict_s", f"{scratch}/ck")
    exp = C.strict_times_n(spark, SF)
    assert exp.count() > 0
    assert sorted(map(tuple, got.select("key", "first_seq", "ts_list").collect())) == \
        sorted(map(tuple, exp.select("user_id", "first_seq", "ts_list").collect()))


def test_window_stream_update_mode(spark, scratch):
    scores = C._scores(spark, SF).drop("ts")
    schema = _write_chunks(scores, f"{scratch}/in", ["arrival_ms", "seq"])
    s = _stream(spark, f"{scratch}/in", schema).withColumn("ts", F.timestamp_millis("ts_ms"))
    # delay + lateness above the 16 h disorder: nothing is dropped, so the last
    # update of every window equals the batch tumbling sum
    got = _memory(J.window_sum_stream(s, C.WINDOW_SIZE, C.HOUR_MS, 23 * C.HOUR_MS), "win_s",
                  f"{scratch}/ck", mode="update")
    last = got.groupBy("name", "window_start_ms").agg(F.max("score_sum").alias("score_sum"),
                                                      F.max("n").alias("n"))
    exp = C.window_tumbling_sum(spark, SF).select("name", "window_start_ms", "score_sum", "n")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, exp.collect()))


def test_late_split_stream(spark, scratch):
    scores = C._scores(spark, SF).drop("ts")
    schema = _write_chunks(scores, f"{scratch}/in", ["arrival_ms", "seq"], n=5)
    q = J.late_split_query(_stream(spark, f"{scratch}/in", schema), f"{scratch}/out", f"{scratch}/ck",
                           C.DAY_MS, C.DELAY_MS, C.LATENESS_MS)
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(f"{scratch}/out/main").unionByName(spark.read.parquet(f"{scratch}/out/late"))
    # per-record watermarks carried across batches: equal to the batch form
    exp = C.late_classify(spark, SF)
    assert {r.seq: r["class"] for r in got.collect()} == {r.seq: r["class"] for r in exp.collect()}
    assert exp.where("class = 'late'").count() > 0


def test_routing_query_and_restart(spark, scratch):
    feed = C._change_feed(spark, SF)
    schema = _write_chunks(feed, f"{scratch}/in", ["ord"])
    files = sorted(os.listdir(f"{scratch}/in"))
    # first run sees two files, the second run (same checkpoint) the rest
    os.makedirs(f"{scratch}/later")
    for f in files[2:]:
        os.rename(f"{scratch}/in/{f}", f"{scratch}/later/{f}")
    orders = lambda s: R.config_feed(table(s, SF, "orders"))
    for step in range(2):
        if step == 1:
            for f in files[2:]:
                os.rename(f"{scratch}/later/{f}", f"{scratch}/in/{f}")
        q = J.routing_query(_stream(spark, f"{scratch}/in", schema), orders, f"{scratch}/out", f"{scratch}/ck",
                            order="ord")  # total: the lineitems of an order share one seq
        q.awaitTermination(300)
        assert q.exception() is None
    topics = spark.read.json(f"{scratch}/out/topics").select("topic", "value")
    exp = C.route_topic_value(spark, SF)
    assert sorted(map(tuple, topics.collect())) == sorted(map(tuple, exp.collect()))
    dims = SK.read_dimension(spark, f"{scratch}/out/dims")
    got = {(r.sink_table, r.pk): r.data["l_partkey"] for r in dims.collect()}
    want = {(r.sink_table, r.pk): r.l_partkey for r in C.dim_upsert_latest(spark, SF).collect()}
    assert got == want
    m = spark.read.parquet(f"{scratch}/out/metrics").agg(F.sum("topic_records"), F.sum("dimension_records")).first()
    assert m[0] == exp.count() and m[1] == C.route_sink_split(spark, SF).where("stream = 'side'").agg(
        F.sum("n")).first()[0]
    SK.compact_dimension(spark, f"{scratch}/out/dims", 10**6)
    snap = SK.read_dimension(spark, f"{scratch}/out/dims_compact")
    assert {(r.sink_table, r.pk): r.data["l_partkey"] for r in snap.collect()} == want


def test_bounce_stream_restart(spark, scratch):
    """Buffered rows and pending partial matches live in the state store and
    survive a stop / restart from the same checkpoint."""
    pages = C._pages(spark, SF)
    schema = _write_chunks(pages, f"{scratch}/all", ["ts_ms", "rec_id"])
    far = pages.agg(F.max("ts_ms")).first()[0] + 10 * C.BOUNCE_WINDOW_MS
    spark.createDataFrame([(-1, far, "~sentinel", "0", far, "click", "home", True)], schema) \
        .coalesce(1).write.parquet(f"{scratch}/_sentinel")
    part = [f for f in os.listdir(f"{scratch}/_sentinel") if f.endswith(".parquet")][0]
    os.rename(f"{scratch}/_sentinel/{part}", f"{scratch}/all/part-999.parquet")
    files = sorted(os.listdir(f"{scratch}/all"))
    os.makedirs(f"{scratch}/in")
    for step, chunk in enumerate((files[:2], files[2:])):
        for f in chunk:
            os.rename(f"{scratch}/all/{f}", f"{scratch}/in/{f}")
        q = (J.bounce_stream(_stream(spark, f"{scratch}/in", schema), C.BOUNCE_WINDOW_MS)
             .writeStream.format("parquet").option("path", f"{scratch}/out")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination(300)
        assert q.exception() is None
    got = spark.read.parquet(f"{scratch}/out").where("mid != '~sentinel'").select("rec_id", "kind")
    exp = C.bounce_all(spark, SF).select("rec_id", "kind")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
