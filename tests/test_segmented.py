"""The segmented (hot-key split) plan must equal plain window functions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.plans import segmented as S


def _data(spark, n=600, keys=4, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, keys)   # key 0 is hot
        rows.append((k, rnd.randint(0, 5000), i, rnd.randint(-5, 20)))
    return spark.createDataFrame(rows, "k int, t long, id long, v long")


def test_neighbors_match_windows(spark):
    df = _data(spark)
    x = S.assign_segments(df, ["k"], "t", max_rows=20)
    assert x.where("_hot").select("_seg").distinct().count() > 3
    x = S.with_neighbors(x, ["k"], ["t", "id"], ["id", "v"], n_next=3, n_prev=2)
    got = {r.id: (r.next_1 and r.next_1.id, r.next_2 and r.next_2.id, r.next_3 and r.next_3.id,
                  r.prev_1 and r.prev_1.id, r.prev_2 and r.prev_2.id)
           for r in x.collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", *[F.lead("id", i).over(w).alias(f"n{i}") for i in (1, 2, 3)],
                    *[F.lag("id", i).over(w).alias(f"p{i}") for i in (1, 2)])
    exp = {r.id: (r.n1, r.n2, r.n3, r.p1, r.p2) for r in ref.collect()}
    assert got == exp


def test_running_match_windows(spark):
    df = _data(spark, seed=9)
    x = S.assign_segments(df, ["k"], "t", max_rows=15)
    x = S.with_running(x, ["k"], ["t", "id"], "v", "rs", how="sum")
    x = S.with_running(x, ["k"], ["t", "id"], "v", "rm", how="max", inclusive=False)
    got = {r.id: (r.rs, r.rm) for r in x.collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("rm"))
    assert got == {r.id: (r.rs, r.rm) for r in ref.collect()}


def test_global_scan(spark):
    df = _data(spark, seed=5)
    x = S.assign_segments(df, [], "t", max_rows=50)
    x = S.with_running(x, [], ["t", "id"], "v", "rm", how="max", inclusive=False)
    got = {r.id: r.rm for r in x.collect()}
    rows = sorted(df.collect(), key=lambda r: (r.t, r.id))
    best, exp = None, {}
    for r in rows:
        exp[r.id] = best
        best = r.v if best is None else max(best, r.v)
    assert got == exp


def test_bounce_hot_path_equals_default(spark):
    from larkspur import catalog as C
    from larkspur.operators import patterns as P
    pages = C._pages(spark, "/root/testdata/sf0.01")
    a = P.bounce(pages, window_ms=C.BOUNCE_WINDOW_MS).select("rec_id", "kind", "next_ts")
    b = P.bounce(pages, window_ms=C.BOUNCE_WINDOW_MS, max_rows=7).select("rec_id", "kind", "next_ts")
    assert sorted(a.collect()) == sorted(b.collect())
    assert a.count() == 1701


def test_refire_hot_path_equals_default(spark):
    from larkspur import catalog as C
    from larkspur.operators import windows as W
    d = "/root/testdata/sf0.01"
    cl = W.classify_lateness(C._scores(spark, d), C.DAY_MS, C.DELAY_MS, C.LATENESS_MS, max_rows=500)
    a = W.refire_results(cl, max_rows=3)
    b = W.refire_results(cl, max_rows=7)
    c = C.window_refire(spark, d)
    assert sorted(a.collect()) == sorted(b.collect()) == sorted(c.collect())


def test_neighbors_with_hash_sample(spark):
    # max_rows=200 -> sampled fraction 0.32: the hash-based sample decides hot keys
    df = _data(spark, n=3000, seed=11)
    x = S.assign_segments(df, ["k"], "t", max_rows=200)
    assert x.where("_hot").select("_seg").distinct().count() > 3
    x = S.with_neighbors(x, ["k"], ["t", "id"], ["id"], n_next=2, n_prev=1)
    got = {r.id: (r.next_1 and r.next_1.id, r.next_2 and r.next_2.id, r.prev_1 and r.prev_1.id)
           for r in x.collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.lead("id", 1).over(w).alias("a"), F.lead("id", 2).over(w).alias("b"),
                    F.lag("id", 1).over(w).alias("c"))
    assert got == {r.id: (r.a, r.b, r.c) for r in ref.collect()}


def _largest(df, max_rows):
    x = S.assign_segments(df, ["k"], ["t", "id"], max_rows=max_rows)
    return x.groupBy("k", "_seg").count().agg({"count": "max"}).first()[0]


def test_segments_stay_balanced_on_outliers_ties_and_bursts(spark):
    """Cuts are quantiles of (time, id): no clock error, tie or burst puts a key back into one task."""
    n, most = 2000, 100
    outlier = [("a", 10**12 if i == 0 else i, i) for i in range(n)]
    ties = [("a", 7, i) for i in range(n)]
    burst = [("a", i if i < 100 else 100, i) for i in range(n)]
    for rows in (outlier, ties, burst):
        assert _largest(spark.createDataFrame(rows, "k string, t long, id long"), most) <= 2 * most


def test_replayed_batch_replaces_the_whole_batch(spark, scratch):
    from larkspur.sources import sinks as SK
    frame = lambda topic: spark.createDataFrame([(topic, "v")] if topic else [], "topic string, value string")
    path = scratch + "/topics"
    SK.write_topics(frame("old"), path, 7)
    SK.write_topics(frame("keep"), path, 8)
    SK.write_topics(frame("new"), path, 7)
    assert {r.topic for r in spark.read.json(path).collect()} == {"new", "keep"}
    SK.write_topics(frame(None), path, 7)
    assert {r.topic for r in spark.read.json(path).collect()} == {"keep"}


def test_summary_and_cuts_have_a_fixed_size(spark, monkeypatch):
    """However many rows a key has, its summary holds at most SUMMARY tuples, and all keys together SEGMENTS cuts."""
    monkeypatch.setattr(S, "SUMMARY", 64)
    monkeypatch.setattr(S, "SEGMENTS", 16)
    for n in (500, 5000, 50_000):
        df = spark.range(n).select((F.col("id") % 5).alias("k"), F.col("id").alias("t"))
        kept = S.hot_cuts(df, ["k"], F.struct("t"), 10, 17)
        spots = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "min(" in spots
        cuts = {r.k: len(r._cuts) for r in kept.collect()}
        assert sum(cuts.values()) <= 16 and (n < 100 or len(cuts) == 5)
        one = S.assign_segments(df.withColumn("k", F.lit(0)), ["k"], "t", max_rows=20)
        sizes = [r["count"] for r in one.groupBy("_seg").count().collect()]
        assert 8 <= len(sizes) <= 16 and max(sizes) < 4 * n / len(sizes)


def test_summary_is_bounded_by_construction(spark, monkeypatch):
    """What the second aggregate collects of a key, counted from the first one's output."""
    monkeypatch.setattr(S, "SUMMARY", 32)
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    own = F.xxhash64(F.col("k"), F.struct("t"), F.lit(18))
    assert df.select(F.pmod(own, F.lit(S.SUMMARY))).distinct().count() <= 32
    x = S.assign_segments(df, ["k"], "t", max_rows=500)
    x = S.with_running(x, ["k"], ["t"], F.lit(1).cast("long"), "n", how="sum")
    assert x.where("n <> t + 1").count() == 0
