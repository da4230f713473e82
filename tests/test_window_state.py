"""Windows with allowed lateness in a stream: each record in a window or late, by one watermark; and windows of arrival time."""

import os
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.operators import windows as W
from larkspur.sources import commits as CM
from larkspur.streaming import jobs as J
from larkspur.streaming import window_state as WS
from tests.test_streaming import SF, _stream, _write_chunks

ROWS = "name string, score long, ts_ms long, arrival_ms long, seq long"


def model(rows, size, delay, lateness):
    """(firings, late seqs) of rows in arrival order, one after another."""
    top, acc, fired, results, late = None, {}, set(), [], []

    def fire(key, no):
        results.append((*key, no, acc[key][0], acc[key][1], acc[key][2]))

    refires = defaultdict(int)
    for name, score, ts, _, seq in rows:
        start = ts // size * size
        key, end = (name, start), start + size - 1
        wm = None if top is None else top - delay - 1
        if wm is not None and end + lateness <= wm:
            late.append(seq)
        else:
            s, n, _ = acc.get(key, (0, 0, None))
            acc[key] = (s + score, n + 1, ts)
            if wm is not None and end <= wm:
                refires[key] += 1
                fired.add(key)
                fire(key, refires[key])
        top = ts if top is None else max(top, ts)
        for k in sorted(acc):
            if k not in fired and k[1] + size - 1 <= top - delay - 1:
                fired.add(k)
                fire(k, 0)
    return sorted(results), sorted(late)


def random_rows(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice("aaab"), rng.randrange(100), max(0, i * 10 + rng.randrange(-900, 300)), i // 3, i) for i in range(n)] + [
        ("~end", 0, 10**7, n, n)]


def written(spark, root):
    res = CM.read_output(spark, root, WS.RESULTS).select("name", "window_start_ms", "fire_no", "score_sum", "n_rows", "last_ts")
    return sorted(map(tuple, res.collect())), sorted(r.seq for r in CM.read_output(spark, root, WS.LATE).collect())


@pytest.mark.parametrize("seed, cuts", [(1, (100, 101, 250)), (2, (7,))])
def test_batches_equal_a_record_by_record_model(spark, scratch, seed, cuts):
    rows, size, delay, lateness = random_rows(seed), 200, 100, 250
    parts = [rows[a:b] for a, b in zip((0, *cuts), (*cuts, len(rows)))]
    for i, part in enumerate(parts):
        WS.window_batch(spark.createDataFrame(part, ROWS).repartition(3), i, scratch, size, delay, lateness)
    want = model(rows, size, delay, lateness)
    assert written(spark, scratch) == want and len(want[1]) > 5 and max(r[2] for r in want[0]) > 1
    taken = sum(1 for r in rows) - len(want[1])
    last = {}
    for r in want[0]:
        last[r[:2]] = max(last.get(r[:2], 0), r[4])
    assert sum(last.values()) == taken - 1                               # all but the sentinel, whose window is open
    states = os.listdir(f"{scratch}/{WS.STATE}")
    assert len(states) <= 2                                              # retired behind the batches


def test_a_failed_batch_leaves_no_state(spark, scratch, monkeypatch):
    rows = random_rows(5)
    parts = [rows[:200], rows[200:]]
    frame = lambda p: spark.createDataFrame(p, ROWS)
    real = CM.Batch.write
    for i, part in enumerate(parts):
        for dies_at in (WS.LATE, WS.STATE, WS.MARK):
            def write(self, df, name, **kw):
                if name == dies_at:
                    raise RuntimeError("killed")
                real(self, df, name, **kw)
            monkeypatch.setattr(CM.Batch, "write", write)
            with pytest.raises(RuntimeError):
                WS.window_batch(frame(part), i, scratch, 200, 100, 250)
        monkeypatch.setattr(CM.Batch, "write", real)
        WS.window_batch(frame(part), i, scratch, 200, 100, 250)
        WS.window_batch(frame(part), i, scratch, 200, 100, 250)         # a replay of a committed batch
    assert written(spark, scratch) == model(rows, 200, 100, 250)
    with pytest.raises(RuntimeError):                                    # never a fresh start in the middle
        WS.window_batch(frame(parts[1]), 4, f"{scratch}/elsewhere", 200, 100, 250)


def test_stream_equals_the_batch_queries(spark, scratch):
    """window_refire, late_classify and the bounds text, from one operator."""
    scores = C._scores(spark, SF).drop("ts")
    end = scores.agg(F.max("ts_ms"), F.max("arrival_ms")).first()
    sentinel = scores.limit(1).select(F.lit(10**9).cast("long").alias("seq"), *[F.lit(v).cast(t).alias(c) for c, v, t in (
        ("arrival_ms", end[1] + 1, "long"), ("value", "~end", "string"), ("name", "~end", "string"), ("score", 0, "long"),
        ("ts_ms", end[0] + 10 * C.DAY_MS, "long"))]).select(scores.columns)
    schema = _write_chunks(scores.unionByName(sentinel), f"{scratch}/in", ["arrival_ms", "seq"], n=5)
    q = WS.window_query(_stream(spark, f"{scratch}/in", schema), f"{scratch}/out", f"{scratch}/ck", C.DAY_MS, C.DELAY_MS, C.LATENESS_MS)
    q.awaitTermination(300)
    assert q.exception() is None
    got = CM.read_output(spark, f"{scratch}/out", WS.RESULTS)
    want = C.window_refire(spark, SF)
    cols = ["name", "window_start_ms", "fire_no", "score_sum", "n_rows"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    late = {r.seq for r in CM.read_output(spark, f"{scratch}/out", WS.LATE).collect()}
    assert late == {r.seq for r in C.late_classify(spark, SF).where("class = 'late'").collect()} and late
    # the text of a window's last firing is the text of the window without its late records
    last = got.groupBy("name", "window_start_ms").agg(F.max_by("text", "fire_no").alias("text"))
    kept = C._scores(spark, SF).where(~F.col("seq").isin(*late))
    exp = W.bounds_text(W.window_sum_last(kept, C.WINDOW_SIZE)).select("name", "window_start_ms", "text")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, exp.collect()))


def test_queue_outputs_carry_keys(spark, scratch):
    sent = []
    publish = lambda df, name: sent.append((name, df.select("key").collect()))
    WS.window_batch(spark.createDataFrame(random_rows(7), ROWS), 0, scratch, 200, 100, 250, publish=publish)
    assert [n for n, _ in sent] == [WS.RESULTS, WS.LATE] and all(r.key.startswith("0:") for _, rows in sent for r in rows)
    assert len({r.key for _, rows in sent for r in rows}) == sum(len(rows) for _, rows in sent)


def test_arrival_windows_close_without_later_input(spark, scratch):
    """Event times are years apart and out of order: only the time of processing counts."""
    os.makedirs(f"{scratch}/in")

    def drop(name, rows):
        spark.createDataFrame(rows, ROWS).coalesce(1).write.parquet(f"{scratch}/{name}")
        part = [f for f in os.listdir(f"{scratch}/{name}") if f.endswith(".parquet")][0]
        os.rename(f"{scratch}/{name}/{part}", f"{scratch}/in/{name}.parquet")
    first = [("a", 1, 10**12, 0, 0), ("a", 2, 5, 0, 1), ("b", 4, 10**12, 0, 2)]
    drop("one", first)
    schema = spark.createDataFrame([], ROWS).schema
    out = J.arrival_window_stream(_stream(spark, f"{scratch}/in", schema), size_ms=2000)
    q = (out.writeStream.format("memory").queryName("arrivals").option("checkpointLocation", f"{scratch}/ck")
         .trigger(processingTime="500 milliseconds").start())
    try:
        def closed(n):
            until = time.time() + 90
            while time.time() < until:
                got = spark.table("arrivals").collect()
                if sum(r.n_rows for r in got) >= n:
                    return got
                time.sleep(0.5)
            raise AssertionError("windows stayed open")
        got = closed(3)                                       # nothing more has come in
        assert {(r.name, r.score_sum, r.n_rows, r.last_ts) for r in got} == {("a", 3, 2, 5), ("b", 4, 1, 10**12)}
        assert all(r.window_start_ms % 2000 == 0 and r.window_end_ms <= time.time() * 1000 for r in got)
        drop("two", [("a", 8, 7, 1, 3)])
        got = closed(4)
        assert sorted(r.score_sum for r in got if r.name == "a") == [3, 8]
    finally:
        q.stop()
    assert q.exception() is None
