"""Random sequences for many keys, checked in one Spark job each against
small pure-Python models (partial-match simulation, brute force, per-record
watermarks).  Half of the runs force tiny segments (hot-key path)."""

import random

import pytest
from pyspark.sql import functions as F

from larkspur.operators import patterns as P
from larkspur.operators import windows as W


def _sequences(seed, keys=300, max_len=12, span=40):
    rnd = random.Random(seed)
    rows, rid = [], 0
    for k in range(keys):
        n = rnd.randint(1, max_len)
        ts = sorted(rnd.sample(range(span * 3), n))
        for t in ts:
            rows.append((f"k{k}", t * 1000, rid, rnd.random() < 0.55))
            rid += 1
    return rows


def _bounce_model(rows, w):
    by = {}
    for mid, ts, rid, entry in rows:
        by.setdefault(mid, []).append((ts, rid, entry))
    out = set()
    for evs in by.values():
        p = None
        for ts, rid, entry in sorted(evs):
            if p is not None and ts - p[0] >= w:
                out.add((p[1], "timeout"))
                p = None
            if p is not None:
                if entry:
                    out.add((p[1], "matched"))
                p = None
            if entry:
                p = (ts, rid)
        if p is not None:
            out.add((p[1], "timeout"))
    return out


@pytest.mark.parametrize("seed,max_rows", [(1, None), (2, 4)])
def test_bounce_matches_partial_match_model(spark, seed, max_rows):
    rows = _sequences(seed)
    df = spark.createDataFrame(rows, "mid string, ts_ms long, rec_id long, entry boolean")
    w = 10_000
    got = P.bounce(df, window_ms=w, entry=F.col("entry"), max_rows=max_rows)
    assert {(r.rec_id, r.kind) for r in got.collect()} == _bounce_model(rows, w)


@pytest.mark.parametrize("seed,n,max_rows", [(3, 3, None), (4, 2, 3), (5, 4, 5)])
def test_strict_times_matches_brute_force(spark, seed, n, max_rows):
    rows = _sequences(seed)
    df = spark.createDataFrame(rows, "k string, ts long, rid long, c boolean")
    got = P.strict_times(df, F.col("c"), n, "k", "ts", "rid", max_rows=max_rows)
    got = {tuple(r[f"e{i}"].rid for i in range(1, n + 1)) for r in got.collect()}
    by = {}
    for k, ts, rid, c in rows:
        by.setdefault(k, []).append((ts, rid, c))
    exp = set()
    for evs in by.values():
        evs.sort()
        for i in range(len(evs) - n + 1):
            if all(e[2] for e in evs[i:i + n]):
                exp.add(tuple(e[1] for e in evs[i:i + n]))
    assert got == exp


@pytest.mark.parametrize("seed,max_rows", [(6, None), (7, 25)])
def test_lateness_matches_per_record_watermark(spark, seed, max_rows):
    rnd = random.Random(seed)
    size, delay, late = 20_000, 10_000, 60_000
    rows = []
    for i in range(800):
        lag = rnd.randint(-200_000, 0) if rnd.random() < 0.1 else rnd.randint(-15_000, 5_000)
        ts = i * 700 + lag
        rows.append(("k", 1, max(ts, 0), i * 700 + rnd.randint(0, 5), i))
    df = spark.createDataFrame(rows, "name string, score long, ts_ms long, arrival_ms long, seq long")
    got = {r.seq: r["class"] for r in W.classify_lateness(df, size, delay, late, max_rows=max_rows).collect()}
    exp, mx = {}, None
    for name, score, ts, arr, seq in sorted(rows, key=lambda r: (r[3], r[4])):
        wm = None if mx is None else mx - delay - 1
        end1 = (ts // size) * size + size - 1
        exp[seq] = "on_time" if wm is None or end1 > wm else ("late" if end1 + late <= wm else "refire")
        mx = ts if mx is None else max(mx, ts)
    assert got == exp
    assert {"on_time", "refire", "late"} <= set(exp.values())
