"""`within` on sequences of n events: matches and timed-out partial matches, in batch and stream, against a plain matcher."""

import json
import random

import pytest
from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.operators import patterns as P
from larkspur.sources import records as R
from larkspur.sources.tables import table
from larkspur.streaming import jobs as J
from larkspur.streaming import processors as PR
from tests.test_streaming import SF, _memory, _stream, _write_chunks


def matcher(events, n, within):
    """(kind, first seq, times) of one key's events, partial match by partial match."""
    out, partial = [], []
    for ts, seq, ok in sorted(events):
        for p in [p for p in partial if ts - p[0][0] >= within]:
            out.append(("timeout", p[0][1], tuple(t for t, _ in p)))
            partial.remove(p)
        if not ok:
            partial = []
            continue
        partial = [[*p, (ts, seq)] for p in partial] + [[(ts, seq)]]
        for p in [p for p in partial if len(p) == n]:
            out.append(("matched", p[0][1], tuple(t for t, _ in p)))
            partial.remove(p)
    return sorted(out + [("timeout", p[0][1], tuple(t for t, _ in p)) for p in partial])


def random_events(seed, keys=5, n=60):
    rng = random.Random(seed)
    return [(f"k{k}", t, i * 10 + k, rng.random() < 0.75) for k in range(keys)
            for i, t in enumerate(sorted(rng.randrange(2000) for _ in range(n)))]


@pytest.mark.parametrize("n, within, most", [(2, 50, None), (3, 60, None), (4, 100, 7), (3, 1, 5)])
def test_batch_equals_the_matcher(spark, n, within, most):
    rows = random_events(n * within)
    df = spark.createDataFrame(rows, "k string, t long, s long, c boolean")
    got = P.strict_times_within(df, F.col("c"), n, "k", "t", "s", within, max_rows=most).collect()
    have = sorted((r.k, r.kind, r.e1.s, tuple(r[f"e{i}"].t for i in range(1, r.length + 1))) for r in got)
    assert have == sorted((k, *m) for k in {r[0] for r in rows} for m in matcher([r[1:] for r in rows if r[0] == k], n, within))
    assert all(r[f"e{i}"] is None for r in got for i in range(r.length + 1, n + 1))


def test_stream_equals_batch(spark, scratch):
    logins = R.login_events(table(spark, SF, "events"))
    _write_chunks(logins, f"{scratch}/in", ["timestamp", "seq"], n=3)
    far = logins.agg(F.max("timestamp")).first()[0] + 10 * C.ALERT_WITHIN_MS
    spark.createDataFrame([("~end", "ip", "view", far, -1)], logins.schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    s = _stream(spark, f"{scratch}/in", logins.schema)
    got = _memory(J.strict_times_stream(s, F.col("event_type") == "fail", C.ALERT_RUN, "user_id", ts="timestamp",
                                        within_ms=C.ALERT_WITHIN_MS, bucket_ms=3_600_000), "within_s", f"{scratch}/ck")
    want = [("matched", C.strict_times_within(spark, SF)), ("timeout", C.strict_times_timeout(spark, SF))]
    want = sorted((r.user_id, kind, r.first_seq, r.length, r.ts_list) for kind, df in want for r in df.collect())
    assert sorted(map(tuple, got.select("key", "kind", "first_seq", "length", "ts_list").collect())) == want
    assert {r[1] for r in want} == {"matched", "timeout"}


class Handle:
    """A state handle that counts what is read and written (the interface of the processors, in memory)."""

    def __init__(self):
        self.timers, self.read, self.written = set(), 0, 0
        outer = self

        class Map(dict):
            def containsKey(self, k):
                return k in self

            def getValue(self, k):
                outer.read += len(json.loads(self[k][0]))
                return self[k]

            def updateValue(self, k, v):
                outer.written += len(json.loads(v[0]))
                self[k] = v

            def removeKey(self, k):
                del self[k]

        class Value:
            held = None

            def exists(self):
                return self.held is not None

            def get(self):
                return self.held

            def update(self, v):
                self.held = v

            def clear(self):
                self.held = None
        self.map, self.new_value = Map(), Value

    def getMapState(self, *_, **__):
        return self.map

    def getValueState(self, *_, **__):
        return self.new_value()

    def registerTimer(self, at):
        self.timers.add(at)


class Timer:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


class Watermark:
    """Always just at the timer that fires: timers come one at a time."""

    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at


class Rec:
    def __init__(self, **kw):
        self.__dict__.update(kw)


@pytest.mark.parametrize("processor, row", [
    (PR.StrictTimesProcessor(3, within_ms=50, bucket_ms=100), lambda i: Rec(ts=i, seq=i, c=i % 7 != 0)),
    (PR.BounceProcessor(50, bucket_ms=100), lambda i: Rec(ts_ms=i, rec_id=i, is_entry=i % 3 != 2, page_id="p", value="v"))])
def test_a_timer_touches_only_what_is_due(processor, row):
    """100,000 rows of one key wait; each timer reads its own bucket, and all of them together every row once."""
    h, n = Handle(), 100_000
    processor.init(h)
    list(processor.handleInputRows(("k",), (row(i) for i in range(n)), None))
    h.read = h.written = 0
    most, out = 0, 0
    while h.timers:
        at = min(h.timers)
        h.timers.remove(at)
        before = h.read
        out += sum(1 for _ in processor.handleExpiredTimer(("k",), Watermark(at), Timer(at)))
        most = max(most, h.read - before)
    assert most <= 100 and h.read == n and h.written == 0 and not h.map and out > n / 10
