"""``transformWithState`` processors for the keyed stateful operators.

Each processor is the streaming twin of a batch operator and is checked
against it (stream == batch) in the tests.  Rows of one key inside a
micro-batch are sorted by the operator's order columns first, because the
grouping shuffle does not keep arrival order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

DAY_MS = 86_400_000


class IsNewRepairProcessor(StatefulProcessor):
    """STA1: per key, the first record claiming ``is_new = "1"`` keeps it;
    later ``"1"`` records become ``"0"``.  ``"0"`` records never touch the
    state.  No TTL (the source never expires it); ``ttl_ms`` is an option
    that needs ``timeMode="ProcessingTime"``."""

    def __init__(self, out_schema: StructType, order: Sequence[str] = ("rec_id",),
                 flag: str = "is_new", day: str = "day", ttl_ms: int | None = None):
        self.fields = out_schema.fieldNames()
        self.order, self.flag, self.day, self.ttl_ms = list(order), flag, day, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_day", "day string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.first.exists()
        for r in sorted(rows, key=lambda x: tuple(x[c] for c in self.order)):
            d = r.asDict()
            if d[self.flag] == "1":
                if seen:
                    d[self.flag] = "0"
                else:
                    self.first.update((d.get(self.day),))
                    seen = True
            yield Row(**{f: d.get(f) for f in self.fields})

    def close(self) -> None:
        pass


class UniqueVisitProcessor(StatefulProcessor):
    """STA2: keep an entry record when its day differs from the stored day;
    the stored day is rewritten on every kept record and expires after
    ``ttl_ms`` of processing time (default one day, refreshed on write)."""

    def __init__(self, out_schema: StructType, order: Sequence[str] = ("arrival_ms", "rec_id"),
                 day: str = "day", ttl_ms: int | None = DAY_MS):
        self.fields = out_schema.fieldNames()
        self.order, self.day, self.ttl_ms = list(order), day, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("visit_day", "day string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cur = self.last.get()[0] if self.last.exists() else None
        for r in sorted(rows, key=lambda x: tuple(x[c] for c in self.order)):
            if cur is None or r[self.day] != cur:
                cur = r[self.day]
                self.last.update((cur,))
                yield Row(**{f: r[f] for f in self.fields})

    def close(self) -> None:
        pass


class Buckets:
    """Rows that wait for the watermark, in map state keyed by time bucket: one timer a bucket, and a timer reads and
    removes its own bucket only, however many rows wait behind it."""

    def __init__(self, handle: StatefulProcessorHandle, name: str, bucket_ms: int):
        self.h, self.ms = handle, bucket_ms
        self.map = handle.getMapState(name, "bucket long", "rows string")
        self.latest = handle.getValueState(f"{name}_latest", "bucket long")

    def add(self, rows: Sequence[tuple]) -> None:
        """Rows are tuples of JSON values whose first is the time in ms."""
        new: dict[int, list] = {}
        for r in rows:
            new.setdefault(r[0] // self.ms, []).append(r)
        for b, more in new.items():
            old = json.loads(self.map.getValue((b,))[0]) if self.map.containsKey((b,)) else []
            if not old:
                self.h.registerTimer((b + 1) * self.ms)     # all of the bucket is at or below the watermark then
            self.map.updateValue((b,), (json.dumps(old + more),))
        if new and (not self.latest.exists() or self.latest.get()[0] < max(new)):
            self.latest.update((max(new),))

    def reached(self, fired_ms: int, watermark_ms: int) -> int:
        """Up to when all rows have been handed out: the watermark, if no bucket is left behind this timer (a timer set now for
        a time the watermark has passed would wait for the next batch), else the timer's time."""
        return watermark_ms if (self.latest.get()[0] + 1) * self.ms <= fired_ms else fired_ms

    def wake(self, at_ms: int) -> None:
        """A timer at the first bucket's end from ``at_ms`` on, when all rows before ``at_ms`` have been handed out."""
        self.h.registerTimer(-(-at_ms // self.ms) * self.ms)

    def due(self, fired_ms: int) -> list[tuple]:
        """The rows of the bucket that this timer stands for, and out of the state."""
        b = fired_ms // self.ms - 1
        if not self.map.containsKey((b,)):
            return []
        rows = [tuple(r) for r in json.loads(self.map.getValue((b,))[0])]
        self.map.removeKey((b,))
        return rows


class BounceProcessor(StatefulProcessor):
    """CEP1-CEP3 in event time (timeMode="EventTime").

    Rows wait in time buckets until the watermark has passed them, then are consumed in
    ``(ts, rec_id)`` order by a one-slot partial match: an entry followed by
    an entry within ``window_ms`` is *matched*; a pending entry whose next
    event is at least ``window_ms`` later, or that is still pending when the
    watermark has passed ``ts + window_ms``, is a *timeout*.  Output rows:
    ``mid, rec_id, ts_ms, page_id, kind, value`` (the record's text)."""

    def __init__(self, window_ms: int = 10_000, bucket_ms: int | None = None):
        self.w, self.ms = window_ms, bucket_ms or max(1, window_ms // 10)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Buckets(handle, "waiting", self.ms)
        self.pending = handle.getValueState("pending", "ts_ms long, rec_id long, page_id string, value string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add([(r.ts_ms, r.rec_id, bool(r.is_entry), r.page_id, r.value) for r in rows])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        p = before = tuple(self.pending.get()) if self.pending.exists() else None

        def found(p, kind):
            return Row(mid=key[0], rec_id=p[1], ts_ms=p[0], page_id=p[2], kind=kind, value=p[3])

        for ts, rec, entry, page, text in sorted(self.waiting.due(fired), key=lambda x: x[:2]):
            if p is not None and ts - p[0] >= self.w:
                yield found(p, "timeout")
                p = None
            if p is not None:
                if entry:
                    yield found(p, "matched")
                p = None
            if entry:
                p = (ts, rec, page, text)
        if p is not None and p[0] + self.w <= self.waiting.reached(fired, timerValues.getCurrentWatermarkInMs()):
            yield found(p, "timeout")
            p = None
        if p != before:
            if p is None:
                self.pending.clear()
            else:
                self.pending.update(p)
                self.waiting.wake(p[0] + self.w)

    def close(self) -> None:
        pass


class StrictTimesProcessor(StatefulProcessor):
    """CEP4 / CEP5 / CEP6 in event time: ``n`` consecutive events meeting the
    condition (strict contiguity, overlapping matches kept), with ``within_ms``
    all of them less than that after the first.

    Rows wait in time buckets until the watermark has passed them and are consumed in
    ``(ts, seq)`` order; the last ``n - 1`` matching events of the current
    run are the starts of partial matches.  A start that is still partial
    ``within_ms`` later is a *timeout* of as many events as it has.  Output rows: ``key, kind,
    length, first_seq, first_ts, last_ts, ts_list``."""

    def __init__(self, n: int = 3, within_ms: int | None = None, bucket_ms: int = 1000):
        self.n, self.w, self.ms = n, within_ms, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Buckets(handle, "waiting", self.ms)
        self.run = handle.getValueState("run", "events string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add([(r.ts, r.seq, bool(r.c)) for r in rows])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        run = [tuple(x) for x in json.loads(self.run.get()[0])] if self.run.exists() else []
        before = list(run)

        def found(events, kind):
            return Row(key=key[0], kind=kind, length=len(events), first_seq=events[0][1], first_ts=events[0][0], last_ts=events[-1][0],
                       ts_list=",".join(str(x[0]) for x in events))

        def expired(now):
            """The starts that are too old at ``now``, oldest first, each with the events that followed it."""
            while self.w is not None and run and run[0][0] + self.w <= now:
                yield found(list(run), "timeout")
                run.pop(0)

        for ts, seq, ok in sorted(self.waiting.due(fired)):
            yield from expired(ts)
            if not ok:
                run.clear()
                continue
            run.append((ts, seq))
            if len(run) == self.n:
                yield found(list(run), "matched")
                run.pop(0)
        yield from expired(self.waiting.reached(fired, timerValues.getCurrentWatermarkInMs()))
        if run != before:
            self.run.update((json.dumps(run),))
            if self.w is not None and run:
                self.waiting.wake(run[0][0] + self.w)

    def close(self) -> None:
        pass


class AsOfRouteProcessor(StatefulProcessor):
    """RTE2 + RTE3 in event time: config rows and data records of one (table, operation, salt) in one operator.

    Both wait in time buckets until the watermark has passed them, so the order in which files or partitions deliver
    them does not matter; then they are merged by arrival number, data before config of the same number.  A data record
    takes the config in force; a config row replaces it (last write wins; deletes never come this far).  State: the
    config in force and what the watermark has not passed yet.  Input rows: ``seq, side`` (0 data, 1 config), ``value``
    (the record's text) and the config fields; output rows: the key, ``seq, value``, the config fields and ``cfg_seq``."""

    def __init__(self, fields: Sequence[str], bucket_ms: int = 1000):
        self.fields, self.ms = list(fields), bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Buckets(handle, "waiting", self.ms)
        self.current = handle.getValueState("current", "cfg_seq long, fields string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self.waiting.add([(r.seq, r.side, r.value if r.side == 0 else None, [r[f] for f in self.fields] if r.side else None) for r in rows])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        cfg = self.current.get() if self.current.exists() else None
        held = (cfg[0], json.loads(cfg[1])) if cfg else None
        order = lambda r: (r[0], r[1], [(v is not None, v or "") for v in r[3] or []])
        before = held
        for seq, side, value, fields in sorted(self.waiting.due(expiredTimerInfo.getExpiryTimeInMs()), key=order):
            if side:
                held = (seq, fields)
            elif held:
                yield Row(table=key[0], operation=key[1], seq=seq, value=value, **dict(zip(self.fields, held[1])), cfg_seq=held[0])
        if held != before:
            self.current.update((held[0], json.dumps(held[1])))

    def close(self) -> None:
        pass


class HandoverProcessor(StatefulProcessor):
    """SRC3's handover, row by row: a chunk row (``side`` 1, ``at`` its low mark) yields if its key has changed after the
    mark; a change (``side`` 0) that a chunk row already holds, at or below the mark, is dropped.  Changes of a key come in
    their order, chunk rows at any time before or after them.  State: a key's last change and last mark, with a
    processing-time ``ttl_ms`` longer than the snapshot takes, or for good."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "changed long, low long", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        changed, low = self.seen.get() if self.seen.exists() else (None, None)
        before = (changed, low)
        for r in sorted(rows, key=lambda x: (x.side, x.at)):
            if r.side == 0:
                changed = r.at if changed is None else max(changed, r.at)
                if low is not None and r.at <= low:
                    continue
            elif changed is not None and changed > r.at or low is not None and low > r.at:
                continue
            else:
                low = r.at
            yield Row(seq=r.at, topic=r.topic, value=r.value)
        if (changed, low) != before:
            self.seen.update((changed, low))

    def close(self) -> None:
        pass


class ArrivalWindowProcessor(StatefulProcessor):
    """WIN6: sums over windows of processing time, per key (timeMode="ProcessingTime").

    A row belongs to the window in which its micro-batch is processed, whatever its event time; nothing is ever late.  The window's
    accumulators (sum, rows, event time of the last element) wait in map state; a processing-time timer at its end emits and removes
    them, with or without later input.  Output rows: ``name, window_start_ms, window_end_ms, score_sum, n_rows, last_ts``."""

    def __init__(self, size_ms: int, order: Sequence[str] = ("arrival_ms", "seq")):
        self.size, self.order = size_ms, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.h = handle
        self.open = handle.getMapState("open", "start long", "score_sum long, n_rows long, last_ts long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start = timerValues.getCurrentProcessingTimeInMs() // self.size * self.size
        if self.open.containsKey((start,)):
            total, n, last = self.open.getValue((start,))
        else:
            total, n, last = 0, 0, None
            self.h.registerTimer(start + self.size)
        newest = None
        for r in rows:
            total, n = total + (r.score or 0), n + 1
            at = tuple(r[c] for c in self.order)
            if newest is None or at > newest:
                newest, last = at, r.ts_ms
        self.open.updateValue((start,), (total, n, last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        start = expiredTimerInfo.getExpiryTimeInMs() - self.size
        if self.open.containsKey((start,)):
            total, n, last = self.open.getValue((start,))
            self.open.removeKey((start,))
            yield Row(name=key[0], window_start_ms=start, window_end_ms=start + self.size, score_sum=total, n_rows=n, last_ts=last)

    def close(self) -> None:
        pass
