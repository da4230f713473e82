"""Snapshot to change stream: nothing is lost, nothing older overwrites anything newer."""

import random

from pyspark.sql import functions as F

from larkspur import apps
from larkspur import catalog as C
from larkspur.functions import json as J
from larkspur.operators import cdc as CDC
from larkspur.operators import handover as HO
from larkspur.sources import connectors as SC
from larkspur.sources import records as R
from larkspur.sources.tables import table
from larkspur.streaming import jobs
from tests.test_streaming import SF, _memory, _write_chunks


def state_of(rows):
    return sorted((r.key, r.state) for r in rows.collect())


def inputs(spark, d=SF):
    items = table(spark, d, "lineitem")
    return R.order_snapshot_chunks(table(spark, d, "orders"), items), R.order_state_changes(items)


def test_rows_yield_and_without_yielding_the_state_is_stale(spark):
    chunks, changes = inputs(spark)
    events = HO.handover(chunks, changes, ["state"])
    kept = events.where("op = 'r'").count()
    assert 0 < kept < chunks.count()
    stale = changes.select("key", F.col("seq").alias("pos"), "op", "state").unionByName(
        chunks.select("key", F.col("high").alias("pos"), F.lit("r").alias("op"), "state"))
    assert state_of(HO.current_rows(stale, ["state"])) != state_of(HO.current_rows(events, ["state"]))
    assert changes.where(f"key = {R.HOT_ORDER}").count() > changes.count() / 4


def test_random_interleavings(spark):
    """A plain table that changes while it is read, against the events."""
    rng = random.Random(4)
    table_, seq, changes, chunks = {k: "base" for k in range(40)}, 0, [], []

    def change(times):
        nonlocal seq
        for _ in range(times):
            seq += 1
            k = rng.choice([3, rng.randrange(44)])
            op = rng.choice("ucd")
            changes.append((k, k // 10, seq, op, None if op == "d" else f"v{seq}"))
            table_.pop(k, None) if op == "d" else table_.__setitem__(k, f"v{seq}")
    change(20)
    for chunk in range(5):
        low = seq
        change(rng.randrange(8))
        found = [(k, v) for k, v in table_.items() if k // 10 == chunk]
        change(rng.randrange(8))
        chunks += [(k, chunk, low, seq, v) for k, v in found]
    change(10)
    c = spark.createDataFrame(chunks, "key long, chunk long, low long, high long, state string")
    f = spark.createDataFrame(changes, "key long, chunk long, seq long, op string, state string")
    events = HO.handover(c, f, ["state"])
    assert dict(state_of(HO.current_rows(events, ["state"]))) == table_
    during = {(k, ch) for k, ch, low, high, _ in chunks if any(x == k and low < s <= high for x, _, s, _, _ in changes)}
    assert events.where("op = 'r'").count() == len(chunks) - len(during)
    assert HO.handover(c.limit(0), f, ["state"]).count() == len(changes) and HO.handover(c, f.limit(0), ["state"]).count() == len(chunks)


def as_events(chunks, changes):
    """Both as change events: ``(low, topic, value)`` and ``(seq, topic, value)``."""
    def text(df, op):
        row = F.struct(F.col("key").alias("id"), "state")
        gone = F.col("op") == "d" if op is None else F.lit(False)
        rec = F.struct(F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), (F.col("op") if op is None else F.lit(op)).alias("op"))
        return df.withColumn("topic", F.lit("s.shop.orders")).withColumn("value", F.to_json(rec))
    return text(chunks, "r").select("low", "topic", "value"), text(changes, None).select("seq", "topic", "value")


def applied(events):
    """The state after events (seq, value)."""
    x = J.with_parsed(events, "value", "v")
    key = F.coalesce(J.path(F.col("v"), "$.after.id", "bigint"), J.path(F.col("v"), "$.before.id", "bigint"))
    x = x.select(key.alias("key"), F.col("seq").alias("pos"), J.path(F.col("v"), "$.op").alias("op"),
                 F.coalesce(J.path(F.col("v"), "$.after.state"), J.path(F.col("v"), "$.before.state")).alias("state"))
    return state_of(HO.current_rows(x, ["state"]))


def test_stream_equals_batch_at_any_pace(spark, scratch):
    """Chunk rows before, among and after the changes."""
    chunks, changes = as_events(*inputs(spark))
    want = state_of(C.cdc_handover_state(spark, SF))
    for name, n_changes, n_chunks in (("ahead", 5, 1), ("behind", 1, 4), ("mixed", 3, 3)):
        root = f"{scratch}/{name}"
        cs = _write_chunks(changes, f"{root}/changes", ["seq"], n=n_changes)
        ks = _write_chunks(chunks, f"{root}/chunks", ["value"], n=n_chunks)
        stream = lambda path, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        out = jobs.handover_stream(stream(f"{root}/changes", cs), stream(f"{root}/chunks", ks), "id")
        got = _memory(out, f"handover_{name}", f"{root}/ck")
        assert applied(got) == want, name


def test_app_with_snapshot(spark, scratch):
    """The chunk reader notes its marks; cdc-ingest takes rows and changes; a row without key passes."""
    base = spark.createDataFrame([(i, "base") for i in range(30)], "id long, state string")
    at = iter((0, 100, 200))
    SC.snapshot_in_chunks([(0, 10), (10, 20), (20, 30)], lambda a, b: CDC.snapshot_events(base.where(f"id >= {a} and id < {b}"), "shop", "orders"),
                          lambda: next(at), f"{scratch}/snap")
    new = [(50, 3, "u"), (150, 12, "u"), (150, 25, "u"), (250, 29, "d"), (20, 5, "u")]
    changes = [(s, "srv.shop.orders", f'{{"before":{{"id":{k}}},"after":{"null" if op == "d" else f"""{{"id":{k},"state":"new{s}"}}"""},"op":"{op}"}}') for s, k, op in new]
    changes.append((300, "srv.shop.orders", '{"after":{"name":"no key"},"op":"c"}'))
    spark.createDataFrame(changes, "seq long, topic string, value string").coalesce(1).write.parquet(f"{scratch}/in")
    for q in apps.cdc_ingest(spark, f"files:{scratch}/in", f"files:{scratch}/out", f"{scratch}/ck", {"availableNow": True}, snapshot=f"files:{scratch}/snap"):
        q.awaitTermination(120)
        assert q.exception() is None
    env = CDC.parse_envelopes(spark.read.parquet(f"{scratch}/out/{apps.TOPICS['db']}"))
    got = env.select("seq", "operation", F.try_variant_get(F.element_at("data", F.lit("id")), "$", "long").alias("id")).collect()
    reads = {r.id for r in got if r.operation == "read"}
    assert reads == set(range(30)) - {3, 5, 12, 29} and len([r for r in got if r.operation != "read"]) == 6   # 25 changed before its chunk
