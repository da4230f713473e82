"""Outputs of a batch as one unit: a batch killed between two outputs shows nothing, its replay shows everything once."""

import pytest
from pyspark.sql import functions as F

from larkspur import catalog as C
from larkspur.sources import commits as CM
from larkspur.sources import records as R
from larkspur.sources import sinks as SK
from larkspur.sources.tables import table
from larkspur.streaming import jobs as J
from tests.test_streaming import SF


class Killed(Exception):
    pass


@pytest.fixture()
def parts(spark):
    """The change feed as three micro-batches."""
    feed = C._change_feed(spark, SF)
    return [feed.where(F.pmod(F.xxhash64("value"), F.lit(3)) == i) for i in range(3)], (lambda s: R.config_feed(table(s, SF, "orders")))


def want_topics(spark):
    return sorted(map(tuple, C.route_topic_value(spark, SF).collect()))


def topics_of(spark, root):
    x = CM.read_output(spark, root, "topics", "json")
    return [] if x is None else sorted(map(tuple, x.select("topic", "value").collect()))


def test_kill_between_outputs(spark, scratch, parts, monkeypatch):
    batches, config = parts
    root, real = f"{scratch}/out", CM.Batch.write
    J.route_batch(batches[0], 0, config, root, order="ord")
    after_first = topics_of(spark, root)
    for dies_at in ("dims", "metrics"):
        def write(self, df, name, **kw):
            if name == dies_at:
                raise Killed
            real(self, df, name, **kw)
        monkeypatch.setattr(CM.Batch, "write", write)
        with pytest.raises(Killed):
            J.route_batch(batches[1], 1, config, root, order="ord")
        monkeypatch.setattr(CM.Batch, "write", real)
        assert spark.read.json(f"{root}/topics").where("batch_id = 1").count() > 0      # topic files of the dead attempt
        assert topics_of(spark, root) == after_first                                     # which no reader sees
        assert CM.read_output(spark, root, "metrics").where("batch_id = 1").isEmpty()
    monkeypatch.setattr(CM.Batch, "commit", lambda self: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):                                                          # all written, not committed
        J.route_batch(batches[1], 1, config, root, order="ord")
    assert topics_of(spark, root) == after_first
    monkeypatch.undo()
    for i in (1, 2, 2, 1):                                                               # replays of committed batches too
        J.route_batch(batches[i], i, config, root, order="ord")
    assert topics_of(spark, root) == want_topics(spark)
    counts = CM.read_output(spark, root, "metrics").agg(F.sum("topic_records"), F.sum("dimension_records")).first()
    assert counts[0] == len(want_topics(spark)) and CM.commits(spark, root).count() == 3
    keys = {(r.sink_table, r.pk) for r in SK.read_dimension(spark, f"{root}/dims").collect()}
    assert keys == {(r.sink_table, r.pk) for r in C.dim_upsert_latest(spark, SF).collect()}
    assert all(sorted(r.outputs) == ["dims", "metrics", "topics"] for r in CM.commits(spark, root).collect())


def test_queue_rows_are_read_once(spark, scratch, parts, monkeypatch):
    """A broker keeps what a dead batch sent: the replay repeats the keys, and the reader keeps one row a key."""
    batches, config = parts
    root, sent = f"{scratch}/out", f"{scratch}/queue"
    publish = lambda df: df.write.mode("append").parquet(sent)
    monkeypatch.setattr(CM.Batch, "commit", lambda self: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):
        J.route_batch(batches[0], 0, config, root, order="ord", publish=publish)
    monkeypatch.undo()
    queue = lambda: spark.read.parquet(sent)
    assert CM.drop_replays(queue(), CM.commits(spark, root)).isEmpty() and not queue().isEmpty()
    for i in range(3):
        J.route_batch(batches[i], i, config, root, order="ord", publish=publish)
    got = CM.drop_replays(queue(), CM.commits(spark, root))
    assert sorted(map(tuple, got.select("topic", "value").collect())) == want_topics(spark) and queue().count() > got.count()
    assert {bytes(r.headers[0].value).decode() for r in got.select("headers").distinct().collect()} == {"0", "1", "2"}


def test_equal_rows_of_a_batch_stay(spark):
    rows = spark.createDataFrame([("t", "same"), ("t", "same"), ("t", "other"), ("t", None)], "topic string, value string")
    once = CM.stamp(rows, 7, "topics", ["topic", "value"])
    got = CM.drop_replays(once.unionByName(CM.stamp(rows.repartition(3), 7, "topics", ["topic", "value"])))
    assert sorted(r.value or "" for r in got.collect()) == ["", "other", "same", "same"]
    assert CM.drop_replays(once.unionByName(CM.stamp(rows, 8, "topics", ["topic", "value"]))).count() == 8


def test_replays_in_a_stream(spark, scratch):
    rows = CM.stamp(spark.range(50).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value")), 3, "topics", ["value"])
    rows = rows.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000))).drop("headers")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    q = (CM.drop_replays(stream).writeStream.format("memory").queryName("replays").option("checkpointLocation", f"{scratch}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert q.exception() is None and spark.table("replays").count() == 50


def test_nothing_written_nothing_read(spark, scratch):
    assert CM.read_output(spark, f"{scratch}/none", "topics") is None and CM.commits(spark, f"{scratch}/none").count() == 0
    empty = spark.createDataFrame([], "table string, seq long, stream string, sink_table string, sink_pk string, data map<string,variant>")
    J.write_routed(empty, 0, f"{scratch}/out")
    assert CM.commits(spark, f"{scratch}/out").count() == 1
