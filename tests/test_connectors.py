"""Source / sink option builders and the change-feed table filter."""

import json

from pyspark.sql import functions as F

from larkspur.operators import cdc as CDC
from larkspur.sources import connectors as SC
from larkspur.sources import sinks as SK


def test_kafka_source_options():
    o = SC.kafka_source_options("b:9092", "ods_base_log", group_id="g")
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "ods_base_log",
                 "startingOffsets": "earliest", "kafka.group.id": "g"}
    t = SC.kafka_source_options("b:9092", "ods_base_db", starting=1_700_000_123_000)
    assert t["startingTimestamp"] == "1700000123000" and "startingOffsets" not in t


def test_kafka_sink_options():
    assert SK.kafka_sink_options("b:9092", "dwd_page_log")["topic"] == "dwd_page_log"
    assert "topic" not in SK.kafka_sink_options("b:9092")   # record-chosen topic column


def test_record_ids_are_unique_across_partitions(spark):
    df = spark.createDataFrame([(p, o) for p in (0, 1, 40) for o in (0, 7, (1 << 48) - 1)], "p int, o long")
    got = [r[0] for r in df.orderBy("p", "o").select(SC.record_id(F.col("p"), F.col("o"))).collect()]
    assert len(set(got)) == 9 and got == sorted(got)


def test_dirty_change_events(spark):
    texts = ['{"op":"c","after":{"id":1}}', "{bad", "[1]", '{"after":{}}', '{"op":"t"}', None, '{"op":"D"}']
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, value string")
    good, dirty = CDC.split_dirty_changes(df)
    assert sorted(r.seq for r in good.collect()) == [0, 6]
    assert {r.seq: r.reason for r in dirty.collect()} == {1: "bad_text", 2: "bad_text", 3: "no_op", 4: "unknown_op", 5: "bad_text"}


def test_compacted_dimension_is_read(spark, scratch):
    def batch(n, rows):
        df = spark.createDataFrame([("dim", k, {"v": v}) for k, v in rows], "sink_table string, pk string, data map<string,string>")
        SK.write_batch(df, f"{scratch}/dims", n, partition_by=("sink_table",))
    batch(0, [("a", "0"), ("b", "0")])
    batch(1, [("a", "1")])
    for _ in range(2):
        SK.compact_dimension(spark, f"{scratch}/dims", 1)
    batch(2, [("b", "2")])
    assert {r.pk: r.data["v"] for r in SK.read_dimension(spark, f"{scratch}/dims").collect()} == {"a": "1", "b": "2"}
    SK.compact_dimension(spark, f"{scratch}/dims", 2)
    only = spark.read.parquet(f"{scratch}/dims_compact").where("batch_id = 2")
    assert {r.pk: r.data["v"] for r in only.collect()} == {"a": "1", "b": "2"}


def test_change_feed_table_list(spark):
    def ev(db, t):
        return json.dumps({"before": None, "after": {"id": 1}, "op": "c", "source": {"db": db, "table": t}})
    df = spark.createDataFrame([("s.a.x", ev("a", "x")), ("s.a.y", ev("a", "y")), ("s.b.x", ev("b", "x"))],
                               "topic string, value string")
    assert SC.change_feed(df, databases=["a"]).count() == 2
    assert SC.change_feed(df, tables=["a.y"]).count() == 1
