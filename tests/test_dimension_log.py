"""The dimension log: buckets, the row's own order, compaction a bucket at a time, retired folders."""

import os

from pyspark.sql import functions as F

from larkspur.sources import sinks as SK


def batch(spark, path, n, rows):
    """Rows (pk, order, value) of batch n."""
    df = spark.createDataFrame([("dim", k, at, v) for k, at, v in rows], "sink_table string, sink_pk string, at long, v string")
    df = df.withColumn("data", F.create_map(F.lit("id"), F.col("sink_pk").cast("variant"), F.lit("v"), F.col("v").cast("variant")))
    SK.upsert_dimension(df.withColumn("sink_pk", F.lit("id")), path, n, "at")


def values(df):
    return {r.pk: r.data["v"] for r in df.collect()}


def folders(path):
    return sorted(int(d.split("=")[1]) for d in os.listdir(path) if d.startswith("batch_id="))


def test_rounds_of_compaction_keep_folders_bounded(spark, scratch):
    path, want, most = f"{scratch}/dims", {}, 0
    for n in range(30):
        rows = [(f"k{(n * 7 + j) % 11}", n * 10 + j, f"v{n}.{j}") for j in range(3)]
        batch(spark, path, n, rows)
        want.update({k: v for k, _, v in rows})
        if n % 6 == 5:
            SK.compact_dimension(spark, path, n, retire=True)
            assert values(SK.read_dimension(spark, path)) == want
        most = max(most, len(folders(path)) + (len(folders(f"{path}_compact")) if os.path.isdir(f"{path}_compact") else 0))
    assert values(SK.read_dimension(spark, path)) == want and most <= 2 * 6 + 3
    SK.compact_dimension(spark, path, 29, retire=True)       # again: nothing changes
    assert values(SK.read_dimension(spark, path)) == want and folders(path)[0] == 24


def test_rows_keep_their_order_across_batches(spark, scratch):
    """A row that comes late does not replace a newer one, before and after compaction."""
    path = f"{scratch}/dims"
    batch(spark, path, 0, [("a", 50, "new"), ("b", 5, "old")])
    batch(spark, path, 1, [("a", 20, "late"), ("b", 9, "newer")])
    assert values(SK.read_dimension(spark, path)) == {"a": "new", "b": "newer"}
    SK.compact_dimension(spark, path, 1)
    batch(spark, path, 2, [("a", 30, "late too"), ("b", 9, "same order, later batch")])
    assert values(SK.read_dimension(spark, path)) == {"a": "new", "b": "same order, later batch"}


def test_a_key_reads_its_bucket_only(spark, scratch):
    path = f"{scratch}/dims"
    batch(spark, path, 0, [(f"k{i}", i, f"v{i}") for i in range(60)])
    one = SK.read_dimension(spark, path, pk="k7")
    assert values(one) == {"k7": "v7"}
    read = {f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()} if len(one.inputFiles()) < 16 else None
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and (read is None or len(read) == 1)
    assert len(os.listdir(f"{path}/batch_id=0")) > 10


def test_an_interrupted_round_loses_nothing(spark, scratch, monkeypatch):
    path = f"{scratch}/dims"
    for n in range(3):
        batch(spark, path, n, [(f"k{i}", n * 100 + i, f"{n}.{i}") for i in range(20)])
    SK.compact_dimension(spark, path, 0, retire=True)
    real, calls = SK._current, []

    def dies(log):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("killed")
        return real(log)
    monkeypatch.setattr(SK, "_current", dies)
    try:
        SK.compact_dimension(spark, path, 1, retire=True)
    except RuntimeError:
        pass
    monkeypatch.undo()
    want = {f"k{i}": f"2.{i}" for i in range(20)}
    assert values(SK.read_dimension(spark, path)) == want and folders(path) == [0, 1, 2]
    SK.compact_dimension(spark, path, 2, retire=True)
    assert values(SK.read_dimension(spark, path)) == want
