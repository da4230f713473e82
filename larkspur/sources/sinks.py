"""Sinks (SNK1-SNK4).

A single file output is idempotent per micro-batch (``write_batch``): a batch
overwrites its own ``batch_id`` folder as a whole.  Several outputs of a batch
are one unit under ``sources.commits``, which also gives queue rows a key that
lets readers drop replays (Spark's Kafka sink is at-least-once).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.operators import routing as RT
from larkspur.sources import commits as CM


def kafka_sink_options(bootstrap: str, topic: str | None = None, **extra: str) -> dict[str, str]:
    """SNK1 (fixed topic) / SNK2 (``topic`` column when ``topic`` is None)."""
    opts = {"kafka.bootstrap.servers": bootstrap}
    if topic:
        opts["topic"] = topic
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def to_kafka(df: DataFrame, bootstrap: str, topic: str | None, checkpoint: str):
    """SNK1 / SNK2 streaming writer (``value`` [+ ``topic``] columns)."""
    w = df.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in kafka_sink_options(bootstrap, topic).items():
        w = w.option(k, v)
    return w.start()


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> None:
    """SNK3: idempotent batch write.  The folder ``batch_id=N`` is one overwrite unit: a replay replaces all of it,
    whatever partitions (or none) the new attempt has."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(f"{path.rstrip('/')}/batch_id={int(batch_id)}")


def write_topics(topic_value: DataFrame, path: str, batch_id: int) -> None:
    """SNK2 on files: one folder per record-chosen topic."""
    write_batch(topic_value, path, batch_id, partition_by=("topic",), fmt="json")


#: Hash buckets of a dimension log: reading a key and compacting touch one at a time.
BUCKETS = 16


def bucket_of(pk, buckets: int = BUCKETS):
    return F.pmod(F.xxhash64(pk), F.lit(buckets)).cast("int")


def dimension_rows(hbase_rows: DataFrame, order: str | Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """SNK4: a batch's surviving row per (sink_table, pk): values by column name, all as strings, the row's own order ``at``
    beside them, and the key's ``bucket``."""
    as_text = F.transform_values(F.col("data"), lambda k, v: F.try_variant_get(v, "$", "string"))
    return RT.dim_upsert_latest(hbase_rows, order, keep="at").select(
        "sink_table", "pk", as_text.alias("data"), "at", bucket_of(F.col("pk"), buckets).alias("bucket"))


def upsert_dimension(hbase_rows: DataFrame, path: str, batch_id: int, order: str | Sequence[str]) -> None:
    """SNK4: append the batch's ``dimension_rows`` to an upsert log; readers merge on read (latest order, then latest
    batch)."""
    write_batch(dimension_rows(hbase_rows, order), path, batch_id, partition_by=LOG_FOLDERS)


LOG_FOLDERS = ("bucket", "sink_table")


def _dimension_log(spark: SparkSession, path: str) -> DataFrame:
    """The upsert log with its compacted snapshots (each counts as the last batch folded into it).  Of a log that a
    routing batch commits with its other outputs, only committed attempts."""
    path = path.rstrip("/")
    log = CM.read_if_there(lambda: spark.read.parquet(path))
    if log is not None and "attempt" in log.columns:
        log = CM.visible(log, CM.commits(spark, path.rpartition("/")[0])).drop("attempt")
    parts = [p for p in (log, CM.read_if_there(lambda: spark.read.parquet(f"{path}_compact"))) if p is not None]
    if not parts:
        raise ValueError(f"no dimension log at {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def _current(log: DataFrame) -> DataFrame:
    """One row a (sink_table, pk): the latest by the rows' own order, then by batch.  Of logs without the order kept, by batch."""
    rank = F.struct("at", "batch_id") if "at" in log.columns else F.col("batch_id")
    kept = [F.max("at").alias("at")] if "at" in log.columns else []
    return log.groupBy("sink_table", "pk").agg(F.max_by(F.col("data"), rank).alias("data"), *kept)


def read_dimension(spark: SparkSession, path: str, pk: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Current dimension rows (sink_table, pk, data), snapshots included; with ``pk``, of that key, read from its bucket only."""
    log = _dimension_log(spark, path)
    if pk is not None:
        log = log.where((F.col("bucket") == bucket_of(F.lit(pk), buckets)) & (F.col("pk") == pk))
    return _current(log).select("sink_table", "pk", "data")


def compact_dimension(spark: SparkSession, path: str, upto_batch: int, retire: bool = False) -> None:
    """Fold batches ``<= upto_batch`` of an upsert log and older snapshots into one snapshot under ``<path>_compact`` (as batch
    ``upto_batch``), a bucket at a time.

    ``retire`` then removes what the snapshot before this one had already folded: its log batches and the snapshots older than it.
    So readers that are under way keep their files for one round, an interrupted round loses nothing, and the folders stay as
    many as two rounds make.  Re-running is idempotent."""
    path = path.rstrip("/")
    snapshots = CM.read_if_there(lambda: spark.read.parquet(f"{path}_compact"))
    before = None if snapshots is None else snapshots.where(F.col("batch_id") < upto_batch).agg(F.max("batch_id")).first()[0]
    log = _dimension_log(spark, path).where(F.col("batch_id") <= upto_batch)
    # Not from its own target: a re-run replaces a snapshot that is already there from the log and the older ones.
    if snapshots is not None:
        folded = snapshots.where(F.col("batch_id") == upto_batch)
        if not folded.isEmpty():
            return
    if "bucket" not in log.columns:
        write_batch(_current(log), f"{path}_compact", upto_batch, partition_by=("sink_table",))
    else:
        for b in sorted(r.bucket for r in log.select("bucket").distinct().collect()):     # at most BUCKETS
            part = _current(log.where(F.col("bucket") == b))
            part.write.mode("overwrite").partitionBy("sink_table").parquet(f"{path}_compact/batch_id={int(upto_batch)}/bucket={b}")
    if retire and before is not None:
        root, _, name = path.rpartition("/")
        CM.retire(spark, root, (name,), before + 1)
        CM.retire(spark, root, (f"{name}_compact",), before)


def write_kafka_batch(df: DataFrame, bootstrap: str, topic: str | None = None) -> None:
    """SNK1 / SNK2 from ``foreachBatch``: ``value`` (+ ``topic``, and ``key``, ``headers`` of ``commits.stamp``)."""
    w = df.write.format("kafka")
    if "headers" in df.columns:
        w = w.option("includeHeaders", "true")
    for k, v in kafka_sink_options(bootstrap, topic).items():
        w = w.option(k, v)
    w.save()
