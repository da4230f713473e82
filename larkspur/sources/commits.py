"""SNK3: the outputs of a micro-batch become visible together, once.

A batch writes each of its outputs into a folder of its own attempt, ``<root>/<name>/batch_id=N/attempt=..``, and last of
all one commit record, ``<root>/commits/batch_id=N``: a table of one row in one file, which appears whole or not at all.
Readers join an output with the commit records, so a batch that died between two outputs shows nothing of any of them,
and a replay, a new attempt, shows each row once.  A batch that is committed already is not written again.

Rows for a message queue cannot be taken back, so each carries its batch and a key that a replay repeats: the batch, the
output, a hash of what identifies the row in its batch, and how many equal rows came before it.  ``drop_replays`` keeps
one row a key, in a batch read of only committed batches or in a stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COMMITS = "commits"


def read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` reads, or None where its path does not exist; every other error is raised."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def commits(spark: SparkSession, root: str) -> DataFrame:
    """(batch_id, attempt, outputs) of the committed batches."""
    found = read_if_there(lambda: spark.read.parquet(f"{root.rstrip('/')}/{COMMITS}"))
    if found is None:
        return spark.createDataFrame([], "batch_id long, attempt string, outputs array<string>")
    return found.select(F.col("batch_id").cast("long").alias("batch_id"), "attempt", "outputs")


class Batch:
    """One attempt at writing the outputs of a micro-batch.

    ``done`` is true where the batch is committed already: a replay then has nothing to do."""

    def __init__(self, spark: SparkSession, root: str, batch_id: int):
        self.spark, self.root, self.batch_id = spark, root.rstrip("/"), int(batch_id)
        self.attempt, self.outputs = f"a{uuid.uuid4().hex}", []      # the letter keeps the folder name a string
        self.done = not commits(spark, root).where(F.col("batch_id") == self.batch_id).isEmpty()

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
        w = df.write.format(fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(f"{self.root}/{name}/batch_id={self.batch_id}/attempt={self.attempt}")
        self.outputs.append(name)

    def published(self, name: str) -> None:
        """An output that went to a queue: its rows carry the batch, the commit record only lists it."""
        self.outputs.append(name)

    def commit(self) -> None:
        names = F.array(*map(F.lit, self.outputs)) if self.outputs else F.array().cast("array<string>")
        record = self.spark.range(1).select(F.lit(self.attempt).alias("attempt"), names.alias("outputs"))
        # Overwriting replaces what a commit that never finished left behind; a finished one is never written again.
        record.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{COMMITS}/batch_id={self.batch_id}")


def write_all(spark: SparkSession, root: str, batch_id: int, write: Callable[[Batch], None]) -> None:
    """Run ``write`` for one micro-batch and commit what it wrote; nothing at all where the batch is committed."""
    batch = Batch(spark, root, batch_id)
    if batch.done:
        return
    write(batch)
    batch.commit()


def read_output(spark: SparkSession, root: str, name: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame | None:
    """The committed rows of an output (None where nothing was ever written under the name)."""
    def read() -> DataFrame:
        r = spark.read.format(fmt)
        return (r.schema(schema) if schema else r).load(f"{root.rstrip('/')}/{name}")

    rows = read_if_there(read)
    return None if rows is None else visible(rows, commits(spark, root))


def visible(rows: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows (batch_id, attempt, ..) of committed attempts."""
    return rows.join(committed.select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")


def retire(spark: SparkSession, root: str, names: Sequence[str], before: int) -> None:
    """Remove the folders of batches below ``before`` of outputs that only the next batch reads (state tables)."""
    jvm = spark._jvm.org.apache.hadoop.fs
    for name in names:
        folder = jvm.Path(f"{root.rstrip('/')}/{name}")
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            continue
        for entry in files.listStatus(folder):
            batch = entry.getPath().getName().partition("batch_id=")[2]
            if batch.isdigit() and int(batch) < before:
                files.delete(entry.getPath(), True)


# ------------------------------------------------------------------ queue rows
def stamp(rows: DataFrame, batch_id: int, name: str, identity: Sequence[Column | str]) -> DataFrame:
    """``rows`` with ``key`` (``batch:output:row:occurrence``) and the batch in ``headers``.

    ``identity`` names what tells a row of the batch from others, best its place in the input; rows that agree in it are
    numbered, so equal rows of one batch stay as many as they are."""
    row = F.xxhash64(*identity)
    same = Window.partitionBy("_row").orderBy(F.lit(0))
    headers = F.array(F.struct(F.lit("batch_id").alias("key"), F.lit(str(int(batch_id))).cast("binary").alias("value")))
    return (rows.withColumn("_row", row).withColumn("_n", F.row_number().over(same))
            .withColumn("key", F.concat(F.lit(f"{int(batch_id)}:{name}:"), F.hex("_row"), F.lit(":"), F.col("_n").cast("string")))
            .withColumn("headers", headers).drop("_row", "_n"))


def batch_of(key: Column) -> Column:
    return F.substring_index(key, ":", 1).cast("long")


def drop_replays(messages: DataFrame, committed: DataFrame | None = None, topic: str = "topic", delay: str = "1 day",
                 ts: str = "timestamp") -> DataFrame:
    """Messages (topic, key, value, ..) without those that a replay sent again: one a key.

    In a batch read with ``committed`` (``commits``), messages of batches without a commit record are left out as well.
    In a stream, keys are remembered for ``delay`` of event time (column ``ts``)."""
    if messages.isStreaming:
        return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark([topic, "key"])
    if committed is not None:
        known = committed.select(F.col("batch_id").alias("_batch"))
        messages = messages.join(known, batch_of(F.col("key")) == F.col("_batch"), "left_semi")
    return messages.dropDuplicates([topic, "key"])
