"""Stream sources (SRC1-SRC4).

Connection settings are always parameters.  The Kafka and JDBC data
sources need their connector jars on the cluster classpath; the option
builders are plain dicts so they can be checked without a broker, and the
file-stream source runs the same downstream code in tests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions import json as J
from larkspur.functions import text as TX


def kafka_source_options(bootstrap: str, topic: str, starting: str | int = "earliest",
                         group_id: str | None = None, **extra: str) -> dict[str, str]:
    """SRC1 / SRC2: ``starting="earliest"`` or an epoch-ms timestamp."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic}
    if isinstance(starting, int):
        opts["startingTimestamp"] = str(starting)
    else:
        opts["startingOffsets"] = starting
    if group_id:
        opts["kafka.group.id"] = group_id
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def record_id(partition: Column, offset: Column) -> Column:
    """One long from partition and offset (below 2^48): unique, in offset order inside a partition."""
    return F.shiftleft(partition.cast("long"), 48).bitwiseOR(offset.cast("long"))


def kafka_text_stream(spark: SparkSession, bootstrap: str, topic: str, starting: str | int = "earliest",
                      group_id: str | None = None) -> DataFrame:
    """SRC1: Kafka topic as ``(rec_id, value STRING, kafka_ts, topic)``; ``rec_id`` is unique in the topic and rises
    in every partition (``record_id``), so it orders the records of a key that its producer keeps in one partition."""
    r = spark.readStream.format("kafka")
    for k, v in kafka_source_options(bootstrap, topic, starting, group_id).items():
        r = r.option(k, v)
    return r.load().select(record_id(F.col("partition"), F.col("offset")).alias("rec_id"), F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("kafka_ts"), F.col("topic"))


def file_text_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """File-stream stand-in for a topic (same columns as the records)."""
    r = spark.readStream.format(fmt)
    if schema:
        r = r.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def change_feed(records: DataFrame, databases: list[str] | None = None,
                tables: list[str] | None = None, value: str = "value", topic: str = "topic") -> DataFrame:
    """SRC3 / SRC4: change events of whole databases or a table list
    (``db.table`` names), by the event's ``source`` block or, without one, the
    topic ``<server>.<db>.<table>``; one parse a record."""
    if not databases and not tables:
        return records
    x = J.with_parsed(records, value, "_fv")
    db = F.coalesce(J.path(F.col("_fv"), "$.source.db"), TX.topic_db_table(topic)[0])
    tb = F.coalesce(J.path(F.col("_fv"), "$.source.table"), TX.topic_db_table(topic)[1])
    x = x.select(*records.columns, db.alias("_db"), tb.alias("_tb"))
    return of_tables(x, databases, tables, "_db", "_tb").drop("_db", "_tb")


def of_tables(events: DataFrame, databases: list[str] | None = None, tables: list[str] | None = None,
              db: str = "dbname", table: str = "table") -> DataFrame:
    """SRC3 / SRC4 on events whose database and table are columns (CDC1's output)."""
    cond = F.lit(True)
    if databases:
        cond = cond & F.col(db).isin(*databases)
    if tables:
        cond = cond & F.concat_ws(".", F.col(db), F.col(table)).isin(*tables)
    return events.where(cond)


def jdbc_snapshot(spark: SparkSession, url: str, table: str, user: str | None = None,
                  password: str | None = None, partition_column: str | None = None,
                  lower: int | None = None, upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """Initial snapshot of a table (the read phase of SRC3), partitioned by a
    numeric column when given so it is read in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if user:
        r = r.option("user", user)
    if password:
        r = r.option("password", password)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def snapshot_in_chunks(bounds: Iterable[tuple], read: Callable[..., DataFrame], position: Callable[[], int], out: str) -> None:
    """SRC3's snapshot phase for a table in use: for every chunk (``bounds``: from, to) note the position that the change
    feed has reached, then read the chunk and append its events (``read(from, to)``: topic, value) with that low mark to
    ``out``, where ``jobs.handover_stream`` takes them up.  One chunk is read at a time; a chunk is read in parallel."""
    for lo, hi in bounds:
        low = position()
        read(lo, hi).withColumn("low", F.lit(int(low)).cast("long")).select("low", "topic", "value").write.mode("append").parquet(out)
