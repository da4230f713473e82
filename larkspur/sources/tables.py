"""Parquet table loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


MIN_PARTITIONS_CONF = "larkspur.scan.minPartitions"


def table(spark: SparkSession, sf_dir: str, name: str, min_partitions: int | None = None) -> DataFrame:
    """Read one table.

    Plain scan by default.  A file with a single row group scans as one
    task, so a caller that knows its inputs are single-split files (the
    benchmark) can set ``larkspur.scan.minPartitions`` (or pass
    ``min_partitions``): a scan with fewer partitions is then spread
    round-robin so CPU-heavy per-row work (JSON encode / parse) uses every
    core.  Filters and column pruning still reach the scan (they are pushed
    below the repartition)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    try:
        want = min_partitions or int(spark.conf.get(MIN_PARTITIONS_CONF, "0"))
        if want <= 1:
            return df
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: keep the plain scan
        return df
    return df.repartition(want) if have < want else df
