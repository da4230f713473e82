"""Shared helpers of the training-data operators: lineage cuts and connected components."""

from __future__ import annotations

import gc
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, functions as F


def shared_dir(spark) -> str:
    """The folder all executors share (``spark.checkpoint.dir``); a temporary one only where it is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = tempfile.mkdtemp(prefix="larkspur-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


#: Rows in one Arrow batch for operators on whole texts: a batch's texts stand in memory several times over, in the JVM
#: and in every Python worker, so the default of 10,000 rows costs an executor hundreds of MB.
TEXT_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``TEXT_ROWS`` rows (a smaller setting stays)."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= TEXT_ROWS:
        conf.set(name, str(TEXT_ROWS))
    return df


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def release(spark) -> None:
    """Spark drops the shuffle files and checkpoints of what nobody refers to any more, but only once the driver collects its
    garbage, which on a large input may be never: ask for it after a large shuffle."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _stars(batches):
    """Union-find over the edges of one partition, a batch at a time: the same connectivity with an edge a node."""
    for batch in batches:
        parent: dict[int, int] = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        got = [(find(v), v) for v in sorted(parent)]
        got = [(r, v) for r, v in got if r != v]
        yield pa.RecordBatch.from_pydict({"a": pa.array([r for r, _ in got], pa.int64()),
                                          "b": pa.array([v for _, v in got], pa.int64())})


#: Few edges make few tasks and few checkpoint files, whatever the partitions: these many, and one for each so many edges.
TASKS, EDGES = 8, 200_000


def _settle(edges: DataFrame, most: int | None = None) -> tuple[DataFrame, tuple]:
    """The edges (``most`` of them at most, if known), contracted in their partitions and cut, with a signature taken on the way."""
    seen = Observation()
    few = edges if most is None else edges.coalesce(TASKS + most // EDGES)
    out = cut(few.mapInArrow(_stars, "a long, b long")
              .observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")))
    return out, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (id, component), component the smallest id reached.

    The smallest id of a component, and ids without an edge, do not appear: join from the left and take the id itself.
    Alternating large-star / small-star rounds: every round is twice a partial aggregate for the smallest neighbour and
    an equi-join (which adaptive execution can split for a hub), so no task holds a component.  Self loops and repeated
    edges are ignored."""
    e, before = _settle(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    while before[0]:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        low2 = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low2, "b")
        e, after = _settle(small.select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(
            F.col("m").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*").where("a <> b"), 2 * before[0])
        if after == before:
            break
        before = after
    return e.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("component")).coalesce(TASKS + before[0] // EDGES)
