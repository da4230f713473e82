"""Sharding by sampled splitters: shards of near-equal bytes, equal texts side by side.

The key of a record is (hash of its text, doc_id).  A hash-drawn, size-weighted sample of keys gives ``RANGES``
quantile splitters (more on large inputs, one for each ``RANGE_BYTES``, so that a task's range stays small at any size;
the driver holds one key a range), which cut the key space into small ranges; one aggregate measures them exactly.  The cuts between
shards belong where the running size passes k / shards of all bytes.  Only the ranges that a cut falls into (the
overfull ones) are subdivided, by ordering their own records: the cut goes to the nearest edge between groups of equal
texts, or inside a group if that edge is more than ``SLACK`` of a shard away, so a text with a third of all rows is
split by doc_id and others stay together.  Shard and position then follow from the record's key; slots count on from
the sizes of the ranges before it, so no task orders more than one range.

Results for odd input: a null text has size 1 and no checksum; a null doc_id comes first in its group; rows with equal
keys share a shard and their slots are dealt in any order; with fewer records than shards some shards stay empty;
``shard`` keeps further columns (its own replace columns of the same name); an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

SHARDS, RANGES, PER_RANGE, SLACK = 8, 512, 24, 0.02
RANGE_BYTES = 128 << 20
_NO_ID = -(1 << 63)


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keys(text: Column, doc_id: Column) -> dict[str, Column]:
    return {"size": size_of(text), "__k": F.xxhash64(text), "__d": F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))}


def _place(cuts: tuple[np.ndarray, np.ndarray]):
    """Arrow-batched lookup: how many of the sorted cut keys (k, d) are below or equal to each record's key."""
    ck, cd = cuts

    def run(k: pd.Series, d: pd.Series) -> pd.Series:
        k, d = k.to_numpy(), d.to_numpy()
        lo, hi = np.searchsorted(ck, k, "left"), np.searchsorted(ck, k, "right")
        out = lo.copy()
        for x in np.unique(lo[lo < hi]):  # records of a text that is itself a splitter: place by doc_id
            at = np.flatnonzero((lo == x) & (lo < hi))
            top = hi[at[0]]
            out[at] = x + np.searchsorted(cd[x:top], d[at], "right")
        return pd.Series(out.astype(np.int32))

    return F.pandas_udf(run, "int")


def _sorted_cuts(rows) -> tuple[np.ndarray, np.ndarray]:
    rows = sorted({(r[0], r[1]) for r in rows})
    return np.array([k for k, _ in rows], np.int64), np.array([d for _, d in rows], np.int64)


def splitters(slim: DataFrame, total: int, ranges: int, per_range: int) -> tuple[np.ndarray, np.ndarray]:
    """Quantile keys of a sample: about ranges * per_range keys, each drawn with odds in proportion to its size."""
    step = max(1.0, total / (ranges * per_range))
    u = (F.shiftrightunsigned(F.xxhash64("__k", "__d", F.lit("draw")), 11)).cast("double") / float(1 << 53)
    # A record of many steps' size counts as often: whole steps for certain, the rest by its draw.
    weight = F.floor(F.col("size") / F.lit(step) + u)
    sample = slim.withColumn("w", weight).where("w > 0")
    run = Window.orderBy("__k", "__d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = F.lit(per_range)
    marks = (sample.select("__k", "__d", "w").withColumn("upto", F.sum("w").over(run))
             .where(F.floor(F.col("upto") / every) > F.floor((F.col("upto") - F.col("w")) / every)))
    return _sorted_cuts([(r["__k"], r["__d"]) for r in marks.select("__k", "__d").collect()])  # at most ranges + 1


def shard_cuts(slim: DataFrame, cuts: tuple[np.ndarray, np.ndarray], shards: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """First keys of the shards 1 .. shards - 1."""
    sums = (slim.withColumn("range", _place(cuts)("__k", "__d")).groupBy("range")
            .agg(F.sum("size").alias("bytes")).orderBy("range").collect())  # one row a range
    upto = np.cumsum([r["bytes"] for r in sums])
    total = int(upto[-1]) if len(upto) else 0
    wanted = []
    for i in range(1, shards):
        aim = total * i / shards
        at = int(np.searchsorted(upto, aim))
        if at < len(sums):
            wanted.append((i, sums[at]["range"], float(aim), int(upto[at] - sums[at]["bytes"])))
    if not wanted:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    spark = slim.sparkSession
    aims = spark.createDataFrame(wanted, "cut int, range int, aim double, below long")
    # A group of equal texts may reach into the neighbouring ranges; its true extent is measured for the texts there.
    full = slim.withColumn("range", _place(cuts)("__k", "__d"))
    inside = full.join(F.broadcast(aims.select("range").distinct()), "range")
    order = Window.partitionBy("range").orderBy("__k", "__d", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("upto", F.sum("size").over(order))
    found = (ranked.join(F.broadcast(aims), "range").withColumn("upto", F.col("upto") + F.col("below"))
             .withColumn("start", F.col("upto") - F.col("size")))
    # The first record whose middle is past the aim, and the nearest edge between texts on either side within reach.
    reach = slack * total / shards
    head = Window.partitionBy("cut", "__k")
    found = found.withColumns({"middle": F.col("start") + F.col("size") / 2, "edge": F.min("start").over(head)})
    inner = found.where("middle >= aim").groupBy("cut").agg(F.min(F.struct("start", "__k", "__d")).alias("inner"))
    edges = (found.where("start = edge").where(F.abs(F.col("start") - F.col("aim")) <= reach)
             .where(F.col("start") > F.col("below"))  # an edge at the range's start may lie inside a text
             .groupBy("cut").agg(F.min(F.struct(F.abs(F.col("start") - F.col("aim")).alias("off"), "__k")).alias("edge")))
    rows = inner.join(edges, "cut", "full_outer").collect()  # one row a cut
    return _sorted_cuts([(r["edge"]["__k"], _NO_ID) if r["edge"] else (r["inner"]["__k"], r["inner"]["__d"]) for r in rows])


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, per_range: int = PER_RANGE,
          slack: float = SLACK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``docs`` with size, shard and slot (position in the shard, by key, without gaps)."""
    own = ("size", "shard", "slot")
    rows = docs.drop(*own).withColumns(_keys(F.col("text"), F.col("doc_id")))
    slim = cut(rows.select("size", "__k", "__d"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    cuts = splitters(slim, total, max(ranges, total // range_bytes), per_range)
    bounds = shard_cuts(slim, cuts, shards, slack)
    fine = _sorted_cuts([*zip(*map(np.ndarray.tolist, cuts)), *zip(*map(np.ndarray.tolist, bounds))])
    first_range = np.array([np.flatnonzero((fine[0] == k) & (fine[1] == d))[0] + 1 for k, d in zip(*bounds)], np.int64)
    place = _place(fine)
    counts = slim.withColumn("range", place("__k", "__d")).groupBy("range").count().orderBy("range").collect()  # one row a range
    ahead, seen, now = [], 0, 0
    for r in counts:
        s = int(np.searchsorted(first_range, r["range"], "right"))
        if s != now:
            seen, now = 0, s
        ahead.append((r["range"], s, seen))
        seen += r["count"]
    offset = docs.sparkSession.createDataFrame(ahead, "__r int, shard int, __ahead long")
    order = Window.partitionBy("__r").orderBy("__k", "__d", "size")
    return (rows.withColumn("__r", place("__k", "__d")).withColumn("__n", F.row_number().over(order) - 1)
            .join(F.broadcast(offset), "__r").withColumn("slot", (F.col("__n") + F.col("__ahead")).cast("long"))
            .select(*[c for c in docs.columns if c not in own], *own))


def digest(docs: DataFrame, **options) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("text").cast("binary")).alias("text_crc32"))  # before the texts are let go
    return shard(rows, **options).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                         F.lit(None).cast("int").alias("grown_shard"))
