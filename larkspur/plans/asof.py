"""As-of merge of two ordered inputs, cut into segments.

Every left row takes the last right row of its key that comes strictly before it.  Both inputs are laid out by
(key, segment), a segment being ``width`` consecutive places of the order, and merged in one sorted pass: "last right
row so far".  What a segment starts with is carried in from the segments before: the last right row of each (key,
segment) that has one, spread over the segments up to the next that has one (``_carried``), and a key's very last right
row beyond those (``_final``, one row a key, broadcast).  So a window holds the rows of one key in ``width`` places however many rows and versions
the key has; nothing is sampled, no key's history stands in one row, and the left input passes once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Places of the order (arrival numbers) in one segment.
WIDTH_CONF, DEFAULT_WIDTH = "larkspur.asof.width", 1 << 19


def width_for(spark: SparkSession, width: int | None) -> int:
    return int(width if width is not None else spark.conf.get(WIDTH_CONF, str(DEFAULT_WIDTH)))


def merge(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str], order: str,
          payload: Sequence[str], width: int | None = None) -> DataFrame:
    """``left`` with ``matched``, the struct (order, *payload) of its key's last ``right`` row before it; rows without
    one are dropped.  Null keys are equal to null.  Right rows of equal key and order count in the order of ``payload``."""
    step = width_for(left.sparkSession, width)
    keys = [f"_k{i}" for i in range(len(left_keys))]
    blank = [f"_b{i}" for i in range(len(left_keys))]

    def laid_out(df: DataFrame, names: Sequence[str], row, version, side: int) -> DataFrame:
        return df.select(*[F.coalesce(F.col(n), F.lit("")).alias(k) for n, k in zip(names, keys)],
                         *[F.col(n).isNull().alias(b) for n, b in zip(names, blank)],
                         F.floor(F.col(order) / F.lit(step)).cast("long").alias("_seg"), F.col(order).cast("long").alias("_at"),
                         F.lit(side).alias("_side"), row.alias("_row"), version.alias("_version"))

    version = F.struct(F.col(order).cast("long").alias(order), *[F.col(c) for c in payload])
    versions = laid_out(right, right_keys, F.lit(None), version, 1)
    key = [*keys, *blank]
    rows = laid_out(left, left_keys, F.struct(*left.columns), F.lit(None), 0)
    inside = Window.partitionBy("_seg", *key).orderBy("_at", "_side", "_version").rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(versions).withColumn("_inside", F.last("_version", ignorenulls=True).over(inside)).where("_side = 0")

    last = (versions.groupBy(*key, "_seg").agg(F.max("_version").alias("_last"))
            .withColumn("_next", F.lead("_seg").over(Window.partitionBy(*key).orderBy("_seg"))))
    carried = last.where(F.col("_next").isNotNull()).select(
        *key, F.explode(F.sequence(F.col("_seg") + 1, F.col("_next"))).alias("_seg"), F.col("_last").alias("_carried"))
    final = last.where(F.col("_next").isNull()).select(*key, F.col("_seg").alias("_from"), F.col("_last").alias("_final"))
    x = both.join(carried, ["_seg", *key], "left").join(F.broadcast(final), key)
    matched = F.coalesce("_inside", "_carried", F.when(F.col("_seg") > F.col("_from"), F.col("_final")))
    return x.withColumn("matched", matched).where(F.col("matched").isNotNull()).select("_row.*", "matched")
