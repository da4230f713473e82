"""Skew-safe keyed sequence plans.

Keyed sequence operators (next / previous event, running sums, prefix
maxima) are usually written as ``Window.partitionBy(key).orderBy(...)``.
That puts every row of a key into one task: a key holding a third of all
rows becomes a third of the job in one task.

The plan here splits *hot* keys into ordered segments:

1. ``assign_segments`` takes a hash-based sample of the input (the same
   rows in every branch and recomputation), finds keys whose estimated row
   count exceeds ``max_rows`` and cuts each such key into segments by
   quantiles of a summary of its sampled order tuples.  The summary merges
   and has a fixed size: of the sampled rows that fall into one of
   ``SUMMARY`` hash buckets, the one with the smallest hash stays, so no
   aggregate ever holds more than ``SUMMARY`` tuples of a key.  At most
   ``SEGMENTS`` segments are made in all: beyond ``SEGMENTS * max_rows`` rows
   segments grow instead (a hot key is one with more than rows / SEGMENTS
   rows).  So the table of hot keys and cuts, which is broadcast, has at most
   ``SEGMENTS`` keys and as many cuts whatever the input's size.  Cold keys
   keep segment 0.
2. Window functions run over ``(key, segment)`` so no task holds more than
   about ``max_rows`` rows of one key.
3. Segment boundaries are stitched with small per-segment summaries (the
   first / last ``n`` rows, or a segment total) that exist only for hot
   keys; a window over those summaries (partitioned by key, one row per
   segment, i.e. a key's rows / ``max_rows``) carries values across
   segments.

Any monotone segmentation gives exact results; the statistics only affect
balance, so sampling is safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEG = "_seg"
HOT = "_hot"
GLOBAL_KEY = "_all"

# Largest number of rows of one key that one window task should hold.
DEFAULT_MAX_ROWS = 1_000_000
# Expected sampled rows of a key at the hot threshold.
SAMPLE_ROWS_AT_THRESHOLD = 64
# Most tuples in a key's summary, and most segments (hence hot keys, and cuts) of one frame.
SUMMARY, SEGMENTS = 1 << 18, 1 << 16


def _conf_int(spark: SparkSession, key: str, default: int) -> int:
    try:
        return int(spark.conf.get(key, str(default)))
    except Exception:  # pragma: no cover - conf lookups on odd sessions
        return default


def max_rows_for(df: DataFrame, max_rows: int | None) -> int:
    if max_rows is not None:
        return int(max_rows)
    return _conf_int(df.sparkSession, "larkspur.segment.maxRows", DEFAULT_MAX_ROWS)


def position(cuts: Column, value: Column) -> Column:
    """How many of the ascending ``cuts`` are at or below ``value``: binary search inside one expression."""
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + F.lit(1))).cast("int") + 1)

    def halve(at: Column, _step: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.get(cuts, mid) <= value
        return F.when(at["lo"] >= at["hi"], at).otherwise(F.struct(
            F.when(below, mid + 1).otherwise(at["lo"]).alias("lo"),
            F.when(below, at["hi"]).otherwise(mid).alias("hi")))

    return F.aggregate(steps, start, halve, lambda at: at["lo"])


def hot_cuts(sample: DataFrame, keys: Sequence[str], place: Column, step: int, seed: int) -> DataFrame:
    """(keys, _cuts): the keys with more than ``step`` sampled rows and where to cut them, by their summaries."""
    own = F.xxhash64(*[F.col(k) for k in keys], place, F.lit(seed + 1))
    spots = (sample.groupBy(*keys, F.pmod(own, F.lit(SUMMARY)).alias("_spot"))
             .agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(own.alias("h"), place.alias("at"))).alias("_least")))
    rows = spots.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).scalar()
    each = F.greatest(F.lit(float(step)), rows / F.lit(float(SEGMENTS)))      # sampled rows of one segment
    stats = spots.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.array_sort(F.collect_list("_least.at")).alias("_s"))
    stats = stats.withColumn("_parts", F.ceil(F.col("_n") / each).cast("int")).where(F.col("_n") > each)
    cuts = F.transform(F.sequence(F.lit(1), F.col("_parts") - 1),
                       lambda i: F.get(F.col("_s"), F.floor(i * F.size("_s") / F.col("_parts")).cast("int")))
    return stats.select(*keys, F.array_distinct(cuts).alias("_cuts"))


def assign_segments(df: DataFrame, keys: Sequence[str], order_value: str | Sequence[str],
                    max_rows: int | None = None, seed: int = 17) -> DataFrame:
    """Add ``_seg`` (bigint) and ``_hot`` (boolean) columns.

    ``order_value`` names the columns of the sequence order, best all of
    them: the cuts are quantiles of the sampled tuples, so an outlier or a
    burst moves no cut and equal times are split by the tie-break.
    ``keys=[]`` treats the whole frame as one key.
    """
    limit = max_rows_for(df, max_rows)
    order = [order_value] if isinstance(order_value, str) else list(order_value)
    keys = list(keys)
    if not keys:
        df = df.withColumn(GLOBAL_KEY, F.lit(0))
        keys = [GLOBAL_KEY]
    frac = min(1.0, SAMPLE_ROWS_AT_THRESHOLD / float(limit))
    src = df.select(*keys, *[c for c in order if c not in keys])
    if frac < 1.0:
        # hash-based sample: a pure function of the row, so every branch and
        # every recomputation (lost executor, retried stage) sees the same
        # hot-key table whatever the partitioning
        h = F.xxhash64(*[F.col(k) for k in keys], *[F.col(c) for c in order], F.lit(seed))
        src = src.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int(frac * (1 << 30))))
    place = F.struct(*[F.col(c) for c in order])
    hot = hot_cuts(src, keys, place, max(1, int(limit * frac)), seed)
    out = df.join(F.broadcast(hot), keys, "left")      # at most SEGMENTS keys and cuts
    seg = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(position(F.col("_cuts"), place)).cast("long")
    return out.withColumn(SEG, seg).withColumn(HOT, F.col("_cuts").isNotNull()).drop("_cuts")


def _keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    keys = list(keys)
    return keys if keys else [GLOBAL_KEY]


def with_neighbors(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   payload: Sequence[str], n_next: int = 0, n_prev: int = 0,
                   next_prefix: str = "next_", prev_prefix: str = "prev_") -> DataFrame:
    """For every row, attach the ``n_next`` following and ``n_prev`` preceding
    rows of the same key (as structs of ``payload``), in ``order``.

    Requires ``assign_segments`` to have run.  Missing neighbours are NULL.
    """
    keys = _keys(df, keys)
    g = keys + [SEG]
    # HOT is constant within a key; as a partition column it lets the hot-row filter of the
    # boundary summaries pass below the window, so only hot rows are shuffled a second time
    w = Window.partitionBy(*g, HOT).orderBy(*order)
    row = F.struct(*[F.col(c) for c in payload])
    x = df.withColumn("_row", row)
    for i in range(1, n_next + 1):
        x = x.withColumn(f"_ln{i}", F.lead("_row", i).over(w))
    for i in range(1, n_prev + 1):
        x = x.withColumn(f"_lp{i}", F.lag("_row", i).over(w))
    if n_next or n_prev:
        x = x.withColumn("_rn", F.row_number().over(w))
    if n_prev:
        x = x.withColumn("_tail", F.lead(F.lit(1), n_prev).over(w).isNull())

    hot_rows = x.where(F.col(HOT))
    kw = Window.partitionBy(*keys).orderBy(SEG)
    if n_next:
        heads = (hot_rows.where(F.col("_rn") <= n_next)
                 .groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("_rn", "_row"))).alias("_h"))
                 .select(*g, F.transform("_h", lambda e: e["_row"]).alias("_h")))
        heads = heads.select(*g, F.slice(F.flatten(F.collect_list("_h").over(
            kw.rowsBetween(1, n_next))), 1, n_next).alias("_nh"))
        x = x.join(heads, g, "left")
        have = sum((F.col(f"_ln{j}").isNotNull().cast("int") for j in range(1, n_next + 1)),
                   F.lit(0))
        for i in range(1, n_next + 1):
            x = x.withColumn(f"{next_prefix}{i}", F.coalesce(
                F.col(f"_ln{i}"),
                F.when(F.lit(i) > have, F.try_element_at(F.col("_nh"), (F.lit(i) - have).cast("int")))))
        x = x.drop("_nh", *[f"_ln{i}" for i in range(1, n_next + 1)])
    if n_prev:
        tails = (hot_rows.where(F.col("_tail"))
                 .groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("_rn", "_row"))).alias("_t"))
                 .select(*g, F.transform("_t", lambda e: e["_row"]).alias("_t")))
        tails = tails.select(*g, F.flatten(F.collect_list("_t").over(
            kw.rowsBetween(-n_prev, -1))).alias("_pt"))
        x = x.join(tails, g, "left")
        have = sum((F.col(f"_lp{j}").isNotNull().cast("int") for j in range(1, n_prev + 1)),
                   F.lit(0))
        for i in range(1, n_prev + 1):
            x = x.withColumn(f"{prev_prefix}{i}", F.coalesce(
                F.col(f"_lp{i}"),
                F.when(F.lit(i) > have, F.try_element_at(F.col("_pt"), (have - F.lit(i)).cast("int")))))
        x = x.drop("_pt", "_tail", *[f"_lp{i}" for i in range(1, n_prev + 1)])
    return x.drop("_row", "_rn")


def with_running(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 value: Column | str | None = None, out: str | None = None, how: str = "sum",
                 inclusive: bool = True,
                 aggs: Sequence[tuple[Column | str, str, str]] | None = None) -> DataFrame:
    """Running ``sum`` or ``max`` per key in ``order``.

    Either one aggregate (``value``, ``out``, ``how``) or several at once
    with ``aggs=[(value, out, how), ...]``: they share one window pass and
    one per-segment summary, so chaining is not needed.  ``inclusive=False``
    aggregates strictly earlier rows (NULL when there are none).  Requires
    ``assign_segments``."""
    keys = _keys(df, keys)
    g = keys + [SEG]
    specs = list(aggs) if aggs else [(value, out, how)]
    fns = {"sum": F.sum, "max": F.max}
    x = df
    for i, (v, _o, _h) in enumerate(specs):
        x = x.withColumn(f"_v{i}", F.col(v) if isinstance(v, str) else v)
    end = 0 if inclusive else -1
    w = Window.partitionBy(*g).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    for i, (_v, _o, h) in enumerate(specs):
        x = x.withColumn(f"_loc{i}", fns[h](f"_v{i}").over(w))
    totals = x.where(F.col(HOT)).groupBy(*g).agg(
        *[fns[h](f"_v{i}").alias(f"_tot{i}") for i, (_v, _o, h) in enumerate(specs)])
    kw = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*g, *[fns[h](f"_tot{i}").over(kw).alias(f"_off{i}")
                                  for i, (_v, _o, h) in enumerate(specs)])
    x = x.join(offsets, g, "left")
    for i, (_v, o, h) in enumerate(specs):
        loc, off = F.col(f"_loc{i}"), F.col(f"_off{i}")
        if h == "sum":
            res = F.when(loc.isNull() & off.isNull(), F.lit(None)).otherwise(
                F.coalesce(off, F.lit(0)) + F.coalesce(loc, F.lit(0)))
        else:
            res = F.greatest(off, loc)
        x = x.withColumn(o, res)
    drop = [f"_{p}{i}" for i in range(len(specs)) for p in ("v", "loc", "off")]
    return x.drop(*drop)


def drop_segments(df: DataFrame) -> DataFrame:
    return df.drop(SEG, HOT, GLOBAL_KEY)
