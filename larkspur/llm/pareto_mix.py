"""Mixing sources to target weights by Pareto order sampling.

The mix holds ``share`` times all words.  Sources split it by weight; no source gets more than ``most`` times its own
words, and what is over goes to the others by weight until none is above (solved in closed form over the sources).
A document of a source with target T and size S has T / S inclusions: the whole part is certain copies, the rest p an
inclusion probability.  Every document draws a uniform u from its id and is ranked by its random odds divided by its
inclusion odds, u / (1 - u) : p / (1 - p); the smallest are taken until the source's remaining words are met, the
document across the line only if that comes nearer to the target.  Reruns draw the same numbers.

No source is gathered into one task: ranks are cut into 2**BUCKET_BITS ranges of u, whose words are summed map-side; only
the one range of each source that crosses the line is ordered.

Results for odd input: null or empty texts have size 0 and take nothing; a null source is a source (last in order);
rows that share an id draw the same number and are ordered by size; a null id draws from the text; an empty table gives
an empty result; further columns are kept by ``mix`` (its own replace columns of the same name)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut

WEIGHTS, SHARE_PERCENT, MOST = (3, 1, 2), 150, 2
BUCKET_BITS = 12
SEED = "mix-1"
_BITS = 52


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """52 pseudo-random bits of the document, as a long."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substr(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), F.lit(1), F.lit(13)), 16, 10).cast("long")


def targets(totals: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST) -> DataFrame:
    """Rows (source, source_size, target) from (source, source_size): one row a source throughout."""
    every = Window.orderBy(F.isnull("source"), "source")
    cyc = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(every) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = totals.withColumn("weight", cyc).withColumn("cap", F.col("source_size") * most)
    # Sources fill up in the order of cap / weight.  The level that the open ones share is the largest of what is left
    # over by the sources before, per weight: it rises while sources fill up and falls once an open one counts as full.
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.isnull("source"), "source")
    s = (s.withColumn("all", F.sum("source_size").over(Window.partitionBy()) * share_percent)
         .withColumn("full", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", F.max((F.col("all") / 100 - F.col("full")) / F.col("left")).over(Window.partitionBy())))
    return s.select("source", "source_size", "weight", F.least(
        F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST,
        seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (words that the mix takes of the document)."""
    own = ("size", "source_size", "target", "copies", "taken")
    rows = docs.drop(*own).withColumns({"size": word_count(F.col("text")), "__u": draw(F.col("doc_id"), F.col("text"), seed)})
    slim = cut(rows.select("source", "size", "__u"))
    aim = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share_percent, most)
    aim = cut(aim.withColumn("certain", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
              .withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size"))
              .withColumn("p", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0)))
    # Within a source p is one number, so the Pareto rank rises with u: ranges of u are ranges of rank.
    bucket = F.shiftright("__u", _BITS - BUCKET_BITS)
    sums = slim.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (sums.withColumn("upto", F.sum("words").over(run))
            .join(aim.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
            .where("upto >= rest").groupBy("source").agg(F.min(F.struct("bucket", "upto", "words")).alias("m"))
            .select("source", F.col("m.bucket").alias("bucket"), (F.col("m.upto") - F.col("m.words")).alias("below")))
    line = cut(aim.join(sums.select(F.col("source").alias("s"), "bucket", "below"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s"))
    rank = Window.partitionBy("source").orderBy("rank", "__u", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = (slim.join(line.select(F.col("source").alias("s"), "bucket", "below", "rest", "p"),
                      F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("bucket")))
            .withColumn("rank", pareto(F.col("__u"), F.col("p")))
            .withColumn("upto", F.col("below") + F.sum("size").over(rank))
            .where("upto - size / 2 <= rest").groupBy("source").agg(F.max(F.struct("rank", "__u", "size")).alias("last")))
    line = line.join(edge.select(F.col("source").alias("s"), "last"), F.col("source").eqNullSafe(F.col("s")), "left")
    line = cut(line.select(F.col("source").alias("__s"), "source_size", "target", "certain", "p", F.col("bucket").alias("__bucket"), F.col("last").alias("__last")))
    inside = ((F.col("__bucket").isNull()) | (bucket < F.col("__bucket")) | ((bucket == F.col("__bucket")) & F.coalesce(
        F.struct(pareto(F.col("__u"), F.col("p")).alias("rank"), F.col("__u"), F.col("size")) <= F.col("__last"), F.lit(False))))
    copies = (F.col("certain") + F.when((F.col("p") > 0) & inside, 1).otherwise(0)).cast("long")
    return (rows.join(F.broadcast(line) if line.count() <= 10_000 else line, F.col("source").eqNullSafe(F.col("__s")))
            .withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
            .select(*[c for c in docs.columns if c not in own], *own))


def pareto(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds."""
    x = (u.cast("double") + 0.5) / F.lit(float(1 << _BITS))
    return (x / (1 - x)) * F.try_divide(1 - p, p)
