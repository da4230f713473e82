"""Merkle manifest of a table: a leaf a row, a tree a group, a tree over the groups' roots, and a proof a row.

Concatenated-level strings: the rows of a group, in order, are cut into aligned blocks of 16^3 leaves.  A block is one
row that keeps each of its levels as one string of 64-character hex digests, so the parents of a level are the digests
of its 1024-character substrings, and the siblings of a node are the two substrings that flank it inside its run.  The
roots of the blocks are the leaves of the next tier, which is cut the same way, until every group has one block; then
the groups' roots, in the order of the groups, go through the same tiers under one common root.  Each tier is some
4000 times smaller than the one below; no task holds more than a block, and the driver holds nothing.

H is the lowercase hex sha256 of the concatenated inputs; digests go in as hex text.  A run is 16 consecutive nodes of a
level, the last one fewer; while a level has more than one node, each run, even of one node, becomes its H.

Results for odd input: null fields are ``-``, others their UTF-8 length, ``:`` and value, so null and ``-`` differ; a
null group is a group of its own and the first; rows are ordered by id (null first), rows of equal id by leaf; rows
that repeat in full have equal leaves and a proof each; only the named columns are read, whatever else the table has; a
table of one row has the leaf as root and an empty proof; an empty table gives an empty result."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut
from .ranks import ranked

FAN, HEIGHT, HEX = 16, 3, 64
BLOCK, RUN = FAN ** HEIGHT, FAN * HEX


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*fields: Column) -> Column:
    """H of the fields, each with its length in front, so no two rows concatenate to the same bytes."""
    def mark(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return digest(*map(mark, fields))


def fold(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to: H of left siblings, node and right siblings, level by level."""
    return F.aggregate(path, node, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def _parents(level: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / RUN).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * RUN + 1, F.lit(RUN)), 256)), "")


def _siblings(level: Column, at: Column) -> Column:
    """The substrings that flank node ``at`` of a level inside its run."""
    begin, inside = F.floor(at / FAN).cast("int") * RUN, at % FAN
    return F.struct(F.substring(level, begin + 1, inside * HEX).alias("left"),
                    F.substring(level, at * HEX + HEX + 1, (FAN - 1 - inside) * HEX).alias("right"))


def _blocks(items: DataFrame) -> DataFrame:
    """Blocks of items (g, pos, n, item: struct<node, ..>): (g, block, n, items, l0, l1, l2, height, node)."""
    rows = (items.select("g", "n", F.floor(F.col("pos") / BLOCK).alias("block"), F.struct((F.col("pos") % BLOCK).cast("int").alias("at"), "item").alias("e"))
            .groupBy("g", "n", "block").agg(F.array_sort(F.collect_list("e")).alias("items"))
            .withColumn("items", F.transform("items", lambda e: e["item"]))
            .withColumn("l0", F.array_join(F.transform("items", lambda e: e["node"]), "")))
    for k in range(HEIGHT):  # a group of one block stops at its root; the blocks of a larger one all have full height
        below = F.col(f"l{k}")
        done = below.isNull() | ((F.col("n") <= BLOCK) & (F.octet_length(below) == HEX))
        rows = rows.withColumn(f"l{k + 1}", F.when(~done, _parents(below)))
    levels = [F.col(f"l{k}") for k in range(HEIGHT + 1)]
    height = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in levels[1:]])
    return cut(rows.select("g", "block", "n", "items", *levels[:-1], height.alias("height"), F.coalesce(*reversed(levels)).alias("node")))


def _tiers(items: DataFrame) -> list[DataFrame]:
    tiers = [_blocks(items)]
    while True:
        rest = tiers[-1].where(F.col("n") > BLOCK)
        if rest.isEmpty():
            return tiers
        tiers.append(_blocks(rest.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.struct("node").alias("item"))))


def _roots(tiers: list[DataFrame]) -> DataFrame:
    found = [t.where(F.col("n") <= BLOCK).select("g", "node") for t in tiers]
    return reduce(DataFrame.unionByName, found)


def _paths(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The items of the lowest tier with ``path``, the siblings up to the top, and the other columns of ``tops``.

    ``tops`` (g, path, ..) holds the way on from each group's root."""
    more = [c for c in tops.columns if c not in ("g", "path")]
    above = None
    for k in reversed(range(len(tiers))):
        tier = tiers[k].withColumnRenamed("node", "__node")
        up = tier.where(F.col("n") <= BLOCK).select("g", "block").join(tops, "g")
        above = up if above is None else above.unionByName(up)
        level = [F.col(f"l{i}") for i in range(HEIGHT)]

        def climb(at: Column, first: int) -> Column:
            """Siblings from level ``first`` of the block, where ``at`` is the node's place, and on from there."""
            steps = [F.when(F.col("height") > i, F.array(_siblings(level[i], F.floor(at / FAN ** (i - first)).cast("int"))))
                     .otherwise(F.slice("path", 1, 0)) for i in range(first, HEIGHT)]
            return F.concat(*steps, F.col("path"))

        rows = tier.join(above, ["g", "block"])
        if k:
            nodes = F.sequence(F.lit(0), F.size("items") - 1)
            rows = rows.select(*more, "g", F.explode(F.transform(nodes, lambda i: F.struct(
                (i + F.col("block") * BLOCK).cast("long").alias("block"), climb(i, 0).alias("path")))).alias("e"))
            above = rows.select("g", "e.block", "e.path", *more)
            continue
        # Run by run: the run's own 1024 characters and the way up from it are taken from the block once for 16 rows.
        runs = F.sequence(F.lit(0), F.floor((F.size("items") - 1) / FAN).cast("int"))
        rows = rows.select("g", "height", *more, F.explode(F.transform(runs, lambda r: F.struct(
            F.slice("items", r * FAN + 1, F.lit(FAN)).alias("items"), F.substring(level[0], r * RUN + 1, F.lit(RUN)).alias("run"),
            climb(r, 1).alias("path")))).alias("e"))
        rows = rows.select("g", "height", *more, "e.run", "e.path", F.posexplode("e.items").alias("at", "item"))
        own = F.when(F.col("height") > 0, F.array(_siblings(F.col("run"), F.col("at")))).otherwise(F.slice("path", 1, 0))
        return rows.select("g", "item", F.concat(own, F.col("path")).alias("path"), *more)


def manifest(df: DataFrame, id_col: str, group_col: str, fields: list[str], claims: Column | None = None) -> DataFrame:
    """(id, group, leaf, subroot, root, path, claim) of every row.

    ``path`` is an array of (left, right) sibling digests from the leaf to the root, so ``fold(leaf, path)`` is the root.
    ``claims``, a column over ``df``, is carried along as ``claim`` (say, the leaf of a copy that is to be verified)."""
    slim = df.select(F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("g"), F.col(id_col).alias("id"),
                     F.col(group_col).alias("group"), leaf(*[F.col(c) for c in fields]).alias("node"),
                     (F.lit(None).cast("string") if claims is None else claims).alias("claim"))
    rows = ranked(slim, "g", ["id", "node"])
    own = _tiers(rows.select("g", "pos", "n", F.struct("node", "id", "group", "claim").alias("item")))
    roots = ranked(_roots(own).select(F.lit("").alias("g"), F.col("g").alias("name"), "node"), "g", ["name"])
    joint = _tiers(roots.select("g", "pos", "n", F.struct("node", "name").alias("item")))
    start = F.array().cast("array<struct<left:string,right:string>>")
    ways = _paths(joint, _roots(joint).select("g", start.alias("path"), F.col("node").alias("root")))
    ways = ways.select(F.col("item.name").alias("g"), "path", "root", F.col("item.node").alias("subroot"))
    return _paths(own, ways).select("item.id", "item.group", F.col("item.node").alias("leaf"), "subroot", "root", "path", "item.claim")


def proof(path: Column) -> Column:
    """The siblings of a path, level by level, left to right, as one hex string."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")
