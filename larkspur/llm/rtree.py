"""Hard negatives by best-first search of an STR-packed R-tree.

Vectors are integers (each component x becomes floor(256 x)), scores are exact integer inner products.

* Packing (sort-tile-recursive): the coordinate that varies most is cut into slabs at quantiles of a sample of at most
  ``4 * SAMPLE`` rows (only the shape of the tree depends on it); each slab is ordered by the next coordinate with exact
  distributed positions and cut into tiles of ``TILE`` rows.  Inside its tile every row is packed the same way, by three
  more sorts, into pages of ``PAGE`` rows; four nodes of a level make one of the next.
* Bounds: a node's minimum bounding box [lo, hi] gives each coordinate of an anchor an interval of products, so the
  inner products under the node lie between sum(a+ lo + a- hi) and sum(a+ hi + a- lo), a+ and a- being a's positive and
  negative parts.
* Search: an anchor asks for the ``k`` best rows in each of its score windows.  A queue opens the node with the highest
  upper bound first and drops nodes that miss the windows or lie strictly below the kth score so far (equal ones stay,
  as ties go to the smaller id).  An anchor first searches the tile it lives in; its kth scores there go out with it, and
  it is sent on only to tiles whose box can still hold something better.

Anchors meet tiles block by block: packs of about ``PACK`` anchors are compared with pages of ``BOXES`` tile boxes, and a
pack travels to a tile without the anchors whose bounds rule it out.  No task holds more than a tile and some packs, nothing
that grows goes through the driver or a broadcast, and there is no limit on candidates.

Results for odd input: rows with a null id or label, a null vector, or a null or non-finite component take no part, nor
do vectors with a scaled component beyond +-2^27, whose sums a long could not hold; shorter vectors count as padded with
zeros; rows that repeat an id each count as candidates, are not "other rows" to an anchor of that id, and make one anchor
(of the smallest label, then vector); equal scores go to the smaller id; an anchor without other rows of its label, or
a positive without rows in its window, gives no rows; other columns are ignored; an empty table gives an empty result."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut
from .ranks import ranked

TILE, PAGE, FAN, SAMPLE, PACK, BOXES = 8192, 128, 4, 8192, 512, 256
LIMIT = 1 << 27
SLOTS = "array<struct<slot:long,low:long,high:long,floor:long>>"
ASKS = f"array<struct<anchor:long,label:int,vec:binary,home:long,slots:{SLOTS}>>"
FOUND = "anchor long, slot long, id long, score long"
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def vectors(df: DataFrame) -> DataFrame:
    """(id, label, v) of the rows that take part, components scaled and floored."""
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= F.lit(LIMIT / 256)))
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("int")
    return (df.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
            .select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), v.alias("v")).where(~odd)
            .withColumn("v", F.transform("v", lambda x: F.floor(x * 256).cast("int"))))


def _str_order(v: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order of a tile's rows: three sorts, each inside the parts of the one before."""
    order, part = np.arange(len(v)), len(v)
    for c in np.argsort(-v.std(axis=0), kind="stable")[:3] if len(v) else ():
        order = np.concatenate([x[np.argsort(v[x, c], kind="stable")] for x in np.split(order, range(part, len(order), part))])
        part = max(PAGE, PAGE * FAN ** max(0, math.ceil(math.log(max(part / PAGE, 1), FAN)) - 1))
    return order


def _pack(dim: int):
    def pack(rows: pa.Table) -> pa.Table:
        v = np.zeros((rows.num_rows, dim), np.int32)
        for i, x in enumerate(rows.column("v").combine_chunks()):
            x = x.values.to_numpy()
            v[i, :len(x)] = x
        order = _str_order(v)
        v = v[order]
        return pa.table({"tile": rows.column("tile")[:1], "ids": [rows.column("id").to_numpy()[order].tobytes()],
                         "labels": [rows.column("label").to_numpy()[order].astype(np.int32).tobytes()], "vecs": [v.tobytes()],
                         "lo": [v.min(axis=0).tobytes()], "hi": [v.max(axis=0).tobytes()]})
    return pack


def pack(rows: DataFrame) -> tuple[DataFrame, int]:
    """Tiles of the tree: (tile, ids, labels, vecs, lo, hi), arrays as bytes; and the number of coordinates."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dim")).first()
    n, dim = size["n"], max(size["dim"], 1)
    sample = rows.sample(min(1.0, 1.2 * SAMPLE / max(n, 1)), 5).limit(4 * SAMPLE).select("v").collect()
    picked = np.zeros((len(sample), dim), np.int32)
    for i, r in enumerate(sample):
        picked[i, :len(r["v"])] = r["v"]
    first, second = (np.argsort(-picked.std(axis=0), kind="stable").tolist() * 2)[:2] if len(sample) else (0, 0)
    slabs = math.ceil(math.sqrt(math.ceil(n / TILE)))
    cuts = np.quantile(picked[:, first], np.arange(1, slabs) / slabs) if len(sample) and slabs > 1 else np.zeros(0)

    @F.pandas_udf("long")
    def slab(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, x.to_numpy()))

    at = lambda i: F.coalesce(F.try_element_at("v", F.lit(i + 1)), F.lit(0))
    placed = ranked(rows.select(slab(at(first)).alias("slab"), at(second).alias("key"), "id", "label", "v"), "slab", ["key", "id"])
    tiled = placed.select((F.col("slab") * F.lit(1 << 32) + F.floor(F.col("pos") / TILE)).alias("tile"), "id", "label", "v")
    return cut(tiled.groupBy("tile").applyInArrow(_pack(dim), "tile long, ids binary, labels binary, vecs binary, lo binary, hi binary")), dim


class _Tree:
    """A tile with the boxes of all its nodes, the lowest level's pages first."""

    def __init__(self, ids: bytes, labels: bytes, vecs: bytes, dim: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int32)
        self.rows = np.frombuffer(vecs, np.int32).reshape(-1, dim)
        self.exact = _kind(dim)
        lo, hi, self.level, width = [], [], [], PAGE
        while True:
            starts = np.arange(0, len(self.rows), width)
            lo.append(np.minimum.reduceat(self.rows, starts, axis=0))
            hi.append(np.maximum.reduceat(self.rows, starts, axis=0))
            self.level.append(len(starts))
            if len(starts) == 1:
                break
            width *= FAN
        self.lo, self.hi = np.concatenate(lo).astype(self.exact), np.concatenate(hi).astype(self.exact)
        self.begin = np.concatenate([[0], np.cumsum(self.level)])
        self.values = self.rows.astype(self.exact)

    def children(self, level: int, at: int):
        return range(at * FAN, min((at + 1) * FAN, self.level[level - 1]))


def _kind(dim: int):
    """Doubles hold these sums exactly while every partial sum stays below 2^53; integers take over beyond that."""
    return np.float64 if dim * LIMIT * LIMIT < 1 << 53 else np.int64


def _bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest inner product of each anchor (row of ``a``) with any vector in each box."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T


def _search(tree: _Tree, anchor: int, label: int, a: np.ndarray, low: np.ndarray, high: np.ndarray, slots: list[dict], same: bool, k: int):
    """(slot, id, score) of the tile's best ``k`` rows in each window of one anchor."""
    need = [max(s["low"], s["floor"]) for s in slots]
    best: list[list[tuple[int, int]]] = [[] for _ in slots]
    top = len(tree.level) - 1
    queue = [(-high[-1], top, 0)]
    while queue:
        bound, level, at = heapq.heappop(queue)
        if -bound < min(need):
            break
        if level:
            for child in tree.children(level, at):
                node = tree.begin[level - 1] + child
                if any(high[node] >= m and low[node] <= s["high"] for m, s in zip(need, slots)):
                    heapq.heappush(queue, (-high[node], level - 1, child))
            continue
        rows = slice(at * PAGE, (at + 1) * PAGE)
        score = tree.values[rows] @ a
        fits = (score >= min(need)) & ((tree.labels[rows] == label) == same) & (tree.ids[rows] != anchor)
        if not fits.any():
            continue
        fits = np.flatnonzero(fits)
        found, ids = score[fits].astype(np.int64), tree.ids[rows][fits]
        for i, s in enumerate(slots):
            here = np.flatnonzero((found >= need[i]) & (found <= s["high"]))
            if len(here):
                best[i] = sorted(best[i] + [(-int(found[j]), int(ids[j])) for j in here])[:k]
                if len(best[i]) == k:
                    need[i] = max(need[i], -best[i][-1][0])
    for s, rows_ in zip(slots, best):
        for score_, id_ in rows_:
            yield s["slot"], id_, -score_


def _probe(dim: int, same: bool, k: int):
    """Searches of each row's tile for each of its ``asks``."""
    def probe(batches):
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                asks = batch.column("asks")[i].as_py()
                tree = _Tree(*(batch.column(c)[i].as_py() for c in ("ids", "labels", "vecs")), dim)
                a = np.array([np.frombuffer(x["vec"], np.int32) for x in asks]).astype(tree.exact)
                low, high = _bounds(a, tree.lo, tree.hi)
                for j, x in enumerate(asks):
                    out.extend((x["anchor"], *row) for row in _search(tree, x["anchor"], x["label"], a[j], low[j], high[j], x["slots"], same, k))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(("anchor", "slot", "id", "score"), cols)})
    return probe


def _route(dim: int):
    """(tile, asks): each pack of anchors cut down to those that a tile's box leaves a chance, home tiles excluded."""
    def route(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                asks, boxes = batch.column("asks")[i].as_py(), batch.column("boxes")[i].as_py()
                exact = _kind(dim)
                lo, hi = (np.array([np.frombuffer(b[c], np.int32) for b in boxes]).astype(exact) for c in ("lo", "hi"))
                low, high = _bounds(np.array([np.frombuffer(x["vec"], np.int32) for x in asks]).astype(exact), lo, hi)
                for t, box in enumerate(boxes):
                    sent = []
                    for j, x in enumerate(asks):
                        slots = [s for s in x["slots"] if high[j, t] >= max(s["low"], s["floor"]) and low[j, t] <= s["high"]]
                        if slots and x["home"] != box["tile"]:
                            sent.append({**x, "slots": slots})
                    if sent:
                        yield pa.RecordBatch.from_pydict({"tile": pa.array([box["tile"]], pa.int64()), "asks": pa.array([sent], _ASKS)})
    return route


_SLOT = pa.struct([("slot", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("floor", pa.int64())])
_ASKS = pa.list_(pa.struct([("anchor", pa.int64()), ("label", pa.int32()), ("vec", pa.binary()), ("home", pa.int64()), ("slots", pa.list_(_SLOT))]))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(tiles: DataFrame, dim: int, asks: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor, slot, id, score, rank) of the best ``k`` rows for every slot of ``asks`` (anchor, label, vec, home, slots): rows of the
    anchor's label (``same``) or of others, with low <= score <= high."""
    ask = F.struct("anchor", "label", "vec", "home", "slots")
    near = cut(tiles.join(asks.groupBy(F.col("home").alias("tile")).agg(F.collect_list(ask).alias("asks")), "tile")
               .select("ids", "labels", "vecs", "asks").mapInArrow(_probe(dim, same, k), FOUND))
    floors = (_best(near, k).where(F.col("rank") == k).groupBy("anchor")
              .agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth")))
    known = asks.join(floors, "anchor", "left").withColumn("slots", F.transform("slots", lambda s: F.struct(
        s["slot"].alias("slot"), s["low"].alias("low"), s["high"].alias("high"),
        F.coalesce(F.try_element_at("kth", s["slot"]), s["floor"]).alias("floor"))))
    packs, pages = math.ceil(asks.count() / PACK), math.ceil(tiles.count() / BOXES)
    if not packs or not pages:
        return _best(near, k)
    packed = known.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(packs)).alias("pack")).agg(F.collect_list(ask).alias("asks"))
    directory = (tiles.groupBy(F.pmod(F.xxhash64("tile"), F.lit(pages)).alias("page"))
                 .agg(F.collect_list(F.struct("tile", "lo", "hi")).alias("boxes")))
    sent = (packed.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
            .join(directory, "page").select("asks", "boxes").mapInArrow(_route(dim), f"tile long, asks {ASKS}"))
    far = tiles.join(sent, "tile").select("ids", "labels", "vecs", "asks").mapInArrow(_probe(dim, same, k), FOUND)
    return _best(near.unionByName(far), k)


def anchors(tiles: DataFrame, dim: int, every: int) -> DataFrame:
    """(anchor, label, vec, home) of the rows whose id ``every`` divides, one an id."""
    def pick(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), np.int64)
                rows = np.frombuffer(batch.column("vecs")[i].as_py(), np.int32).reshape(-1, dim)
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(ids[at]), "label": pa.array(np.frombuffer(batch.column("labels")[i].as_py(), np.int32)[at]),
                    "vec": pa.array([rows[j].tobytes() for j in at], pa.binary()), "home": pa.array(np.full(len(at), batch.column("tile")[i].as_py()), pa.int64())})

    found = tiles.select("tile", "ids", "labels", "vecs").mapInArrow(pick, "anchor long, label int, vec binary, home long")
    return cut(found.groupBy("anchor").agg(F.min(F.struct("label", "vec", "home")).alias("a")).select("anchor", "a.*"))


def hard_negatives(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """For each anchor (vec_id divisible by ``every``) and each of its best ``positives`` of the same label, the best
    ``negatives`` of other labels that score from ``percent`` % of the positive's score up to it."""
    tiles, dim = pack(vectors(df))
    who = anchors(tiles, dim, every)
    slot = lambda key, low, high: F.struct(key.alias("slot"), low.alias("low"), high.alias("high"), F.lit(LOWEST).alias("floor"))
    wide = who.withColumn("slots", F.array(slot(F.lit(0).cast("long"), F.lit(LOWEST), F.lit(HIGHEST))))
    found = cut(search(tiles, dim, wide, True, positives).select("anchor", F.col("id").alias("positive"), "score"))
    # The least integer score that reaches the percentage: the ceiling of percent * score / 100.
    least = F.expr(f"CAST(ceil(CAST(high AS DECIMAL(38, 0)) * {percent} / 100) AS LONG)")
    windows = (found.select("anchor", F.col("score").alias("high")).distinct()
               .groupBy("anchor").agg(F.collect_list(slot(F.col("high"), least, F.col("high"))).alias("slots")))
    rivals = search(tiles, dim, who.join(windows, "anchor"), False, negatives)
    return (found.join(rivals.withColumnsRenamed({"score": "negative_score", "slot": "score"}), ["anchor", "score"])
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("negative_id"), F.col("score").alias("positive_score"), "negative_score"))
