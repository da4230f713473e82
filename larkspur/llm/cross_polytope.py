"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

Vectors link when their labels are equal and not null and their cosine, in double precision, is at least ``threshold``.

1. Equal vectors of a label form one class with a weight; classes are compared, copies are counted by weight.
2. Each of ``TABLES`` tables rotates the unit vector ``FUNCTIONS`` times by three rounds of random signs and a fast
   Hadamard transform; a hash is the nearest signed axis, a bucket the hashes together.  Multiprobe: a vector also
   enters the ``PROBES`` next buckets that change one hash to its runner-up axis, least loss first.
3. Buckets with one class are dropped from slim rows.  The others fetch their vectors and are cut into tiles of
   ``TILE`` x ``TILE``, so a bucket with a third of all vectors is spread over tasks.  A tile computes its cosines as one
   matrix product and counts a pair only in the first bucket that the pair shares, so every pair found counts once.
   It reports a link count for each class and links that join separate parts, never the pairs.

Results for odd input: vectors that are null, zero or hold null or non-finite components, and vectors without label,
link with nothing; vectors of other lengths than each other never link; a null vec_id is returned with no links and no
component; repeated rows are vectors of their own that link with each other (same id: one component); further columns
are ignored; an empty table gives an empty result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import components, cut
from .words import U, mix

THRESHOLD = 0.98
TABLES, FUNCTIONS, PROBES, TILE = 6, 2, 3, 512
#: Buckets of up to so many vectors are compared many at a time.
SMALL = 32


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the (unnormalised) Hadamard matrix, in O(d log d) for each."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def buckets(x: np.ndarray, tables: int, functions: int, probes: int, seed: int = 7) -> np.ndarray:
    """Bucket numbers (rows x tables x (1 + probes)) of unit rows."""
    n, d = x.shape
    size = 1 << max(1, (d - 1).bit_length())
    wide = np.zeros((n, size))
    wide[:, :d] = x
    out = np.zeros((n, tables, 1 + probes), U)
    rows = np.arange(n)
    for t in range(tables):
        best, second, loss = [], [], []
        for f in range(functions):
            rng = np.random.default_rng((seed, t, f, size))
            y = wide
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size)) / np.sqrt(size)
            a = np.abs(y)
            two = np.argpartition(-a, 1, axis=1)[:, :2]
            swap = a[rows, two[:, 1]] > a[rows, two[:, 0]]
            two[swap] = two[swap][:, ::-1]
            axis = two * 2 + (y[rows[:, None], two] < 0)
            best.append(axis[:, 0])
            second.append(axis[:, 1])
            loss.append(a[rows, two[:, 0]] - a[rows, two[:, 1]])
        # Probe sequence: every non-empty set of functions moved to the runner-up, by the sum of its losses.
        sets = [[f for f in range(functions) if s >> f & 1] for s in range(1 << functions)]
        cost = np.stack([sum((loss[f] for f in s), np.zeros(n)) for s in sets], axis=1)
        order = np.argsort(cost, axis=1, kind="stable")[:, :1 + probes]
        code = np.zeros((n, len(sets)), U)
        for j, s in enumerate(sets):
            for f in range(functions):
                code[:, j] = code[:, j] * U(2 * size) + (second[f] if f in s else best[f]).astype(U)
        out[:, t] = mix(np.take_along_axis(code, order, axis=1) + U((t + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    return out


def _vectors(vecs: DataFrame) -> DataFrame:
    """Classes (id, label, v, w): distinct usable vectors by label, with the smallest id and the number of copies."""
    v = F.col("embedding").cast("array<double>")
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()
              & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))
    # -0.0 and 0.0 are one number: adding 0.0 makes both plus.
    key = F.sha1(F.concat_ws(",", F.col("label").cast("string"), F.concat_ws(",", F.transform(v, lambda x: (x + 0.0).cast("string")))).cast("binary"))
    return vecs.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"), F.when(usable, key).alias("key"))


def _matrix(col: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x.values, dtype=np.float64) for x in col]


def _hash_rows(classes: DataFrame, tables: int, functions: int, probes: int) -> DataFrame:
    """Classes with their bucket numbers mixed with label and length."""
    def run(batches):
        for batch in batches:
            vs = _matrix(batch.column("v"))
            got = np.zeros((len(vs), tables * (1 + probes)), U)
            for d in {len(v) for v in vs}:
                at = np.array([i for i, v in enumerate(vs) if len(v) == d])
                x = np.stack([vs[i] for i in at])
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                label = batch.column("lkey").take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.int64).view(U)
                b = buckets(x, tables, functions, probes).reshape(len(at), -1)
                got[at] = mix(b + mix(label + U(d))[:, None])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([g.view(np.int64).tolist() for g in got], pa.list_(pa.int64()))],
                                             names=["id", "b"])

    return classes.select("id", "lkey", "v").mapInArrow(run, "id long, b array<long>")


def _tile(rows: list[tuple], bucket: int, threshold: float):
    """Counts and joining links of one tile of rows (id, side, w, v, b); sides 0 and 1 meet, side 2 meets itself."""
    left = [r for r in rows if r[1] != 1]
    right = [r for r in rows if r[1] == 1]
    own = not right
    right = right or left

    def unit(part):
        x = np.stack([r[3] for r in part])
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    if not left:
        return [], []
    near = unit(left) @ unit(right).T >= threshold
    if own:
        near &= ~np.tri(len(left), dtype=bool)
    i, j = np.nonzero(near)
    if len(i):
        # The pair counts here if this is the smallest bucket that both are in.
        bl, br = np.stack([r[4] for r in left]), np.stack([r[4] for r in right])
        first = np.zeros(len(i), bool)
        for lo in range(0, len(i), 4096):
            a, c = bl[i[lo:lo + 4096]], br[j[lo:lo + 4096]]
            same = (a[:, :, None] == c[:, None, :]).any(axis=2)
            first[lo:lo + 4096] = np.where(same, a, np.iinfo(np.int64).max).min(axis=1) == bucket
        i, j = i[first], j[first]
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    counts: dict[int, int] = {}
    links = []
    for a, c in zip(i.tolist(), j.tolist()):
        p, q = left[a], right[c]
        counts[p[0]] = counts.get(p[0], 0) + q[2]
        counts[q[0]] = counts.get(q[0], 0) + p[2]
        if find(p[0]) != find(q[0]):
            parent[find(p[0])] = find(q[0])
            links.append((p[0], q[0]))
    return list(counts.items()), links


def _keys(part: pa.Table) -> np.ndarray:
    return np.stack([part.column(c).to_numpy().astype(np.int64) for c in ("bucket", "x", "y")], axis=1)


def _whole_tiles(part: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The rows of complete tiles, and those of the last one, which may go on."""
    keys = _keys(part)
    last = np.flatnonzero((keys != keys[-1]).any(axis=1))
    n = int(last[-1]) + 1 if len(last) else 0
    return part.slice(0, n), part.slice(n)


def _tiles(part: pa.Table, threshold: float):
    """(counts, links) of sorted tiles: small ones of one block many at a time, by their number of rows."""
    keys = _keys(part)
    head = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    size = np.diff(np.append(head, len(keys)))
    v, b = part.column("v").combine_chunks(), part.column("b").combine_chunks()
    length = np.diff(np.asarray(v.offsets, dtype=np.int64))
    ids, side, w = (part.column(c).to_numpy() for c in ("id", "side", "w"))
    equal = len(set(length.tolist())) == 1
    small = (size > 1) & (size <= SMALL) & equal & (side[head] == 2)
    for g in np.flatnonzero((size > 1) & ~small):
        rows = [(int(ids[i]), int(side[i]), int(w[i]), np.asarray(v[i].values, dtype=np.float64), np.asarray(b[i].values, dtype=np.int64))
                for i in range(head[g], head[g] + size[g])]
        yield _tile(rows, int(keys[head[g], 0]), threshold)
    if not small.any():
        return
    x = np.asarray(v.flatten(), dtype=np.float64).reshape(len(v), -1)
    bs = np.asarray(b.flatten(), dtype=np.int64).reshape(len(b), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    for s in np.unique(size[small]):
        starts, upper = head[small & (size == s)], ~np.tri(int(s), dtype=bool)
        step = max(1, (1 << 20) // int(s * s + s * x.shape[1]))
        for lo in range(0, len(starts), step):
            at = starts[lo:lo + step, None] + np.arange(s)
            g, i, j = np.nonzero((x[at] @ x[at].transpose(0, 2, 1) >= threshold) & upper)
            i, j = at[g, i], at[g, j]
            same = (bs[i][:, :, None] == bs[j][:, None, :]).any(axis=2)
            first = np.where(same, bs[i], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max) == keys[i, 0]
            i, j = i[first], j[first]
            yield ([*zip(ids[i].tolist(), w[j].tolist()), *zip(ids[j].tolist(), w[i].tolist())], list(zip(ids[i].tolist(), ids[j].tolist())))


def _joined(classes: DataFrame, threshold: float, tables: int, functions: int, probes: int, tile: int) -> DataFrame:
    """Rows (id, n, other): link counts of classes in one bucket tile, and (n null) links (id, other)."""
    hashed = cut(_hash_rows(classes, tables, functions, probes))
    slim = hashed.select("id", F.explode(F.array_distinct("b")).alias("bucket"))
    blocks = (slim.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
              .select("bucket", F.ceil(F.col("c") / F.lit(tile)).cast("int").alias("m")))
    placed = slim.join(blocks, "bucket").withColumn("i", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
    # Block i of m meets blocks i .. m - 1 from the left and 0 .. i from the right.
    spots = F.concat(
        F.transform(F.sequence(F.col("i"), F.col("m") - 1), lambda k: F.struct(
            F.col("i").alias("x"), k.alias("y"), F.when(k == F.col("i"), 2).otherwise(0).alias("side"))),
        F.filter(F.transform(F.sequence(F.lit(0), F.col("i")), lambda k: F.struct(
            k.alias("x"), F.col("i").alias("y"), F.lit(1).alias("side"))), lambda s: s["x"] != s["y"]))
    rows = placed.select("id", "bucket", F.explode(spots).alias("s")).select("id", "bucket", "s.x", "s.y", "s.side")
    full = hashed.join(classes.select("id", "v", "w"), "id")
    rows = (rows.join(full, "id").repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
            .select("bucket", "x", "y", "id", "side", "w", "v", "b"))

    def batch_of(counts, links):
        return pa.RecordBatch.from_pydict({
            "id": pa.array([a for a, _ in counts] + [a for a, _ in links], pa.int64()),
            "n": pa.array([n for _, n in counts] + [None] * len(links), pa.int64()),
            "other": pa.array([None] * len(counts) + [b for _, b in links], pa.int64())})

    def run(batches):
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            done, rest = _whole_tiles(part)
            if done.num_rows:
                yield from (batch_of(*got) for got in _tiles(done, threshold))
        if rest is not None and rest.num_rows:
            yield from (batch_of(*got) for got in _tiles(rest, threshold))

    return rows.mapInArrow(run, "id long, n long, other long")


def near_duplicates(vecs: DataFrame, threshold: float = THRESHOLD, tables: int = TABLES, functions: int = FUNCTIONS,
                    probes: int = PROBES, tile: int = TILE) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) of ``vecs`` (vec_id, embedding, label)."""
    rows = cut(_vectors(vecs))
    classes = cut(rows.where("key is not null").groupBy("key")
                  .agg(F.min("vec_id").alias("id"), F.count("*").alias("w"), F.first("v").alias("v"),
                       F.first(F.xxhash64("label")).alias("lkey")))
    found = cut(_joined(classes.withColumn("id", F.xxhash64("key")).select("id", "w", "v", "lkey"),
                        threshold, tables, functions, probes, tile))
    links = found.where("n is null").select(F.col("id").alias("a"), F.col("other").alias("b"))
    # Components run on the classes' smallest ids.
    name = classes.select(F.xxhash64("key").alias("h"), "id")
    named = (links.join(name.toDF("a", "ia"), "a").join(name.toDF("b", "ib"), "b").select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    comp = components(named)
    count = found.where("n is not null").groupBy(F.col("id").alias("h")).agg(F.sum("n").alias("n"))
    info = (classes.select("key", F.xxhash64("key").alias("h"), "id", "w").join(count, "h", "left").join(comp, "id", "left")
            .select("key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"), F.coalesce("component", "id").alias("comp")))
    return (rows.select("vec_id", "key").join(info, "key", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.when(
                F.col("vec_id").isNotNull(), F.coalesce("comp", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
