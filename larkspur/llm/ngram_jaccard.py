"""Exact n-gram Jaccard self-join for near duplicates: size bands, hashed bitmaps, sorted-array intersection.

Documents link when 100 * |A & B| >= threshold * |A | B| for their sets of ``k``-word shingles.

1. ``profiles``: set size, a 128-bit key of the set, and a bitmap signature of about size / 2 bits in which each
   shingle flips one bit.  Equal sets form one class; only classes are compared.
2. Candidates (exact prefix filter): two linked sets share one of the first n - ceil(t n) + 1 shingles under any common
   order.  The order puts rare shingles first (``rarity``), by two count-min sketches of fixed size: that of words tells
   how often a shingle would come by chance, on a corpus of any size; that of shingles, whose noise grows with the
   corpus, puts last what stands out of the noise, so a passage that many documents share stays out of the prefixes.
   Unrelated documents share frequent words only and hardly meet.  A class in a partition sends its prefix once however many
   copies.  If many classes still meet in hot shingles (item 4), these go last, whatever the sketches say, and the
   prefixes are made anew: a passage then stays only in the prefixes of documents that hold little else.
3. Shingles with up to ``hot`` classes give candidate pairs inside the size bounds.  Bitmaps whose differing bits bound
   the overlap below the threshold drop most; the rest are decided by intersecting the sorted shingle arrays.
4. A shingle with more classes than that (a large family of near copies) is not expanded into pairs: every member is
   compared with the shingle's smallest class, and members that are not yet in the family's largest linked component
   meet the family in size-banded tiles.  A tile bounds all its overlaps by bit counts, intersects what remains and
   reports only links that join separate parts.

Results for odd input: texts that are null or have no words have an empty set and link with nothing; texts with fewer
than ``k`` words have one shingle, the whole sequence; rows without id get their size, no component, and link with
nothing; repeated rows are returned as often as given; other columns are ignored; an empty table gives an empty
result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .sketch import build, cells, estimate
from .common import components, cut, release, small_batches
from .words import U, mix, short_grams, stream, text_slices, windows, word_hashes

SHINGLE, PERCENT = 4, 85
HOT, TILE = 64, 256
#: Where the tiles of hot shingles would hold more than this share of all sets, the hot shingles go last and the prefixes are
#: made again, so often at most.
SPARE, PASSES = 0.125, 3
#: Further back in the order than any level.
LAST = 1 << 12
LOG2_WIDTH, MEMBER_BITS = 21, 23
TOKEN_BITS = 60


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct 60-bit shingle hashes of each text (A-Z lower-cased)."""
    h, ptr = word_hashes(data, off, lower=True)
    _, before, g = _grams(h, ptr, k)
    return _sets(h, ptr, before, g, k)


def _grams(h: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For shingles as they stand: (index of the first word, shingles before each text, hash)."""
    at, _, before = windows(ptr, k)
    return at, before, short_grams(h, at, k, 3) >> U(64 - TOKEN_BITS)


def _sets(h: np.ndarray, ptr: np.ndarray, before: np.ndarray, g: np.ndarray, k: int) -> list[np.ndarray]:
    m = stream(k, 3)
    out = []
    for i in range(len(ptr) - 1):
        n = ptr[i + 1] - ptr[i]
        if n >= k:
            x = np.sort(g[before[i]:before[i + 1]])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif n:
            whole = (h[ptr[i]:ptr[i + 1]] * m[:n]).sum(dtype=U) + U(int(n) * 0x51ED27)
            out.append(mix(np.array([whole], U)) >> U(64 - TOKEN_BITS))
        else:
            out.append(np.zeros(0, U))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    a, b = mix(s + U(0x1234567)), mix(s * U(0xD1342543DE82EF95) + U(99))
    return int(a.sum(dtype=U).view(np.int64)), int(b.sum(dtype=U).view(np.int64))


def bitmap(s: np.ndarray) -> bytes:
    """Parity bitmap: every shingle flips one of 2**b bits, 2**b about half the size (64 at least)."""
    b = max(6, int(len(s) // 2).bit_length())
    bits = np.bincount((mix(s) >> U(64 - b)).astype(np.int64), minlength=1 << b) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def fold(bm: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes folded to ``width`` bytes; top hash bits index the map, so neighbours merge."""
    bits = np.unpackbits(bm, axis=1).reshape(len(bm), width * 8, -1)
    return np.packbits(np.bitwise_xor.reduce(bits, axis=2), axis=1)


def need(na, nb, percent):
    """Smallest overlap that links sets of these sizes: 100 i >= p (na + nb - i)."""
    return -((-percent * (na + nb)) // (100 + percent))


def profiles(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, n, k1, k2, bits), one per document."""
    def run(batches):
        for batch in batches:
            for lo, hi, data, off in text_slices(batch.column("text")):
                sets = shingle_sets(data, off, k)
                keys = [set_key(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                    "n": pa.array([len(s) for s in sets], pa.int64()),
                    "k1": pa.array([x for x, _ in keys], pa.int64()), "k2": pa.array([x for _, x in keys], pa.int64()),
                    "bits": pa.array([bitmap(s) if len(s) else None for s in sets], pa.binary())})

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, k1 long, k2 long, bits binary"))


def _frequency(docs: DataFrame, k: int, log2_width: int) -> np.ndarray:
    """Sketches of the shingles (once a text) and of the words (as often as they stand)."""
    def keys_of(batch):
        for _, _, data, off in text_slices(batch.column("text")):
            h, ptr = word_hashes(data, off, lower=True)
            _, before, g = _grams(h, ptr, k)
            sets = _sets(h, ptr, before, g, k)
            if sets:
                yield [np.concatenate(sets), h]

    return build(docs.select("text"), keys_of, 2, log2_width, (1 << 31) - 1)


def rarity(sketch: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """What orders shingles, in eighths of log2 of a count and made once, so that all tasks agree: for each cell of the
    shingles' sketch the level it bounds a count by and whether the count stands out of the cell's noise, for each cell of
    the words' sketch its level, and the level to take from the sum of ``k`` words to get the count by chance."""
    def level(count):
        return np.round(8 * np.log2(np.maximum(count, 1))).astype(np.uint8)

    shingles, words = sketch
    noise = shingles.mean()
    clear = shingles - noise
    sure = clear > 6 * np.sqrt(noise)
    return level(np.where(sure, clear, shingles)), sure, level(words), (k - 1) * int(level(words.sum(dtype=np.float64)))


def prefixes(data: np.ndarray, off: np.ndarray, k: int, percent: int, order: tuple,
             late: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(sorted set, its prefix in the common order) of each text.

    Shingles in the sketch ``late`` come last.  Else a shingle comes by its count where the sketch is sure of it, or by what
    its words make likely within the sketch's bound; then by its hash."""
    bound, sure, words, off_chance = order
    width = len(bound).bit_length() - 1
    h, ptr = word_hashes(data, off, lower=True)
    at, before, g = _grams(h, ptr, k)
    upto = np.concatenate([[0], np.cumsum(words[cells(h, 1, width)], dtype=np.int64)])
    chance = upto[at + k] - upto[at] - off_chance
    out = []
    for i, s in enumerate(_sets(h, ptr, before, g, k)):
        p = len(s) + (-percent * len(s)) // 100 + 1
        if p < len(s):  # so the text has windows
            likely = np.empty(len(s), np.int64)
            likely[np.searchsorted(s, g[before[i]:before[i + 1]])] = chance[before[i]:before[i + 1]]
            cell = cells(s, 0, width)
            most = bound[cell].astype(np.int64)
            score = np.where(sure[cell], most, np.minimum(likely, most))
            if late is not None:
                score += LAST * (estimate(late, s) > 0)
            out.append((s, s[np.argsort(score.astype(np.int16), kind="stable")[:p]]))
        else:
            out.append((s, s[:p]))
    return out


def _prefixes(docs: DataFrame, k: int, percent: int, order, late) -> DataFrame:
    """Rows (token, k1): the prefix of each class, once per partition."""
    def run(batches):
        done: set[int] = set()
        for batch in batches:
            for _, _, data, off in text_slices(batch.column("text")):
                tokens, keys = [], []
                for s, p in prefixes(data, off, k, percent, order.value, late and late.value):
                    if not len(s):
                        continue
                    key = set_key(s)
                    if key[0] in done:
                        continue
                    done.add(key[0])
                    tokens.append(p)
                    keys.append(np.full(len(p), key[0], np.int64))
                if tokens:
                    yield pa.RecordBatch.from_pydict({"token": pa.array(np.concatenate(tokens).view(np.int64)),
                                                      "k1": pa.array(np.concatenate(keys))})

    return docs.where("doc_id is not null").select("text").mapInArrow(run, "token long, k1 long")


def _bitmap_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb, bits_a, bits_b) whose bitmaps allow enough overlap."""
    def run(batches):
        for batch in batches:
            na, nb = batch.column("na").to_numpy(), batch.column("nb").to_numpy()
            low = need(na, nb, percent)
            ok = np.zeros(len(na), bool)
            la = np.array([len(x.as_buffer()) for x in batch.column("bits_a")], np.int64)
            lb = np.array([len(x.as_buffer()) for x in batch.column("bits_b")], np.int64)
            for wa, wb in {(int(x), int(y)) for x, y in zip(la, lb)}:
                at = np.flatnonzero((la == wa) & (lb == wb))
                take = pa.array(at)
                xa, xb = (np.frombuffer(b"".join(batch.column(c).take(take).to_pylist()), np.uint8).reshape(len(at), -1)
                          for c in ("bits_a", "bits_b"))
                w = min(wa, wb)
                xa, xb = fold(xa, w) if wa > w else xa, fold(xb, w) if wb > w else xb
                differ = np.bitwise_count(xa ^ xb).sum(axis=1, dtype=np.int64)
                ok[at] = (na[at] + nb[at] - differ) // 2 >= low[at]
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _arrays(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """Rows (id, arr): the sorted shingles of the wanted documents (id, k1).

    A membership sketch of fixed size first drops, where they are read, the texts of documents that are not wanted; the
    join decides about the few others, so it moves little more text than it needs."""
    members = docs.sparkSession.sparkContext.broadcast(build(
        wanted.select("id"), lambda batch: [batch.column("id").to_numpy().view(U)], 1, MEMBER_BITS, 1))

    def may_want(batches):
        for batch in batches:
            yield batch.filter(pa.array(estimate(members.value, batch.column("id").to_numpy().view(U)) > 0))

    def run(batches):
        for batch in batches:
            k1 = batch.column("k1").to_pylist()
            ids = batch.column("id").to_pylist()
            for lo, hi, data, off in text_slices(batch.column("text")):
                sets = shingle_sets(data, off, k)
                hit = [i for i, s in enumerate(sets) if len(s) and set_key(s)[0] == k1[lo + i]]
                yield pa.RecordBatch.from_pydict({"id": pa.array([ids[lo + i] for i in hit], pa.int64()),
                                                  "arr": pa.array([sets[i].tobytes() for i in hit], pa.binary())})

    maybe = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    return maybe.mapInArrow(may_want, "id long, text string").join(wanted, "id").mapInArrow(run, "id long, arr binary")


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum()) if len(y) else 0


def _verify(pairs: DataFrame, arrays: DataFrame, percent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("arr_a"), batch.column("arr_b")):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                i = overlap(x, y)
                keep.append(100 * i >= percent * (len(x) + len(y) - i))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    one = arrays.select(F.col("id").alias("b"), F.col("arr").alias("arr_b"))
    two = arrays.select(F.col("id").alias("a"), F.col("arr").alias("arr_a"))
    return pairs.join(one, "b").join(two, "a").select("a", "b", "arr_a", "arr_b").mapInArrow(run, "a long, b long")


def _tile_links(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links joining separate parts among one tile's rows (id, side, comp, n, bits, arr); sides 0 and 1 meet, side 2
    (a diagonal tile) meets itself."""
    left = [r for r in rows if r[1] != 1]
    right = [r for r in rows if r[1] == 1] or left
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def packed(part, w):
        return np.concatenate([fold(np.frombuffer(r[4], np.uint8)[None], w) for r in part])

    w = min(len(r[4]) for r in left + right)
    xa, xb = packed(left, w), packed(right, w)
    na, nb = np.array([r[3] for r in left]), np.array([r[3] for r in right])
    out = []
    for i, r in enumerate(left):
        differ = np.bitwise_count(xa[i] ^ xb).sum(axis=1, dtype=np.int64)
        ok = (na[i] + nb - differ) // 2 >= need(na[i], nb, percent)
        if right is left:
            ok[:i + 1] = False
        for j in np.flatnonzero(ok):
            q = right[j]
            if r[0] == q[0] or find(r[2]) == find(q[2]):
                continue
            x, y = np.frombuffer(r[5], U), np.frombuffer(q[5], U)
            c = overlap(x, y)
            if 100 * c >= percent * (len(x) + len(y) - c):
                parent[find(r[2])] = find(q[2])
                out.append((r[0], q[0]))
    return out


def _band(percent: int):
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.001 / percent))).cast("int")


def _tiled(hot: DataFrame, percent: int, tile: int) -> int:
    """Shingles in the tiles of ``_hot_links`` at most: if all members were one family without a link."""
    bands = hot.select("id", "n").distinct().groupBy(_band(percent).alias("band")).agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    bands = {r["band"]: r for r in bands.collect()}  # a row for each band of sizes, which are a logarithm's
    return sum(r["n"] * sum(-(-bands[x]["c"] // tile) for x in (b - 1, b, b + 1) if x in bands) for b, r in bands.items())


def _hot_links(hot: DataFrame, comp: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int,
               tile: int) -> DataFrame:
    """Links among members (token, id) of hot shingles that the components so far do not already connect."""
    lead = hot.groupBy("token").agg(F.min("id").alias("lead"))
    family = components(hot.join(lead, "token").select(F.col("id").alias("a"), F.col("lead").alias("b")))
    member = (hot.select("id").distinct().join(family.withColumnRenamed("component", "family"), "id", "left")
              .join(comp, "id", "left").select("id", F.coalesce("family", "id").alias("family"), F.coalesce("component", "id").alias("comp")))
    member = cut(member.join(classes.select("id", "k1", "n", "bits"), "id"))
    sizes = member.groupBy("family", "comp").agg(F.count("*").alias("c"))
    main = sizes.groupBy("family").agg(F.max(F.struct("c", F.col("comp"))).alias("m"), F.sum("c").alias("total")).where("m.c < total")
    # Banded by size: linked sets differ by less than one band, so a tile joins a band with itself or the next.
    member = (member.join(main.select("family", F.col("m.comp").alias("main")), "family")
              .withColumn("rest", F.col("comp") != F.col("main")).withColumn("band", _band(percent)))
    many = member.groupBy("family", "band", "rest").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("blocks"))
    member = member.join(many, ["family", "band", "rest"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    member = cut(member)
    rest = many.where("rest").select("family", F.col("band").alias("rband"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("rblock"))
    # A tile is one block of rest rows (rband, rblock) against one block (band, rest, block) of the same or a near band.
    spots = member.select("family", "band", "rest", "block").distinct()
    tiles = (spots.join(rest, "family")
             .where("abs(band - rband) <= 1 and (not rest or rband > band or (rband = band and rblock >= block))")
             .withColumn("tile", F.xxhash64("family", "rband", "rblock", "band", "rest", "block")))
    diagonal = F.expr("rest and rband = band and rblock = block")
    right = tiles.select("tile", "family", "band", "rest", "block", F.when(diagonal, 2).otherwise(1).alias("side"))
    left = tiles.where(~diagonal).select("tile", "family", F.col("rband").alias("band"), F.lit(True).alias("rest"),
                                         F.col("rblock").alias("block"), F.lit(0).alias("side"))
    placed = member.join(right.unionByName(left), ["family", "band", "rest", "block"])
    arrays = _arrays(docs, member.select("id", "k1").distinct(), k)
    placed = (placed.select("tile", "id", "side", "comp", "n", "bits").join(arrays, "id")
              .repartition("tile").sortWithinPartitions("tile"))

    def run(batches):
        tile_id, rows = None, []

        def flush():
            got = _tile_links(rows, percent) if rows else []
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in got], pa.int64()),
                                               "b": pa.array([y for _, y in got], pa.int64())})
        for batch in batches:
            for t, *r in zip(*(batch.column(c).to_pylist() for c in ("tile", "id", "side", "comp", "n", "bits", "arr"))):
                if t != tile_id:
                    if rows:
                        yield flush()
                    tile_id, rows = t, []
                rows.append(tuple(r))
        if rows:
            yield flush()

    return placed.select("tile", "id", "side", "comp", "n", "bits", "arr").mapInArrow(run, "a long, b long")


def _shared(docs: DataFrame, classes: DataFrame, k: int, percent: int, order, late) -> DataFrame:
    """Rows (token, id, n, c, lead): the shingles in several classes' prefixes, with their classes, how many and the smallest."""
    by_token = Window.partitionBy("token")
    pre = (_prefixes(docs, k, percent, order, late)
           .withColumn("lo", F.min("k1").over(by_token)).withColumn("hi", F.max("k1").over(by_token))
           .where("lo < hi").select("token", "k1").distinct())
    pre = cut(pre.join(classes.select("k1", "id", "n"), "k1").select("token", "id", "n"))
    release(docs.sparkSession)
    return pre.join(pre.groupBy("token").agg(F.count("*").alias("c"), F.min("id").alias("lead")), "token")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, hot: int = HOT, tile: int = TILE,
                    log2_width: int = LOG2_WIDTH, spare: float = SPARE) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): component_id is the smallest doc_id reachable by links."""
    spark = docs.sparkSession
    docs = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    prof = cut(profiles(docs, k))
    classes = cut(prof.where("n > 0 and doc_id is not null").groupBy("k1", "k2", "n")
                  .agg(F.min("doc_id").alias("id"), F.first("bits").alias("bits")))
    order = spark.sparkContext.broadcast(rarity(_frequency(docs, k, log2_width), k))
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    late = before = None
    for left in reversed(range(PASSES)):
        pre = _shared(docs, classes, k, percent, order, late)
        many = cut(pre.where(F.col("c") > hot).select("token", "id", "n", "lead"))
        tiled = _tiled(many, percent, tile)
        if not left or tiled <= spare * total or before and 2 * tiled > before:
            break  # the prefixes of any pass are complete
        found = build(many.select("token").distinct(), lambda batch: [batch.column("token").to_numpy().view(U)], 1, MEMBER_BITS, 1)
        late, before = spark.sparkContext.broadcast(np.maximum(found, late.value) if late else found), tiled
    cold = pre.where(F.col("c") <= hot)
    near = f"(least(na, nb) * 100 >= {percent} * greatest(na, nb))"
    pairs = (cold.select("token", F.col("id").alias("a"), F.col("n").alias("na"))
             .join(cold.select("token", F.col("id").alias("b"), F.col("n").alias("nb")), "token")
             .where(f"a < b and {near}"))
    lead = many.join(classes.select(F.col("id").alias("lead"), F.col("n").alias("nl")), "lead")
    pairs = pairs.select("a", "b").unionByName(
        lead.select(F.col("lead").alias("a"), F.col("id").alias("b"), F.col("nl").alias("na"), F.col("n").alias("nb"))
        .where(f"a < b and {near}").select("a", "b")).distinct()
    info = classes.select("id", "n", "bits")
    pairs = (pairs.join(info.toDF("a", "na", "bits_a"), "a").join(info.toDF("b", "nb", "bits_b"), "b"))
    pairs = cut(_bitmap_filter(pairs.select("a", "b", "na", "nb", "bits_a", "bits_b"), percent))
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    arrays = _arrays(docs, cut(ends.join(classes.select("id", "k1"), "id")), k)
    links = cut(_verify(pairs, arrays, percent))  # a stage of its own: one Python worker a core, not two in a row
    comp = cut(components(links))
    if tiled:
        more = cut(_hot_links(many.select("token", "id"), comp, classes, docs, k, percent, tile))
        if not more.isEmpty():
            comp = components(comp.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(more))
    named = classes.select("k1", "k2", "id").join(comp, "id", "left").select(
        "k1", "k2", F.coalesce("component", "id").alias("comp"))
    return (prof.join(named, ["k1", "k2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id")).alias("component_id")))
