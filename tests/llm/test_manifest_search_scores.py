"""Merkle manifest, hard-negative search and document scores against plain Python versions, on odd input too."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.llm import merkle, ppm, rtree
from larkspur.llm.ranks import ranked

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def lower(text):
    return bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode())


def test_ranks(spark):
    rng = random.Random(1)
    rows = [(g, rng.randrange(40), i) for i, g in enumerate(["a"] * 3000 + ["b"] * 2 + [""] * 500)] + [("c", None, -1), ("c", 5, -2)]
    got = ranked(spark.createDataFrame(rows, "g string, k int, id long").repartition(7), "g", ["k", "id"]).collect()
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {(*r, i, len(x)) for x in by.values() for i, r in enumerate(sorted(x, key=lambda r: (r[1] is not None, r[1] or 0, r[2])))}
    assert {(r["g"], r["k"], r["id"], r["pos"], r["n"]) for r in got} == want
    same = ranked(spark.createDataFrame([("x", 1)] * 900, "g string, k int").repartition(5), "g", ["k"]).collect()
    assert sorted(r["pos"] for r in same) == list(range(900)) and ranked(spark.createDataFrame([], "g string, k int"), "g", ["k"]).count() == 0


def tree(leaves):
    """(root, siblings of each leaf, level by level)."""
    level, paths, owner = leaves, [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for leaf, at in enumerate(owner):
            begin = at // 16 * 16
            paths[leaf].append((level[begin:at], level[at + 1:begin + 16]))
        level = [H(*level[i:i + 16]) for i in range(0, len(level), 16)]
        owner = [at // 16 for at in owner]
    return level[0] if level else None, paths


def manifest(rows):
    mark = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r, H(*map(mark, r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[g] = tree([h for _, h in groups[g]])
    root, ways = tree([trees[g][0] for g in names])
    for g, way in zip(names, ways):
        for (r, h), path in zip(groups[g], trees[g][1]):
            full = path + way
            fake = h
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                fake = H(*map(mark, (*r[:4], None if r[4] is None else lower(r[4]).decode())))
            for left, right in full:
                fake = H(*left, fake, *right)
            yield (r[0], h, trees[g][0], root, H(*(x for left, right in full for x in left + right)), fake, fake == root)


def digests(frame):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*map(F.col, fields[:-1]), low))
    rows = merkle.manifest(frame, "doc_id", "source", fields, claim)
    folded = merkle.fold(F.coalesce("claim", "leaf"), F.col("path"))
    return Counter(tuple(r) for r in rows.select("id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")), 256), folded, folded == F.col("root")).collect())


DOC = "doc_id long, source string, lang string, n_chars long, text string, g string, node string, path string, pos int, leaf string"


def test_merkle_brute_force(spark):
    """Sources of one leaf, of several blocks and of partly filled runs; nulls, '-' texts, ties and whole repeats."""
    rng = random.Random(4)
    rows = [(i, "big", "en", i % 7, f"Text {rng.random()}") for i in range(4096 + 300)]
    rows += [(i, f"s{i % 3}", None, None, None if i % 5 == 0 else "-") for i in range(5000, 5060)]
    rows += [(7, "one", "en", 1, "A"), (None, None, None, None, None), (None, None, None, None, None), (3, None, "-", 0, ""), (3, None, None, 0, "Ü b"),
             (2 ** 40, "é", "en", 1, "x"), (-5, "Z", "en", 1, "Y"), (1, "", "en", 1, "empty name"), (1, "", "en", 1, "Empty name")]
    rows += [(6000, "rep", "en", 2, "Same row")] * 40
    got = digests(spark.createDataFrame([(*r, *["clash"] * 3, 1, "clash") for r in rows], DOC).repartition(5))
    assert got == Counter(manifest(rows))
    lone = digests(spark.createDataFrame([(*rows[0], *["clash"] * 3, 1, "clash")], DOC))
    assert lone == Counter(manifest(rows[:1])) and next(iter(lone))[4] == H()
    assert digests(spark.createDataFrame([], DOC)) == Counter()


def test_merkle_many_groups(spark):
    """More groups than a block holds, so that the tree over the groups has tiers as well."""
    rows = [(i, f"src{i % 4500}", "en", 1, f"T{i}") for i in range(4700)]
    assert digests(spark.createDataFrame([(*r, *["clash"] * 3, 1, "clash") for r in rows], DOC)) == Counter(manifest(rows))


def negatives(rows):
    fine = [(i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, label, v in fine:
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in fine if j != i]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:5]:
            window = sorted(s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)
            for rank, (n, k, _) in enumerate(window[:5], 1):
                yield (i, j, rank, k, -p, -n)


VEC = "vec_id long, embedding array<float>, label int, id string, tile string, v string"


def run_negatives(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], VEC)
    return Counter(tuple(r) for r in rtree.hard_negatives(frame).collect())


@pytest.mark.parametrize("tile, page", [(8192, 128), (64, 4)])
def test_hard_negatives_brute_force(spark, monkeypatch, tile, page):
    """Also with tiny tiles, so that anchors travel and boxes prune; a third of all rows is one vector; many ties."""
    monkeypatch.setattr(rtree, "TILE", tile)
    monkeypatch.setattr(rtree, "PAGE", page)
    monkeypatch.setattr(rtree, "PACK", 3)
    monkeypatch.setattr(rtree, "BOXES", 2)
    rng = random.Random(tile)
    f32 = lambda v: [float(F32(x)) for x in v]
    from numpy import float32 as F32
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(900):
        c = rng.choice(centre)
        v = [0.5, -0.25, 0.125, 0.0, 0.75, 0.1] if i % 3 == 0 else [x + rng.gauss(0, .15) for x in c]
        rows.append((i, f32(v), rng.randrange(4)))
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None, 1), (1100, [nan, 1.0, 0, 0, 0, 0], 1), (1200, [inf, 1.0, 0, 0, 0, 0], 1), (1300, [None, 1.0, 0, 0, 0, 0], 1), (1400, f32(centre[0]), None),
             (None, f32(centre[0]), 1), (1500, [0.0] * 6, 1), (1600, [], 2), (1700, [1.0, 0.5], 3), (1800, f32(centre[1]), 9), (-300, f32(centre[2]), -1)]
    rows = [(i, v and [float(x) if x is not None else None for x in v], label) for i, v, label in rows]
    want = Counter(negatives(rows))
    assert run_negatives(spark, rows) == want and len(want) > 50
    if page == 4:
        assert run_negatives(spark, rows[:1]) == Counter() and rtree.hard_negatives(spark.createDataFrame([], VEC)).count() == 0


def test_tree_bounds_prune():
    """The queue leaves pages closed: clustered vectors, an anchor inside one cluster."""
    import numpy as np
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(c, 4, (256, 8)) for c in rng.normal(0, 200, (16, 8))]).astype(np.int32)
    v = v[rtree._str_order(v)]
    tree_ = rtree._Tree(np.arange(len(v)).tobytes(), np.zeros(len(v), np.int32).tobytes(), v.tobytes(), 8)
    opened = []

    class Watched:
        def __init__(self, a):
            self.a = a

        def __getitem__(self, rows):
            opened.append(rows)
            return self.a[rows]
    a = v[100].astype(float)
    low, high = rtree._bounds(a[None], tree_.lo, tree_.hi)
    tree_.values = Watched(tree_.values)
    slot = {"slot": 0, "low": rtree.LOWEST, "high": rtree.HIGHEST, "floor": rtree.LOWEST}
    got = sorted((-s, i) for _, i, s in rtree._search(tree_, 100, 0, a, low[0], high[0], [slot], True, 5))
    assert got == sorted((-int(s), i) for i, s in enumerate(v @ v[100]) if i != 100)[:5] and len(opened) < tree_.level[0] / 2


def ppm_counts(texts, order):
    table = defaultdict(Counter)
    for t in texts:
        s = [0] * order + [b + 1 for b in t] + [257]
        for i in range(order, len(s)):
            for j in range(order + 1):
                table[tuple(s[i - j:i])][s[i]] += 1
    return table


def ppm_log10(table, order, text):
    s, total = [0] * order + [b + 1 for b in text] + [257], 0.0
    for i in range(order, len(s)):
        gone = set()
        for j in range(order, -1, -1):
            left = {k: v for k, v in table.get(tuple(s[i - j:i]), {}).items() if k not in gone}
            if not left:
                continue
            whole = sum(left.values()) + len(left)
            if s[i] in left:
                total += math.log10(left[s[i]] / whole)
                break
            total += math.log10(len(left) / whole)
            gone |= set(left)
        else:
            total -= math.log10(257 - len(gone))
    return total


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 7 == 2


def check_scores(spark, rows):
    frame = spark.createDataFrame([(i, t, "clash", 1, "clash") for i, t in rows], "doc_id long, text string, chunk string, train int, key string").repartition(4)
    got = [tuple(r) for r in ppm.score(frame).collect()]
    train = [lower(t) for i, t in rows if not held(i)]
    table, words = ppm_counts(train, ppm.ORDER), Counter(w for t in train for w in [*t.split(), None])
    n, v = sum(words.values()), len(words)
    want = []
    for i, t in rows:
        tokens = [*lower(t).split(), None]
        want.append((i, held(i), len(tokens), sum(words[w] > 0 for w in tokens), n, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens),
                     ppm_log10(table, ppm.ORDER, lower(t))))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("chunk", [1 << 24, 200])
def test_scores_brute_force(spark, monkeypatch, chunk):
    """Also with chunks of a document or two; one text is longer than any chunk, a third of all rows is one text."""
    monkeypatch.setattr(ppm, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(ppm, "PIECE", 700)
    rng = random.Random(2)
    words = ["the", "Cat", "sat", "över", "маленький", "x", "zebra\x00", "no-one"]
    rows = [(i, " ".join(rng.choice(words[:3 + i % 6]) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    rows += [(i, "the cat\tsat\n the cat") for i in range(100, 130)] + [(None, "the Cat"), (None, None), (5, None), (6, ""), (6, ""), (7, " \n"), (8, "THE CAT " * 600)]
    check_scores(spark, rows)


def test_scores_without_training(spark):
    ids = [i for i in range(40) if held(i)]
    check_scores(spark, [(i, "abc") for i in ids])
    assert ppm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_probabilities_sum_to_one(spark):
    """All 257 continuations of a seen, a partly seen and an unseen context."""
    texts = [b"abracadabra", b"abrakadabra", b"cad"]
    table = ppm_counts(texts, ppm.ORDER)
    code = lambda s: sum(x << ppm.BITS * i for i, x in enumerate(reversed(s)))
    contexts = [tuple(b + 1 for b in c) for c in (b"dabra", b"zdabr", b"zzzzz")] + [(0,) * 5]
    counts = Counter({code(c + (s,)): n for c, x in table.items() if len(c) == 5 for s, n in x.items()})
    asked = {code(c + (s,)): counts[code(c + (s,))] for c in contexts for s in range(1, 258)} | dict(counts)
    got = {r["key"]: r["value"] for r in ppm.log_probabilities(spark.createDataFrame(list(asked.items()), "key long, n long")).collect()}
    for c in contexts:
        assert sum(10 ** got[code(c + (s,))] for s in range(1, 258)) == pytest.approx(1)
