"""run() against the five stages in plain Python, one after the other, on a table whose columns clash with the operators' own."""

import hashlib
import random
from collections import Counter, defaultdict

import corpus_pipeline
from larkspur.llm import langid

WORDS = {"en": "the river and old stone bridge were quiet in evening light when last boat came home they had walked with some bread for her".split(),
         "de": "der alte fluss und die steinerne bruecke waren still im abendlicht als letzte boot nach hause kam sie hatten etwas brot".split()}


def texts():
    rng = random.Random(11)
    make = lambda lang, n: " ".join(rng.choice(WORDS[lang]) for _ in range(n))
    item = make("en", 40)
    rows = [(i, make("en" if i % 2 else "de", rng.randrange(12, 90)), "en" if i % 2 else "de") for i in range(1, 81)]
    base = rows[4][1].split()
    near = [*base]
    near[len(near) // 2] = "changed"
    rows += [(100, rows[3][1], "de"), (101, rows[3][1].upper(), "de"), (102, " ".join(near), "en"), (103, f"so {item} on", "en"),
             (104, " ".join(item.split()[25:] + ["and"] + item.split()[:25]) + "!", "en"), (105, None, "en"), (106, "", "en"), (107, "12 34 !!", None),
             (108, "the", "en"), (109, "the river", "en"), (110, make("en", 3000), "en"), (111, make("de", 30), None), (None, make("en", 25), "en"),
             (1, rows[0][1], "en")]
    bench = [(1, item), (2, "the"), (3, None), (4, ""), (5, make("de", 12) + " nie gesehen worte hier stehen noch mehr davon")]
    return [(i, t, lang, ["a", "b", None][n % 3] if n % 5 else "hot", len(t or "")) for n, (i, t, lang) in enumerate(rows)], bench


def grams(text):
    x = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    x = f" {' '.join(x)} " if x else ""
    return Counter(x[i:i + n] for n in (1, 2, 3) for i in range(len(x) - n + 1) if x[i:i + n] != " ")


def ranked(counts, top):
    code = lambda g: sum(ord(c) << (21 * (len(g) - 1 - i)) for i, c in enumerate(g))
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:top]


def language(rows):
    import zlib
    sums = defaultdict(Counter)
    for i, t, lang, *_ in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 5 and lang and t is not None:
            sums[lang] += grams(t)
    profiles = {lang: {g: r for r, g in enumerate(ranked(c, langid.TOP))} for lang, c in sums.items()}
    for row in rows:
        doc = ranked(grams(row[1]), langid.TOP)
        if doc:
            far = min(sum(abs(p[g] - r) if g in p else langid.TOP for r, g in enumerate(doc)) for p in profiles.values())
            if 1 - far / (langid.TOP * len(doc)) >= corpus_pipeline.MIN_SCORE:
                yield row


def near_duplicates(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    sets = [(r[0], shingles(r[1])) for r in rows if r[0] is not None]
    comp = {i: i for i, _ in sets}
    change = True
    while change:
        change = False
        for i, a in sets:
            for j, b in sets:
                if a and b and 100 * len(a & b) >= 80 * len(a | b) and comp[i] != comp[j]:
                    comp[i] = comp[j] = min(comp[i], comp[j])
                    change = True
    return [r for r in rows if r[0] is None or comp[r[0]] == r[0]]


def tiled(doc, item, k=5):
    """Words of the item in greedy tiles, by trying every pair of places for the longest match."""
    in_doc, in_item, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while (a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and a + n not in in_doc and b + n not in in_item):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < k:
            return total
        in_doc |= set(range(a, a + n))
        in_item |= set(range(b, b + n))
        total += n


def decontaminate(rows, bench):
    split = lambda t: "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (t or "").lower()).split()
    items = [split(t) for _, t in bench if len(split(t)) >= 5]
    return [r for r in rows if len(r[1]) > 10_000 or not any(tiled(split(r[1]), x) >= 0.5 * len(x) for x in items)]


def mix(rows):
    size = lambda r: len((r[1] or "").split())
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(names)}
    own = {s: sum(map(size, by[s])) for s in names}
    target, left, rest = {}, set(names), 1.5 * sum(own.values())
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * own[s]]
        if not over:
            break
        for s in over:
            target[s] = 2 * own[s]
            rest -= target[s]
            left.discard(s)
    target |= share if left else {}
    for s in names:
        certain = int(target[s] // own[s]) if own[s] else 0
        need, upto = target[s] - certain * own[s], 0
        draw = lambda r: int(hashlib.md5(f"mix-1:{r[0] if r[0] is not None else hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()[:13], 16)
        for r in sorted(by[s], key=lambda r: (draw(r), size(r))):
            upto += size(r)
            extra = need > 0 and upto - size(r) / 2 <= need
            yield from [r] * (certain + extra)


def test_run_equals_the_plain_pipeline(spark, scratch):
    rows, bench = texts()
    extra = ("mine", "big", "c", 7, "x", 3.5)
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, copy string, row int, lang_pred string, target double"
    spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(3).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    kept = list(language(rows))
    assert {r[0] for r in rows} - {r[0] for r in kept} >= {105, 106, 107}
    distinct = near_duplicates(kept)
    assert not {100, 101, 102} & {r[0] for r in distinct}
    clean = decontaminate(distinct, bench)
    assert not {103, 104} & {r[0] for r in clean} and {108, 109} <= {r[0] for r in clean}
    want = Counter((*r, *(e for e in extra if e != "big")) for r in mix(clean))
    got = corpus_pipeline.run(spark, scratch).collect()
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars, r.score, r.copy, r.row, r.lang_pred, r.target) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    for x in shards.values():
        assert sorted(r.slot for r in x) == list(range(len(x)))
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got) and set(shards) <= set(range(8))


def test_run_on_empty_tables(spark, scratch):
    rows, bench = texts()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0
