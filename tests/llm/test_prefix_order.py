"""op3's order of shingles on a corpus that outgrows the sketch: the widths and limits here are small instead."""

import random

import pytest

from larkspur.llm import ngram_jaccard

STOP = "the of and to in".split()
SCHEMA = "doc_id long, text string"


def word(rng):
    return "".join(rng.choice("bcdfghjklmnp") for _ in range(7))


def plain(rows, k, percent):
    sets = [(i, {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}) for i, w in ((i, t.split()) for i, t in rows)]
    comp = {i: i for i, _ in sets}
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if 100 * len(a & b) >= percent * len(a | b) and comp[i] != comp[j]:
                x, y = sorted((comp[i], comp[j]))
                comp = {q: x if c == y else c for q, c in comp.items()}
    return comp


@pytest.fixture
def hot_members(monkeypatch):
    """Members of hot shingles that reach the tiles."""
    seen, links = [], ngram_jaccard._hot_links

    def watched(hot, *rest):
        seen.append(hot.select("id").distinct().count())
        return links(hot, *rest)
    monkeypatch.setattr(ngram_jaccard, "_hot_links", watched)
    return seen


def near_copies(rng, rows, every):
    """A copy of each so many rows with one word changed."""
    out = []
    for i, t in rows[::every]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        out.append((i + 10_000, " ".join(w)))
    return out


def check(spark, rows, **limits):
    got = ngram_jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), **limits).collect()
    want = plain(rows, 4, 85)
    assert {r["doc_id"]: r["component_id"] for r in got} == want and any(i != c for i, c in want.items())


def test_chance_meetings_stay_out_of_the_tiles(spark, hot_members):
    """Unrelated texts share shingles of frequent words, each in more texts than a hot shingle has, and below the sketch's noise."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(STOP) if j % 100 < 50 else word(rng) for j in range(200))) for i in range(120)]
    check(spark, rows + near_copies(rng, rows, 10), hot=6, log2_width=9)
    assert not hot_members


def test_passages_stay_out_of_the_tiles(spark, hot_members):
    """A passage of rare words in every text, which neither sketch can tell from noise here."""
    rng = random.Random(5)
    passage = " ".join(word(rng) for _ in range(30))
    rows = [(i, " ".join([*(word(rng) for _ in range(60)), passage, *(word(rng) for _ in range(60))])) for i in range(100)]
    check(spark, rows + near_copies(rng, rows, 10), hot=6, log2_width=5, tile=4, spare=0.0)
    assert not hot_members


def test_a_family_of_near_copies_is_still_tiled(spark, hot_members):
    """What is hot in every order stays hot, and linked."""
    rng = random.Random(6)
    base = [word(rng) for _ in range(80)]
    rows = [(i, " ".join("changed" if rng.random() < 0.02 else w for w in base)) for i in range(60)]
    check(spark, rows + [(100 + i, " ".join(word(rng) for _ in range(40))) for i in range(20)], hot=2, tile=4, spare=0.0)
    assert hot_members
