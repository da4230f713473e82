"""Connected components against a plain union-find on random graphs, chains and hubs."""

import random

import pytest

from larkspur.llm.common import components


def plain(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent if find(x) != x}


def graphs():
    rng = random.Random(5)
    yield []
    yield [(3, 3)]
    yield [(i, i + 1) for i in range(60)]
    yield [(7, i) for i in range(8, 300)] + [(299, 1)]
    yield [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] * 2


@pytest.mark.parametrize("edges", list(graphs()), ids=["empty", "loop", "chain", "hub", "random"])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()
    assert {r["id"]: r["component"] for r in got} == plain(edges)
