"""Connected components against union-find."""

from __future__ import annotations

import random

import pytest

from dispensa.llm.components import connected


def union_find(links):
    up = {x: x for link in links for x in link}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "two hubs"])
def test_components(spark, staging, shape):
    rng = random.Random(5)
    links = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
        "chain": [(i, i + 1) for i in range(120)],
        "star": [(7, i) for i in range(8, 3000)],
        "two hubs": [(0 if i % 2 else 1, i) for i in range(2, 1500)] + [(1499, 1498)],
    }[shape]
    links += links[:5] + [(3, 3)]
    got = connected(spark.createDataFrame(links, "a long, b long"), staging)
    want = union_find([x for x in links if x[0] != x[1]])
    assert {r["node"]: r["component"] for r in got.collect()} == want and got.count() == len(want)


def test_text_nodes_nulls_and_nothing(spark, staging):
    links = spark.createDataFrame([("b", "a"), ("c", "b"), (None, "a"), ("x", None)], "a string, b string")
    assert {tuple(r) for r in connected(links, staging).collect()} == {("a", "a"), ("b", "a"), ("c", "a")}
    assert connected(links.limit(0), staging).collect() == []
