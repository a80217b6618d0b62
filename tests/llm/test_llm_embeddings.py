"""Near-duplicate vectors against all cosines."""

from __future__ import annotations

import numpy as np
import pytest

from dispensa.llm.embeddings import near_duplicates, passes_for
from tests.llm.brute import components


def brute(ids, vectors, threshold=0.9):
    x = np.array([np.zeros(1) if v is None else v for v in vectors], dtype=object)
    good = [v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v) for v in vectors]
    links = []
    for i in range(len(ids)):
        for j in range(i):
            if good[i] and good[j] and len(x[i]) == len(x[j]):
                a, b = np.array(x[i], dtype=float), np.array(x[j], dtype=float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links.append((ids[i], ids[j]))
    count = {i: 0 for i in ids}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    part = components(ids, links)
    return {i: (count[i], part[i], part[i] == i) for i in ids}


def clustered(seed, n=400, dim=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 4, dim))
    out = []
    for k in range(n):
        centre = centres[k % len(centres) if k % 3 else 0]  # a third around one centre
        out.append((centre + rng.normal(scale=0.15, size=dim)).astype(np.float32).tolist())
    return out


@pytest.mark.parametrize("seed", range(2))
def test_recall_and_precision(spark, staging, seed):
    vectors = clustered(seed)
    ids = list(range(len(vectors)))
    table = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>")
    got = {r["vec_id"]: tuple(r)[1:] for r in near_duplicates(table, staging).collect()}
    want = brute(ids, vectors)
    found, total = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert len(got) == len(ids) and total > 10000
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert found >= 0.98 * total
    assert sum(got[i][1] == want[i][1] for i in ids) >= 0.98 * len(ids)


def test_big_components_are_counted_in_tiles(spark, staging, monkeypatch):
    from dispensa.llm import embeddings

    monkeypatch.setattr(embeddings, "TILE", 16)
    vectors = clustered(3, n=240)
    ids = list(range(len(vectors)))
    table = spark.createDataFrame(list(zip(ids, vectors)), "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(table, staging).collect()}
    want = {i: w[0] for i, w in brute(ids, vectors).items()}
    assert sum(got.values()) >= 0.98 * sum(want.values()) and all(got[i] <= want[i] for i in ids)


def test_copies_bad_vectors_and_nothing(spark, staging):
    a, b = [1.0, 0.0, 2.0], [0.0, 1.0, 0.0]
    rows = [
        (5, a, "x"), (3, a, "x"), (9, [2.0, 0.0, 4.0], "x"), (2, b, "x"), (11, b, "x"), (11, b, "x"), (20, None, "x"), (21, [], "x"),
        (22, [0.0, 0.0, 0.0], "x"), (23, [1.0, None, 2.0], "x"), (24, [float("nan"), 0.0, 2.0], "x"), (25, [float("inf"), 0.0, 2.0], "x"),
        (26, [1.0, 0.0], "x"), (27, [1e-200, 0.0, 2e-200], "x"), (28, [1e200, 0.0, 2e200], "x"), (None, a, "x"),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component_id string")
    got = sorted(tuple(r) for r in near_duplicates(table, staging).collect())
    same = {3: 4, 5: 4, 9: 4, 27: 4, 28: 4}
    want = [(i, n, 3, i == 3) for i, n in same.items()] + [(2, 2, 2, True), (11, 2, 2, False), (11, 2, 2, False)]
    want += [(i, 0, i, True) for i in (20, 21, 22, 23, 24, 25, 26)]
    assert got == sorted(want)
    assert near_duplicates(table.limit(0), staging).collect() == []


def test_passes_follow_the_number_of_vectors():
    """By the chance to share the bits that lead into one window, 1 - (1 - p ** log2(N / 24)) ** passes."""
    p = 1 - np.arccos(0.9) / np.pi
    for n in (10, 20_000, 50_000, 1_000_000, 10_000_000):
        chance = p ** max(0, np.log2(n / 24))
        assert 1 - (1 - chance) ** passes_for(n) >= 0.99
    assert passes_for(10) == 16 < passes_for(20_000) < passes_for(1_000_000) == 48
    assert passes_for(1_000_000, threshold=0.8) > 48 > passes_for(1_000_000, window=480)


@pytest.mark.parametrize("partitions", (4, 37))
def test_windows_reach_over_range_borders(spark, staging, partitions):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=32)
    rows = [(k, (centre + rng.normal(scale=0.1, size=32)).astype(np.float32).tolist()) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(n) for n in names]
    try:
        for name, value in zip(names, (str(partitions), "false")):
            spark.conf.set(name, value)
        # Each vector links with the next one, so one pass with the least window finds all.
        got = near_duplicates(table, staging, passes=1, window=1).collect()
        assert {(r["n_links"], r["component_id"]) for r in got} == {(59, 0)}
    finally:
        for name, value in zip(names, before):
            spark.conf.set(name, value)
