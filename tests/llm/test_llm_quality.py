"""The quality classifier on held-out rows and odd inputs."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from dispensa.llm import quality


@pytest.fixture(scope="module")
def scored(spark):
    folder = Path("/root/testdata/sf0.01")
    if not folder.is_dir():
        pytest.skip("no test tables")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.fit(docs, labels)
    rows = quality.score(docs, machine).select("doc_id", "held_out", "score", "predicted").collect()
    return {r["doc_id"]: r for r in rows}, {r["doc_id"]: r["quality"] for r in labels.collect()}


def test_held_out_accuracy(scored):
    rows, labels = scored
    apart = [(rows[i], y) for i, y in labels.items() if rows[i]["held_out"]]
    good, bad = ([r["score"] for r, y in apart if y == v] for v in (1, 0))
    auc = np.mean([g > b for g in good for b in bad])
    assert len(apart) > 40 and auc > 0.9
    assert np.mean([r["predicted"] == y for r, y in apart]) > 0.9
    assert np.mean([s >= 0.3 for s in good]) > 0.97


def test_folds_and_ranges(scored):
    rows, _ = scored
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_pairwise_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    sparse, statistics = quality.features(pa.array(["a b c d", "", "x y x"]))
    width = quality.BUCKETS + statistics.shape[1]
    machine = quality.Machine(0.5, rng.normal(size=width), rng.normal(size=(width, 3)), statistics.mean(0), np.ones(statistics.shape[1]))
    f = machine.design(sparse, statistics)
    for row, margin in enumerate(machine.margins(f)[0]):
        at = np.flatnonzero(f.owner == row)
        want = 0.5 + machine.weights[f.place[at]] @ f.x[at]
        for n, i in enumerate(at):
            for j in at[n + 1 :]:
                want += machine.factors[f.place[i]] @ machine.factors[f.place[j]] * f.x[i] * f.x[j]
        assert margin == pytest.approx(want)


def test_only_the_text_matters(spark):
    texts = ["good words in a row " * 5, "BAD!! BAD!! BAD!! " * 9]
    rows = [(i, texts[i % 2], "en" if i % 3 else "de", f"s{i}") for i in range(60)] + [(60, None, None, None), (None, "", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    machine = quality.fit(docs, labels)
    out = quality.score(docs, machine)
    assert out.columns == ["doc_id", "text", "lang", "source", "score", "predicted", "held_out"]
    by = {}
    for r in out.collect():
        by.setdefault(r["text"] or "", set()).add(r["score"])
    assert all(len(s) == 1 for s in by.values()) and len(by) == 3
    assert max(by[texts[1]]) < 0.3 < min(by[texts[0]])
    assert [r["held_out"] for r in out.where("doc_id is null").collect()] == [True]


def test_without_labels_or_rows(spark):
    schema = "doc_id long, text string, score string, predicted string"
    docs = spark.createDataFrame([(1, "a b", "old", "old"), (1, "a b", "old", "old")], schema)
    labels = spark.createDataFrame([(1, 1), (1, None), (1, 7), (None, 0)], "doc_id long, quality int")
    none = quality.fit(docs, labels.limit(0))
    assert [(r["score"], r["predicted"]) for r in quality.score(docs, none).collect()] == [(0.5, 1)] * 2
    one_kind = quality.fit(docs, labels)
    assert {r["predicted"] for r in quality.score(docs, one_kind).collect()} == {1}
    assert quality.score(docs.limit(0), none).collect() == []


def test_the_training_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, "a b")] * 50 + [(i, f"t {i}") for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int")
    assert quality.fit(docs, labels, rows=10) is not None
