"""The class-based language model: exact counts, a true distribution, and better than unigrams."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from dispensa.llm import language_model as lm

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER)) + [None]


def unigrams(docs):
    """Per document what the base model says."""
    split = [(i, tokens(t)) for i, t in docs]
    apart = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in split]
    count = Counter(w for (_, ws), a in zip(split, apart) if not a for w in ws)
    total = sum(count.values())
    out = []
    for (i, ws), a in zip(split, apart):
        score = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (len(count) + 1))) for w in ws)
        out.append((i, a, len(ws), sum(count[w] > 0 for w in ws), total, score))
    return out


def check(docs, rows):
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows), key=str)
    for g, w in zip(got, sorted(unigrams(docs), key=str), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def model_rows(spark, folder):
    from dispensa.sources.staging import Staging

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in docs.collect()], lm.score(docs, Staging(spark)).collect()


def test_counts_and_base(model_rows):
    check(*model_rows)


def test_better_than_unigrams_on_held_out_texts(model_rows):
    rows = [r for r in model_rows[1] if r["held_out"]]
    assert len(rows) > 20
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) + 0.1 * sum(r["n_tokens"] for r in rows)
    known = [r for r in model_rows[1] if r["n_known"] == r["n_tokens"]]
    assert sum(r["score"] for r in known) > sum(r["base_score"] for r in known)
    assert all(r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"])) for r in rows)


def test_probabilities_sum_to_one():
    """After any history the classes' chances sum to 1, and in a class those of its words."""
    rng = np.random.default_rng(0)
    k = lm.CLASSES + 2
    n_class, v_class = rng.integers(0, 50, k - 1).astype(float), rng.integers(0, 9, k - 1).astype(float)
    n_class = np.maximum(n_class, v_class)
    seen = rng.integers(0, 9, (k, k)).astype(float)
    chance = 10 ** lm.transition_logs(seen, n_class, v_class)
    assert chance.shape == (k, k) and np.allclose(chance.sum(axis=1), 1)
    words = np.array([5.0, 2.0, 1.0])
    assert np.sum((words + 0.5) / (words.sum() + 0.5 * 3)) == pytest.approx(1)


def test_odd_inputs(spark, staging):
    docs = [(1, "A a b"), (1, "A a b"), (2, None), (3, ""), (None, "a"), (8, " \t"), (13, "b q"), (40, "é é É")]
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, sequence string")
    check(docs, lm.score(table, staging).collect())
    assert lm.score(table.limit(0), staging).collect() == []
    apart = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 5 == 1)
    only = lm.score(spark.createDataFrame([(apart, "a b")], "doc_id long, text string"), staging).collect()
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in only] == [(0, 0, 0.0, pytest.approx(0.0))]


def test_neighbours_of_a_stream():
    import pyarrow as pa

    stream = lm._Stream(pa.array(["a b", None, "c"]))
    before, after = lm._neighbours(stream)
    t = stream.tokens
    assert stream.sizes.tolist() == [3, 1, 2] and (t[[2, 3, 5]] == lm._END).all()
    assert before.tolist() == [lm._END, t[0], t[1], lm._END, lm._END, t[4]]
    assert after.tolist() == [t[1], t[2], lm._END, lm._END, t[5], lm._END]
    assert np.array_equal(stream.sums(np.ones(6)), [3, 1, 2])
