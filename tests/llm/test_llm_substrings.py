"""Removal of repeated word sequences against a dictionary of all windows."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from dispensa.llm import substrings


def brute(texts, size):
    split = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def made_texts(seed, n=40):
    """Texts of few words, with passages taken over, runs of one word, and copies."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(0, 90))) for _ in range(n)]
    for i in range(0, n, 3):
        source = texts[rng.randrange(n)].split(" ")
        a = rng.randrange(max(1, len(source)))
        texts[i] += "\t" + "\n".join(source[a : a + rng.randint(1, 60)])
    texts[3] = " ".join(["run"] * 70)
    texts[4] = "x " + " ".join(["run"] * 50) + " y"
    texts[5] = texts[6]
    return texts + ["", "  \n ", None, "une é漢 mot"]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("size", [4, 35])
def test_against_all_windows(spark, seed, size):
    texts = made_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs, size).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(brute(texts, size)):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["text"] or "") == want
        spans = got[i]["removed"]
        assert sum(b - a for a, b in spans) == want[1] and all(a < b for a, b in spans)
        assert (got[i]["text"] is None) == (texts[i] is None)


def test_equal_windows_are_named_alike_wherever_they_stand():
    """Names depend on the window only: they agree for equal windows in different surroundings."""
    rng = np.random.default_rng(3)
    words = [" ".join(map(str, rng.integers(0, 40, 200))) for _ in range(30)]
    passage = " ".join(map(str, rng.integers(0, 9, 60)))
    texts = pa.array([w[:k] + " " + passage + " " + w[k:] for k, w in enumerate(words)])
    found = substrings.Windows(texts, 35)
    names = {}
    for name, window in zip(found.names.tolist(), found.hashes.tolist()):
        assert names.setdefault(window, name) == name
    assert max(Counter(found.hashes.tolist()).values()) >= 30


def test_other_columns_repeated_rows_and_an_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(40))
    schema = "doc_id long, block string, text string, n_words string, others int, `odd name` int"
    rows = [(1, "b", text, "x", 5, 1), (1, "b", text, "x", 5, 1), (None, None, "short text", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    out = substrings.remove_repeats(docs)
    assert out.columns == ["doc_id", "block", "text", "others", "odd name", "n_words", "n_removed", "removed"]
    got = sorted((r["doc_id"] or 0, r["text"], r["n_words"], r["n_removed"], r["odd name"]) for r in out.collect())
    assert got == [(0, "short text", 2, 0, None), (1, "", 40, 40, 1), (1, "", 40, 40, 1)]
    assert substrings.remove_repeats(docs.limit(0)).collect() == []
    blank = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"], r["n_words"]) for r in substrings.remove_repeats(blank).collect()) == [
        (1, "", 0), (2, None, 0), (3, "", 0),
    ]
