"""Token counts against the sentencepiece library, and what is proven offline against replayed merges."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from dispensa.llm import token_counts as tc
from dispensa.llm.queries import PIECES, QUERIES

PATH = public_tokenizers.path(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def proven():
    return tc.prove(tc.read_pieces(PATH))


@pytest.fixture(scope="module")
def counter(proven):
    return tc.Counter(proven)


def same(counter, library, texts):
    assert counter.counts(texts) == [len(ids) for ids in library.encode(texts)]


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text(counter, library, texts):
    same(counter, library, texts)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet="abeilnorst' \n\t0123é漢▁.<s>", max_size=80), min_size=1, max_size=5))
def test_repetitive_text(counter, library, texts):
    same(counter, library, texts)


def test_edges_and_long_pre_tokens(counter, library):
    rng = random.Random(1)
    long = "".join(rng.choice("aeth") for _ in range(5000))
    texts = ["", " ", "  ", "\n", "\n\n a", " a", "a ", "▁", "a▁b", "a" * 3000, " " * 500 + "x", "x" + " " * 77, "\x00", "<s></s>"]
    same(counter, library, [*texts, long, "😀" * 100, "the " * 50, "a" * 64, "a" * 65])


def test_whole_tokens_are_proven(proven, library):
    rng = random.Random(2)
    for piece in rng.sample(sorted(proven.scores), 500):
        assert (piece in proven.whole) == (tc.merged(piece, proven.scores) == [piece])


def test_a_piece_that_merges_lead_away_from():
    # "bc" goes first, and neither "abc" nor "bcd" is a piece, so "abcd" is never made of its own letters.
    scores = {"a": -9.0, "b": -9.0, "c": -9.0, "d": -9.0, "bc": -0.1, "ab": -1.0, "cd": -1.0, "abcd": -2.0}
    assert tc.merged("abcd", scores) == ["a", "bc", "d"]
    found = tc.prove(scores)
    assert found.whole == set(scores) - {"abcd"}
    assert tc.Merges(scores).counts(["abcd", "abd", "aé"]) == [3, 2, 3]


def test_cuts_that_a_vocabulary_forbids():
    scores = {"a": -9.0, tc.SPACE: -9.0, "\n": -9.0, "a" + tc.SPACE: -1.0, "a\na": -3.0, "a\n": -2.0}
    found = tc.prove(scores)
    assert not found.cut_words and not found.cut_lines
    counts = tc.Counter(found).counts(["a a", "a\na", ""])
    assert counts == [len(tc.merged("▁a▁a", scores)), len(tc.merged("▁a\na", scores)), 0]


def test_memory_is_bounded(monkeypatch, proven, library):
    monkeypatch.setattr(tc, "REMEMBERED", 50)
    counter = tc.Counter(proven)
    for k in range(0, 200, 20):
        same(counter, library, [" ".join(f"w{i}q" for i in range(k, k + 60))])
    assert len(counter._spaced) <= len(counter._spaced._whole) + 200


def test_tables(spark, proven, library):
    schema = "doc_id long, text string, n_tokens string, `a b` int"
    rows = [(1, "Hello world", "x", 1), (1, "Hello world", "x", 1), (2, None, None, None), (None, "", "y", 2), (3, "é" * 9000, "", 3)]
    docs = spark.createDataFrame(rows, schema)
    out = tc.count_tokens(docs, proven, limit=5)
    assert out.columns == ["doc_id", "text", "a b", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect())
    n = len(library.encode("é" * 9000))
    assert got == [(0, 0, 0, False), (1, 11, 2, False), (1, 11, 2, False), (2, 0, 0, False), (3, 18000, n, True)]
    assert tc.count_tokens(docs.limit(0), proven).collect() == []


def test_query(spark, folder, library):
    out = QUERIES["op11_token_counts"].run(spark, folder)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = []
    for r in docs:
        text = r["text"] or ""
        n = len(library.encode(text))
        want.append((r["doc_id"], len(text.encode()), n, n > 4096))
    assert sorted(map(tuple, out.collect())) == sorted(want)
