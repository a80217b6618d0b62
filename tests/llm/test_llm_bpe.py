"""Byte-level BPE against the tiktoken library, and round trips."""

from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from dispensa.llm import bpe

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def raw(name):
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    text = raw(request.param)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, text.splitlines())}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.Vocabulary(text, public_tokenizers.PATTERN), library


def same(pair, texts):
    own, library = pair
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=5))
def test_any_text(pair, texts):
    same(pair, texts)


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(alphabet="abeilnorst' \n0123é漢", max_size=80), max_size=5))
def test_repetitive_text(pair, texts):
    same(pair, texts)


def test_runs_and_long_pieces(pair):
    rng = random.Random(1)
    same(pair, ["a" * 3000, " " * 500 + "x", "ab" * 999 + "a", "<|endoftext|>", "", "".join(rng.choice("aeth") for _ in range(4000))])


def test_words_of_documents(pair, spark, folder):
    same(pair, [r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])


def test_memory_is_bounded(monkeypatch, pair):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    same(pair, [" ".join(f"w{i}" for i in range(k, k + 60)) for k in range(0, 200, 20)])


def test_tables(spark):
    schema = "doc_id long, text string, ids int, `n tokens` string"
    rows = [(1, "Hello world", 1, "a"), (1, "Hello world", 1, "a"), (2, None, 2, None), (None, "", None, "b")]
    docs = spark.createDataFrame(rows, schema)
    codec = bpe.Codec(spark, public_tokenizers.path(FILES[0]), public_tokenizers.PATTERN)
    out = codec.decode(codec.encode(docs))
    assert out.columns == ["doc_id", "text", "n tokens", "n_tokens", "ids", "decoded"]
    got = sorted((r["doc_id"] or 0, r["n_tokens"], bytes(r["decoded"])) for r in out.collect())
    assert got == [(0, 0, b""), (1, 2, b"Hello world"), (1, 2, b"Hello world"), (2, 0, b"")]
    assert codec.encode(docs.limit(0)).collect() == []
    both = codec.encode(docs, decoded=True)
    assert both.columns == out.columns and sorted(map(str, both.collect())) == sorted(map(str, out.collect()))
