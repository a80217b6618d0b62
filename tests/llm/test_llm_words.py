"""Word splitting and hashing against regular expressions."""

from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from dispensa.llm.words import ALNUM, Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \n\t\x0b\x85 .é!漢😀\x00", max_size=30)), max_size=6)


def found(words: Words) -> list[list[str]]:
    return [
        [words.word(i).decode() for i in range(words.first[t], words.first[t + 1])] for t in range(len(words.counts))
    ]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    column = pa.array(texts, pa.string())
    assert found(Words(column)) == [SPACED.findall(t or "") for t in texts]
    assert found(Words(column, ALNUM, lower=True)) == [PLAIN.findall((t or "").translate(LOWER)) for t in texts]


@settings(max_examples=80, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_window_hashes_are_equal_exactly_for_equal_sequences(texts, size):
    words = Words(pa.array(texts, pa.string()))
    split = [SPACED.findall(t or "") for t in texts]
    want = [tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1)]
    at, hashes = words.windows(size)
    assert len(at) == len(want)
    pairs = set(zip(want, hashes.tolist()))
    assert len(pairs) == len(set(want)) == len(set(hashes.tolist()))


def test_a_long_text_hashes_like_its_words_alone():
    word = "x" * 3_000_000
    texts = pa.array([f"a {word} b", word])
    words = Words(texts)
    assert words.hashes[1] == words.hashes[3]
    sliced = Words(pa.array(["zz", f"a {word} b", word]).slice(1))
    assert (sliced.hashes == words.hashes).all()
