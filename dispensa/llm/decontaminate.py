"""Benchmark passages in documents, found with a generalised suffix automaton of the benchmark's items.

The automaton holds every sequence of words that any item has. Document words stream through it; the longest
match that ends at each word tells whether a window of an item ends there, and which items hold it. Only
stretches of words whose every neighbouring pair occurs in an item can hold a window, so only those are
streamed; they are found with array operations on hashes, and their words are compared as bytes.

Items are dealt into automata of a bounded number of words. Each goes to the executors in a broadcast of
that size, and documents pass them one after the other, so a benchmark of any size is searched whole.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; a window is ``size``
consecutive words of an item, or all of a shorter one. Defined results: null, empty and blank texts have no
words and no hits; an item without words has no window; repeated items or windows count once for their
identifier; an item without identifier marks words but is not named; without items nothing is hit. Input
columns named like a result are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispensa.llm.batches import mapped
from dispensa.llm.ship import shipped
from dispensa.llm.words import ALNUM, U, Words, buffers, mix

WINDOW = 10
WORDS_PER_AUTOMATON = 50_000
RESULTS = "n_words bigint, n_hit bigint, items array<string>, hits array<struct<first:int,last:int>>"


def _pairs(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes[:-1] * U(3) + hashes[1:])


class Automaton:
    """Generalised suffix automaton over the word sequences of items [(identifier, text)]."""

    def __init__(self, items: list[tuple[str | None, str]], size: int = WINDOW):
        self.size = size
        words = Words(pa.array([text for _, text in items], pa.string()), ALNUM, lower=True)
        owner = words.owner()
        self.ids: dict[bytes, int] = {}
        sequences: list[list[int]] = [[] for _ in items]
        for i in range(len(owner)):
            sequences[owner[i]].append(self.ids.setdefault(words.word(i), len(self.ids)))
        self.length, self.link, self.next = [0], [-1], [{}]
        for s in sequences:
            last = 0
            for c in s:
                last = self._extend(last, c)
        self._own(items, sequences)
        lengths = [len(s) for s in sequences if s]
        #: With one-word windows single words are looked up, else pairs of neighbours.
        self.shortest = min([size, *lengths])
        self.single = self.shortest == 1
        same = owner[1:] == owner[:-1]
        self.known = np.unique(words.hashes if self.single else _pairs(words.hashes)[same])

    def _state(self, length: int, link: int, to: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(to)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for the match of p and c, apart from the longer ones of q."""
        if self.length[p] + 1 == self.length[q]:
            return q
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c, self.next[last][c])
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c, self.next[p][c])
        return new

    def _own(self, items: list[tuple[str | None, str]], sequences: list[list[int]]) -> None:
        """Names at each state the items whose windows end with it."""
        n = len(self.length)
        self.owners: list[set[str | None]] = [set() for _ in range(n)]
        self.short: list[list[tuple[int, str | None]]] = [[] for _ in range(n)]
        seen = [-1] * n
        for k, ((name, _), s) in enumerate(zip(items, sequences)):
            v = 0
            for c in s:
                v = u = self.next[v][c]
                while u > 0 and seen[u] != k and self.length[u] >= self.size:
                    seen[u] = k
                    self.owners[u].add(name)
                    u = self.link[u]
            if 0 < len(s) < self.size:
                # The state reached holds all of s and longer sequences that end with it.
                while self.length[self.link[v]] >= len(s):
                    v = self.link[v]
                self.short[v].append((len(s), name))
        #: For each state the one of its suffixes that holds sequences of exactly ``size`` words.
        self.whole = [-1] * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            up = self.link[v]
            if self.length[v] >= self.size:
                self.whole[v] = self.whole[up] if self.length[up] >= self.size else v
            if self.short[up]:
                self.short[v] = self.short[v] + self.short[up]

    def stream(self, words: list[bytes]) -> Iterator[tuple[int, int, set[str | None]]]:
        """(last word, number of words, items) of the windows that occur in a stretch of words."""
        v = matched = 0
        for i, word in enumerate(words):
            c = self.ids.get(word, -1)
            while v and c not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            if c not in self.next[v]:
                continue
            v = self.next[v][c]
            matched += 1
            if matched >= self.size:
                yield i, self.size, self.owners[self.whole[v]]
            for n, name in self.short[v]:
                if n <= matched:
                    yield i, n, {name}

    def search(self, words: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """The hit words of some texts, and the names of the items found in each text."""
        hit = np.zeros(len(words.starts), dtype=bool)
        found: dict[int, set[str]] = {}
        if not len(self.known) or not len(hit):
            return hit, found
        owner = words.owner()
        probes = words.hashes if self.single else _pairs(words.hashes)
        at = np.minimum(np.searchsorted(self.known, probes), len(self.known) - 1)
        likely = self.known[at] == probes
        if not self.single:
            likely &= owner[1:] == owner[:-1]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], likely.view(np.int8), [0]]))).reshape(-1, 2)
        for a, b in edges[edges[:, 1] - edges[:, 0] >= self.shortest - (not self.single)]:
            stop = b if self.single else b + 1
            starts = [a, *(a + 1 + np.flatnonzero(np.diff(owner[a:stop])))]
            for lo, hi in zip(starts, [*starts[1:], stop]):
                for i, n, items in self.stream([words.word(j) for j in range(lo, hi)]):
                    hit[lo + i + 1 - n : lo + i + 1] = True
                    found.setdefault(int(owner[lo]), set()).update(x for x in items if x is not None)
        return hit, found


def _automata(items: DataFrame, size: int, key: str, text: str, most: int) -> Iterator[Automaton]:
    """Automata of about ``most`` words each, that hold all items together."""
    items = items.select(F.col(key).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Words are at least one byte and one byte apart.
    size_bound = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] // 2
    shards = max(1, math.ceil(size_bound / 3 / most))
    for k in range(shards):
        here = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k)
        yield Automaton(sorted({(r["item"], r["text"]) for r in here.collect()}, key=str), size)


def mark(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    words_per_automaton: int = WORDS_PER_AUTOMATON,
) -> DataFrame:
    """The documents with n_words, n_hit, the sorted names of the items found and the byte ranges of hit words."""
    spark = docs.sparkSession
    shipped(spark)
    shared = [
        spark.sparkContext.broadcast(a) for a in _automata(items, size, item_key, item_text, words_per_automaton)
    ]

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        words = Words(batch.column(text), ALNUM, lower=True)
        hit, found = np.zeros(len(words.starts), dtype=bool), {}
        for automaton in shared:
            more, names = automaton.value.search(words)
            hit |= more
            for t, x in names.items():
                found[t] = found.get(t, set()) | x
        total = np.concatenate([[0], np.cumsum(hit)])[words.first]
        return {
            "n_words": pa.array(words.counts.astype(np.int64)),
            "n_hit": pa.array(np.diff(total).astype(np.int64)),
            "items": pa.array([sorted(found.get(t, ())) for t in range(batch.num_rows)], pa.list_(pa.string())),
            "hits": _ranges(words, hit, batch.column(text)),
        }

    return mapped(docs, text, work, RESULTS)


def _ranges(words: Words, hit: np.ndarray, texts: pa.Array) -> pa.Array:
    """The byte ranges [first, last) in each text that runs of hit words cover."""
    _, offsets = buffers(texts)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
    out: list[list[dict[str, int]]] = []
    for t in range(len(words.counts)):
        a, b = words.first[t], words.first[t + 1]
        here = hit[a:b]
        if not here.any():
            out.append([])
            continue
        runs = np.flatnonzero(np.diff(np.concatenate([[0], here.view(np.int8), [0]]))).reshape(-1, 2)
        out.append(
            [
                {"first": int(words.starts[a + x] - offsets[t]), "last": int(words.ends[a + y - 1] - offsets[t])}
                for x, y in runs
            ]
        )
    return pa.array(out, kind)


def remove_hits(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, coverage: float = 0.5, text: str = "text", **names: str
) -> DataFrame:
    """The documents with the marked spans cut out of the text; a text of which they cover more than ``coverage``
    of the words becomes empty. Adds the columns of ``mark``."""
    found = mark(docs, items, size, text, **names)
    raw = F.col(text).cast("binary")
    # The stretches between the marked ranges, as bytes: hits lie at borders of words, so characters stay whole.
    ends = F.concat(F.array(F.lit(0)), F.col("hits.last"))
    starts = F.concat(F.col("hits.first"), F.array(F.octet_length(text)))
    rest = F.zip_with(ends, starts, lambda a, b: F.substring(raw, a + 1, b - a))
    joined = F.decode(F.aggregate(rest, F.lit(b""), lambda s, x: F.concat(s, x)), "utf-8")
    mostly = F.col("n_hit") > coverage * F.col("n_words")
    return found.withColumn(text, F.when(F.size("hits") == 0, F.col(text)).when(mostly, F.lit("")).otherwise(joined))
