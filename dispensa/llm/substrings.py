"""Removal of long word sequences that occur more than once in the corpus, by recompression.

Rounds rename each document's words: a maximal run of one symbol becomes one symbol, then neighbours whose
names fall on the left and the right side of a split of all names become one symbol for the pair. A name is
a hash of what it stands for, so it is the same in every document without a dictionary. What a symbol is
depends on a bounded context of words, which is kept with it: two equal windows hold the same symbols
wherever the context lies inside them.

Each window of ``size`` words is represented by one of its symbols of the highest level that has any, the
one with the least hash. First all documents ask (``packed``) which of those symbols, with their context,
occur anywhere else; windows whose symbol does not are unique. The others are verified by a hash of all
their words. A repeat of any length is found, since each of its windows is.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. Defined results: a null text stays null and has no words; an
empty or blank text becomes empty; fewer words than a window are kept; repeated rows count as
occurrences of each other, whatever their identifiers; an empty table gives no rows; the results replace
input columns of their names.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from dispensa.llm import packed
from dispensa.llm.words import U, Words, buffers, mix

BLOCK_BYTES = 4 << 20  # of text; a block is held whole, with several arrays of its words
ROUNDS = 3
WINDOW = 35
_INDEX = U((1 << 32) - 1)


class _Level:
    """Symbols in a row: their names, the texts they lie in, and the words [lo, hi) that decide them."""

    def __init__(self, names: np.ndarray, owner: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.names, self.owner, self.lo, self.hi = names, owner, lo, hi

    def _neighbours(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The contexts of the symbols before and after; a text's edge lies outside of all windows."""
        same = self.owner[1:] == self.owner[:-1]
        before, after = first[self.owner] - 1, first[self.owner + 1] + 1
        before[1:][same] = self.lo[:-1][same]
        after[:-1][same] = self.hi[1:][same]
        return before, after

    def runs(self, first: np.ndarray) -> _Level:
        if not len(self.names):
            return self
        before, after = self._neighbours(first)
        starts = np.ones(len(self.names), dtype=bool)
        starts[1:] = (self.names[1:] != self.names[:-1]) | (self.owner[1:] != self.owner[:-1])
        at = np.flatnonzero(starts)
        stop = np.append(at[1:], len(self.names))
        names = self.names[at].copy()
        long = stop - at > 1
        names[long] = mix(names[long] + mix((stop - at)[long].astype(U)))
        return _Level(names, self.owner[at], before[at], after[stop - 1])

    def pairs(self, first: np.ndarray, turn: int) -> _Level:
        before, after = self._neighbours(first)
        right = (mix(self.names + U(turn * 2 + 1)) & U(1)).astype(bool)
        joins = np.zeros(len(self.names), dtype=bool)
        joins[:-1] = ~right[:-1] & right[1:] & (self.owner[1:] == self.owner[:-1])
        second = np.zeros(len(self.names), dtype=bool)
        second[1:] = joins[:-1]
        at = np.flatnonzero(~second)
        both = at[joins[at]]
        names, lo, hi = self.names.copy(), self.lo.copy(), self.hi.copy()
        alone = ~joins & ~second
        lo[alone & right], hi[alone & ~right] = before[alone & right], after[alone & ~right]
        names[both] = mix(self.names[both] * U(3) + mix(self.names[both + 1] + U(turn + 1)))
        hi[both] = self.hi[both + 1]
        return _Level(names[at], self.owner[at], lo[at], hi[at])


def _levels(words: Words, rounds: int) -> list[_Level]:
    at = np.arange(len(words.starts))
    levels = [_Level(words.hashes, words.owner(), at, at + 1)]
    for turn in range(rounds):
        levels.append(levels[-1].runs(words.first).pairs(words.first, turn))
    return levels


def _least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The least value of each range [lo, hi), none of them empty."""
    out, width, span = np.empty(len(lo), dtype=U), hi - lo, 1
    table = values
    while len(lo):
        here = (width >= span) & (width < 2 * span)
        out[here] = np.minimum(table[lo[here]], table[hi[here] - span])
        span *= 2
        if span > width.max():
            break
        table = np.minimum(table[: len(table) - span // 2], table[span // 2 :])
    return out


class Windows:
    """The windows of some texts and the names of the symbols that represent them."""

    def __init__(self, texts: pa.ChunkedArray, size: int, rounds: int = ROUNDS):
        self.words, self.size = Words(texts), size
        self.at, self.hashes = self.words.windows(size)
        left = np.arange(len(self.at))
        occurrence = np.zeros(len(self.at), dtype=U)  # level and place of the symbol
        self.names = np.zeros(len(self.at), dtype=U)
        for k, level in reversed(list(enumerate(_levels(self.words, rounds)))):
            lo = np.searchsorted(level.lo, self.at[left], "left")
            hi = np.searchsorted(level.hi, self.at[left] + size, "right")
            has = lo < hi
            rank = (mix(level.names) & ~_INDEX) | np.arange(len(level.names), dtype=U)
            best = (_least(rank, lo[has], hi[has]) & _INDEX).astype(np.int64)
            found = left[has]
            self.names[found] = self.words.spans(level.lo[best], level.hi[best]) + U(k)
            occurrence[found] = best.astype(U) + (U(k) << U(40))
            left = left[~has]
        _, first = np.unique(occurrence, return_index=True)
        self.symbols, self._counts = np.unique(self.names[first], return_counts=True)

    def ask_symbols(self) -> tuple[np.ndarray, np.ndarray]:
        return self.symbols, self._counts

    def suspects(self, totals: np.ndarray) -> np.ndarray:
        """The windows whose symbols occur more than once."""
        return np.flatnonzero((totals > 1)[np.searchsorted(self.symbols, self.names)])

    def covered(self, windows: np.ndarray) -> np.ndarray:
        """The words that these windows cover."""
        change = np.zeros(len(self.words.starts) + 1, dtype=np.int32)
        np.add.at(change, self.at[windows], 1)
        np.add.at(change, self.at[windows] + self.size, -1)
        return np.cumsum(change)[:-1] > 0


def remove_repeats(docs: DataFrame, size: int = WINDOW, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents without the words of any window that occurs elsewhere, the rest joined by one space.

    Adds n_words, n_removed and ``removed``, the runs of removed words as [first, after the last].
    """
    blocks, parts = packed.blocked(docs, key, text, carried=True, block_bytes=BLOCK_BYTES), packed.parts_of(docs)

    def ask(block: int, rows: pa.Table) -> pa.Table:
        symbols, counts = Windows(rows["text"], size).ask_symbols()
        return packed.question(block, 0, symbols, counts, parts)

    def confirm(block: int, rows: pa.Table, told: pa.Table) -> pa.Table:
        found = Windows(rows["text"], size)
        suspects = found.suspects(packed.answers(told, 0, found.symbols, parts))
        hashes, counts = np.unique(found.hashes[suspects], return_counts=True)
        return packed.question(block, 1, hashes, counts, parts)

    def remove(block: int, rows: pa.Table, told: pa.Table) -> pa.Table:
        found = Windows(rows["text"], size)
        suspects = found.suspects(packed.answers(told, 0, found.symbols, parts))
        asked, place = np.unique(found.hashes[suspects], return_inverse=True)
        totals = packed.answers(told, 1, asked, parts)
        covered = found.covered(suspects[totals[place] > 1])
        words = found.words
        removed = np.concatenate([np.zeros(1, np.int64), np.cumsum(covered)])[words.first]
        kept, spans = _kept(rows["text"], words, covered)
        columns = {c: rows[c] for c in rows.column_names if c not in ("block", "text")}
        return pa.table(
            columns
            | {"text": kept, "n_words": pa.array(words.counts), "n_removed": pa.array(np.diff(removed)), "removed": spans}
        )

    symbols = packed.tallied(packed.each_block(blocks, ask, packed.ASKED), most=2)
    windows = packed.tallied(packed.with_answers(blocks, symbols, confirm, packed.ASKED), most=2)
    schema = StructType([f for f in blocks.schema.fields if f.name not in ("block", "text")] + [blocks.schema["text"]])
    for name in ("n_words", "n_removed"):
        schema = schema.add(name, LongType())
    schema = schema.add(StructField("removed", ArrayType(ArrayType(LongType()))))
    out = packed.with_answers(blocks, symbols.unionByName(windows), remove, schema)
    return packed.restored(out, docs, text, ["n_words", "n_removed", "removed"])


def _kept(texts: pa.ChunkedArray, words: Words, covered: np.ndarray) -> tuple[pa.Array, pa.Array]:
    data, offsets = buffers(texts)
    null = pc.is_null(texts).to_numpy()
    kept, spans = [], []
    for t in range(len(words.counts)):
        a, b = words.first[t], words.first[t + 1]
        # The classes of bytes.split and of the words are the same.
        parts = data[offsets[t] : offsets[t + 1]].tobytes().split()
        gone = covered[a:b]
        if gone.any():
            parts = list(compress(parts, ~gone))
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
            spans.append(edges.reshape(-1, 2).tolist())
        else:
            spans.append([])
        kept.append(None if null[t] else b" ".join(parts).decode())
    return pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int64())))

