"""How many tokens a piece vocabulary makes of each text, counting whole tokens without merging.

A vocabulary of pieces with scores (byte pair merges, spaces written as U+2581, one put before the text, bytes for
what no piece holds) merges the neighbours whose joint piece scores highest, the left ones first among equals. Offline,
once for a vocabulary, ``prove`` finds:

* where texts can be cut: no piece holds a space behind another character, so no merge crosses from a word to the
  space behind it; and none holds a line feed, which therefore always stands alone, as one byte. What lies between
  two cuts is a pre-token, merged as if it were alone. A cut that a vocabulary doesn't allow is not made.
* which pieces are whole tokens: a piece counts as proven where the merges, replayed over its own characters, end in
  that one piece. Where merges of higher scores lead away from it, it is not.

Then a pre-token that is a proven piece counts one, by one look into a table. Only the rest is merged: all new ones of
a batch together, each turn merging the best pair of every pre-token by array operations. A worker remembers the
counts of twice ``REMEMBERED`` such pre-tokens at most. Nothing is shuffled; the vocabulary's size doesn't depend on
the corpus, and it travels in a broadcast.

Defined results: a null text counts as empty, an empty text has no bytes and no tokens; strings of control pieces
inside texts are ordinary text; pre-tokens of any length are merged whole, long ones one by one in a time of n log n.
Repeated rows are counted each. Input columns named like a result are replaced by it; all others are kept.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame

from dispensa.llm.batches import mapped

REMEMBERED = 500_000
LIMIT = 4096
SPACE = "▁"
LONG = 64  # characters; longer pre-tokens are merged one by one
BATCH = 8 << 20
_NONE = 1 << 30  # the rank of a pair without a joint piece


@dataclass(frozen=True)
class Proven:
    """A vocabulary with what is proven about it."""

    scores: dict[str, float]
    whole: frozenset[str]
    cut_words: bool
    cut_lines: bool


def read_pieces(path: str) -> dict[str, float]:
    """The scores of a model file's pieces, without those for bytes, control and unknown text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces that the merges leave of one text; characters without a piece stay alone."""
    parts = list(text)
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[float, int, int, str]] = []

    def enter(i: int, j: int) -> None:
        if 0 <= i and j < n:
            joint = parts[i] + parts[j]
            if (score := scores.get(joint)) is not None:
                heapq.heappush(heap, (-score, i, j, joint))

    for i in range(n - 1):
        enter(i, i + 1)
    while heap:
        _, i, j, joint = heapq.heappop(heap)
        if parts[i] and parts[j] and after[i] == j and parts[i] + parts[j] == joint:
            parts[i], parts[j] = joint, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            enter(before[i], i)
            enter(i, after[i])
    return [p for p in parts if p]


class Merges:
    """Counts what the merges leave of many texts at once."""

    def __init__(self, scores: dict[str, float]):
        self._scores = scores
        letters = sorted({c for p in scores for c in p})
        number = {s: i for i, s in enumerate(dict.fromkeys([*letters, *scores]))}
        self._letter = np.full(0x110000, -1, dtype=np.int32)  # by code point
        for c in letters:
            self._letter[ord(c)] = number[c]
        self._bytes = np.ones(len(number), dtype=np.int64)  # tokens of a symbol; bytes of a letter that is no piece
        for c in letters:
            if c not in scores:
                self._bytes[number[c]] = len(c.encode())
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = sorted(
            (number[p[:cut]] << 32 | number[p[cut:]], order[score], number[p])
            for p, score in scores.items()
            for cut in range(1, len(p))
            if p[:cut] in number and p[cut:] in number
        )
        # One more, that nothing meets, for symbols that make no piece with the next.
        keys, ranks, joint = np.array([*pairs, (1 << 62, _NONE, -1)], dtype=np.int64).T.copy()
        self._keys, self._ranks, self._joint = keys, ranks, joint.astype(np.int32)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair of symbols in the table of pairs, or the last one."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._keys, key)
        none = len(self._keys) - 1
        return np.where((self._keys[np.minimum(at, none)] == key) & (left >= 0) & (right >= 0), at, none)

    def counts(self, texts: Sequence[str]) -> list[int]:
        out = np.zeros(len(texts), dtype=np.int64)
        short = [i for i, t in enumerate(texts) if 0 < len(t) <= LONG]
        for i, t in enumerate(texts):
            if len(t) > LONG:
                out[i] = sum(1 if p in self._scores else len(p.encode()) for p in merged(t, self._scores))
        if short:
            out[short] = self._together([texts[i] for i in short])
        return out.tolist()

    def _together(self, texts: list[str]) -> np.ndarray:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        symbols, text = self._letter[points], np.arange(len(texts))
        unknown = symbols < 0
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        own = np.where(unknown, width, self._bytes[symbols])  # tokens of each symbol as long as it is not merged
        none = len(self._keys) - 1
        starts = np.cumsum(sizes) - sizes
        pair = np.full(len(symbols), none)
        inner = np.ones(len(symbols), dtype=bool)
        inner[starts + sizes - 1] = False
        at = np.flatnonzero(inner)
        pair[at] = self._pairs(symbols[at], symbols[at + 1])
        found = np.zeros(len(texts), dtype=np.int64)
        while len(text):
            best = np.minimum.reduceat(self._ranks[pair] << 32 | np.arange(len(pair)), starts)
            ended = best >= _NONE << 32
            if ended.any():
                found[text[ended]] = np.add.reduceat(own, starts)[ended]
            now = (best & 0xFFFFFFFF)[~ended]
            kept = np.repeat(~ended, sizes)
            kept[now + 1] = False
            symbols[now], own[now] = self._joint[pair[now]], 1
            last = np.zeros(len(symbols), dtype=bool)
            last[starts + sizes - 1] = True
            # The merged symbol is last if its right half was; then come the pairs that it makes with its neighbours.
            last[now] = last[now + 1]
            place = np.cumsum(kept) - 1
            symbols, own, pair, last = symbols[kept], own[kept], pair[kept], last[kept]
            text, sizes = text[~ended], sizes[~ended] - 1
            starts = np.cumsum(sizes) - sizes
            now = place[now]
            pair[now] = none
            right = now[~last[now]]
            pair[right] = self._pairs(symbols[right], symbols[right + 1])
            left = now[now > starts] - 1
            pair[left] = self._pairs(symbols[left], symbols[left + 1])
        return found


def prove(scores: dict[str, float]) -> Proven:
    """Replay the merges over every piece, and look for pieces that forbid a cut."""
    pieces = list(scores)
    counts = Merges(scores).counts(pieces)
    return Proven(
        scores=scores,
        whole=frozenset(p for p, n in zip(pieces, counts) if n == 1),  # one token of all its characters is the piece
        cut_words=not any(SPACE in p.lstrip(SPACE) for p in scores),
        cut_lines=not any("\n" in p for p in scores),
    )


class _Known(dict):
    """Tokens of pre-tokens behind ``head``: the proven pieces, and what was merged lately.

    When ``REMEMBERED`` others are reached they become the older generation; what is asked again comes back from there.
    """

    def __init__(self, proven: Proven, head: str):
        self.head = head
        self._whole = {p.removeprefix(head).replace(SPACE, " "): 1 for p in proven.whole if p.startswith(head)}
        self._older: dict[str, int] = {}
        super().__init__(self._whole)

    def missing(self, words: set[str]) -> list[str]:
        """The words to merge. All others of them can be looked up afterwards."""
        new = [w for w in words if w not in self]
        if len(self) + len(new) > len(self._whole) + REMEMBERED:
            self._older = dict(self)
            self.clear()
            self.update(self._whole)
            new = [w for w in words if w not in self]
        older = self._older
        if older:
            self.update((w, older[w]) for w in new if w in older)
            new = [w for w in new if w not in older]
        return new


class Counter:
    def __init__(self, proven: Proven):
        self._proven = proven
        self._merges = Merges(proven.scores)
        self._spaced = _Known(proven, SPACE)  # words behind one space, which is left out
        self._plain = _Known(proven, "")  # anything else
        self._parts = re.compile(" *[^ ]+| +").findall

    def _cut(self, text: str) -> tuple[list[str], list[str], int]:
        """The pre-tokens behind a space, the others, and the line feeds of a text."""
        if not text:
            return [], [], 0
        text = " " + text.replace(SPACE, " ")
        if not self._proven.cut_words:
            return [], [text], 0
        lines = text.split("\n") if self._proven.cut_lines else [text]
        spaced: list[str] = []
        plain: list[str] = []
        for line in lines:
            words = line.split(" ")
            if "" not in words:
                plain.append(words[0])
                spaced += words[1:]
            elif "" in words[1:]:  # runs of spaces, or a space at the end
                plain += self._parts(line)
            else:
                spaced += words[1:]
        return spaced, plain, len(lines) - 1

    def counts(self, texts: Sequence[str]) -> list[int]:
        """The numbers of tokens of texts."""
        cut = [self._cut(t) for t in texts]
        new = [
            (known, known.missing(set().union(*[c[k] for c in cut])))
            for k, known in enumerate((self._spaced, self._plain))
        ]
        found = iter(self._merges.counts([known.head + w.replace(" ", SPACE) for known, words in new for w in words]))
        for known, words in new:
            known.update(zip(words, found))
        spaced, plain = self._spaced.__getitem__, self._plain.__getitem__
        return [sum(map(spaced, a)) + sum(map(plain, b)) + n for a, b, n in cut]


@functools.lru_cache(maxsize=1)
def _counter(shared: Broadcast) -> Counter:
    """A worker's counter; a broadcast that is unpickled again is the same object."""
    return Counter(shared.value)


def count_tokens(docs: DataFrame, proven: Proven, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The documents with n_bytes (of UTF-8), n_tokens, and over_limit: more than ``limit`` tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(proven)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = pc.fill_null(batch.column(text), "")
        tokens = pa.array(_counter(shared).counts(texts.to_pylist()), pa.int64())
        sizes = pc.cast(pc.binary_length(texts), pa.int64())
        return {"n_bytes": sizes, "n_tokens": tokens, "over_limit": pc.greater(tokens, limit)}

    return mapped(docs, text, work, "n_bytes bigint, n_tokens bigint, over_limit boolean", limit=BATCH)
