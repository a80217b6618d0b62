"""Byte-level BPE by replaying merges over all distinct pieces of a stretch of the corpus at once.

Texts are cut into pieces by the vocabulary's pattern. The distinct pieces of a batch that the worker has not
seen lately are laid out as one row of tokens. An inverted index leads from the ranks of token pairs, in bands
of ``BAND`` ranks, to the positions where they stand. Bands are taken in rising order, and in a band each piece's
least rank, for all pieces at once (of overlapping pairs the left one), so every piece sees its merges in the
order of their ranks. Only the two pairs beside a merge are looked up anew and entered in the index. Merges
never cross pieces, so the result is that of encoding each piece alone, and no data has to be shuffled.

A vocabulary file has about a megabyte whatever the corpus, and travels in a broadcast. A worker keeps the
encodings of ``REMEMBERED`` pieces; when they are reached they become the older ones, and those asked again come back.

Defined results: a null text counts as empty; an empty text has no ids and decodes to no bytes; special tokens
are ordinary text; unknown ids raise. Input columns named like a result are replaced by it.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from dispensa.llm.batches import mapped

REMEMBERED = 100_000
BAND = 1024
_NONE = 1 << 30  # the rank of a pair that makes no token
_GAP, _GONE = 1 << 20, (1 << 20) + 1  # between pieces; taken into a token to the left


class Vocabulary:
    """Ranks of a file of lines "base64 rank", and the pairs of tokens that make a token."""

    def __init__(self, raw: bytes, pattern: str):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @functools.cached_property
    def pairs(self) -> np.ndarray:
        """All pairs of tokens that make a token, as left << 32 | right, in rising order, above their ranks."""
        found = [
            (a << 32 | b, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (a := self.ranks.get(token[:cut])) is not None and (b := self.ranks.get(token[cut:])) is not None
        ]
        return np.array(sorted(found), dtype=np.int64).T.copy()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of tokens."""
        pair, (keys, ranks) = left.astype(np.int64) << 32 | right, self.pairs
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        return np.where(keys[at] == pair, ranks[at], _NONE).astype(np.int32)

    def learn(self, pieces: list[str]) -> None:
        """Encode distinct pieces together by replaying the merges in the order of their ranks."""
        if not pieces:
            return
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        row = np.full(int(sizes.sum()) + len(raw) + 1, _GAP, dtype=np.int32)
        begins = 1 + np.cumsum(sizes + 1) - (sizes + 1)
        row[np.arange(sizes.sum()) + np.repeat(np.arange(1, len(raw) + 1), sizes)] = self.first[
            np.frombuffer(b"".join(raw), dtype=np.uint8)
        ]
        owner = np.repeat(np.arange(len(raw) + 1, dtype=np.int32), np.append(sizes + 1, 1))  # of the gap before a piece too
        after, before = np.arange(1, len(row) + 1, dtype=np.int32), np.arange(-1, len(row) - 1, dtype=np.int32)
        chosen = np.zeros(len(row), dtype=bool)
        rank = np.append(self._rank(row[:-1], row[1:]), np.int32(_NONE))
        index: list[list[np.ndarray]] = [[] for _ in range(int(self.pairs[1].max()) // BAND + 1)]

        def enter(places: np.ndarray) -> None:
            bands = rank[places] // BAND
            order = np.argsort(bands, kind="stable")
            cuts = np.flatnonzero(np.diff(bands[order])) + 1
            for part in np.split(places[order], cuts):
                index[rank[part[0]] // BAND].append(part)

        at = np.flatnonzero(rank < _NONE)
        if len(at):
            enter(at)
        for band, places in enumerate(index):
            while places:
                # A place may have been entered twice, or have got another pair since.
                at = np.sort(np.concatenate(places))
                places.clear()
                at = at[np.flatnonzero(np.diff(at, prepend=-1))]
                at = at[rank[at] < (band + 1) * BAND]
                if not len(at):
                    continue
                # Places of a piece lie side by side; its least rank is next. Of a run of equal pairs that overlap
                # the first goes now, the third in the next turn.
                heads = np.flatnonzero(np.diff(owner[at], prepend=-1))
                widths = np.diff(np.append(heads, len(at)))
                least = rank[at] == np.repeat(np.minimum.reduceat(rank[at], heads), widths)
                chosen[at[least]] = True
                least &= ~chosen[before[at]]
                chosen[at] = False
                now = at[least]
                if len(now) < len(at):
                    places.append(at[~least])
                right = after[now]
                beyond = after[right]
                row[now], row[right] = rank[now], _GONE
                after[now], before[beyond] = beyond, now
                rank[right] = _NONE
                rank[now] = self._rank(row[now], row[beyond])
                left = before[now]
                rank[left] = self._rank(row[left], row[now])
                touched = np.concatenate([now, left])
                touched = touched[rank[touched] < _NONE]
                early = rank[touched] < (band + 1) * BAND
                if early.any():
                    places.append(touched[early])
                if not early.all():
                    enter(touched[~early])
        kept = row < _GAP
        ids = row[kept].astype("<u4").tobytes()
        stops = 4 * np.concatenate([[0], np.cumsum(kept)])
        starts, ends = stops[begins].tolist(), stops[begins + sizes].tolist()
        for piece, a, b in zip(pieces, starts, ends):
            self.known[piece] = ids[a:b]

    def forget(self) -> None:
        self.known, self.older = {}, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pieces(text) for text in texts]
        distinct = set().union(*cut)
        new = [p for p in distinct if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.older, self.known = self.known, {}
            new = list(distinct)
        older = self.older
        self.known.update((p, older[p]) for p in new if p in older)
        self.learn([p for p in new if p not in older])
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def _vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(raw, pattern)


class Codec:
    """Encodes and decodes tables with one vocabulary file, read by the driver."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self._raw = spark.sparkContext.broadcast(f.read())
        self._pattern = pattern

    def encode(self, docs: DataFrame, text: str = "text", decoded: bool = False) -> DataFrame:
        """The documents with n_tokens and ids, the ids as little-endian unsigned 32-bit integers.

        With ``decoded`` also the bytes that the ids decode to, in the same pass.
        """
        shared, pattern = self._raw, self._pattern

        def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            vocabulary = _vocabulary(shared.value, pattern)
            ids = vocabulary.encode(pc.fill_null(batch.column(text), "").to_pylist())
            out = {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            return out | ({"decoded": pa.array(map(vocabulary.decode, ids), pa.binary())} if decoded else {})

        def done() -> None:
            _vocabulary(shared.value, pattern).forget()

        made = "n_tokens bigint, ids binary" + ", decoded binary" * decoded
        return mapped(docs, text, work, made, done=done)

    def decode(self, encoded: DataFrame, ids: str = "ids") -> DataFrame:
        """The table with decoded, the bytes that the ids stand for."""
        shared, pattern = self._raw, self._pattern

        def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            decode = _vocabulary(shared.value, pattern).decode
            return {"decoded": pa.array([decode(x or b"") for x in batch.column(ids).to_pylist()], pa.binary())}

        return mapped(encoded, ids, work, "decoded binary")
