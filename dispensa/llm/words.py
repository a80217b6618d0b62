"""Words of many texts at once, as NumPy arrays: where they lie, and a 64-bit hash of each.

A text is split by a table of the bytes that belong to words; a null text has no words. Hashes are
polynomials modulo 2**64 over random byte values, so that those of words, and of runs of words, come
from running sums with a constant number of array operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**64, 256, dtype=np.uint64, endpoint=False)
_CHUNK = 1 << 20

_byte = np.arange(256)
#: Bytes of words between ASCII white space.
NOT_SPACE = ~((_byte == 0x20) | ((_byte >= 9) & (_byte <= 13)))
#: Bytes of words of lower-cased text made of ASCII letters, digits and all beyond ASCII.
ALNUM = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
_LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte).astype(np.uint8)

_powers: dict[str, np.ndarray] = {"base": np.ones(1, U), "inverse": np.ones(1, U)}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the base or of its inverse."""
    if len(_powers[kind]) < n:
        factor = np.full(max(n, _CHUNK + 1), _BASE if kind == "base" else pow(_BASE, -1, 2**64), dtype=U)
        factor[0] = 1
        _powers[kind] = np.cumprod(factor)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values under which each output bit depends on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values, out=out[1:])
    return out


class Words:
    """The words of a list of texts: ``data[starts[i]:ends[i]]`` is word i, text t has words ``first[t]:first[t + 1]``."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray, inside: np.ndarray = NOT_SPACE, lower: bool = False):
        self.data, offsets = buffers(texts)
        if lower:
            self.data = _LOWER[self.data]
        part = inside[self.data]
        begin, end = part.copy(), part.copy()
        begin[1:] &= ~part[:-1]
        end[:-1] &= ~part[1:]
        filled = offsets[:-1] < offsets[1:]  # a word never runs from one text into the next
        heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
        begin[heads], end[tails] = part[heads], part[tails]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            out, i, n = np.empty(len(self.starts), dtype=U), 0, len(self.starts)
            while i < n:  # in pieces, so that the sums stay small beside the text
                lo = self.starts[i]
                j = max(i + 1, int(np.searchsorted(self.ends, lo + _CHUNK, "right")))
                size = int(self.ends[j - 1] - lo)
                sums = _sums(_VALUE[self.data[lo : lo + size]] * _power("base", size))
                a, b = self.starts[i:j] - lo, self.ends[i:j] - lo
                out[i:j] = (sums[b] - sums[a]) * _power("inverse", size)[a]
                i = j
            self._hashes = mix(out)
        return self._hashes

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A hash for the words a[i] up to b[i], equal for equal sequences."""
        n = len(self.starts)
        sums = _sums(self.hashes * _power("base", n))
        return mix((sums[b] - sums[a]) * _power("inverse", n + 1)[a])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first words of all windows of ``size`` words of one text, and the windows' hashes."""
        stops = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(len(self.starts)) + size <= stops)
        return at, self.spans(at, at + size)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
