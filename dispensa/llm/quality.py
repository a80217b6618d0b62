"""Document quality by a factorisation machine.

A text becomes sparse features: counts of its words hashed into ``BUCKETS`` places, and statistics of its
structure (lengths, shares of kinds of characters, repeated words and lines). The score is
w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2) through a logistic function: every pair of
features interacts at a cost linear in their number.

The machine is fitted on at most ``TRAINING_ROWS`` labelled documents, those with the least hashes, whose
features (a few kilobytes each) are gathered; every document is scored, whole. Labels, language, source and
identifier are never features. Rows held out are those whose identifier's CRC is divisible by ``FOLDS``.

Defined results: a null text counts as empty; an empty text gets a score too; rows that share an identifier
are scored each by its own text; a null identifier counts as held out; labels other than 0 and 1 are ignored;
without labels of both kinds every score is the share of good labels (1/2 if there are none). Input columns
named like a result are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.llm.batches import mapped
from dispensa.llm.words import U, Words, buffers

BUCKETS = 1 << 12
FACTORS = 4
TRAINING_ROWS = 8000
FOLDS = 5
THRESHOLD = 0.3
_NOT_NEWLINE = np.arange(256) != 10
_byte = np.arange(256)
_KINDS = (
    (_byte >= 0x41) & (_byte <= 0x5A),  # capitals
    (_byte >= 0x61) & (_byte <= 0x7A),  # small letters
    (_byte >= 0x30) & (_byte <= 0x39),  # digits
    _byte >= 0x80,
    np.isin(_byte, np.frombuffer(b".,;:'\"?-", dtype=np.uint8)),
    np.isin(_byte, np.frombuffer(b"!#$%&*+/<=>@[\\]^_`{|}~()", dtype=np.uint8)),
    _byte == 10,
)
_STATISTICS = len(_KINDS) + 7


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == 0, F.lit(True))


@dataclass
class Features:
    """Sparse rows: value ``x`` of feature ``place`` in document ``owner``."""

    owner: np.ndarray
    place: np.ndarray
    x: np.ndarray
    rows: int


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(texts: pa.Array) -> tuple[Features, np.ndarray]:
    """Hashed words, each document's counts scaled to length 1, and the statistics of its structure."""
    words, lines = Words(texts), Words(texts, _NOT_NEWLINE)
    data, offsets = buffers(texts)
    n, size = words.counts, np.diff(offsets)
    owner = words.owner()
    key, counts = np.unique((owner.astype(U) << U(32)) | (words.hashes & U(BUCKETS - 1)), return_counts=True)
    doc, place = (key >> U(32)).astype(np.int64), (key & U(BUCKETS - 1)).astype(np.int64)
    norm = np.sqrt(np.bincount(doc, weights=counts.astype(float) ** 2, minlength=len(n)))
    sparse = Features(doc, place, counts / norm[doc], len(n))

    def within(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[cuts])

    again = np.zeros(len(owner), dtype=bool)
    again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (owner[1:] == owner[:-1])
    line = np.unique(lines.owner().astype(U) << U(40) | (lines.hashes >> U(24)))
    distinct_lines = np.bincount((line >> U(40)).astype(np.int64), minlength=len(n))
    length = (words.ends - words.starts).astype(float)
    columns = [_share(within(kind[data], offsets), size) for kind in _KINDS]
    columns += [
        np.log1p(n),
        _share(np.bincount(owner, weights=length, minlength=len(n)), n),
        np.sqrt(np.maximum(0, _share(np.bincount(owner, weights=length**2, minlength=len(n)), n)
                - _share(np.bincount(owner, weights=length, minlength=len(n)), n) ** 2)),
        _share(np.bincount(doc, minlength=len(n)), n),
        _share(within(again, words.first), n),
        _share(distinct_lines, lines.counts),
        np.log1p(_share(size, np.maximum(1, lines.counts))),
    ]
    return sparse, np.column_stack(columns)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def design(self, sparse: Features, statistics: np.ndarray) -> Features:
        """All features in one sparse table; statistics are standardised and bounded."""
        z = np.clip((statistics - self.mean) / self.scale, -4, 4) / 2
        rows, k = z.shape
        return Features(
            np.concatenate([sparse.owner, np.repeat(np.arange(rows), k)]),
            np.concatenate([sparse.place, np.tile(BUCKETS + np.arange(k), rows)]),
            np.concatenate([sparse.x, z.ravel()]),
            rows,
        )

    def margins(self, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """The scores before the logistic function, and sum v_if x_i of each document and factor."""
        total = np.bincount(f.owner, weights=self.weights[f.place] * f.x, minlength=f.rows) + self.bias
        v = self.factors[f.place] * f.x[:, None]
        sums = np.column_stack([np.bincount(f.owner, weights=v[:, k], minlength=f.rows) for k in range(v.shape[1])])
        squares = np.bincount(f.owner, weights=(v**2).sum(axis=1), minlength=f.rows)
        return total + ((sums**2).sum(axis=1) - squares) / 2, sums

    def scores(self, sparse: Features, statistics: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(self.design(sparse, statistics))[0], -30, 30)))


def train(sparse: Features, statistics: np.ndarray, label: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.08) -> Machine:
    """Fit by AdaGrad on the logistic loss, in an order fixed by a seed."""
    rng = np.random.default_rng(7)
    width = BUCKETS + _STATISTICS
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3)) if len(label) else 0.5
    scale = statistics.std(axis=0) if len(label) else np.ones(_STATISTICS)
    mean = statistics.mean(axis=0) if len(label) else np.zeros(_STATISTICS)
    machine = Machine(np.log(share / (1 - share)), np.zeros(width), np.zeros((width, FACTORS)), mean, np.where(scale > 1e-9, scale, 1.0))
    if len(np.unique(label)) < 2:
        return machine
    machine.factors = rng.normal(0, 0.05, (width, FACTORS))
    f = machine.design(sparse, statistics)
    order = np.argsort(f.owner, kind="stable")
    owner, place, x = f.owner[order], f.place[order], f.x[order]
    first = np.searchsorted(owner, np.arange(f.rows + 1))
    gw, gv, gb = np.full(width, 1e-6), np.full((width, FACTORS), 1e-6), 1e-6
    for _ in range(epochs):
        shuffled = rng.permutation(f.rows)
        for chosen in np.array_split(shuffled, max(1, f.rows // batch)):
            chosen = np.sort(chosen)
            at = np.concatenate([np.arange(first[i], first[i + 1]) for i in chosen])
            part = Features(np.searchsorted(chosen, owner[at]), place[at], x[at], len(chosen))
            margin, sums = machine.margins(part)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[chosen]) / len(chosen)
            pull = error[part.owner] * part.x
            used, where = np.unique(part.place, return_inverse=True)
            dw = np.bincount(where, weights=pull) + 1e-6 * machine.weights[used]
            v = machine.factors[part.place]
            slope = pull[:, None] * (sums[part.owner] - v * part.x[:, None])
            dv = np.column_stack([np.bincount(where, weights=slope[:, k]) for k in range(FACTORS)]) + 1e-5 * machine.factors[used]
            gw[used] += dw**2
            gv[used] += dv**2
            gb += error.sum() ** 2
            machine.weights[used] -= rate * dw / np.sqrt(gw[used])
            machine.factors[used] -= rate / 2 * dv / np.sqrt(gv[used])
            machine.bias -= rate * error.sum() / np.sqrt(gb)
    return machine


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", rows: int = TRAINING_ROWS) -> Machine:
    """The machine learnt from at most ``rows`` labelled documents of the folds that are not held out."""
    marked = labels.where("quality in (0, 1)").select(F.col(key).alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marked = marked.where(~held_out("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    chosen = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(marked), "doc_id")

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sparse, statistics = features(batch.column("text"))
        cuts = np.searchsorted(sparse.owner, np.arange(1, sparse.rows))
        raw = lambda a, t: pa.array([p.astype(t).tobytes() for p in np.split(a, cuts)] if sparse.rows else [], pa.binary())
        return {
            "doc_id": batch.column("doc_id"),
            "label": batch.column("label"),
            "place": raw(sparse.place, np.uint16),
            "x": raw(sparse.x, np.float32),
            "statistics": pa.array([r.tobytes() for r in statistics], pa.binary()),
        }

    kind = docs.schema[key].dataType.simpleString()
    made = mapped(chosen, "text", work, f"doc_id {kind}, label int, place binary, x binary, statistics binary", only=True)
    # Repeated identifiers must not make the sample larger than its bound.
    got = made.orderBy(F.xxhash64("doc_id"), "doc_id", "label", "place").limit(rows).collect()
    places = [np.frombuffer(r["place"], np.uint16) for r in got]
    sparse = Features(
        np.repeat(np.arange(len(got)), [len(p) for p in places]),
        np.concatenate([np.zeros(0, np.uint16), *places]).astype(np.int64),
        np.concatenate([np.zeros(0, np.float32), *[np.frombuffer(r["x"], np.float32) for r in got]]).astype(float),
        len(got),
    )
    statistics = np.array([np.frombuffer(r["statistics"]) for r in got]).reshape(len(got), _STATISTICS)
    return train(sparse, statistics, np.array([r["label"] for r in got], dtype=float))


def score(docs: DataFrame, machine: Machine, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with held_out, score and predicted."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = machine.scores(*features(batch.column(text)))
        return {"score": pa.array(found), "predicted": pa.array((found >= threshold).astype(np.int32))}

    return mapped(docs, text, work, "score double, predicted int").withColumn("held_out", held_out(key))
