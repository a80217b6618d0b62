"""A class-based bigram language model: P(w | h) = P(class(w) | class(h)) P(w | class(w)).

Exchange clustering. Each word of the training texts has counts of its left and right neighbours, in features
that are hashes of the neighbour (as many as ``FEATURES`` on each side). Classes start as the most frequent
words, one each. In a sweep every word moves to the class whose neighbour counts make its own most likely,
all at once against the counts of the sweep before; that never lowers the mutual information between classes
and neighbours. The sweeps read the words' counts, not the texts, and send classes x features sums to the driver.

1. Chunks of text send each distinct word with its counts to its part of the hash range; a part adds them up.
2. Sweeps over the parts' tables.
3. Blocks of documents ask for count and class of their distinct words (``packed``) and write each document
   as its classes, with the sums over its words of the unigram and the emission probability.
4. Class transitions are counted on these, and then score them.

Probabilities. A text is its words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, and an end, which is the history of
the first word. Words that training lacks are one class of their own: it occurs wherever training has a word
of count 1, and after it what follows such words. Transitions are smoothed with ``ALPHA`` counts of the class's
share among unigrams, emissions with half a count for each word. All probabilities after a history sum to 1.

Defined results: a null or empty text is one end; rows that share an identifier are texts of their own; a null
identifier belongs to the training part; without training texts every word is unknown with probability 1; an
empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.llm import packed
from dispensa.llm.batches import mapped
from dispensa.llm.words import U, Words
from dispensa.sources.staging import Staging

CLASSES = 64
FEATURES = 64
SWEEPS = 5
ALPHA = 20.0
FOLDS, FOLD = 5, 1
CHUNK_BYTES = 8 << 20
_END = U(0x5EED0000000000E5)  # the end's place among word hashes
_HAPAX = 128  # marks a class in a sequence as that of a word of count 1
_COUNTED = "part int, chunk bigint, hashes binary, counts binary, widths binary, places binary, times binary"
_TABLE = "part int, hashes binary, counts binary, widths binary, places binary, times binary"
_SCORED = (
    "doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, emission double, sequence binary"
)


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == FOLD, F.lit(False))


class _Stream:
    """The tokens of some texts in a row: word hashes, after each text an end."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray):
        words = Words(texts, lower=True)
        n = len(words.counts)
        self.sizes = words.counts + 1
        self.stops = np.cumsum(self.sizes)
        self.tokens = np.full(len(words.starts) + n, _END, dtype=U)
        self.tokens[np.arange(len(words.starts)) + words.owner()] = words.hashes

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stops] - total[self.stops - self.sizes]


def _neighbours(stream: _Stream) -> tuple[np.ndarray, np.ndarray]:
    """The tokens before and after each; before a text and after its end stands an end."""
    before, after = np.roll(stream.tokens, 1), np.roll(stream.tokens, -1)
    before[stream.stops - stream.sizes] = _END
    after[stream.stops - 1] = _END
    return before, after


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


def _context_rows(texts: pa.Array, chunk: int, parts: int) -> pa.Table:
    """The chunk's words for each part: sorted hashes, counts, and sparse rows of neighbour features."""
    stream = _Stream(texts)
    before, after = _neighbours(stream)
    hashes, word, counts = np.unique(stream.tokens, return_inverse=True, return_counts=True)
    mask, width = U(FEATURES - 1), 2 * FEATURES
    keys = np.concatenate(
        [word * width + (before & mask).astype(np.int64), word * width + FEATURES + (after & mask).astype(np.int64)]
    )
    keys, times = np.unique(keys, return_counts=True)
    owner, places = keys // width, (keys % width).astype(np.uint8)
    widths = np.bincount(owner, minlength=len(hashes)).astype(np.uint8)  # 2 * FEATURES at most
    bounds = packed._bounds(hashes, parts)
    cuts = np.searchsorted(owner, bounds)
    rows = []
    for p in range(parts):
        a, b, c, d = bounds[p], bounds[p + 1], cuts[p], cuts[p + 1]
        if a < b:
            rows.append(
                (p, chunk, packed.press(np.diff(hashes[a:b], prepend=U(0))), packed.press(counts[a:b].astype(np.uint32)),
                 packed.press(widths[a:b]), packed.press(places[c:d]), packed.press(times[c:d].astype(np.uint32)))
            )
    return pa.Table.from_pylist(
        [dict(zip(("part", "chunk", "hashes", "counts", "widths", "places", "times"), r)) for r in rows],
        schema=pa.schema(
            [("part", pa.int32()), ("chunk", pa.int64())]
            + [(c, pa.binary()) for c in ("hashes", "counts", "widths", "places", "times")]
        ),
    )


class _Table:
    """Words of a part with counts and sparse rows of neighbour features."""

    def __init__(self, row: dict):
        self.hashes = np.cumsum(packed.unpress(row["hashes"], np.uint64), dtype=np.uint64)
        self.counts = packed.unpress(row["counts"], np.uint32 if "chunk" in row else np.int64).astype(np.int64)
        widths = packed.unpress(row["widths"], np.uint8)
        self.owner = np.repeat(np.arange(len(widths)), widths)
        self.places = packed.unpress(row["places"], np.uint8).astype(np.int64)
        self.times = packed.unpress(row["times"], np.uint32 if "chunk" in row else np.int64).astype(np.int64)

    def best(self, logs: np.ndarray) -> np.ndarray:
        """The class under which each word's neighbours are likeliest; the end is a class by itself."""
        out = np.zeros(len(self.hashes), dtype=np.int64)
        starts = np.searchsorted(self.owner, np.arange(len(self.hashes)))
        step = 1 << 14  # words at a time, so that the products stay small
        for a in range(0, len(out), step):
            b = min(a + step, len(out))
            lo, hi = starts[a], starts[b] if b < len(out) else len(self.owner)
            cells = (self.owner[lo:hi] - a) * (2 * FEATURES) + self.places[lo:hi]
            dense = np.bincount(cells, weights=self.times[lo:hi], minlength=(b - a) * 2 * FEATURES)
            out[a:b] = (dense.reshape(b - a, 2 * FEATURES) @ logs.T).argmax(axis=1)
        return np.where(self.hashes == _END, CLASSES, out)


def _merge(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    parts = [_Table(r) for r in rows]
    hashes, word = np.unique(np.concatenate([p.hashes for p in parts]), return_inverse=True)
    counts = np.bincount(word, weights=np.concatenate([p.counts for p in parts])).astype(np.int64)
    width, cut, keys = 2 * FEATURES, 0, []
    for p in parts:
        keys.append(word[cut + p.owner] * width + p.places)
        cut += len(p.hashes)
    key, times = _summed(np.concatenate(keys), np.concatenate([p.times for p in parts]))
    widths = np.bincount(key // width, minlength=len(hashes)).astype(np.uint8)
    return pa.table(
        {
            "part": pa.array([rows[0]["part"]], pa.int32()),
            "hashes": [packed.press(np.diff(hashes, prepend=U(0)))],
            "counts": [packed.press(counts)],
            "widths": [packed.press(widths)],
            "places": [packed.press((key % width).astype(np.uint8))],
            "times": [packed.press(times)],
        }
    )


def _counted(docs: DataFrame, staging: Staging) -> DataFrame:
    """The training words, one row for each part of the hash range."""
    parts = packed.parts_of(docs)
    made = mapped(docs, "text", lambda b: _exploded(_context_rows(b.column("text"), 0, parts)), _COUNTED, CHUNK_BYTES, only=True)
    return staging.keep(made.groupBy("part").applyInArrow(_merge, _TABLE), "words")


def _exploded(table: pa.Table) -> dict[str, pa.Array]:
    return {c: table.column(c).combine_chunks() for c in table.column_names}


def _seeds(words: DataFrame) -> np.ndarray:
    """The neighbour counts of the most frequent words, a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = _Table(row)
                top = [i for i in np.lexsort((t.hashes, -t.counts))[: CLASSES + 1] if t.hashes[i] != _END]
                vectors = []
                for i in top:
                    v = np.zeros(2 * FEATURES)
                    at = t.owner == i
                    v[t.places[at]] = t.times[at]
                    vectors.append(v.tobytes())
                yield pa.RecordBatch.from_pydict(
                    {
                        "n": pa.array(t.counts[top], pa.int64()),
                        "h": pa.array(t.hashes[top].view(np.int64)),
                        "v": pa.array(vectors, pa.binary()),
                    }
                )

    found = words.mapInArrow(run, "n long, h long, v binary").orderBy(F.desc("n"), "h").limit(CLASSES).collect()
    return np.array([np.frombuffer(r["v"]) for r in found]).reshape(len(found), 2 * FEATURES)


def _logs(counts: np.ndarray) -> np.ndarray:
    smooth = counts + 0.1
    return np.log(smooth / smooth.sum(axis=1, keepdims=True))


def _sweep(words: DataFrame, logs: np.ndarray) -> np.ndarray:
    """The neighbour counts of the classes after every word has moved to its best class."""
    classes = len(logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, 2 * FEATURES))
        for batch in batches:
            for row in batch.to_pylist():
                t = _Table(row)
                best = t.best(logs)[t.owner]
                used = best < CLASSES
                np.add.at(total, (best[used], t.places[used]), t.times[used])
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "n": pa.array(total.ravel()[cells].astype(np.int64))})

    cells = words.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(classes * 2 * FEATURES)
    out[[r["cell"] for r in cells]] = [r["n"] for r in cells]
    return out.reshape(classes, 2 * FEATURES)


def _class_totals(words: DataFrame, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Tokens and words of each class (the end's last), and of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                t = _Table(row)
                best = t.best(logs)
                yield pa.RecordBatch.from_pydict(
                    {
                        "class": pa.array(np.arange(CLASSES + 1)),
                        "n": pa.array(np.bincount(best, weights=t.counts, minlength=CLASSES + 1).astype(np.int64)),
                        "v": pa.array(np.bincount(best, minlength=CLASSES + 1).astype(np.int64)),
                    }
                )

    rows = words.mapInArrow(run, "class long, n long, v long").groupBy("class").agg(F.sum("n"), F.sum("v")).collect()
    n, v = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1)
    for r in rows:
        n[r[0]], v[r[0]] = r[1], r[2]
    return n, v, int(n.sum()), int(v.sum())


def _told(logs: np.ndarray):
    """Answers blocks with class and count of their words: (class << 48) + count, 0 for an unknown word."""

    def work(asked: pa.Table, table: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        hashes, values = np.zeros(0, U), np.zeros(0, np.int64)
        if table.num_rows:
            t = _Table(table.to_pylist()[0])
            hashes, values = t.hashes, (t.best(logs) << 48) + t.counts
        found = []
        for r in rows:
            wanted = np.cumsum(packed.unpress(r["hashes"], np.uint64), dtype=np.uint64)
            at = np.searchsorted(hashes, wanted)
            known = np.zeros(len(wanted), dtype=bool)
            known[at < len(hashes)] = hashes[at[at < len(hashes)]] == wanted[at < len(hashes)]
            out = np.zeros(len(wanted), dtype=np.int64)
            out[known] = values[at[known]]
            found.append(packed.press(out))
        return pa.table(
            {
                "block": pa.array([r["block"] for r in rows], pa.int32()),
                "step": pa.array([0] * len(rows), pa.int32()),
                "part": pa.array([r["part"] for r in rows], pa.int32()),
                "answers": pa.array(found, pa.binary()),
            }
        )

    return work


def _transitions(sequences: list[bytes]) -> np.ndarray:
    """Counts of (history, class) for classes, the end and, last, unknown words, for which words of count 1 stand too."""
    k = CLASSES + 2
    out = np.zeros((k, k), dtype=np.int64)
    codes = np.frombuffer(b"".join(sequences), dtype=np.uint8).astype(np.int64)
    if not len(codes):
        return out
    stops = np.cumsum([len(s) for s in sequences])
    before = np.roll(codes, 1)
    before[np.concatenate([[0], stops[:-1]])] = CLASSES
    plain, history = codes % _HAPAX, before % _HAPAX
    out += np.bincount(history * k + plain, minlength=k * k).reshape(k, k)
    once, after_once = codes >= _HAPAX, before >= _HAPAX
    out[:, -1] += np.bincount(history[once], minlength=k)
    out[-1] += np.bincount(plain[after_once], minlength=k)
    out[-1, -1] += int((once & after_once).sum())
    return out


def transition_logs(seen: np.ndarray, n_class: np.ndarray, v_class: np.ndarray) -> np.ndarray:
    """log10 P(class | history) from counted transitions and the classes' tokens and words; the last is the unknown."""
    share = np.append(n_class + 0.5 * v_class, 0.5) / (n_class.sum() + 0.5 * (v_class.sum() + 1))
    return np.log10(np.maximum((seen + ALPHA * share) / (seen.sum(axis=1, keepdims=True) + ALPHA), 1e-300))


def score(docs: DataFrame, staging: Staging, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("held_out", held_out("doc_id"))
    words = _counted(rows.where("not held_out").select("text"), staging)
    counts = _seeds(words)
    if not len(counts):
        counts = np.ones((1, 2 * FEATURES))
    for _ in range(SWEEPS):
        counts = _sweep(words, _logs(counts))
    logs = _logs(counts)
    n_class, v_class, total, distinct = _class_totals(words, logs)
    whole = total + 0.5 * (distinct + 1)

    blocks, parts = packed.blocked(rows, "doc_id", "text", carried=True), packed.parts_of(docs)

    def ask(block: int, table: pa.Table) -> pa.Table:
        hashes = np.unique(_Stream(table["text"]).tokens)
        return packed.question(block, 0, hashes, np.zeros(len(hashes)), parts)

    def write(block: int, table: pa.Table, told: pa.Table) -> pa.Table:
        stream = _Stream(table["text"])
        hashes, word = np.unique(stream.tokens, return_inverse=True)
        values = packed.answers(told, 0, hashes, parts, np.int64)
        count = (values & ((1 << 48) - 1)).astype(np.float64)
        kind = np.where(count > 0, values >> 48, CLASSES + 1)
        base = np.log10((count + 0.5) / whole)
        within = np.minimum(kind, CLASSES)
        emission = np.where(count > 0, np.log10((count + 0.5) / (n_class + 0.5 * v_class + 1e-9)[within]), 0.0)
        code = (kind + np.where(count == 1, _HAPAX, 0)).astype(np.uint8)[word].tobytes()
        stops = stream.stops.tolist()
        others = table["others"].combine_chunks()
        return pa.table(
            {
                "doc_id": others.field("doc_id"),
                "held_out": others.field("held_out"),
                "n_tokens": pa.array(stream.sizes.astype(np.int64)),
                "n_known": pa.array(stream.sums((count > 0)[word]).astype(np.int64)),
                "train_tokens": pa.array(np.full(len(stops), total, np.int64)),
                "base_score": pa.array(stream.sums(base[word])),
                "emission": pa.array(stream.sums(emission[word])),
                "sequence": pa.array([code[a:b] for a, b in zip([0, *stops], stops)], pa.binary()),
            }
        )

    asked = packed.each_block(blocks, ask, packed.ASKED)
    replies = asked.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(_told(logs), packed.ANSWERED)
    schema = _SCORED.format(kind=rows.schema["doc_id"].dataType.simpleString())
    written = staging.keep(packed.with_answers(blocks, replies, write, schema), "sequences")

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((CLASSES + 2, CLASSES + 2), dtype=np.int64)
        for batch in batches:
            out += _transitions(batch.column("sequence").to_pylist())
        cells = np.flatnonzero(out)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "n": pa.array(out.ravel()[cells])})

    train = written.where("not held_out").select("sequence").mapInArrow(count_batches, "cell long, n long")
    cells = train.groupBy("cell").agg(F.sum("n").alias("n")).collect()
    k = CLASSES + 2
    seen = np.zeros(k * k)
    seen[[r["cell"] for r in cells]] = [r["n"] for r in cells]
    seen = seen.reshape(k, k)
    chance = transition_logs(seen, n_class, v_class)

    def add(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        sequences = batch.column("sequence").to_pylist()
        stops = np.cumsum([len(s) for s in sequences])
        codes = np.frombuffer(b"".join(sequences), dtype=np.uint8) % _HAPAX
        before = np.roll(codes, 1)
        before[np.concatenate([[0], stops[:-1]])] = CLASSES
        steps = np.concatenate([[0], np.cumsum(chance[before, codes])])
        moved = steps[stops] - steps[np.concatenate([[0], stops[:-1]])]
        return {"score": pa.array(batch.column("emission").to_numpy() + moved)}

    out = mapped(written, "sequence", add, "score double")
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
