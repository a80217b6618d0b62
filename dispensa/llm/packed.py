"""Questions of documents to the whole corpus, without a shuffled row for each word.

Documents are dealt into blocks of a few megabytes. Each block sends the sorted hashes it asks about to
the parts of the hash range, as one compressed value for each part; a part adds up what all blocks say
about a hash and answers each block in the order of its question. A hash that a third of all rows share
is one entry for each block, so no part is larger than the others for it. Spark deals, shuffles and
recomputes blocks and parts; a lost executor costs only the parts it held.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispensa.llm.ship import shipped

BLOCK_BYTES = 8 << 20
ASKED = "part int, block int, step int, hashes binary, weights binary"
ANSWERED = "block int, step int, part int, answers binary"


def blocked(docs: DataFrame, key: str, text: str, carried: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (block, doc_id, text), dealt into blocks of about ``block_bytes`` of text by a hash of the row.

    ``carried`` adds the other columns as one struct, under whatever names they have.
    """
    shipped(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text) + 64), F.lit(0))).first()[0]
    block = F.pmod(F.xxhash64(key, text), F.lit(max(1, math.ceil(size / block_bytes)))).cast("int")
    columns = [block.alias("block"), F.col(key).alias("doc_id"), F.col(text).alias("text")]
    if carried:
        columns.append(F.struct(*[c for c in docs.columns if c != text]).alias("others"))
    return docs.select(*columns)


def restored(out: DataFrame, docs: DataFrame, text: str, results: list[str]) -> DataFrame:
    """The columns of ``docs`` in their order, then the results; a result replaces a column of its name."""
    kept = [F.col("text").alias(text) if c == text else F.col(f"others.`{c}`") for c in docs.columns if c not in results]
    return out.select(*kept, *results)


def ordered(table: pa.Table, columns: list[str]) -> pa.Table:
    """The rows of a block in an order that does not depend on how they arrived."""
    return table.take(pc.sort_indices(table, sort_keys=[(c, "ascending") for c in columns])).combine_chunks()


def parts_of(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def press(values: np.ndarray) -> bytes:
    """The values, byte place by byte place, so that equal high bytes shrink."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpress(raw: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def _bounds(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the hash range begins in the sorted hashes."""
    edges = np.array([i * 2**64 // parts for i in range(parts)], dtype=np.uint64)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def question(block: int, step: int, hashes: np.ndarray, weights: np.ndarray, parts: int) -> pa.Table:
    """Rows that send distinct sorted hashes and their weights to the parts."""
    bounds = _bounds(hashes, parts)
    filled = [p for p in range(parts) if bounds[p] < bounds[p + 1]]
    cut = [slice(bounds[p], bounds[p + 1]) for p in filled]
    return pa.table(
        {
            "part": pa.array(filled, pa.int32()),
            "block": pa.array([block] * len(filled), pa.int32()),
            "step": pa.array([step] * len(filled), pa.int32()),
            "hashes": pa.array([press(np.diff(hashes[c], prepend=np.uint64(0))) for c in cut], pa.binary()),
            "weights": pa.array([press(weights[c].astype(np.uint32)) for c in cut], pa.binary()),
        }
    )


def tallied(asked: DataFrame, most: int | None = None) -> DataFrame:
    """The sum of the weights of each hash over all blocks, for each block that asked.

    ``most`` bounds the sums that are told where only "that many or more" matters.
    """

    def add_up(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hashes = [np.cumsum(unpress(r["hashes"], np.uint64), dtype=np.uint64) for r in rows]
        weights = np.concatenate([unpress(r["weights"], np.uint32) for r in rows])
        _, group = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(group, weights=weights)
        sums = np.minimum(sums, most or 2**32 - 1).astype(np.uint32)[group]
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        return pa.table(
            {
                "block": pa.array([r["block"] for r in rows], pa.int32()),
                "step": pa.array([r["step"] for r in rows], pa.int32()),
                "part": pa.array([r["part"] for r in rows], pa.int32()),
                "answers": pa.array([press(x) for x in np.split(sums, cuts)], pa.binary()),
            }
        )

    return asked.groupBy("part").applyInArrow(add_up, ANSWERED)


def answers(replies: pa.Table, step: int, hashes: np.ndarray, parts: int, dtype: type = np.uint32) -> np.ndarray:
    """The answers to a block's sorted hashes."""
    out, bounds = np.zeros(len(hashes), dtype=dtype), _bounds(hashes, parts)
    for r in replies.to_pylist():
        if r["step"] == step:
            out[bounds[r["part"]] : bounds[r["part"] + 1]] = unpress(r["answers"], dtype)
    return out


def with_answers(
    blocks: DataFrame, replies: DataFrame, work: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Each block beside the answers it got. The blocks' shuffle is the one of the question, used again."""

    def run(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the block before took
        return work(key[0].as_py(), rows, told)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def each_block(blocks: DataFrame, work: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what the block before took
        return work(key[0].as_py(), rows)

    return blocks.groupBy("block").applyInArrow(run, schema)
