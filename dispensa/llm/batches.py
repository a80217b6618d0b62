"""Columns computed by Python workers from batches of a few megabytes of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dispensa.llm.ship import shipped

LIMIT = 2 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``limit`` bytes of the column; a longer value is a piece by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    stops, cut = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), 0
    while cut < batch.num_rows:
        stop = max(cut + 1, int(np.searchsorted(stops, stops[cut] + limit, "right")) - 1)
        yield batch.slice(cut, stop - cut)
        cut = stop


def mapped(
    table: DataFrame,
    column: str,
    work: Callable[[pa.RecordBatch], dict[str, pa.Array]],
    results: str,
    limit: int = LIMIT,
    only: bool = False,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """The table with the columns that ``work`` makes, which replace columns of their names; ``only``: just those.

    ``done`` runs at the end of each partition. Workers live on for other stages, so memory is given back then.
    """
    shipped(table.sparkSession)
    made = StructType.fromDDL(results)
    kept = [] if only else [f for f in table.schema.fields if f.name not in made.names]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column, limit):
                columns = {name: batch.column(name) for name in names} | work(batch)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                del batch, columns
        if done:
            done()
        pa.default_memory_pool().release_unused()

    return table.select(*[F.col(f"`{c}`") for c in table.columns]).mapInArrow(run, StructType([*kept, *made.fields]))
