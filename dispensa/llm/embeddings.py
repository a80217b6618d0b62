"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors by the bits of random projections, the first bit first, so that similar vectors
tend to lie side by side; each vector is compared with the next ``WINDOW`` ones. The passes are one shuffle
ranged by (pass, bits), and a task passes on what joins its vectors (a forest, not all pairs). The ends of the
ranges meet afterwards, so windows reach over range borders. The union over passes gives components.

Two vectors at the threshold agree on a bit with p = 1 - arccos(threshold) / pi and lie in one window if they
share about log2(2 N / window) leading bits. The number of passes follows from the number N of distinct vectors,
so that a pair at the threshold with no other links is found with a chance of ``RECALL`` among vectors that are
spread out, at any size of the table. A dense region of vectors that do not link needs more passes than that.

Equal vectors are taken together before, so no order can be filled by copies of one vector. Links are counted
inside components afterwards: their members are compared in tiles of bounded size, in which the counts are
added up without a row for each pair. A component found is therefore counted in full, however large.

Cosines are in double precision. Defined results: a vector that is null, empty, zero or has a null, NaN or
infinite component, or another length than the vector it meets, links with nothing and is its own
component; repeated rows link with each other; rows without identifier are dropped, as they cannot be told
apart. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from dispensa.llm.components import connected
from dispensa.llm.ship import shipped
from dispensa.sources.staging import Staging

RECALL = 0.99
PASSES = 16  # at least
BITS = 62
WINDOW = 48
THRESHOLD = 0.9
TILE = 1024


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """How many passes find a pair at the threshold among n spread-out vectors with a chance of ``recall``."""
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    once = agree ** math.log2(max(1.0, 2 * n / window))
    return PASSES if once >= 1 else max(PASSES, math.ceil(math.log(1 - recall) / math.log1p(-once)))


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows, scaled to length 1 in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(table: pa.Table | pa.RecordBatch) -> Iterator[pa.Table]:
    sizes = pc.list_value_length(table.column("v"))
    for n in pc.unique(sizes).to_pylist():
        yield pa.table({c: table.column(c) for c in table.schema.names}).filter(pc.equal(sizes, n))


def _keys(passes: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for table in _by_length(batch):
                x = _rows(table["v"])
                for turn in range(passes):
                    planes = np.random.default_rng([seed, turn, x.shape[1]]).normal(size=(x.shape[1], bits))
                    key = (x @ planes > 0) @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                    one = table.append_column("turn", pa.array(np.full(len(x), turn, np.int32)))
                    yield from one.append_column("key", pa.array(key)).combine_chunks().to_batches()

    return run


class _Forest:
    """Joins numbers to groups."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        self.up[a] = b
        return a != b


def _links(rows: pa.Table, window: int, threshold: float) -> dict[str, pa.Array]:
    """Links between sorted vectors at most ``window`` apart in a pass; a link that closes a circle is left out."""
    a, b = [], []
    for table in _by_length(rows):
        x, turn = _rows(table["v"]), table["turn"].to_numpy()
        ids, forest = table["vec_id"].to_numpy(), _Forest(len(x))
        for step in range(1, min(window, len(x) - 1) + 1):
            near = np.einsum("ij,ij->i", x[:-step], x[step:]) >= threshold
            for i in np.flatnonzero(near & (turn[:-step] == turn[step:])).tolist():
                if forest.join(i, i + step):
                    a.append(ids[i])
                    b.append(ids[i + step])
    return {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}


def _neighbours(window: int, threshold: float):
    """The links inside a range, and the rows at its ends (range, place) for what crosses its borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: pa.Table | None = None
        tail: pa.Table | None = None
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = pa.Table.from_batches([batch])
            both = fresh if tail is None else pa.concat_tables([tail, fresh])
            found = _links(both, window, threshold)
            none = {c: pa.nulls(len(found["a"]), t) for c, t in (("range", pa.int32()), ("place", pa.int64()))}
            none |= {c: pa.nulls(len(found["a"]), fresh.schema.field(c).type) for c in ("vec_id", "v", "turn")}
            yield pa.RecordBatch.from_pydict(found | none)
            n += batch.num_rows
            tail = both.slice(max(0, both.num_rows - window))
            if head is None or head.num_rows < window:
                head = (fresh if head is None else pa.concat_tables([head, fresh])).slice(0, window)
        if head is not None:
            last = tail.slice(max(0, head.num_rows + tail.num_rows - n))  # what is not in the head
            ends = pa.concat_tables([head, last]).select(["vec_id", "v", "turn"])
            place = np.append(np.arange(head.num_rows), np.arange(n - last.num_rows, n))
            where = {"range": pa.array(np.full(len(place), TaskContext.get().partitionId(), np.int32)), "place": pa.array(place)}
            none = {c: pa.nulls(len(place), pa.int64()) for c in ("a", "b")}
            table = pa.table(none | where | {c: ends[c] for c in ends.schema.names})
            yield from table.combine_chunks().to_batches()

    return run


def _over_borders(found: DataFrame, window: int, threshold: float) -> DataFrame:
    """The links between vectors at most ``window`` apart that lie in different ranges.

    The driver learns the size of each range. A border's group has the ``window`` rows on each side of it,
    whichever ranges they come from.
    """
    ends = found.where("range is not null")
    sizes = sorted(map(tuple, ends.groupBy("range").agg(F.max("place") + 1).collect()))
    stops = np.cumsum([n for _, n in sizes], dtype=np.int64)
    spans = []
    for (at, n), stop in zip(sizes, stops):
        lo, hi = np.searchsorted(stops, [stop - n - window, stop + window], side="left")
        borders = stops[lo : hi + 1]
        spans.append((at, int(stop - n), [int(e) for e in borders if e < stops[-1]]))
    spans = F.broadcast(found.sparkSession.createDataFrame(spans, "range int, begin long, borders array<long>"))
    placed = ends.join(spans, "range").withColumn("pos", F.col("begin") + F.col("place"))
    near = F.filter("borders", lambda e: (F.col("pos") >= e - window) & (F.col("pos") < e + window))
    placed = placed.select(F.explode(near).alias("border"), "pos", "vec_id", "v", "turn")

    def work(table: pa.Table) -> pa.Table:
        return pa.table(_links(table.sort_by("pos").combine_chunks(), window, threshold))

    return placed.groupBy("border").applyInArrow(work, "a long, b long")


def _count(threshold: float):
    """Adds up, for the vectors of one or two tiles, how many others each is linked to."""

    def work(table: pa.Table) -> pa.Table:
        ids, found = [], []
        order = pc.sort_indices(table, sort_keys=[("component", "ascending"), ("tile", "ascending")])
        table = table.take(order).combine_chunks()
        component = table["component"].to_numpy()
        cuts = np.flatnonzero(np.diff(component)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(component)]):
            for part in _by_length(table.slice(lo, hi - lo)):
                x, copies = _rows(part["v"]), part["copies"].to_numpy()
                tile, ids_here = part["tile"].to_numpy(), part["vec_id"].to_numpy()
                two = tile[0] != tile[-1]
                links = np.zeros(len(x), dtype=np.int64)
                for at in range(0, len(x), TILE):
                    here = slice(at, at + TILE)
                    near = x[here] @ x.T >= threshold
                    if two:  # pairs within a tile are counted where it stands alone
                        near &= tile[here, None] != tile[None, :]
                    links[here] = near @ copies
                    if not two:
                        own = np.arange(at, min(at + TILE, len(x)))
                        links[own] -= np.where(near[own - at, own], copies[own], 0)
                ids.append(ids_here)
                found.append(links)
        return pa.table({"vec_id": pa.array(np.concatenate(ids)), "links": pa.array(np.concatenate(found))})

    return work


def near_duplicates(
    vectors: DataFrame,
    staging: Staging,
    vector: str = "embedding",
    key: str = "vec_id",
    threshold: float = THRESHOLD,
    passes: int | None = None,
    bits: int = BITS,
    window: int = WINDOW,
    seed: int = 11,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept): one for each row of the table that has an identifier.

    Without ``passes`` there are as many as ``passes_for`` the distinct vectors.
    """
    spark = vectors.sparkSession
    shipped(spark)
    # Single precision travels as such; cosines are in double precision in either case.
    given = vectors.select(vector).schema[0].dataType
    single = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast(kind).alias("v"))
    rows = rows.where("vec_id is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is the largest value
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    name = F.when(usable, F.struct(F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("g")))
    rows = rows.withColumn("name", name)
    # Equal vectors: one of them is compared, the others count with it.
    kinds = rows.where("name is not null").groupBy("name").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("v").alias("v")
    )
    kinds = staging.keep(kinds, "vectors")
    if passes is None:
        passes = passes_for(kinds.count(), threshold, window)
    keyed = kinds.select("vec_id", "v").mapInArrow(_keys(passes, bits, seed), f"vec_id long, v {kind}, turn int, key long")
    keyed = keyed.repartitionByRange("turn", "key").sortWithinPartitions("turn", "key", "vec_id")
    found = keyed.mapInArrow(
        _neighbours(window, threshold), f"a long, b long, range int, place long, vec_id long, v {kind}, turn int"
    )
    found = staging.keep(found, "links")
    links = found.where("a is not null").select("a", "b").unionByName(_over_borders(found, window, threshold))
    groups = staging.keep(connected(links, staging), "groups")

    # Members are dealt into tiles; every two tiles of a component meet in one group, small components share one.
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = kinds.join(groups.withColumnRenamed("node", "vec_id"), "vec_id").join(sizes, "component")
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("vec_id"), "tiles").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = members.select("component", "vec_id", "copies", "v", "tile", "tiles", "size", each)
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    shared = F.pmod(F.xxhash64("component"), F.lit(max(1, total // (4 * TILE))))
    spread = spread.select(
        F.when(F.col("tiles") > 1, F.col("component")).alias("alone"),
        F.when(F.col("tiles") == 1, shared).alias("shelf"),
        F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
        "component", "vec_id", "copies", "v", "tile",
    )
    found = spread.groupBy("alone", "shelf", "t1", "t2").applyInArrow(_count(threshold), "vec_id long, links long")
    found = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    kinds = kinds.select("name", "vec_id", "copies").join(found, "vec_id", "left").join(
        groups.withColumnRenamed("node", "vec_id"), "vec_id", "left"
    )
    kinds = kinds.select(
        "name", F.coalesce("component", "vec_id").alias("found"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    out = rows.select("vec_id", "name").join(kinds, "name", "left")
    component = F.coalesce("found", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
