"""A Merkle manifest of a table, with a proof for every row.

Rows are leaves: the digest of their fields, written so that no two rows run together. Each group's leaves stand in
order; every two neighbours become the digest of their digests (a last one alone becomes its own digest again), level
by level, until one subroot is left. The groups' subroots, in the order of the groups, become the root likewise.

Proofs come from pointer jumping. First a node knows its parent, one level up, and the sibling that stands beside it.
In each round the nodes are joined with themselves: a node whose pointer leads d levels up takes over the segment of
the node it points to, which leads from there another d levels up. After about log2(height) rounds every leaf points to
its subroot, and its segment is its proof; one last join does the same for the subroots' way to the root. Only nodes
that later rounds can point to stay in the table, so a round's rows are about the leaves.

How it holds at scale: positions come from a range partition and offsets per range, so a group with most of all rows is
spread; ``BLOCK`` levels are computed at once from 2**BLOCK neighbours, a bounded list, not a shuffle a level. High
ancestors have many descendants: they are repeated once for each block of 2**BLOCK descendants and joined on the block,
so no key has more rows than that and nothing has to be broadcast. All of it is column functions.

Defined results: a null field has a mark that no value has; a null group is one group, the first; null order values come
first. Rows equal in group and order stand in the order of their leaves, so that equal rows may change places. No rows:
no result. Other columns, of any name, are kept; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispensa.operators.ordered import RANGE, place
from dispensa.sources.staging import Staging

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK = 10
_MADE = ("leaf", "subroot", "root", "proof")


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text, 256)


def leaf_digest(fields: Sequence[str | Column] = FIELDS) -> Column:
    """The digest of a row: each field as ``-`` if null, else its byte count, a colon and the value."""

    def entry(field: str | Column) -> Column:
        value = (F.col(f"`{field}`") if isinstance(field, str) else field).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(F.concat(*map(entry, fields)))


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def _height(n: Column) -> Column:
    """Levels above n leaves: the bits of n - 1."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _positions(leaves: DataFrame, order: Sequence[str], staging: Staging) -> DataFrame:
    """Add ``i``, the position of a leaf in its tree, and ``n``, the leaves of the tree."""
    by = [F.col(c) for c in order]
    placed = place(leaves, ["tree"], by, staging, "placed")
    sizes = placed.groupBy("tree", RANGE).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy("tree").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "tree",
        RANGE,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy("tree")).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy("tree", RANGE).orderBy(*by))
    rows = placed.join(staging.keep(sizes, "sizes"), ["tree", RANGE])
    return rows.select("tree", "n", (F.col("_before") + inside - 1).alias("i"), "digest", "row")


def _above(digests: Column) -> Column:
    """The digests of every two neighbours; of a last one alone, its own."""
    runs = F.sequence(F.lit(0), F.call_function("div", F.size(digests) - 1, F.lit(2)).cast("int"))
    second = lambda j: F.coalesce(F.get(digests, j * 2 + 1), F.lit(""))
    return F.transform(runs, lambda j: digest(F.concat(F.get(digests, j * 2), second(j))))


def _levels(base: DataFrame, first: int) -> DataFrame:
    """One row for each 2**BLOCK neighbours of level ``first``: the digests of ``BLOCK`` levels above them too."""
    entry = F.struct("i", "digest", "row")
    blocks = base.groupBy("tree", "n", F.shiftright("i", BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    blocks = blocks.withColumns(
        {
            "l0": F.transform("entries", lambda e: e["digest"]),
            "rows": F.transform("entries", lambda e: e["row"]),
            "height": _height(F.col("n")),
        }
    ).drop("entries")
    for k in range(1, BLOCK + 1):
        blocks = blocks.withColumn(f"l{k}", F.when(F.col("height") >= first + k, _above(F.col(f"l{k - 1}"))))
    return blocks


def _tree(leaves: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """All nodes but the subroots, with the segments to their parents; and the subroots (tree, n, digest)."""
    nodes, roots, first, base = [], [], 0, leaves
    while True:
        blocks = staging.keep(_levels(base, first), "blocks")
        none = F.lit(None).cast(base.schema["row"].dataType)
        spread = blocks.select(
            "tree", "n", "height", "block", "rows", F.posexplode(F.array(*[f"l{k}" for k in range(BLOCK)])).alias("k", "digests")
        ).where(F.col("height") > first + F.col("k"))
        spread = spread.select("*", F.posexplode("digests").alias("pos", "_"))
        sibling = F.get("digests", F.col("pos").bitwiseXOR(F.lit(1)))
        lead = F.call_function("shiftleft", F.col("block"), F.lit(BLOCK) - F.col("k"))
        nodes.append(
            spread.select(
                "tree",
                "n",
                "height",
                (F.lit(first) + F.col("k")).alias("level"),
                (lead + F.col("pos")).alias("i"),
                F.array(F.coalesce(F.unhex(sibling), F.lit(b""))).alias("segment"),
                none.alias("row") if first else F.when(F.col("k") == 0, F.get("rows", F.col("pos"))).alias("row"),
            )
        )
        top = [F.when(F.col("height") == first + k, F.get(f"l{k}", F.lit(0))) for k in range(BLOCK + 1)]
        if first:  # a tree of that height was ready before
            top[0] = F.lit(None).cast("string")
        roots.append(blocks.select("tree", "n", F.coalesce(*top).alias("digest")).where("digest is not null"))
        first += BLOCK
        above = blocks.where(F.col("height") > first)
        if above.isEmpty():
            break
        base = above.select(
            "tree",
            "n",
            F.col("block").alias("i"),
            F.get(f"l{BLOCK}", F.lit(0)).alias("digest"),
            F.lit(None).cast(base.schema["row"].dataType).alias("row"),
        )
    # A tree of one leaf has no node below its subroot; the leaf itself must stay.
    single = leaves.where("n = 1").select(
        "tree", "n", F.lit(0).alias("height"), F.lit(0).alias("level"), "i", F.lit([]).cast("array<binary>").alias("segment"), "row"
    )
    union = single
    for part in nodes:
        union = union.unionByName(part)
    found = roots[0]
    for part in roots[1:]:
        found = found.unionByName(part)
    return staging.keep(union, "nodes"), staging.keep(found, "roots")


def _blocks_below(nodes: DataFrame, distance: int) -> DataFrame:
    """Add ``block``: ancestors ``distance`` levels up, once for each block of descendants there."""
    wide = max(distance - BLOCK, 0)
    if not wide:
        return nodes.withColumn("block", F.col("i"))
    level = F.col("level") - distance + BLOCK  # the blocks are nodes of this level
    end = F.least(F.shiftleft(F.col("i") + 1, wide) - 1, F.call_function("shiftright", F.col("n") - 1, level))
    return nodes.withColumn("block", F.explode(F.sequence(F.shiftleft("i", wide), end)))


def _jumped(nodes: DataFrame, staging: Staging) -> DataFrame:
    """The leaves with segments that lead to their subroots, as (tree, n, i, segment, row)."""
    tallest = nodes.agg(F.max("height")).first()[0] or 0
    distance = 1
    while distance < tallest:
        # Pointers go ``distance`` levels up; those of every second such level are doubled, over the others.
        near = nodes.where(F.col("level") % (2 * distance) == 0)
        far = _blocks_below(nodes.where(F.col("level") % (2 * distance) == distance), distance)
        far = far.select(
            F.col("tree").alias("_tree"), F.col("level").alias("_level"), "block", F.col("segment").alias("_segment")
        )
        block = F.shiftright("i", min(distance, BLOCK))
        met = (F.col("tree") == F.col("_tree")) & (F.col("level") + distance == F.col("_level")) & (block == F.col("block"))
        joined = near.join(far, met, "left")
        longer = F.concat("segment", F.coalesce("_segment", F.lit([]).cast("array<binary>")))
        nodes = staging.keep(joined.withColumn("segment", longer).select(*nodes.columns), f"jump{distance}")
        distance *= 2
    return nodes.where("level = 0").select("tree", "n", "i", "segment", "row")


def _steps(segment: str, i: Column) -> Column:
    """A segment as steps: the sibling's digest, null where there is none, and whether it stands left."""
    return F.transform(
        segment,
        lambda s, k: F.named_struct(
            F.lit("left"),
            F.call_function("shiftright", i, k).bitwiseAND(F.lit(1)) == 1,
            F.lit("digest"),
            F.when(F.octet_length(s) > 0, _hex(s)),
        ),
    )


def manifest(
    rows: DataFrame, staging: Staging, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id",
    kept: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """The ``kept`` columns of all rows, with leaf, subroot, root and proof.

    A proof is an array of steps (left, digest) from the leaf up: the sibling's digest, null for a node without one, and
    whether the sibling stands left. ``folded`` gives the root again.
    """
    names = [c for c in kept if c not in _MADE]
    leaves = rows.select(
        F.coalesce(F.concat(F.lit(":"), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("tree"),
        F.col(f"`{order}`").alias("at"),
        leaf_digest(fields).alias("digest"),
        F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("kept"),
    )
    leaves = leaves.withColumn("row", F.struct(F.col("digest").alias("leaf"), "kept")).drop("kept")
    # Equal rows get a number, so that they can be spread; stored, so that it stays theirs.
    leaves = staging.keep(leaves.withColumn("number", F.monotonically_increasing_id()), "leaves")
    nodes, roots = _tree(_positions(leaves, ["at", "digest", "number"], staging), staging)
    below = _jumped(nodes, staging)
    groups = roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("at"), "digest", F.struct("tree", "n", "digest").alias("row")
    )
    nodes, top = _tree(_positions(groups, ["at"], staging), staging)
    above = _jumped(nodes, staging).select(
        F.col("row.tree").alias("_tree"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright(F.col("row.n") - 1, BLOCK))).alias("block"),
        F.col("row.digest").alias("subroot"),
        _steps("segment", F.col("i")).alias("upper"),
    )
    met = (F.col("tree") == F.col("_tree")) & (F.shiftright("i", BLOCK) == F.col("block"))
    whole = below.join(above, met).crossJoin(F.broadcast(top.select(F.col("digest").alias("root"))))  # one row
    return whole.select(
        *[F.col("row.kept")[c].alias(c) for c in names],
        F.col("row.leaf").alias("leaf"),
        "subroot",
        "root",
        F.concat(_steps("segment", F.col("i")), "upper").alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""

    def step(node: Column, s: Column) -> Column:
        beside = F.coalesce(s["digest"], F.lit(""))
        return digest(F.when(s["left"], F.concat(beside, node)).otherwise(F.concat(node, beside)))

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """One digest of all siblings of a proof, from the leaf up."""
    return digest(F.array_join(F.transform(proof, lambda s: s["digest"]), ""))
