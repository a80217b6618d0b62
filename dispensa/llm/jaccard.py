"""Self-join of documents on the Jaccard similarity of their word n-grams, with the components it makes.

1. Blocks ask how many documents hold each of their shingles (``packed``), which orders every set from its
   rarest shingle on. Of n shingles only the first n - ceil(t n) + 1 are joined: two sets that reach the
   threshold t share one of those. Shingles of one document only are never sent.
2. Documents with equal sets become one class; one of them stands for it.
3. Prefix shingles are joined. Length, positional and suffix filters (the last from counts of each set in
   fixed parts of the hash range) leave candidate pairs, each verified once by intersecting the whole sets.
4. A shingle with m documents is not turned into m * m pairs: while there would be more than ``LINEAR`` pairs
   for each document and shingle, a round pairs the documents with ``LEADS`` of them, and the components found
   make most pairs needless. What still joins two components in the end is enumerated in full, so the
   components are exact.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a set has the distinct n-grams, or the
whole sequence if there are fewer words. Defined results: a null, empty or blank text has an empty set
(n_shingles 0) and is linked with nothing; rows that share an identifier are compared each by its own text;
a row without identifier gets a null component and links nothing. An empty table gives no rows. Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispensa.llm import packed
from dispensa.llm.components import connected
from dispensa.llm.words import Words, mix
from dispensa.sources.staging import Staging

STAR_ROUNDS = 2
LEADS = 12
LINEAR = 2  # pairs for each post that are enumerated at once
SKETCH = 32
_COUNTED = np.uint64(0xFFFFFFFFFF000000)  # 40 bits name a shingle while counting; they only order it
_SETS = (
    "doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint, "
    "prefix array<struct<shingle:bigint,at:int>>, sketch array<int>, members array<bigint>"
)


class _Sets:
    """The sorted distinct shingles of each text of a block: text t has ``items[first[t]:first[t + 1]]``."""

    def __init__(self, texts: pa.ChunkedArray, n: int):
        words = Words(texts, lower=True)
        at, hashes = words.windows(n)
        owner = words.owner()[at]
        short = np.flatnonzero((words.counts > 0) & (words.counts < n))
        hashes = np.concatenate([hashes, words.spans(words.first[short], words.first[short + 1])])
        owner = np.concatenate([owner, short])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.items, self.owner = hashes[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(words.counts))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return total[self.first[1:]] - total[self.first[:-1]]


def _ask(n: int, parts: int):
    def work(block: int, rows: pa.Table) -> pa.Table:
        hashes, counts = np.unique(_Sets(rows["text"], n).items & _COUNTED, return_counts=True)
        return packed.question(block, 0, hashes, counts, parts)

    return work


def _sets(n: int, t: Fraction, parts: int):
    def work(block: int, rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = packed.ordered(rows, ["doc_id", "text"])
        sets = _Sets(rows["text"], n)
        asked, place = np.unique(sets.items & _COUNTED, return_inverse=True)
        held = packed.answers(told, 0, asked, parts)[place]
        rank = np.lexsort((sets.items, held, sets.owner))  # rarest first, within each text
        items, held = sets.items[rank], held[rank]
        at = np.arange(len(items)) - sets.first[:-1][sets.owner]
        # n - ceil(t n) + 1, in whole numbers
        reach = sets.sizes + (-sets.sizes * t.numerator) // t.denominator + 1
        sent = (at < reach[sets.owner]) & (held > 1)
        c1, c2 = sets.sums(mix(sets.items)), sets.sums(mix(sets.items ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        sketch = np.zeros((rows.num_rows, SKETCH), dtype=np.int32)
        np.add.at(sketch, (sets.owner, (sets.items >> np.uint64(59)).astype(np.int64)), 1)
        # Equal sets in one block: the first document with an identifier sends for them.
        known = pc.is_valid(rows["doc_id"]).to_numpy(zero_copy_only=False)
        first: dict[tuple[int, int], int] = {}
        for i in np.flatnonzero(known & (sets.sizes > 0)):
            first.setdefault((int(c1[i]), int(c2[i])), int(i))
        speaks = np.zeros(rows.num_rows, dtype=bool)
        speaks[list(first.values())] = True
        speaks &= np.bincount(sets.owner[sent], minlength=rows.num_rows) > 0
        sent &= speaks[sets.owner]
        shingles = pa.StructArray.from_arrays(
            [pa.array(items[sent].view(np.int64)), pa.array(at[sent].astype(np.int32))], names=["shingle", "at"]
        )
        whole = speaks[sets.owner]
        return pa.table(
            {
                "doc_id": rows["doc_id"].cast(pa.int64()),
                "n_shingles": pa.array(sets.sizes.astype(np.int64)),
                "c1": pa.array(c1.view(np.int64)),
                "c2": pa.array(c2.view(np.int64)),
                "prefix": _lists(np.bincount(sets.owner[sent], minlength=rows.num_rows), shingles),
                "sketch": _lists(np.where(speaks, SKETCH, 0), pa.array(sketch[speaks].ravel())),
                "members": _lists(np.where(speaks, sets.sizes, 0), pa.array(sets.items[whole].view(np.int64))),
            }
        )

    return work


def _lists(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), values)


def _possible(t: Fraction, a: str, b: str, at: bool = False) -> str:
    """SQL: sizes (and, with ``at``, the places of a common shingle) allow the similarity t.

    Sets of n and m need t / (1 + t) (n + m) common shingles to reach it; when the first common one stands
    at places i and j (from 0), no more than min(n - i, m - j) can follow.
    """
    p, q = t.numerator, t.denominator
    need = f"{p} * ({a}.n + {b}.n)"
    if at:
        return f"{need} <= {p + q} * least({a}.n - {a}.at, {b}.n - {b}.at)"
    return f"{p} * greatest({a}.n, {b}.n) <= {q} * least({a}.n, {b}.n)"


def _verified(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity."""
    p, q = t.numerator, t.denominator
    left = sets.selectExpr("rep as a", "n as n_a", "sketch as s_a", "members as m_a")
    right = sets.selectExpr("rep as b", "n as n_b", "sketch as s_b", "members as m_b")
    # Suffix filter: the common shingles number no more than the smaller count in each part of the hash range.
    bound = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    near = (p * (F.col("n_a") + F.col("n_b"))) <= (p + q) * bound
    found = F.size(F.array_intersect("m_a", "m_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(near).where((p * (F.col("n_a") + F.col("n_b"))) <= (p + q) * found).select("a", "b")


def similarity_components(
    docs: DataFrame,
    staging: Staging,
    n: int = 5,
    threshold: Fraction = Fraction(3, 4),
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id): the smallest identifier each document is linked to, directly or not."""
    blocks, parts = packed.blocked(docs, key, text), packed.parts_of(docs)
    replies = packed.tallied(packed.each_block(blocks, _ask(n, parts), packed.ASKED))
    table = staging.keep(packed.with_answers(blocks, replies, _sets(n, threshold, parts), _SETS), "sets")

    classes = table.where("n_shingles > 0 and doc_id is not null").groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"))
    # The least identifier of a class is also the first in its block, so it is among those that send.
    sets = table.where("size(members) > 0").join(classes, ["c1", "c2"]).where("doc_id = rep")
    sets = staging.keep(sets.select("rep", F.col("n_shingles").alias("n"), "prefix", "sketch", "members"), "senders")
    posts = sets.select("rep", "n", F.inline("prefix")).withColumn("part", F.col("rep"))
    shared = posts.groupBy("shingle").agg(F.count("*").alias("held")).where("held > 1").select("shingle")
    posts = staging.keep(posts.join(shared, "shingle"), "posts")

    posts = staging.keep(_with_partners(posts, threshold), "reaching")
    links, groups, turn = None, None, 0
    while not posts.isEmpty():
        last = turn == STAR_ROUNDS or _is_linear(posts)
        pairs = _across(posts, threshold) if last else _stars(posts, turn, threshold)
        found = staging.keep(_verified(pairs.distinct(), sets, threshold), "links")
        links = found if links is None else links.unionByName(found)
        groups = connected(links, staging)
        if last:
            break
        turn += 1
        posts = staging.keep(_with_partners(_open(posts, groups), threshold), "open")
    merged = sets.select("rep").limit(0).selectExpr("rep as node", "rep as component") if groups is None else groups
    named = classes.join(merged, classes["rep"] == merged["node"], "left").select(
        "c1", "c2", F.coalesce("component", "rep").alias("found")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return table.select("doc_id", "n_shingles", "c1", "c2").join(named, ["c1", "c2"], "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )


def _is_linear(posts: DataFrame) -> bool:
    """Whether the pairs of documents of a shingle that lie in two components are few beside the posts."""
    parts = posts.groupBy("shingle", "part").agg(F.count("*").cast("double").alias("m"))
    pairs = parts.groupBy("shingle").agg(((F.sum("m") ** 2 - F.sum(F.col("m") ** 2)) / 2).alias("pairs"), F.sum("m").alias("m"))
    total, rows = pairs.agg(F.sum("pairs"), F.sum("m")).first()
    return total <= LINEAR * rows


def _open(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """The posts with the component of their document."""
    marked = posts.drop("part").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    return marked.select("shingle", "rep", "n", "at", F.coalesce("component", "rep").alias("part"))


def _with_partners(posts: DataFrame, t: Fraction) -> DataFrame:
    """The posts that may link with another component's at their shingle.

    The shingle must hold two components, and the sizes and places must allow the similarity with the most
    that any other document there can offer: the smallest set, and the most shingles from this one on.
    """
    p, q = t.numerator, t.denominator
    best = posts.groupBy("shingle").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("n").alias("least"), F.max(F.expr("n - at")).alias("rest")
    )
    reach = posts.join(best.where("lo < hi").select("shingle", "least", "rest"), "shingle")
    return reach.where(f"{p} * (n + least) <= {p + q} * least(n - at, rest)").select(*posts.columns)


def _stars(posts: DataFrame, turn: int, t: Fraction) -> DataFrame:
    """Pairs of each document of a shingle with ``LEADS`` of them, others in each turn.

    The first is the smallest one, which is likeliest to link with documents that share nothing else there.
    """
    one = F.struct("rep", "n", "at", "part")
    orders = [F.struct(F.xxhash64("rep", F.lit(turn * LEADS + k)), F.col("rep")) for k in range(1, LEADS)]
    orders.append(F.struct("n", "rep") if turn == 0 else F.struct(F.xxhash64("rep", F.lit(turn * LEADS)), F.col("rep")))
    leads = posts.groupBy("shingle").agg(F.array(*[F.min_by(one, order) for order in orders]).alias("leads"))
    leads = leads.select("shingle", F.inline(F.array_distinct("leads")))
    pairs = posts.alias("x").join(leads.alias("y"), "shingle").where("x.part <> y.part")
    return _ends(pairs.where(_possible(t, "x", "y")).where(_possible(t, "x", "y", at=True)))


def _across(posts: DataFrame, t: Fraction) -> DataFrame:
    """All pairs of documents of a shingle that lie in two components."""
    left = _asking(posts, t)
    right = posts.withColumnRenamed("part", "other")
    pairs = left.alias("x").join(right.alias("y"), ["shingle", "other"])
    return _ends(pairs.where(_possible(t, "x", "y")).where(_possible(t, "x", "y", at=True)))


def _asking(posts: DataFrame, t: Fraction) -> DataFrame:
    """Of two components at a shingle, the posts of the one that has fewer there, with the ``other`` that they may meet.

    So a large component is not repeated for each of the small ones beside it.
    """
    parts = posts.groupBy("shingle", "part").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.expr("n - at")).alias("rest"), F.count("*").alias("m")
    )
    p, q = t.numerator, t.denominator
    two = parts.alias("v").join(parts.alias("w"), "shingle").where("v.m < w.m or (v.m = w.m and v.part < w.part)")
    # The filters of single documents, for the best that any two of the components can offer.
    two = two.where(f"{p} * w.lo <= {q} * v.hi and {p} * v.lo <= {q} * w.hi")
    two = two.where(f"{p} * (v.lo + w.lo) <= {p + q} * least(v.rest, w.rest)")
    two = two.selectExpr("shingle", "v.part as part", "w.part as other", "w.lo as lo", "w.hi as hi", "w.rest as rest")
    asking = two.join(posts, ["shingle", "part"]).where(f"{p} * lo <= {q} * n and {p} * n <= {q} * hi")
    # The same for a document and the best that the other component can offer it.
    return asking.where(f"{p} * (n + lo) <= {p + q} * least(n - at, rest)").select("shingle", "other", "rep", "n", "at")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"))
