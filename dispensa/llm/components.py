"""Connected components of a link table, as rounds of joins and grouped minima.

Large-star and small-star rounds: first every node sends the least node of its neighbourhood to its
larger neighbours, then to its smaller ones. Both are a grouped minimum (combined before the shuffle) and
an equi-join, so a hub with a third of all links is split like any skewed join. Each round is a written
table in the shared folder; the driver only learns whether all trees are flat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispensa.sources.staging import Staging


def _done(edges: DataFrame) -> bool:
    """Whether every node hangs directly on one root."""
    ends = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    roots = edges.select(F.col("v").alias("x"), F.lit(None).cast(edges.schema["v"].dataType).alias("y"))
    seen = ends.unionByName(roots).groupBy("x").agg(
        F.min("y").alias("lo"), F.max("y").alias("hi"), F.count("y").alias("hangs"), F.count("*").alias("n")
    )
    return seen.where("hangs > 0 and (lo <> hi or n > hangs)").isEmpty()


def connected(links: DataFrame, staging: Staging) -> DataFrame:
    """(node, component): every node of the links (a, b) with the least node it is connected to.

    Links with a null end, from a node to itself, or repeated are left out. No links: no rows.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staging.keep(edges, "links")
    while not _done(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Used twice below; its shuffles are the same and run once.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staging.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
