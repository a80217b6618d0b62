"""Exact distinct counts that add up: bitmaps of whole numbers, merged upwards without the rows.

A count of distinct values can't be summed from months to quarters; the sets can be united. A set is kept as bitmaps of
4 KB, one for each bucket of 32,768 numbers that it touches, built with partial bitmaps on the map side. Several
measures pass as rows of one table, so no plan expands the fact once for each. A group of any size is a few bitmaps.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """(keys, measure, bucket, bits): the sets of the measures' values per group.

    Measures are columns of whole numbers; a null is in no set, but its group is there, with an empty one.
    """
    values = F.array(*[F.struct(F.lit(name).alias("measure"), c.cast("bigint").alias("value")) for name, c in measures.items()])
    long = rows.select(*keys, F.inline(values))
    bucket = F.coalesce(F.bitmap_bucket_number("value"), F.lit(0))
    return long.groupBy(*keys, "measure", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
    )


def merged(sets: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """The united sets of coarser groups."""
    return sets.groupBy(*keys, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(sets: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group with a column for each measure: how many distinct values its set has."""
    sums = {m: F.sum(F.when(F.col("measure") == m, F.bitmap_count("bits"))) for m in measures}
    return sets.groupBy(*keys).agg(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(m) for m, c in sums.items()])


def distinct_counts(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Per group the number of distinct values of each measure, all in one pass without a row per measure and value."""
    return counts(bitmaps(rows, keys, measures), keys, list(measures))
