"""Ranks, running sums and medians over groups too large for one task.

An unpartitioned window, or a window over a group that holds a third of all rows, sorts that
group in one task. Here the rows are range-partitioned on (group, order) first, and the number
of the range is stored with each row. A group then spans many ranges; a small table of totals
per range gives the offset at which each range starts, and the window runs inside a range.

The order must be unique within its group, which also makes the ranges even.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispensa.functions.compat import int_div
from dispensa.sources.staging import Staging

RANGE = "_range"


def place(df: DataFrame, group: Sequence[str], order: Sequence[Column], staging: Staging, name: str) -> DataFrame:
    """Store ``df`` with the number of the range of (group, order) that each row falls into."""
    placed = df.repartitionByRange(*[F.col(g) for g in group], *order)
    return staging.keep(placed.withColumn(RANGE, F.spark_partition_id()), name)


def _range_offsets(placed: DataFrame, group: Sequence[str], value: Column) -> DataFrame:
    """Per (group, range): ``_size`` = sum of ``value``, ``_before`` = that sum over earlier ranges."""
    sizes = placed.groupBy(*group, RANGE).agg(F.sum(value).alias("_size"))
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))


def _join_ranges(placed: DataFrame, side: DataFrame, group: Sequence[str], staging: Staging) -> DataFrame:
    """Add the columns of ``side``, which has at most one row per (group, range).

    Without a group there are no more ranges than shuffle partitions. With groups their number is
    not known, so the side is stored, and the planner broadcasts it only where it is small.
    """
    keys = [*group, RANGE]
    renamed = side.withColumnsRenamed({k: f"_o{k}" for k in keys})
    renamed = staging.keep(renamed, "ranges") if group else F.broadcast(renamed)
    on = " and ".join(f"{k} <=> _o{k}" for k in keys)
    return placed.join(renamed, F.expr(on)).drop(*[f"_o{k}" for k in keys])


def running_sums(
    df: DataFrame, values: Mapping[str, str], order: Sequence[Column], staging: Staging, group: Sequence[str] = ()
) -> DataFrame:
    """Add for each (value, into) the sum of ``value`` over the rows of the group up to and including this one."""
    placed = place(df, group, order, staging, f"placed_{'_'.join(values.values())}")
    sizes = placed.groupBy(*group, RANGE).agg(*[F.sum(v).alias(f"_size_{i}") for i, v in enumerate(values)])
    earlier = Window.partitionBy(*group).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *group, RANGE, *[F.sum(f"_size_{i}").over(earlier).alias(f"_before_{i}") for i in range(len(values))]
    )
    rows = _join_ranges(placed, offsets, group, staging)
    upto = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = {
        into: F.coalesce(f"_before_{i}", F.lit(0)) + F.coalesce(F.sum(value).over(upto), F.lit(0))
        for i, (value, into) in enumerate(values.items())
    }
    return rows.withColumns(sums).drop(RANGE, *[f"_before_{i}" for i in range(len(values))])


def running_sum(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    into: str,
    staging: Staging,
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the rows of the group up to and including this one."""
    placed = place(df, group, order, staging, f"placed_{into}")
    rows = _join_ranges(placed, _range_offsets(placed, group, F.col(value)).drop("_size"), group, staging)
    upto = Window.partitionBy(*group, RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(into, F.col("_before") + F.sum(value).over(upto)).drop(RANGE, "_before")


def row_numbers(
    df: DataFrame, order: Sequence[Column], into: str, staging: Staging, group: Sequence[str] = ()
) -> DataFrame:
    """Add ``into``: the position of the row in its group, from 1."""
    placed = place(df, group, order, staging, f"placed_{into}")
    rows = _join_ranges(placed, _range_offsets(placed, group, F.lit(1)).drop("_size"), group, staging)
    inside = Window.partitionBy(*group, RANGE).orderBy(*order)
    return rows.withColumn(into, F.col("_before") + F.row_number().over(inside)).drop(RANGE, "_before")


def integer_median(
    df: DataFrame, group: Sequence[str], value: str, tie: Sequence[str], into: str, staging: Staging
) -> DataFrame:
    """Per group the mean of the middle one or two values of ``value``, truncated to an integer.

    Null values do not count. Only the one or two ranges that hold the middle of a group are
    sorted; the others are known by their size alone.
    """
    order = [F.col(value).asc(), *[F.col(t).asc() for t in tie]]
    measured = df.where(F.col(value).isNotNull()).select(*group, value, *tie)
    placed = place(measured, group, order, staging, f"placed_{into}")
    whole = Window.partitionBy(*group)
    offsets = _range_offsets(placed, group, F.lit(1)).withColumn("_n", F.sum("_size").over(whole))
    first = int_div(F.col("_n") + 1, F.lit(2))
    last = int_div(F.col("_n") + 2, F.lit(2))
    middle = offsets.where((F.col("_before") < last) & (F.col("_before") + F.col("_size") >= first))
    rows = _join_ranges(placed, middle.drop("_size"), group, staging)
    inside = Window.partitionBy(*group, RANGE).orderBy(*order)
    ranked = rows.withColumn("_rn", F.col("_before") + F.row_number().over(inside))
    return (
        ranked.where(F.col("_rn").between(first, last))
        .groupBy(*group)
        .agg(int_div(F.sum(value), F.count(value)).alias(into))
    )
