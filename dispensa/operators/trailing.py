"""Sums over trailing windows by difference events, whatever the length of the window.

Joining each row to all the windows it counts in multiplies it by the length of the window. Instead a row becomes two
events: its value comes in where its first window starts to hold it, and goes out behind its last window. A running sum
of the events is then the sum over the window at any point; a running count of rows beside it tells a window without
rows from one whose values cancel out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispensa.operators.ordered import running_sums
from dispensa.sources.staging import Staging


def events(rows: DataFrame, keys: Sequence[str], value: str, comes: Column, goes: Column, last: Column | None = None) -> DataFrame:
    """Events (keys, at, value, rows, known) of rows that count from ``comes`` up to before ``goes``, summed by point.

    Events behind ``last`` are left out. ``known`` counts the rows whose value is not null.
    """
    one = F.when(F.col(value).isNotNull(), 1).otherwise(0)
    entry = lambda at, sign: F.struct(
        at.alias("at"), (F.lit(sign) * F.coalesce(value, F.lit(0))).alias("value"), F.lit(sign).alias("rows"), (F.lit(sign) * one).alias("known")
    )
    both = F.array(entry(comes, 1), entry(goes, -1))
    if last is not None:
        both = F.filter(both, lambda e: e["at"] <= last)
    spread = rows.select(*keys, F.inline(both))
    return spread.groupBy(*keys, "at").agg(*[F.sum(c).alias(c) for c in ("value", "rows", "known")])


def sums_at(changes: DataFrame, keys: Sequence[str], points: DataFrame, point: str, into: str) -> DataFrame:
    """(keys, point, into): the sums at each point of a short list, where some row counts.

    ``changes`` are events; a key has few of them, at most two a point. Between two events the sums stand still, so each
    event answers for the points up to the next one.
    """
    upto = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead("at").over(Window.partitionBy(*keys).orderBy("at"))
    states = changes.select(*keys, "at", following.alias("_next"), *[F.sum(c).over(upto).alias(c) for c in ("value", "rows", "known")])
    listed = F.broadcast(points.agg(F.array_sort(F.collect_set(point)).alias("_points")))  # one row, the list of a run
    held = F.filter("_points", lambda p: (p >= F.col("at")) & (F.col("_next").isNull() | (p < F.col("_next"))))
    return (
        states.where("rows > 0")
        .crossJoin(listed)
        .select(F.explode(held).alias(point), *keys, F.when(F.col("known") > 0, F.col("value")).alias(into))
    )


def trailing_sums(
    rows: DataFrame, keys: Sequence[str], at: str, value: str, size: int, into: str, staging: Staging
) -> DataFrame:
    """Add ``into``: the sum of ``value`` over the key's rows at ``at - size`` up to ``at - 1``; null without such rows.

    ``at`` is a whole number, a month or a day, and unique within the key, which may have any number of rows. Three rows
    pass for each one, whatever the size: where it comes, where it goes, and where it asks.
    """
    own = rows.select(*keys, F.col(at).alias("at"), F.lit(0).alias("value"), F.lit(0).alias("rows"), F.lit(0).alias("known"))
    changes = events(rows, keys, value, F.col(at) + 1, F.col(at) + size + 1)
    both = changes.withColumn("asks", F.lit(0)).unionByName(own.withColumn("asks", F.lit(1)))
    points = both.groupBy(*keys, "at").agg(*[F.sum(c).alias(c) for c in ("value", "rows", "known")], F.max("asks").alias("asks"))
    running = {"value": "_value", "known": "_known"}
    found = running_sums(points, running, [F.col("at")], staging, list(keys)).where("asks = 1")
    sums = found.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("at").alias("_at"), F.when(F.col("_known") > 0, F.col("_value")).alias(into)
    )
    same = " and ".join([*[f"{k} <=> _{k}" for k in keys], f"{at} = _at"])
    return rows.join(sums, F.expr(same), "left").drop(*[f"_{k}" for k in keys], "_at")
