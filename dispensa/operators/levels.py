"""Means of units at several product levels, and their attachment to packs.

A mean belongs to a stratum (period, region, size class, chain) and one value of one level.
Everything here works on rows of one (stratum, pack): units are summed to that grain once, so
neither the eightfold level expansion nor the joins see a row per shop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dispensa.functions.compat import int_div

STRATUM = ("PdID", "Region", "TSC", "Chain")
# Fallback order of the product levels, from the finest to the coarsest.
LEVELS = ("Brand", "ATC4", "ATC3", "ATC2", "ATC1", "Basket", "Rx")
ALL_LEVELS = ("Class", *LEVELS)


def level_means(cells: DataFrame, months: DataFrame, units: Sequence[str]) -> DataFrame:
    """Long table (stratum, Level, Value, *units): summed units divided by the months, truncated.

    ``cells`` has a stratum, the eight level columns, the ``units`` columns and onPanel;
    ``months`` is one row (MthsAvg). Null values of a level form a group, which no equality join
    finds later. onPanel is 1 where some cell of the group has it.
    """
    long = cells.unpivot([*STRATUM, "onPanel", *units], list(ALL_LEVELS), "Level", "Value")
    sums = long.groupBy(*STRATUM, "Level", "Value").agg(
        F.max("onPanel").alias("onPanel"), *[F.sum(u).alias(u) for u in units]
    )
    return sums.crossJoin(F.broadcast(months)).select(
        *STRATUM, "Level", "Value", "onPanel", *[int_div(F.col(u), F.col("MthsAvg")).alias(u) for u in units]
    )


def one_level(means: DataFrame, level: str, units: str, into: str) -> DataFrame:
    """The means of one level as a table of its own."""
    return means.where(f"Level = '{level}'").selectExpr(*STRATUM, f"Value as {level}", f"{units} as {into}")


def join_level(rows: DataFrame, means: DataFrame, level: str, level_column: str, **values: str) -> DataFrame:
    """Left join of the means of ``level``; ``values`` maps columns of the means to new names."""
    keys = (*STRATUM, "Value")
    side = means.where(f"Level = '{level}'").selectExpr(
        *[f"{k} as _{k}" for k in keys], *[f"{column} as {into}" for column, into in values.items()]
    )
    mine = (*STRATUM, level_column)
    on = " and ".join(f"{m} = _{k}" for m, k in zip(mine, keys, strict=True))
    return rows.join(side, F.expr(on), "left").drop(*[f"_{k}" for k in keys])


def attach_levels(
    cells: DataFrame, means: DataFrame, units: Mapping[str, str], fix_class_key: bool = False
) -> DataFrame:
    """Add eight columns ``<prefix>Wx<level>Units`` per entry of ``units`` (prefix -> column of means).

    The class mean is looked up by Brand, as the published rule has it, unless ``fix_class_key``.
    The class column then takes the mean of the first level whose value equals the class.
    """
    own = {column: f"_own{prefix}" for prefix, column in units.items()}
    out = join_level(cells, means, "Class", "Class" if fix_class_key else "Brand", **own)
    for level in LEVELS:
        out = join_level(out, means, level, level, **{c: f"{p}Wx{level}Units" for p, c in units.items()})
    cases = {
        p: " ".join(f"when Class = {level} then {p}Wx{level}Units" for level in LEVELS) for p in units
    }
    return out.withColumns(
        {f"{p}WxClassUnits": F.expr(f"case {cases[p]} else _own{p} end") for p in units}
    ).drop(*own.values())


def distinct_values(rows: DataFrame, prefix: str) -> DataFrame:
    """Long distinct table (stratum, Level, Value, <prefix>Units) of attached level columns."""
    pairs = ", ".join(
        f"struct('{level}' as Level, {level} as Value, {prefix}Wx{level}Units as {prefix}Units)" for level in ALL_LEVELS
    )
    return rows.selectExpr(*STRATUM, f"inline(array({pairs}))").distinct()
