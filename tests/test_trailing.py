"""Trailing sums by difference events against plain sums over the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dispensa.operators import ordered
from dispensa.operators.trailing import trailing_sums


@pytest.mark.parametrize("size", [1, 9, 24])
@pytest.mark.parametrize("keys", [["k"], []])
def test_sums_over_rows_before(spark, staging, size, keys):
    rng = random.Random(size)
    rows = {}
    for _ in range(600):
        # A key with most rows, gaps, values that cancel out, nulls, a null key.
        k = rng.choice(["a", "a", "a", "b", None]) if keys else "a"
        rows[k, rng.randint(0, 400)] = rng.choice([None, -3, 0, 3, 7])
    table = spark.createDataFrame([(k, at, v, "x") for (k, at), v in rows.items()], "k string, at_month int, units int, other string")
    got = trailing_sums(table, keys, "at_month", "units", size, "before", staging)
    assert got.columns == ["k", "at_month", "units", "other", "before"]
    for r in got.collect():
        held = [rows[r["k"], m] for m in range(r["at_month"] - size, r["at_month"]) if rows.get((r["k"], m)) is not None]
        assert r["before"] == (sum(held) if held else None), r
    assert got.count() == len(rows)


def test_no_rows(spark, staging):
    table = spark.createDataFrame([], "k string, at_month int, units int")
    assert trailing_sums(table, ["k"], "at_month", "units", 9, "before", staging).collect() == []


def test_three_rows_for_each_whatever_the_size(spark, staging, monkeypatch):
    placed, place = [], ordered.place

    def noted(df, *args):
        placed.append(df.count())
        return place(df, *args)

    monkeypatch.setattr(ordered, "place", noted)
    table = spark.createDataFrame([(m,) for m in range(0, 4000, 40)], "m int").selectExpr("m", "1 as units")
    for size in (9, 24, 1000):
        trailing_sums(table, [], "m", "units", size, "before", staging)
    assert len(placed) == 3 and max(placed) <= 300


def test_running_sums(spark, staging):
    rows = [("a" if i % 3 else "b", i, i if i % 4 else None, 1) for i in range(200)]
    table = spark.createDataFrame(rows, "k string, i int, x int, y int").repartition(5)
    got = ordered.running_sums(table, {"x": "xs", "y": "ys"}, [F.col("i")], staging, ["k"])
    for r in got.collect():
        mine = [row for row in rows if row[0] == r["k"] and row[1] <= r["i"]]
        assert (r["xs"], r["ys"]) == (sum(row[2] or 0 for row in mine), len(mine))
