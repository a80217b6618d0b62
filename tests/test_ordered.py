"""Ranks, running sums and medians against brute force, with hot groups and ties."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dispensa.operators import ordered


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small test data would otherwise end up in one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows(seed: int, n: int = 3000):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}"
        units = 7 if rng.random() < 0.3 else rng.randrange(-5, 400)
        out.append((group, i, units))
    return out


SCHEMA = "g string, id int, units int"


def by_units():
    return [F.col("units").desc(), F.col("id").asc()]


@pytest.mark.parametrize("seed", [1, 2])
def test_running_sum_without_group(spark, staging, seed):
    data = rows(seed)
    got = ordered.running_sum(spark.createDataFrame(data, SCHEMA), "units", by_units(), "upto", staging)
    want, total = {}, 0
    for _, i, units in sorted(data, key=lambda r: (-r[2], r[1])):
        total += units
        want[i] = total
    assert {r["id"]: r["upto"] for r in got.collect()} == want


def test_running_sum_per_group(spark, staging):
    data = rows(3)
    got = ordered.running_sum(spark.createDataFrame(data, SCHEMA), "units", by_units(), "upto", staging, ["g"])
    want, totals = {}, {}
    for g, i, units in sorted(data, key=lambda r: (r[0], -r[2], r[1])):
        totals[g] = totals.get(g, 0) + units
        want[i] = totals[g]
    assert {r["id"]: r["upto"] for r in got.collect()} == want


def test_row_numbers_per_group_and_null_group(spark, staging):
    data = [(None if g == "g1" else g, i, u) for g, i, u in rows(4)]
    got = ordered.row_numbers(spark.createDataFrame(data, SCHEMA), by_units(), "rn", staging, ["g"])
    want, seen = {}, {}
    for g, i, _ in sorted(data, key=lambda r: (r[0] or "", -r[2], r[1])):
        seen[g] = seen.get(g, 0) + 1
        want[i] = seen[g]
    assert {r["id"]: r["rn"] for r in got.collect()} == want


def test_order_of_input_does_not_matter(spark, staging):
    data = rows(5, 800)
    shuffled = data[:]
    random.Random(9).shuffle(shuffled)
    results = []
    for part in (data, shuffled):
        df = spark.createDataFrame(part, SCHEMA).repartition(7)
        ranked = ordered.row_numbers(df, by_units(), "rn", staging)
        results.append(sorted((r["id"], r["rn"]) for r in ranked.collect()))
    assert results[0] == results[1]


def test_ranges_are_ordered_and_even(spark, staging):
    df = spark.range(20000).select(F.lit(1).alias("same"), F.col("id"))
    placed = ordered.place(df, [], [F.col("same").asc(), F.col("id").asc()], staging, "even")
    sizes = placed.groupBy(ordered.RANGE).agg(F.count("*").alias("n"), F.min("id"), F.max("id")).collect()
    bounds = sorted((r[2], r[3]) for r in sizes)
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    assert len(sizes) > 1  # one value everywhere, and still several ranges


def brute_median(values):
    v = sorted(values)
    n = len(v)
    middle = v[(n + 1) // 2 - 1 : (n + 2) // 2]
    return int(sum(middle) / len(middle))


def test_integer_median(spark, staging):
    data = [(g, i, None if i % 11 == 0 else u) for g, i, u in rows(6)] + [("none", -1, None)]
    got = ordered.integer_median(spark.createDataFrame(data, SCHEMA), ["g"], "units", ["id"], "m", staging)
    groups = {}
    for g, _, u in data:
        if u is not None:
            groups.setdefault(g, []).append(u)
    assert {r["g"]: r["m"] for r in got.collect()} == {g: brute_median(v) for g, v in groups.items()}


@pytest.mark.parametrize(("values", "median"), [([4, 5], 4), ([1], 1), ([3, 1, 2], 2), ([-4, -5], -4), ([2, 2, 9, 9], 5)])
def test_small_medians(spark, staging, values, median):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], SCHEMA)
    got = ordered.integer_median(df, ["g"], "units", ["id"], "m", staging).collect()
    assert [tuple(r) for r in got] == [("a", median)]
