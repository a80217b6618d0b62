"""Exact distinct counts by bitmaps against sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dispensa.operators.distinct import bitmaps, counts, distinct_counts, merged
from dispensa.plans import projection as pj

SCHEMA = "month int, region string, shop bigint, pack int"


def made():
    rng = random.Random(1)
    # Values around the borders of buckets, negative ones, repeats, nulls, and a group without any value.
    near = [0, 1, -1, 32767, 32768, 32769, 65536, -32768, -32769, 10**12, 2**31]
    rows = [
        (rng.randint(1, 12), rng.choice(["a", "a", "b", None]), rng.choice([*near, rng.randint(0, 10**6), None]), rng.randint(0, 50))
        for _ in range(3000)
    ]
    return [*rows, (13, "c", None, None)]


def plain(rows, key):
    out = {}
    for r in rows:
        shops, packs = out.setdefault(key(r), (set(), set()))
        shops.add(r[2])
        packs.add(r[3])
    return {k: tuple(len(s - {None}) for s in v) for k, v in out.items()}


def test_counts_add_up_over_coarser_groups(spark, staging):
    rows = made()
    table = spark.createDataFrame(rows, SCHEMA).repartition(7)
    months = staging.keep(bitmaps(table, ["month"], {"shops": F.col("shop"), "packs": F.col("pack")}), "bitmaps")
    got = {r["month"]: (r["shops"], r["packs"]) for r in counts(months, ["month"], ["shops", "packs"]).collect()}
    assert got == plain(rows, lambda r: r[0])
    quarters = merged(months, [F.ceil(F.col("month") / 3).alias("quarter")])
    got = {r["quarter"]: (r["shops"], r["packs"]) for r in counts(quarters, ["quarter"], ["shops", "packs"]).collect()}
    assert got == plain(rows, lambda r: -(-r[0] // 3))
    # A month that is added later is united with the stored ones; the rows of the others are not read again.
    late = bitmaps(spark.createDataFrame([(14, "a", 77_000_000, 1)], SCHEMA), ["month"], {"shops": F.col("shop"), "packs": F.col("pack")})
    whole = counts(merged(months.unionByName(late), [F.lit(1).alias("all")]), ["all"], ["shops", "packs"]).first()
    assert (whole["shops"], whole["packs"]) == plain([*rows, (14, "a", 77_000_000, 1)], lambda r: 1)[1]


def test_all_measures_in_one_pass_without_expand(spark):
    rows = made()
    table = spark.createDataFrame(rows, SCHEMA)
    got = distinct_counts(table, ["region"], {"shops": F.col("shop"), "packs": F.col("pack")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan") == 1
    assert {r["region"]: (r["shops"], r["packs"]) for r in got.collect()} == plain(rows, lambda r: r[1])
    assert "Expand" in table.groupBy("region").agg(F.countDistinct("shop"), F.countDistinct("pack"))._jdf.queryExecution().executedPlan().toString()


def test_a_large_group_is_a_few_bitmaps(spark):
    table = spark.range(200_000).select(F.lit("hot").alias("k"), (F.col("id") % 100_000).alias("v"))
    sets = bitmaps(table, ["k"], {"n": F.col("v")})
    assert sets.count() == 5 and counts(sets, ["k"], ["n"]).first()["n"] == 100_000


def test_of_case_like_the_size_classes(spark):
    shops = spark.createDataFrame([(i % 40, "R" if i % 3 else "S", i % 40 % 3 + 1) for i in range(300)], "ShopID int, Region string, TSC int")
    want = {r["Region"]: tuple(r)[1:] for r in pj.size_class_check(shops).collect()}
    measures = {f"Stores_TSC{c}": F.when(F.col("TSC") == c, F.col("ShopID")) for c in (1, 2, 3)} | {"Stores_TOT": F.col("ShopID")}
    got = {r["Region"]: r.asDict() for r in distinct_counts(shops, ["Region"], measures).collect()}
    names = pj.size_class_check(shops).columns[1:]
    assert {k: tuple(v[n] for n in names) for k, v in got.items()} == want


@pytest.mark.parametrize("keys", [["month"], ["month", "region"]])
def test_no_rows(spark, keys):
    table = spark.createDataFrame([], SCHEMA)
    assert distinct_counts(table, keys, {"shops": F.col("shop")}).collect() == []
