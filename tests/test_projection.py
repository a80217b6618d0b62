"""Projection rules on hand-made rows, and properties of a whole run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dispensa.catalog import projection as catalog
from dispensa.operators import levels as lv
from dispensa.plans import projection as pj
from dispensa.sources.tables import control_value

CELL = "PdID int, Region string, TSC int, Chain int, PackID int, Brand string, ATC1 string, ATC2 string, ATC3 string, ATC4 string, Basket string, Rx string, Class string, UnvrsUnits bigint, PanelUnits bigint, onPanel int, inPanel int"


def months(spark, n=9):
    return spark.createDataFrame([(n,)], "MthsAvg int")


def cell(pack, cls, brand="B1", atc4="N02B", basket="K1", units=90, panel=45, in_panel=1, region="R"):
    return (1, region, 2, 1, pack, brand, atc4[:1], atc4[:3], atc4[:4], atc4, basket, "1", cls, units, panel, 1, in_panel)


def attach(spark, cells, fix=False):
    df = spark.createDataFrame(cells, CELL)
    means = lv.level_means(df, months(spark), pj.UNITS)
    prefixes = {"Unvrs": "UnvrsUnits", "Panel": "PanelUnits"}
    return lv.attach_levels(df.drop(*pj.UNITS), means, prefixes, fix)


def test_month_index_and_window(spark):
    periods = spark.createDataFrame([(p,) for p in ("201611", "201612", "201701", "201703")], "PdID string")
    numbered = pj.month_index(periods)
    assert {r["PdID"]: r["PdNbr"] for r in numbered.collect()} == {"201611": 11, "201612": 12, "201701": 13, "201703": 15}
    oper = spark.createDataFrame([(201703,), (201702,)], "pd_id int")
    got = pj.expand_periods(numbered, oper, months(spark, 3))
    assert sorted(tuple(r) for r in got.collect()) == [(12, "201612", 15, 201703), (13, "201701", 15, 201703)]
    short = pj.window_periods(periods, oper, months(spark, 3))
    assert sorted((r["PdID"], r["ProcPdID"]) for r in short.collect()) == [("201612", 201703), ("201701", 201703)]


def test_window_of_the_worked_example(spark):
    periods = spark.createDataFrame([(str(y * 100 + m),) for y in (2016, 2017) for m in range(1, 13)], "PdID string")
    oper = spark.createDataFrame([(201707,), (201711,)], "pd_id int")
    got = pj.window_periods(periods, oper, months(spark)).groupBy("ProcPdID").agg(F.min("PdID"), F.max("PdID"), F.count("*"))
    assert sorted(tuple(r) for r in got.collect()) == [(201707, "201610", "201706", 9), (201711, "201702", "201710", 9)]


@pytest.mark.parametrize("values", [[], ["9", "8"]])
def test_control_table_must_have_one_row(spark, values):
    control = spark.createDataFrame([("MthsAvg", v) for v in values] + [("Other", "1")], "param string, val string")
    with pytest.raises(Exception, match="one row for MthsAvg"):
        control_value(control, "MthsAvg", "int", "MthsAvg").collect()


def test_shop_base_folds_regions_and_keeps_unmapped_shops(spark):
    shops = spark.createDataFrame([("1", 10), ("2", 11), ("3", None)], "imscode string, brick int")
    bricks = spark.createDataFrame([(10, 1), (11, 2)], "brick1 int, tcode int")
    names = spark.createDataFrame([(1, "DOĞU ANADOLU"), (2, "EGE")], "brickcode int, bolge string")
    got = {r["imscode"]: (r["Region"], r["onUnvrs"], r["onPanel"]) for r in pj.shop_base(shops, bricks, names).collect()}
    assert got == {"1": ("DOĞU/GÜNEYDOĞU ANADOLU", 1, 1), "2": ("EGE", 1, 1), "3": (None, 1, 1)}


def test_size_classes_with_ties(spark, staging):
    imputed = spark.createDataFrame([("R", i, 1, 10) for i in range(10)], "Region string, ShopID int, onPanel int, Units bigint")
    shops = pj.size_class(pj.cumulative_units(imputed, staging))
    assert {r["ShopID"]: r["TSC"] for r in shops.collect()} == {i: 3 if i < 4 else 2 if i < 8 else 1 for i in range(10)}


def test_regions_without_a_median_drop_out(spark, staging):
    rows = [(1, "A", 1, 4), (2, "A", 1, 5), (3, "A", 1, None), (4, "B", 1, None), (5, None, 1, 8)]
    shops = spark.createDataFrame(rows, "ShopID int, Region string, onPanel int, Units bigint")
    got = pj.impute_units(shops, pj.region_median(shops, staging))
    assert sorted((r["ShopID"], r["Units"]) for r in got.collect()) == [(1, 4), (2, 5), (3, 4)]


def test_projection_class_of_every_flag(spark):
    flags = ["pfc", "Brand", "atc1", "ATC2", "atc3", "atc4", "basket", "rx", "odd", None]
    packs = spark.createDataFrame(
        [(f"{i:08d}", "BR", "N02BE", "PRESC") for i in range(len(flags) + 1)],
        "bridge_code string, prod_desc string, class_code string, pack_flag string",
    )
    pfg = spark.createDataFrame([(str(i), "K") for i in range(len(flags) + 1)], "pfc string, pfg string")
    prod_flag = spark.createDataFrame([(str(i), f) for i, f in enumerate(flags)], "pfc string, prod_flag string")
    got = {r["PackID"]: r["Class"] for r in pj.pack_hierarchy(packs, pfg, prod_flag).collect()}
    assert got == dict(enumerate(["0", "BR", "N", "N02", "N02B", "N02BE", "K", "1", "K", "K", "K"]))


def test_eight_digit_pack_codes(spark):
    """Turnover matches the last seven digits of a code, the universe the first seven of the number."""
    monthly = spark.createDataFrame(
        [("201701", "0000001", "1234567", 1), ("201701", "0000001", "2345678", 10), ("201701", "0000001", "0000042", 100)],
        "period string, customer_code string, pfc string, total_unit int",
    )
    window = spark.createDataFrame([("201701", 201702)], "PdID string, ProcPdID int")
    shops = spark.createDataFrame([(1, "R", 2, 1, 1)], "ShopID int, Region string, TSC int, Chain int, onPanel int")
    packs = spark.createDataFrame([(12345678,), (42,)], "PackID int")
    got = pj.universe(monthly, window, shops, packs)
    assert sorted((r["PackID"], r["Units"]) for r in got.collect()) == [(42, 100), (12345678, 1)]
    raw = spark.createDataFrame([("12345678",), ("00000042",)], "bridge_code string")
    base = spark.createDataFrame([("0000001", "R", 1, 1)], "imscode string, Region string, onUnvrs int, onPanel int")
    oper = spark.createDataFrame([(201802,)], "pd_id int")
    sales = pj.shop_sales(monthly, raw, base, oper, window)
    assert [r["Units"] for r in pj.prior_year_turnover(sales).collect()] == [110]


def test_level_means_truncate_after_the_sum(spark):
    cells = [cell(1, "K1", units=8, panel=8), cell(2, "K1", units=8, panel=None), cell(3, "K1", brand="B2", units=8, panel=8)]
    means = lv.level_means(spark.createDataFrame(cells, CELL), months(spark), pj.UNITS)
    got = {(r["Level"], r["Value"]): (r["UnvrsUnits"], r["PanelUnits"]) for r in means.collect()}
    assert got[("Brand", "B1")] == (1, 0) and got[("Brand", "B2")] == (0, 0) and got[("Basket", "K1")] == (2, 1)


def test_class_mean_is_looked_up_by_brand_unless_fixed(spark):
    cells = [cell(7, "7", brand="B1", units=90), cell(8, "8", brand="7", units=900)]
    written = {r["PackID"]: r["UnvrsWxClassUnits"] for r in attach(spark, cells).collect()}
    assert written == {7: None, 8: 10}  # pack 8 has the brand '7' and gets the mean of class '7'
    fixed = {r["PackID"]: r["UnvrsWxClassUnits"] for r in attach(spark, cells, fix=True).collect()}
    assert fixed == {7: 10, 8: 100}


def test_equal_values_take_the_first_level(spark):
    """A four-character code makes ATC4 and ATC3 equal, and a short brand can equal them too."""
    cells = [cell(1, "N02B", brand="X", atc4="N02B", units=9), cell(2, "K1", brand="Y", atc4="N02B", units=18)]
    cells += [cell(3, "N02B", brand="N02B", atc4="N02BE", units=90)]
    got = {r["PackID"]: r["UnvrsWxClassUnits"] for r in attach(spark, cells).collect()}
    assert got[1] == 3  # ATC4 'N02B': packs 1 and 2
    assert got[3] == 10  # brand 'N02B': pack 3 alone


def test_null_level_values_find_nothing(spark):
    cells = [cell(1, "K1", brand=None), cell(2, "K1", brand=None)]
    means = lv.level_means(spark.createDataFrame(cells, CELL), months(spark), pj.UNITS)
    assert means.where("Level = 'Brand' and Value is null").count() == 1
    assert {r["UnvrsWxBrandUnits"] for r in attach(spark, cells).collect()} == {None}


def test_fallback_takes_each_level_in_turn(spark):
    """Orphans whose panel mean is zero or missing at ever more levels."""
    triple = "PdID int, ShopID int, PackID int, Region string, TSC int, Chain int, Brand string, ATC1 string, ATC2 string, ATC3 string, ATC4 string, Basket string, Rx string, Class string"
    means = ", ".join(f"UnvrsWx{v}Units bigint, PanelWx{v}Units bigint" for v in lv.ALL_LEVELS)
    rows = []
    for k in range(len(lv.ALL_LEVELS) + 1):
        values = []
        for i in range(len(lv.ALL_LEVELS)):
            values += [10 * (i + 1), (0 if i % 2 else None) if i < k else 4]
        rows.append((1, 5, k, "R", 2, 1, "brand", "a1", "a2", "a3", "a4", "basket", "rx", "class", *values))
    got = {r["PackID"]: (r["PF"], r["Class"]) for r in pj.factor_orphan(spark.createDataFrame(rows, f"{triple}, {means}")).collect()}
    names = ["class", "brand", "a4", "a3", "a2", "a1", "basket", "rx"]
    assert got == {k: (10 * (k + 1) / 4, names[k]) for k in range(8)} | {8: (None, None)}


def test_lookup_multiplies_rows_like_two_joins(spark):
    """Two panel values and two universe values of one class give four rows."""
    cells = [
        cell(1, "X", brand="X", units=90, panel=90),
        cell(2, "X", brand="B", basket="X", units=180, panel=180),
    ]
    attached = attach(spark, cells)
    lookup = pj.fallback_lookup(attached)
    of_class = lookup.where("Level = 'Class' and Value = 'X'")
    pairs = sorted((r["PanelUnits"], r["UnvrsUnits"]) for r in of_class.collect())
    assert pairs == [(10, 10), (10, 20), (20, 10), (20, 20)]


def test_regular_factor_is_null_for_an_empty_panel_mean(spark):
    schema = "PdID int, ShopID int, PackID int, Region string, TSC int, Chain int, Class string, PanelWxClassUnits bigint"
    rows = [(1, 1, 1, "R", 2, 1, "K", 4), (1, 2, 1, "R", 2, 1, "K", 0), (1, 3, 1, "R", 2, 1, "K", None), (1, 3, 1, "R", 2, 1, "K", None)]
    rows += [(1, 4, 2, "R", 2, 1, "L", 2), (1, 5, 3, "R", 2, 1, None, 2), (1, 6, 4, "R", 2, 1, "M", 2)]
    unvrs = spark.createDataFrame(
        # A class of one mean twice, one of three means, null among them, and rows without a class.
        [(1, "R", 2, 1, c, m) for c, m in (("K", 10), ("K", 10), ("L", 4), ("L", 6), ("L", None), (None, 8))],
        "PdID int, Region string, TSC int, Chain int, Class string, UnvrsWxClassUnits bigint",
    )
    means = pj.with_class_means(unvrs)
    assert means.count() == 6
    known = means.select("Class", "ClassMeans").where("Class is not null").distinct()
    panel = spark.createDataFrame(rows, schema).join(known, "Class", "left")
    got = sorted(((r["ShopID"], r["PF"]) for r in pj.factor_regular(panel).collect()), key=str)
    assert got == [(1, 2.5), (2, None), (3, None), (4, 2.0), (4, 3.0), (4, None)]


def test_swapped_period(spark):
    got = spark.sql("select date '2017-03-11' as d").select(pj.swapped_period(F.col("d")).alias("p")).first()
    assert got["p"] == 201711


@pytest.fixture(scope="module")
def job(spark, folder):
    return catalog.run(spark, folder)


def test_every_panel_triple_has_a_factor(job):
    panel = {tuple(r) for r in job.panel().collect()}
    rows = job.factors().collect()
    regular = {(r["PdID"], r["ShopID"], r["PackID"]) for r in rows if r["Orphan"] == 0}
    orphan = {(r["PdID"], r["ShopID"], r["PackID"]) for r in rows if r["Orphan"] == 1}
    assert regular | orphan == panel and not regular & orphan


def test_size_classes_cover_all_shops(job):
    check = pj.size_class_check(job.shops()).collect()
    assert all(r["Stores_TSC1"] + r["Stores_TSC2"] + r["Stores_TSC3"] == r["Stores_TOT"] for r in check)
    assert sum(r["Stores_TOT"] for r in check) == job.shops().count()
    top = job.cumulative().agg(F.max("UnitsCUM")).first()[0]
    assert top == job.imputed().agg(F.sum("Units")).first()[0]


def test_universe_24_reads_the_sellin_once(spark, folder, monkeypatch):
    from dispensa.catalog import all_queries

    calls, once = [], pj.monthly_sellin
    monkeypatch.setattr(pj, "monthly_sellin", lambda *a: calls.append(a) or once(*a))
    assert all_queries()["universe_24"].run(spark, folder).count() > 0
    assert len(calls) == 1
