"""Sell-out mart rules on hand-made rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dispensa.plans import sellout as so

FACTS = "source string, period string, whs string, pfc string, pr_unit decimal(10,0), pr_bonus decimal(10,0)"
PRICES = "period string, prd_cd string, new_name string, prod_flag string, who_atc string, pub_price decimal(10,2), isf decimal(9,2)"


@pytest.fixture(scope="module")
def dims(spark):
    accounts = spark.createDataFrame(
        [("s1", "Shop 1", "u1"), ("s2", "Shop 2", "u2")], "account_code string, account_name string, universe_code string"
    )
    shops = spark.createDataFrame([("u1", 10)], "imscode string, brick int")
    bricks = spark.createDataFrame([(10, 1)], "brick1 int, tcode int")
    names = spark.createDataFrame([(1, "EGE")], "brickcode int, bolge string")
    atc = spark.createDataFrame(
        [("p1", "A", "A0", "A02", "A02B", "N", "N1", "N11")],
        "pfc string, atc1 string, atc2 string, atc3 string, atc4 string, nfc1 string, nfc2 string, nfc3 string",
    )
    prices = spark.createDataFrame(
        [
            ("2101", "p1", "Product 1", "F", "W", D("2.25"), D("1.00")),
            ("2101", "p2", "Twin", "F", "W", D("1.00"), D("1.00")),
            ("2101", "p2", "Twin", "G", "W", D("2.00"), D("1.00")),
            ("2102", "p1", "Product 1", "F", "W", D("3.00"), None),
        ],
        PRICES,
    )
    return {"prices": prices, "accounts": so.account_regions(accounts, shops, bricks, names), "atc_names": atc}


def facts(spark, rows):
    return spark.createDataFrame([(s, p, w, c, D(u), D(b)) for s, p, w, c, u, b in rows], FACTS)


def test_both_markets(spark, dims):
    rows = [
        ("T", "2101", "s1", "p1", 1, 1), ("R", "2101", "s1", "p1", 0, 0), ("P", "2101", "s1", "p1", 3, 0),
        ("RP", "2102", "s1", "p1", 4, 0), ("T", "2102", "s3", "p9", 5, 0), ("X", "2101", "s1", "p1", 99, 0),
    ]
    mart = so.sellout_mart(facts(spark, rows), **dims)
    assert [f.simpleString() for f in mart.schema.fields] == [
        c.strip().replace(" ", ":") for c in so.MART_SCHEMA.split(",")
    ]
    got = {(r["PazarTipi"], r["DONEM"]): r for r in mart.collect()}
    assert len(got) == 4
    drug = got[("ILAC", "2101")]
    assert (drug["YIL"], drug["KUTU"], drug["TL"]) == ("2021", 2, 5)  # 4.50 rounds away from zero
    assert (drug["Kategori1"], drug["Kategori4"], drug["Kategori5"], drug["Bolge"]) == ("A", "A02B", "W", "EGE")
    other = got[("ILAC DISI", "2101")]
    assert (other["KUTU"], other["TL"], other["Kategori3"], other["Kategori4"]) == (3, 3, "N11", "")
    assert got[("ILAC DISI", "2102")]["TL"] is None  # no price of that kind
    bare = got[("ILAC", "2102")]
    assert (bare["EczaneKod"], bare["AccountName"], bare["Urun"], bare["TL"], bare["KUTU"]) == ("s3", None, None, None, 5)
    assert {r["OldCode"] for r in got.values()} == {None} and {r["Goster"] for r in got.values()} == {1}


def test_hidden_product_flag_repeats_visible_keys(spark, dims):
    mart = so.sellout_mart(facts(spark, [("T", "2101", "s1", "p2", 3, 0), ("T", "2101", "s1", "p2", 1, 0)]), **dims)
    assert sorted((r["Urun"], r["KUTU"], r["TL"]) for r in mart.collect()) == [("Twin", 4, 4), ("Twin", 4, 8)]


def test_equal_group_with_two_prices_adds_up(spark, dims):
    prices = spark.createDataFrame(
        [("2101", "p1", "Same", "F", "W", D("1.00"), D("1.00")), ("2101", "p1", "Same", "F", "W", D("5.00"), D("1.00"))],
        PRICES,
    )
    mart = so.sellout_mart(facts(spark, [("T", "2101", "s1", "p1", 2, 0)]), **(dims | {"prices": prices}))
    assert [(r["KUTU"], r["TL"]) for r in mart.collect()] == [(4, 12)]


def test_one_period(spark, dims):
    rows = [("T", "2101", "s1", "p1", 1, 0), ("T", "2102", "s1", "p1", 1, 0)]
    assert {r["DONEM"] for r in so.sellout_mart(facts(spark, rows), **dims, period="2102").collect()} == {"2102"}


def test_publish_replaces_only_its_periods(spark, dims, tmp_path):
    path = str(tmp_path / "mart")
    first = [("T", "2101", "s1", "p1", 1, 0), ("T", "2102", "s1", "p1", 1, 0)]
    so.publish_mart(so.sellout_mart(facts(spark, first), **dims), path)
    so.publish_mart(so.sellout_mart(facts(spark, [("T", "2102", "s2", "p1", 7, 0)]), **dims), path)
    got = so.read_mart(spark, path)
    assert sorted((r["DONEM"], r["EczaneKod"], r["KUTU"]) for r in got.collect()) == [("2101", "s1", 1), ("2102", "s2", 7)]
    assert dict(got.dtypes)["DONEM"] == "string"


def test_publish_into_a_catalog_table(spark, dims):
    first = [("T", "2101", "s1", "p1", 1, 0), ("T", "2102", "s1", "p1", 1, 0)]
    so.publish_table(so.sellout_mart(facts(spark, first), **dims), "mart_under_test")
    try:
        so.publish_table(so.sellout_mart(facts(spark, [("T", "2102", "s2", "p1", 7, 0)]), **dims), "mart_under_test")
        got = spark.table("mart_under_test")
        assert sorted((r["DONEM"], r["EczaneKod"], r["KUTU"]) for r in got.collect()) == [("2101", "s1", 1), ("2102", "s2", 7)]
        assert sorted(got.columns) == sorted(c.split()[0] for c in so.MART_SCHEMA.split(", "))
    finally:
        spark.sql("drop table mart_under_test")
    assert not spark.catalog.tableExists("mart_under_test")


def test_null_in_a_required_column_fails(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    assert so.not_null_violations(df, ["id", "name"]).first().asDict() == {"id": 0, "name": 1}
    assert so.require_not_null(df.where("id = 1"), ["id", "name"]).collect()
    with pytest.raises(Exception, match="null in name"):
        so.require_not_null(df, ["id", "name"]).collect()


@pytest.fixture(scope="module")
def small_mart(spark):
    rows = []
    for u, t in (("u1", "ILAC"), ("u2", "ILAC"), ("u1", "ILAC DISI")):
        rows += [("2101", "Shop " + u, f"P{k}", k, k // 3 * 10, t, 1, u) for k in range(9)]
    rows += [("2101", "Shop u1", None, 1, None, "ILAC", 1, "u1"), ("2101", "Shop u1", "Hidden", 1, 999, "ILAC", 0, "u1")]
    rows += [("2112", "Shop u1", "P1", 1, 10, "ILAC", 1, "u1")]
    return spark.createDataFrame(
        rows, "DONEM string, AccountName string, Urun string, KUTU int, TL int, PazarTipi string, Goster int, UniverseCode string"
    )


@pytest.fixture(scope="module")
def report_periods(spark):
    return spark.createDataFrame([("2101", 1), ("2112", 0)], "period string, is_active int")


def test_top_products(small_mart, report_periods):
    got = [tuple(r) for r in so.top_products(small_mart, report_periods, "u1", "2101", "ILAC ", 4).orderBy("RowNo").collect()]
    assert got == [
        (1, "P6", 20, 6, "2101", "Shop u1"), (2, "P7", 20, 7, "2101", "Shop u1"),
        (3, "P8", 20, 8, "2101", "Shop u1"), (4, "P3", 10, 3, "2101", "Shop u1"),
    ]
    everything = so.top_products(small_mart, report_periods, "u1", "2101", "ILAC").orderBy("RowNo").collect()
    assert [everything[-1][c] for c in ("RowNo", "URUN", "TL")] == [10, "", 0]
    assert so.top_products(small_mart, report_periods, "u1", "2112", "ILAC").count() == 0


def test_top_products_of_all(small_mart, report_periods):
    every = so.top_products_all(small_mart, report_periods, 3)
    for u, t in (("u1", "ILAC"), ("u2", "ILAC"), ("u1", "ILAC DISI")):
        mine = every.where((F.col("UniverseCode") == u) & (F.col("PazarTipi") == t)).drop("UniverseCode", "PazarTipi")
        one = so.top_products(small_mart, report_periods, u, "2101", t, 3)
        assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, one.collect()))
    assert every.count() == 9


def test_dates_are_not_used(spark):
    """A whole fact row passes the union with a constant report price."""
    row = ("T", "2101", "TR01", dt.date(2021, 1, 5), "s", "p", "u", D(1), D(0), D("1.00"), D("1.00"), 0, D("1.00"),
           D("1.00"), D("0.00"), dt.date(2021, 1, 5), "i", D("0.00"), 1, 1.0, 1.0)
    schema = (
        "source string, period string, production string, sale_date date, whs string, pfc string, u_code string, "
        "pr_unit decimal(10,0), pr_bonus decimal(10,0), pr_price decimal(10,2), ndf_price decimal(10,2), setflag int, "
        "pub_price decimal(10,2), trd_price decimal(10,2), iskonto decimal(7,2), invoice_date date, invoice_number string, "
        "vat decimal(7,2), is_prescription int, prj_unit double, prj_value double"
    )
    got = so.union_sources(spark.createDataFrame([row], schema), so.DRUG).first()
    assert len(got) == 21 and got["tpt_price"] == D("0.00")
    assert so.union_sources(spark.createDataFrame([row], schema), so.NON_DRUG).count() == 0


def test_a_null_unit_or_bonus_fails_the_mart(spark, dims):
    for broken in ((None, D(0)), (D(5), None)):
        rows = spark.createDataFrame([("T", "2101", "s1", "p1", D(3), D(0)), ("T", "2101", "s1", "p1", *broken)], FACTS)
        with pytest.raises(Exception, match="null in pr_"):
            so.sellout_mart(rows, **dims).collect()
    other = spark.createDataFrame([("X", "2101", "s1", "p1", None, None), ("T", "2101", "s1", "p1", D(3), D(0))], FACTS)
    assert [r["KUTU"] for r in so.sellout_mart(other, **dims).collect()] == [3]  # not one of the markets' sources


def test_blank_padded_keys_meet(spark, dims):
    rows = [("T", "2101", "s1   ", "p1 ", 1, 1), ("T", "2101", "s1", "p1", 1, 0)]
    padded = dims | {
        "prices": dims["prices"].withColumn("prd_cd", F.rpad("prd_cd", 8, " ")),
        "accounts": dims["accounts"],
        "atc_names": dims["atc_names"].withColumn("pfc", F.rpad("pfc", 5, " ")),
    }
    got = so.sellout_mart(facts(spark, rows), **padded).collect()
    assert [(r["EczaneKod"], r["UrunKod"], r["AccountName"], r["Urun"], r["KUTU"], r["Kategori1"], r["Bolge"]) for r in got] == [
        ("s1", "p1", "Shop 1", "Product 1", 3, "A", "EGE")
    ]


def test_regions_of_padded_accounts(spark):
    accounts = spark.createDataFrame([("s1 ", "Shop", "u1  ")], "account_code string, account_name string, universe_code string")
    shops = spark.createDataFrame([("u1", 10)], "imscode string, brick int")
    bricks = spark.createDataFrame([(10, 1)], "brick1 int, tcode int")
    names = spark.createDataFrame([(1, "EGE")], "brickcode int, bolge string")
    assert tuple(so.account_regions(accounts, shops, bricks, names).first()) == ("s1", "Shop", "u1", "EGE")


def whole_facts(spark, rows):
    """All 19 columns filled; ``rows`` give source, period, shop, product, units and bonus, and columns to overwrite."""
    kinds = {
        "production": "string", "sale_date": "date", "u_code": "string", "pr_price": "decimal(10,2)", "ndf_price": "decimal(10,2)",
        "setflag": "int", "pub_price": "decimal(10,2)", "trd_price": "decimal(10,2)", "iskonto": "decimal(7,2)",
        "invoice_date": "date", "invoice_number": "string", "vat": "decimal(7,2)", "is_prescription": "int",
        "prj_unit": "double", "prj_value": "double",
    }
    fill = {"string": "x", "date": dt.date(2021, 1, 1), "int": 1, "double": 1.0}
    schema = FACTS + "".join(f", {c} {t}" for c, t in kinds.items())
    names = [c.split()[0] for c in FACTS.split(", ")] + list(kinds)
    full = []
    for *given, odd in rows:
        values = [*given[:4], D(given[4]), D(given[5]), *[fill.get(t, D(1)) for t in kinds.values()]]
        full.append(tuple((dict(zip(names, values)) | odd).values()))
    return spark.createDataFrame(full, schema)


def held(mart):
    return sorted((r["DONEM"], r["EczaneKod"], r["KUTU"]) for r in mart.collect())


def test_load_replaces_its_periods_and_keeps_older_versions(spark, dims, tmp_path):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    assert store.current() == 0 and store.read().collect() == [] and store.read().dtypes == so.in_mart_columns(store.read()).dtypes
    first = whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {}), ("T", "2102", "s1", "p1", 1, 0, {})])
    report = so.load_mart(store, first, **dims)
    assert (report.rows, report.version, set(report.nulls.values())) == (2, 1, {0})
    assert so.load_mart(store, whole_facts(spark, [("T", "2102", "s2", "p1", 7, 0, {})]), **dims).version == 2
    assert held(store.read()) == [("2101", "s1", 1), ("2102", "s2", 7)]
    assert held(store.read(1)) == [("2101", "s1", 1), ("2102", "s1", 1)]
    assert store.restore(1) == 3 and held(store.read()) == held(store.read(1))
    # A period that is loaded and has no facts is emptied; a version that is not there can't be gone back to.
    assert so.load_mart(store, first, **dims, period="2103").version == 4 and held(store.read()) == held(store.read(1))
    assert so.load_mart(store, first.where("period = '2101'"), **dims, period="2102").version == 5
    assert held(store.read()) == [("2101", "s1", 1)]
    with pytest.raises(ValueError, match="no version 9"):
        store.restore(9)


def test_a_null_in_any_column_leaves_the_mart_as_it_was(spark, dims, tmp_path):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    so.load_mart(store, whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {})]), **dims)
    loads = store._names("data")
    for column in so.FACT_COLUMNS:
        broken = whole_facts(spark, [("T", "2101", "s1", "p1", 5, 0, {}), ("P", "2101", "s1", "p1", 5, 0, {column: None})])
        report = so.load_mart(store, broken, **dims)
        assert report.version is None and report.rows == 2
        assert {c: n for c, n in report.nulls.items() if n} == {column: 1}
        # Without a store, the job itself fails, whether it uses the column or not.
        with pytest.raises(Exception, match=f"null in {column}"):
            so.market_sellout(broken, [so.NON_DRUG], **dims).collect()
    assert store.versions() == [1] and store._names("data") == loads and held(store.read()) == [("2101", "s1", 1)]
    odd = [("X", "2101", "s1", "p1", 5, 0, {"vat": None}), ("T", "2101", "s1", "p1", 2, 0, {})]
    assert so.load_mart(store, whole_facts(spark, odd), **dims).version == 2  # not one of the markets' sources


def test_facts_without_a_column_are_not_loaded(spark, dims, tmp_path):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    with pytest.raises(ValueError, match="lack the columns vat"):
        so.load_mart(store, whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {})]).drop("vat"), **dims)
    assert store.versions() == []


def test_the_load_counts_in_the_pass_that_writes(spark, dims, tmp_path, monkeypatch):
    """One scan of the facts: the plan that is written holds the counts, and no other job reads them."""
    whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {})] * 50).write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    store = so.mart_store(spark, str(tmp_path / "mart"))
    plans = []
    write = store.write

    def noted(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write(rows)

    monkeypatch.setattr(store, "write", noted)
    assert so.load_mart(store, facts, **dims).rows == 50
    assert len(plans) == 1 and plans[0].count("CollectMetrics") == 1
    assert plans[0].count("Relation [source#") == 1


def test_a_publish_that_is_killed_half_way_is_not_seen(spark, dims, tmp_path, monkeypatch):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    first = whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {}), ("T", "2102", "s1", "p1", 1, 0, {})])
    so.load_mart(store, first, **dims)
    reader = store.read()

    def killed(*_):
        raise KeyboardInterrupt

    # Killed between the writing of the data and the switch; and after some of the data only.
    with monkeypatch.context() as m:
        m.setattr(store, "_switch", killed)
        with pytest.raises(KeyboardInterrupt):
            so.load_mart(store, whole_facts(spark, [("T", "2102", "s2", "p1", 7, 0, {})]), **dims)
    bad = so.sellout_mart(first, **dims).withColumn("KUTU", F.when(F.col("DONEM") == "2102", F.raise_error(F.lit("killed"))).otherwise(F.col("KUTU")))
    with pytest.raises(Exception, match="killed"):
        store.publish(bad)
    assert store.versions() == [1] and held(reader) == held(store.read()) == [("2101", "s1", 1), ("2102", "s1", 1)]
    # The next load goes on from there, and what nobody names is deleted.
    assert so.load_mart(store, whole_facts(spark, [("T", "2102", "s2", "p1", 7, 0, {})]), **dims).version == 2
    store.vacuum(keep=1)
    assert store.versions() == [2] and held(store.read()) == [("2101", "s1", 1), ("2102", "s2", 7)]
    named = {f"load={load}" for load in store.partitions().values()}
    assert set(store._names("data")) == named


def test_two_loads_at_once_take_turns(spark, dims, tmp_path, monkeypatch):
    store, other = (so.mart_store(spark, str(tmp_path / "mart")) for _ in range(2))
    so.load_mart(store, whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {})]), **dims)
    late = store.write(so.sellout_mart(whole_facts(spark, [("T", "2102", "s1", "p1", 2, 0, {})]), **dims))
    current, calls = store.current, []

    def slow():
        found = current()
        if not calls:  # the other load finishes between this one's look at the number and its switch
            calls.append(so.load_mart(other, whole_facts(spark, [("T", "2103", "s1", "p1", 3, 0, {})]), **dims).version)
        return found

    monkeypatch.setattr(store, "current", slow)
    assert store.commit(late) == 3 and calls == [2]
    assert held(store.read()) == [("2101", "s1", 1), ("2102", "s1", 2), ("2103", "s1", 3)]


def test_versions_prune_by_period(spark, dims, tmp_path):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    so.load_mart(store, whole_facts(spark, [("T", p, "s1", "p1", 1, 0, {}) for p in ("2101", "2102", "2103")]), **dims)
    plan = store.read().where("DONEM = '2102'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(DONEM" in plan
    assert len(store.read().where("DONEM = '2102'").inputFiles()) >= 1


def test_refused_facts_are_neither_joined_nor_written(spark, dims, tmp_path, monkeypatch):
    store = so.mart_store(spark, str(tmp_path / "mart"))
    monkeypatch.setattr(store, "write", lambda rows: pytest.fail("written"))
    report = so.load_mart(store, whole_facts(spark, [("T", "2101", "s1", "p1", 1, 0, {"vat": None})] * 3), **dims)
    assert (report.rows, report.nulls["vat"], report.version) == (3, 3, None)


def test_a_load_deals_the_sums_and_not_the_mart(spark, dims, tmp_path, monkeypatch):
    """Whole rows of the mart are not exchanged, also where prices have to be; a share of a period is one file."""
    store, plans = so.mart_store(spark, str(tmp_path / "mart")), []
    monkeypatch.setattr(so, "PARTITIONS_A_SHARE", 2)
    write = store.write

    def noted(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(rows)

    monkeypatch.setattr(store, "write", noted)
    monkeypatch.setattr(store, "spread", lambda rows: pytest.fail("dealt again"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    facts = whole_facts(spark, [("T", p, "s1", f"p{k}", k, 0, {}) for p in ("2101", "2102") for k in range(1, 9)])
    small = {"accounts": F.broadcast(dims["accounts"]), "atc_names": F.broadcast(dims["atc_names"])}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        so.load_mart(store, facts, **(dims | small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plans[0] and plans[0].count("REPARTITION_BY_COL") == 2
    assert plans[0].count("Exchange hashpartitioning(period") == 3  # the sums, twice, and the prices
    files = [f.split("/")[-2] for f in store.read().inputFiles()]
    assert set(files) == {"DONEM=2101", "DONEM=2102"} and all(files.count(f) <= 2 for f in files)
    plain = so.sellout_mart(facts, **dims)
    assert sorted(map(str, store.read().select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
