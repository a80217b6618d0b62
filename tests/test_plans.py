"""Plans: no cross products, no Python in the rows, no window over everything."""

from __future__ import annotations

import re

import pytest

from dispensa.catalog import all_queries, projection
from dispensa.operators import ordered
from dispensa.plans import projection as pj
from dispensa.sources.staging import Staging, subset_keys
from dispensa.sources.tables import partition_scan

# Windows without a partition that see a proven small number of rows: ranges, or the best n.
SMALL_WINDOWS = {"top_products": "TakeOrderedAndProject", "join_theta_self": ordered.RANGE, "win_global_rank": ordered.RANGE, "join_band": ordered.RANGE}


def text_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check(key, plan):
    assert "CartesianProduct" not in plan, key
    for name in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert name not in plan, key
    if "Exchange SinglePartition" in plan and "windowspecdefinition(" in plan:
        lone = [w for w in re.findall(r"windowspecdefinition\(([^)]*?)specifiedwindowframe", plan)
                if re.match(r"^[^,]*(ASC|DESC)", w.strip())]
        if lone:
            assert key in SMALL_WINDOWS, f"{key}: window over one partition"
            assert SMALL_WINDOWS[key] in plan


KEYS = [k for k in all_queries() if k not in projection.STAGES]


@pytest.mark.parametrize("key", KEYS)
def test_query_plan(key, spark, folder):
    check(key, text_of(all_queries()[key].run(spark, folder)))


@pytest.fixture(scope="module")
def job(spark, folder):
    return projection.run(spark, folder)


@pytest.mark.parametrize("key", list(projection.STAGES))
def test_stage_plan(key, job):
    plan = text_of(projection.STAGES[key][0](job))
    assert "CartesianProduct" not in plan and "EvalPython" not in plan


def test_scans_read_only_what_they_need(spark, folder):
    plan = text_of(all_queries()["filter_basic"].run(spark, folder))
    assert "EqualTo(o_orderstatus,F)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_orderdate" not in schema and "o_orderpriority" not in schema


def test_top_per_pharmacy_prunes_before_the_shuffle(spark, folder):
    assert "WindowGroupLimit" in text_of(all_queries()["top_products_all"].run(spark, folder))


def test_top_n_does_not_sort_everything(spark, folder):
    assert "TakeOrderedAndProject" in text_of(all_queries()["top_n"].run(spark, folder))


def test_mart_aggregates_before_it_joins(spark, folder):
    """One shuffle of the facts; the prices are the only side that may be shuffled."""
    plan = text_of(all_queries()["sellout_drug"].run(spark, folder))
    lines = plan.splitlines()
    first_join = next(i for i, line in enumerate(lines) if "Join [" in line and "pfc" in line)
    assert any("partial_sum" in line for line in lines[first_join:])


def test_sellin_is_read_once(job, spark):
    """After the first stage, the projection reads stored tables instead of the fact."""
    plan = text_of(job.factors())
    assert "lineitem" not in plan


def test_needed_periods_prune_a_partitioned_fact(spark, tmp_path):
    path = str(tmp_path / "sellin")
    rows = [(f"{y}{m:02d}", "0000001", "0000001", 1) for y in (2015, 2016, 2017) for m in range(1, 13)]
    fact = spark.createDataFrame(rows, "period string, customer_code string, pfc string, total_unit int")
    fact.write.partitionBy("period").parquet(path)
    stored = spark.read.schema(fact.schema).parquet(path)
    oper = spark.createDataFrame([(201702,)], "pd_id int")
    months = spark.createDataFrame([(9,)], "MthsAvg int")
    monthly = pj.monthly_sellin(stored, pj.needed_periods(oper, months))
    assert "dynamicpruning" in text_of(monthly)
    found = sorted(r["period"] for r in monthly.select("period").distinct().collect())
    assert found == [f"2016{m:02d}" for m in range(1, 13)] + ["201701", "201702"]


def test_one_period_of_a_family_is_a_partition_filter(spark, tmp_path):
    path = str(tmp_path / "family")
    spark.createDataFrame([("2101", 1), ("2102", 2)], "period string, n int").write.partitionBy("period").parquet(path)
    one = partition_scan(spark.read.schema("n int, period string").parquet(path), "2102")
    assert "PartitionFilters: [isnotnull(period" in text_of(one) and [r["n"] for r in one.collect()] == [2]


def by_date(spark, tmp_path):
    """A sell-out fact partitioned by its stored date, over three years."""
    path = str(tmp_path / "sellout")
    rows = spark.sql(
        """select sale_date, '0000001' as shop_code, '0000001' as pfc, '01' as record_type, 1 as pr_unit
           from (select explode(sequence(date '2015-01-01', date '2017-12-31', interval 1 day)) as sale_date)
           where day(sale_date) <= 12 and month(sale_date) <= 3"""
    )
    rows.write.partitionBy("sale_date").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def test_operated_periods_prune_the_sellout(spark, tmp_path):
    stored = by_date(spark, tmp_path)
    oper = spark.createDataFrame([(201702,), (201705,)], "pd_id int")
    codes = pj.panel_codes(stored, oper)
    assert "dynamicpruning" in text_of(codes)
    assert sorted(r["PdID"] for r in codes.collect()) == [201702, 201705]
    factors = spark.createDataFrame(
        [(201702, 1, 1, 2.0, "R")], "PdID int, ShopID int, PackID int, PF double, Region string"
    )
    units = pj.apply_factors(stored, factors, oper)
    assert "dynamicpruning" in text_of(units)
    # The second days of three stored months belong to the period.
    assert [(r["Units"], r["ProjUnits"]) for r in units.collect()] == [(3, 6.0)]


@pytest.mark.parametrize("months", [9, 24])
def test_a_month_has_two_events_at_most_and_periods_come_last(spark, months):
    index = lambda p: p // 100 * 12 + p % 100 - 1
    every = [y * 100 + m for y in (2015, 2016, 2017) for m in range(1, 13)]
    operated = every[-8:]
    sold = [(str(p), f"{s:07d}", "0000002", p % 7 - 3) for p in every for s in (1, 3) if p % 5 or s == 1]
    sold += [("201703", "0000005", "0000002", 4), ("201704", "0000005", "0000002", -4)]  # these cancel out
    monthly = spark.createDataFrame(sold, "period string, customer_code string, pfc string, total_unit int")
    pairs = [(str(p), q) for q in operated for p in every if 1 <= index(q) - index(p) <= months]
    window = spark.createDataFrame(pairs, "PdID string, ProcPdID int")
    shops, packs = spark.createDataFrame([(1,), (3,), (5,)], "ShopID int"), spark.createDataFrame([(2,)], "PackID int")
    want = {}
    for p, q in pairs:
        for period, shop, _, units in sold:
            if period == p:
                want[q, int(shop), 2] = want.get((q, int(shop), 2), 0) + units
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            got = pj.universe(monthly, window, shops, packs)
            assert {(r[0], r[1], r[2]): r[3] for r in got.collect()} == want and 0 in want.values()
            plan = text_of(got).split("Initial Plan")[0]
            # The plan is printed from the end: periods come last, after the window over the events.
            assert plan.index("explode(filter(_points") < plan.index("Window [")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    used = len({(p, s) for p, s, _, _ in sold for q, _ in [(x, 0) for x, _ in pairs] if p == q})
    n = pj.universe_events(monthly, window, shops, packs).agg({"rows": "count"}).first()[0]
    joined = sum(1 for p, _ in pairs for s in sold if s[0] == p)
    assert n <= 2 * used and (months == 9 or joined > 6 * used)
    # One operated period: a month comes in with all others of its window, and never goes.
    one = window.where("ProcPdID = 201712")
    assert pj.universe_events(monthly, one, shops, packs).count() == 3


def test_calendar_queries_scan_the_fact_once(spark, folder):
    """The sums per day are stored; the calendar's plan reads only them."""
    plan = text_of(all_queries()["date_dimension_full"].run(spark, folder))
    assert "lineitem" not in plan and "l_shipdate" not in plan


def test_the_log_is_summed_once(spark, folder):
    plan = text_of(all_queries()["gate_verdict"].run(spark, folder))
    # What is left of the events are the requests and accounts; the sums of the log are a stored table.
    assert "sum(" not in plan


def test_reports_read_the_stored_mart(spark, folder):
    plan = text_of(all_queries()["top_products"].run(spark, folder))
    assert re.search(r"PartitionFilters: \[[^\]]*DONEM", plan)
    for key in ("top_products", "top_products_all"):  # of the fact only the report periods' dates are left
        assert "l_quantity" not in text_of(all_queries()[key].run(spark, folder))


def test_a_run_leaves_nothing_behind(spark, folder):
    from pathlib import Path

    from dispensa.catalog.projection import inputs
    from dispensa.sources.staging import Staging

    with Staging(spark) as staging:
        job = pj.Projection(inputs(spark, folder, staging), staging)
        assert job.factors().count() > 0
        root = Path(staging.root.removeprefix("file:"))
        assert any(root.iterdir())
    assert not root.exists()


def test_level_joins_run_where_their_sides_lie(spark, folder):
    """Bucketed stages: no exchange below the eight level joins, the class means and what reads them, broadcasts off."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Staging(spark) as staging:
            run = pj.Projection(projection.inputs(spark, folder, staging), staging)
            run.means()
            with subset_keys(spark):
                joins = text_of(run.attach())
            assert joins.count("Join [") == 8 and "Exchange" not in joins
            for made in (run.universe_levels(), run.panel_levels(), run.factor_regular()):
                plan = text_of(made)
                assert plan.count("Join [") == 1 and "Exchange" not in plan and "Bucketed: true" in plan
                assert made.count() > 0
            cells = text_of(pj.level_cells(run.pairs(), run.packs()))
            assert cells.count("hashpartitioning(PdID") == 0  # summed where the pairs lie
            tables = list(staging._tables)
            assert len(tables) == 4
        assert not any(spark.catalog.tableExists(t) for t in tables)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
