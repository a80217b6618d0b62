"""Monthly folders of several schemas under one declared schema."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import types as T

from dispensa.sources.periods import PeriodTable, SchemaRefused, holds

NOW = "whs string, units bigint, price decimal(10,2), vat double, day timestamp_ntz"


@pytest.fixture()
def table(spark, tmp_path):
    return PeriodTable(spark, str(tmp_path / "months"), NOW)


def test_months_written_with_and_without_columns(spark, table):
    table.write(spark.createDataFrame([("a", 1)], "whs string, units int"), "0001")
    table.write(spark.createDataFrame([("b", 2, D("1.5"), 3)], "whs string, units smallint, price decimal(4,1), vat int"), "0002")
    table.write(spark.createDataFrame([("c", 3, D("2.25"), 4.5, dt.datetime(2021, 1, 1))], NOW), "0003")
    table.write(spark.createDataFrame([("d", dt.date(2021, 1, 2))], "whs string, day date"), "0004")
    table.write(spark.createDataFrame([], "units int, whs string"), "0005")
    got = table.read()
    assert got.columns == ["period", "whs", "units", "price", "vat", "day"]
    assert [t for _, t in got.dtypes] == ["string", "string", "bigint", "decimal(10,2)", "double", "timestamp_ntz"]
    assert sorted(map(tuple, got.collect())) == [
        ("0001", "a", 1, None, None, None),
        ("0002", "b", 2, D("1.50"), 3.0, None),
        ("0003", "c", 3, D("2.25"), 4.5, dt.datetime(2021, 1, 1)),
        ("0004", "d", None, None, None, dt.datetime(2021, 1, 2)),
    ]
    states = {(r["period"], r["column"]): r["state"] for r in table.report().collect()}
    assert states["0001", "units"] == "widened" and states["0001", "price"] == "missing" and states["0003", "vat"] == "same"
    assert table.periods() == ["0001", "0002", "0003", "0004", "0005"]
    assert sorted(r["period"] for r in table.read(["0002", "0003", "0009"]).collect()) == ["0002", "0003"]


def test_a_filter_prunes_folders(spark, table):
    for p in ("0001", "0002", "0003"):
        table.write(spark.createDataFrame([(p, 1)], "whs string, units int"), p)
    plan = table.read().where("period = '0002'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and plan.count("FileScan") == 1  # one schema, one scan
    assert [r["whs"] for r in table.read().where("period = '0002'").collect()] == ["0002"]


@pytest.mark.parametrize(
    "schema, rows, state",
    [
        ("whs string, units double", [("a", 1.0)], "narrowed"),
        ("whs string, price decimal(11,2)", [("a", D("1"))], "narrowed"),
        ("whs string, price decimal(10,3)", [("a", D("1"))], "narrowed"),
        ("whs int", [(1,)], "narrowed"),
        ("whs string, vat bigint", [("a", 1)], "narrowed"),
        ("whs string, extra int", [("a", 1)], "undeclared"),
    ],
)
def test_narrowed_and_undeclared_columns_are_refused(spark, table, schema, rows, state):
    table.write(spark.createDataFrame([("a", 1)], "whs string, units int"), "0001")
    odd = spark.createDataFrame(rows, schema)
    with pytest.raises(SchemaRefused, match=f"period 0002: .* is {state}"):
        table.write(odd, "0002")
    assert table.periods() == ["0001"]
    # A folder that another program wrote is refused on reading, and reported.
    odd.write.parquet(f"{table.root}/period=0002")
    with pytest.raises(SchemaRefused, match=f"is {state}"):
        table.read()
    assert state in {r["state"] for r in table.report().collect()}
    assert table.read(["0001"]).count() == 1


def test_the_declared_schema_can_only_grow(spark, table):
    table.write(spark.createDataFrame([("a", 1)], "whs string, units int"), "0001")
    table.widen(NOW + ", bonus int")
    table.write(spark.createDataFrame([("b", 2)], "whs string, bonus int"), "0002")
    assert sorted((r["period"], r["bonus"]) for r in table.read().collect()) == [("0001", None), ("0002", 2)]
    for narrower in (NOW, NOW.replace("units bigint", "units int") + ", bonus int"):
        with pytest.raises(SchemaRefused, match="not wider"):
            table.widen(narrower)


def test_which_types_hold_which():
    yes = [(T.LongType(), T.IntegerType()), (T.DoubleType(), T.IntegerType()), (T.DecimalType(12, 2), T.IntegerType()), (T.DecimalType(5, 2), T.DecimalType(4, 1))]
    no = [(T.DoubleType(), T.LongType()), (T.DecimalType(11, 2), T.IntegerType()), (T.IntegerType(), T.LongType()), (T.StringType(), T.IntegerType()), (T.FloatType(), T.DoubleType())]
    assert all(holds(a, b) for a, b in yes) and not any(holds(a, b) for a, b in no)


def test_no_periods(spark, table):
    assert table.read().collect() == [] and table.read().columns == ["period", "whs", "units", "price", "vat", "day"]
    assert table.report().collect() == []
