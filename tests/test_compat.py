"""Dialect rules and staging."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dispensa.functions import compat as c
from dispensa.functions import dates as dt
from dispensa.sources.staging import Staging, shared_folder


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("n", "d", "q"), [(8, 9, 0), (17, 9, 1), (-17, 9, -1), (9, 2, 4)])
def test_int_div(spark, n, d, q):
    assert value(spark, c.int_div(F.lit(n), F.lit(d))) == q


@pytest.mark.parametrize(("text", "width", "want"), [("42", 7, "0000042"), ("12345678", 7, "1234567"), ("", 3, "000")])
def test_zero_pad(spark, text, width, want):
    assert value(spark, c.zero_pad(F.lit(text), width)) == want


def test_text(spark):
    assert value(spark, c.same_text(F.lit("ILAC"), F.lit("ILAC  "))) is True
    assert value(spark, c.text_concat(F.lit("a"), F.lit(None), F.lit(1))) == "a1"
    assert value(spark, c.isnull(F.lit(None).cast("int"), F.lit("7"), "int")) == 7


@pytest.mark.parametrize(("x", "want"), [("2.5", 3), ("-2.5", -3), ("3.5", 4), ("2.49", 2)])
def test_round_to_int(spark, x, want):
    assert value(spark, c.round_to_int(F.lit(x).cast("decimal(10,2)"))) == want


def test_styles(spark):
    day = F.lit("2021-04-01").cast("date")
    assert value(spark, dt.style_100(day)) == "Apr  1 2021"
    assert value(spark, dt.style_101(day)) == "04/01/2021"
    assert value(spark, dt.style_112(day)) == "20210401"


def test_staging_uses_the_shared_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    staging = Staging(spark)
    kept = staging.keep(spark.range(5).where("id > 2"), "some")
    assert staging.root.startswith(folder) and sorted(r["id"] for r in kept.collect()) == [3, 4]
    assert "ExistingRDD" not in kept._jdf.queryExecution().toString()
    staging.drop()
    with pytest.raises(Exception, match="(?i)not.exist|FILE_NOT|file"):
        kept.collect()


def test_staging_keeps_an_empty_table(spark):
    assert Staging(spark).keep(spark.range(0), "empty").columns == ["id"]
