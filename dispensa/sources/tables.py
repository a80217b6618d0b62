"""Reading of input tables."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.functions.compat import raise_unless


@functools.cache
def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as a DataFrame; its schema is read once per session."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partition_scan(family: DataFrame, period: str | Column, column: str = "period") -> DataFrame:
    """One member of a family of period-suffixed tables.

    The family is one table partitioned by ``column``; the filter prunes the other partitions.
    """
    return family.where(F.col(column) == period)


def control_value(control: DataFrame, param: str, dtype: str, into: str) -> DataFrame:
    """The value of one parameter of a (param, val) control table, as a one-row DataFrame.

    No row would silently empty every job that crosses with it and two rows would double the
    results, so both fail.
    """
    found = control.where(F.col("param") == param).agg(F.count("*").alias("n"), F.max("val").alias("val"))
    value = raise_unless(F.col("n") == 1, F.col("val").cast(dtype), f"control table needs one row for {param}")
    return found.select(value.alias(into))


def inline_values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literal rows."""
    return spark.createDataFrame(rows, schema)
