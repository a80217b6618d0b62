"""Registered queries: each key has a Spark callable and, beside it, SQL for another engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def all_queries() -> dict[str, Query]:
    from dispensa.catalog import calendar, feed, gate, primitives, projection, sellout

    found: dict[str, Query] = {}
    for module in (projection, sellout, gate, calendar, feed, primitives):
        for key, query in module.QUERIES.items():
            if key in found:
                raise ValueError(f"query {key} is registered twice")
            found[key] = query
    return found
