"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from check_oracle import TABLES, kind, rows_of
from dispensa.catalog import all_queries, projection


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def job(spark, folder):
    return projection.run(spark, folder)


def compare(df, db, sql):
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    types = {c[0]: kind(str(c[1])) for c in cursor.description}
    want = rows_of(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert {c: kind(t) for c, t in df.dtypes} == types
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want
    return want


def _keys():
    # The stages of one projection run share its stored tables below.
    return [k for k in all_queries() if k not in projection.STAGES]


@pytest.mark.parametrize("key", _keys())
def test_query(key, spark, folder, db):
    query = all_queries()[key]
    assert query.sql, f"{key} has no SQL"
    compare(query.run(spark, folder), db, query.sql)


@pytest.mark.parametrize("key", list(projection.STAGES))
def test_projection_stage(key, job, db):
    pick, final = projection.STAGES[key]
    compare(pick(job), db, projection.oracle(final))


def test_flagship_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["PdID", "ShopID", "PackID", "PF", "Region", "TSC", "Chain", "Class", "Orphan"]
    assert df.count() > 0


def test_entry_needs_no_session():
    import subprocess
    import sys

    code = "import __spark_entry__ as e; assert set(e.queries()) >= set(e.oracle_sql()) and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
