"""Results stay whole when one shop, one pack and one event type hold a third of all rows."""

from __future__ import annotations

import duckdb
import pytest

from check_oracle import TABLES, rows_of
from dispensa.catalog import all_queries, projection


@pytest.fixture(scope="module")
def hot(folder, tmp_path_factory):
    """The test tables with a hot supplier and part in lineitem and a hot type in events."""
    path = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t}_source as select * from '{folder}/{t}.parquet'")
    columns = {
        "lineitem": "case when hash(l_orderkey, l_linenumber, l_quantity) % 3 = 0 then 1 else l_suppkey end as l_suppkey, "
        "case when hash(l_orderkey, l_linenumber, l_quantity) % 3 = 0 then 2 else l_partkey end as l_partkey",
        "events": "case when hash(event_id) % 3 = 0 then 'click' else event_type end as event_type",
        "supplier": "case when s_suppkey = 1 then 9000.0 else s_acctbal end as s_acctbal",
    }
    for t in TABLES:
        extra = f"replace ({columns[t]})" if t in columns else ""
        con.execute(f"copy (select * {extra} from {t}_source) to '{path}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    return str(path), con


@pytest.fixture(autouse=True)
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def compare(df, con, sql):
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == want and want


@pytest.mark.parametrize(
    "key",
    ["sellout_drug", "top_products_all", "gate_verdict", "gate_notes", "win_row_number", "win_count", "json_shred",
     "agg_count_distinct", "join_computed_key", "math_int_div"],
)
def test_hot_query(key, spark, hot):
    path, con = hot
    compare(all_queries()[key].run(spark, path), con, all_queries()[key].sql)


@pytest.fixture(scope="module")
def job(spark, hot):
    return projection.run(spark, hot[0])


@pytest.mark.parametrize(
    "key", ["group_median", "running_sum", "size_class", "panel", "universe_levels", "projection_factors", "projected_units"]
)
def test_hot_projection(key, job, hot):
    pick, final = projection.STAGES[key]
    compare(pick(job), hot[1], projection.oracle(final))
