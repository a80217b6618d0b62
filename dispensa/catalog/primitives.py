"""One query per relational primitive that the jobs use, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.functions import compat as c
from dispensa.functions import dates as dt
from dispensa.operators import ordered
from dispensa.operators.trailing import trailing_sums
from dispensa.plans.feed import append_by_position
from dispensa.sources.staging import Staging
from dispensa.sources.standins import standin, standin_sql
from dispensa.sources.tables import control_value, inline_values, parquet_table, partition_scan

QUERIES: dict[str, Query] = {}


class Tables:
    """The test tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return parquet_table(self.spark, self.folder, name)

    def standin(self, name: str) -> DataFrame:
        return standin(self.spark, self.folder, name)

    def staging(self) -> Staging:
        return Staging(self.spark)


def query(key: str, sql: str) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[key] = Query(lambda spark, folder: fn(Tables(spark, folder)), sql)
        return fn

    return register


def money(column: str) -> Column:
    """An amount as an exact decimal, so that sums do not depend on the order of rows."""
    return F.col(column).cast("decimal(18,2)")


# --- scans and table operations --------------------------------------------------------------


@query("scan", "select * replace (cast(o_orderdate as date) as o_orderdate) from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


_MONTH_SRC = standin_sql("month_src")


@query("partition_scan", f"select period, whs, pfc, cast(pr_unit as double) as pr_unit from ({_MONTH_SRC}) where period = '0003'")
def _(t: Tables) -> DataFrame:
    return partition_scan(t.standin("month_src"), "0003").select("period", "whs", "pfc", F.col("pr_unit").cast("double"))


@query(
    "control_scalar",
    f"""select o_custkey, cast(count(*) as bigint) as orders from orders, (select cast(val as int) as m from ({standin_sql('ctrl')}))
        where month(o_orderdate) <= m group by o_custkey""",
)
def _(t: Tables) -> DataFrame:
    months = control_value(t.standin("ctrl"), "MthsAvg", "int", "m")
    kept = t.orders.crossJoin(F.broadcast(months)).where(F.month("o_orderdate") <= F.col("m"))
    return kept.groupBy("o_custkey").agg(F.count("*").alias("orders"))


@query("ctas", "select l_suppkey, cast(sum(l_quantity) as bigint) as units from lineitem group by 1")
def _(t: Tables) -> DataFrame:
    units = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return t.staging().keep(units, "units")


@query(
    "inline_values",
    """select name, cast(sum(l_quantity) as bigint) as units from lineitem join
       (values ('A', 'accepted'), ('N', 'new'), ('R', 'returned')) v(flag, name) on flag = l_returnflag group by 1""",
)
def _(t: Tables) -> DataFrame:
    names = inline_values(t.spark, "flag string, name string", [("A", "accepted"), ("N", "new"), ("R", "returned")])
    joined = t.lineitem.join(F.broadcast(names), F.col("flag") == F.col("l_returnflag"))
    return joined.groupBy("name").agg(F.sum("l_quantity").cast("bigint").alias("units"))


@query(
    "append_by_name",
    """select s_name as name, s_nationkey as nation, s_acctbal as balance, null::varchar as segment from supplier
       union all select c_name, c_nationkey, c_acctbal, c_mktsegment from customer""",
)
def _(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    customers = t.customer.select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "append_by_position",
    "select s_suppkey as id, s_name as name from supplier union all select cast(p_partkey as bigint), p_brand from part",
)
def _(t: Tables) -> DataFrame:
    target = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return append_by_position(target, t.part.select("p_partkey", "p_brand"))


@query(
    "conditional_update",
    """select o_orderkey, o_orderpriority, case when o_totalprice > 300000 and o_orderstatus = 'O' then 'H'
       else o_orderstatus end as o_orderstatus from orders""",
)
def _(t: Tables) -> DataFrame:
    hold = (F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") == "O")
    updated = t.orders.withColumn("o_orderstatus", F.when(hold, "H").otherwise(F.col("o_orderstatus")))
    return updated.select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query(
    "update_from_join",
    """select p_partkey, p_name, coalesce(first_sold, date '1900-01-01') as first_sold from part left join
       (select l_partkey, cast(min(l_shipdate) as date) as first_sold from lineitem where l_returnflag = 'R' group by 1)
       on l_partkey = p_partkey""",
)
def _(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_name", F.lit("1900-01-01").cast("date").alias("first_sold"))
    returned = t.lineitem.where(F.col("l_returnflag") == "R")
    found = returned.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_shipdate").cast("date").alias("_new"))
    joined = parts.join(found, "p_partkey", "left")
    return joined.withColumn("first_sold", F.coalesce("_new", "first_sold")).drop("_new")


# --- projections, filters, predicates --------------------------------------------------------


@query("project", "select o_orderkey as id, o_totalprice as price, cast(o_orderdate as date) as day from orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("date").alias("day")
    )


@query(
    "case_simple",
    """select case l_returnflag when 'A' then 'accepted' when 'R' then 'returned' else 'new' end as state,
       count(*) as lines from lineitem group by 1""",
)
def _(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    state = F.when(flag == "A", "accepted").when(flag == "R", "returned").otherwise("new")
    return t.lineitem.groupBy(state.alias("state")).agg(F.count("*").alias("lines"))


@query(
    "case_searched",
    """select case when o_totalprice < 100000 then 'small' when o_totalprice < 300000 then 'medium' else 'large' end as size,
       count(*) as orders from orders group by 1""",
)
def _(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    size = F.when(price < 100000, "small").when(price < 300000, "medium").otherwise("large")
    return t.orders.groupBy(size.alias("size")).agg(F.count("*").alias("orders"))


@query(
    "filter_basic",
    "select o_orderkey, o_custkey from orders where o_orderstatus = 'F' and o_totalprice >= 250000",
)
def _(t: Tables) -> DataFrame:
    kept = t.orders.where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 250000))
    return kept.select("o_orderkey", "o_custkey")


@query("filter_ne", "select l_linestatus, count(*) as lines from lineitem where l_returnflag <> 'R' group by 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_returnflag") != "R").groupBy("l_linestatus").agg(F.count("*").alias("lines"))


_LOG = standin_sql("log_pp")


@query(
    "filter_null",
    f"""select cycle_id, count(*) filter (is_deleted is null) as unset, count(*) filter (bonus is not null) as with_bonus
        from ({_LOG}) group by 1""",
)
def _(t: Tables) -> DataFrame:
    return t.standin("log_pp").groupBy("cycle_id").agg(
        F.count(F.when(F.col("is_deleted").isNull(), 1)).alias("unset"),
        F.count(F.when(F.col("bonus").isNotNull(), 1)).alias("with_bonus"),
    )


@query(
    "soft_delete",
    f"select cycle_id, count(*) as n from ({_LOG}) where is_deleted = 0 or is_deleted is null group by 1",
)
def _(t: Tables) -> DataFrame:
    return t.standin("log_pp").where(c.live()).groupBy("cycle_id").agg(F.count("*").alias("n"))


@query(
    "filter_in",
    "select p_brand, count(*) as parts from part where p_type in ('PROMO', 'SMALL', 'LARGE') group by 1",
)
def _(t: Tables) -> DataFrame:
    chosen = t.part.where(F.col("p_type").isin("PROMO", "SMALL", "LARGE"))
    return chosen.groupBy("p_brand").agg(F.count("*").alias("parts"))


@query(
    "scalar_subquery",
    """select l_suppkey, count(*) as lines from lineitem
       where l_quantity > (select cast(sum(l_quantity) as bigint) // count(*) from lineitem) group by 1""",
)
def _(t: Tables) -> DataFrame:
    mean = t.lineitem.agg(c.int_div(F.sum("l_quantity").cast("bigint"), F.count("*")).alias("mean"))
    above = t.lineitem.crossJoin(F.broadcast(mean)).where(F.col("l_quantity") > F.col("mean"))
    return above.groupBy("l_suppkey").agg(F.count("*").alias("lines"))


@query("distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


# --- joins -----------------------------------------------------------------------------------


@query(
    "join_inner",
    """select c_mktsegment, o_orderpriority, count(*) as orders from orders join customer on c_custkey = o_custkey
       group by all""",
)
def _(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(F.count("*").alias("orders"))


@query(
    "join_left_multi",
    """with f as (select l_suppkey, l_returnflag, l_linestatus, cast(sum(l_quantity) as bigint) as u from lineitem group by all)
       select a.l_suppkey, a.l_returnflag, a.l_linestatus, a.u as units, b.u as open_units, s.u as returned_units
       from f a left join (select n.l_suppkey, n.l_returnflag, n.u from f n where l_linestatus = 'O') b
              on a.l_suppkey = b.l_suppkey and a.l_returnflag = b.l_returnflag
       left join (select l_suppkey, l_linestatus, u from f where l_returnflag = 'R') s
              on a.l_suppkey = s.l_suppkey and a.l_linestatus = s.l_linestatus""",
)
def _(t: Tables) -> DataFrame:
    keys = ["l_suppkey", "l_returnflag", "l_linestatus"]
    sums = t.lineitem.groupBy(*keys).agg(F.sum("l_quantity").cast("bigint").alias("units"))
    opened = sums.where(F.col("l_linestatus") == "O").select(*keys[:2], F.col("units").alias("open_units"))
    returned = sums.where(F.col("l_returnflag") == "R").select(keys[0], keys[2], F.col("units").alias("returned_units"))
    return sums.join(opened, keys[:2], "left").join(returned, [keys[0], keys[2]], "left")


@query(
    "join_cross_scalar",
    """select o_orderstatus, cast(sum(datediff('day', o_orderdate, m)) as bigint) as age from orders,
       (select max(o_orderdate) as m from orders) group by 1""",
)
def _(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max("o_orderdate").alias("last"))
    aged = t.orders.crossJoin(F.broadcast(last))
    return aged.groupBy("o_orderstatus").agg(F.sum(F.datediff("last", "o_orderdate")).alias("age"))


@query(
    "join_band",
    """with d as (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1)
       select a.day, a.n as orders, cast(sum(b.n) as bigint) as week_before from d a
       join d b on b.day between a.day - 7 and a.day - 1 group by all""",
)
def _(t: Tables) -> DataFrame:
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("orders"))
    days = days.withColumn("number", F.unix_date("day"))
    return trailing_sums(days, [], "number", "orders", 7, "week_before", t.staging()).where("week_before is not null").drop("number")


@query(
    "join_theta_self",
    """with d as (select cast(l_shipdate as date) as day, cast(sum(l_quantity) as bigint) as units from lineitem group by 1)
       select a.day, a.units, cast(sum(b.units) as bigint) as units_to_date from d a join d b on a.day >= b.day group by all""",
)
def _(t: Tables) -> DataFrame:
    days = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum("l_quantity").cast("bigint").alias("units")
    )
    return ordered.running_sum(days, "units", [F.col("day").asc()], "units_to_date", t.staging())


@query(
    "join_semi",
    """select c_custkey, c_mktsegment from customer where exists (select 1 from orders where o_custkey = c_custkey
       and o_orderstatus = 'P')""",
)
def _(t: Tables) -> DataFrame:
    pending = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(pending, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query(
    "join_anti",
    """select c_custkey, c_mktsegment from customer where not exists (select 1 from orders where o_custkey = c_custkey
       and o_totalprice > 400000)""",
)
def _(t: Tables) -> DataFrame:
    large = t.orders.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(large, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


@query(
    "join_computed_key",
    f"""select account_name, cast(sum(l_quantity) as bigint) as units from lineitem
        join ({standin_sql('account')}) on account_code = lpad(l_suppkey::varchar, 7, '0') group by 1""",
)
def _(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    keyed = sums.withColumn("account_code", c.zero_pad(F.col("l_suppkey"), 7))
    return keyed.join(t.standin("account"), "account_code").select("account_name", "units")


# --- aggregations ----------------------------------------------------------------------------


@query("agg_sum", "select l_partkey, cast(sum(l_quantity) as bigint) as units from lineitem group by 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))


@query(
    "agg_sum_expr",
    """select l_suppkey, round(cast(sum(cast(l_extendedprice as decimal(18,2)) * (l_linenumber + 1)) as double), 2) as value
       from lineitem group by 1""",
)
def _(t: Tables) -> DataFrame:
    value = F.sum(money("l_extendedprice") * (F.col("l_linenumber") + 1))
    return t.lineitem.groupBy("l_suppkey").agg(F.round(value.cast("double"), 2).alias("value"))


@query("agg_sum_null0", f"select account_id, cast(sum(coalesce(bonus, 0)) as bigint) as bonus from ({_LOG}) group by 1")
def _(t: Tables) -> DataFrame:
    return t.standin("log_pp").groupBy("account_id").agg(F.sum(F.coalesce("bonus", F.lit(0))).alias("bonus"))


@query(
    "agg_minmax",
    "select min(l_shipdate)::date as first_day, max(l_shipdate)::date as last_day, max(l_quantity) as most from lineitem",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.agg(
        F.min("l_shipdate").cast("date").alias("first_day"),
        F.max("l_shipdate").cast("date").alias("last_day"),
        F.max("l_quantity").alias("most"),
    )


@query("agg_count", "select count(*) as rows, count(*) filter (l_returnflag = 'R') as returned from lineitem")
def _(t: Tables) -> DataFrame:
    returned = F.count(F.when(F.col("l_returnflag") == "R", 1))
    return t.lineitem.agg(F.count("*").alias("rows"), returned.alias("returned"))


@query(
    "agg_count_distinct",
    "select l_returnflag, count(distinct l_suppkey) as shops, count(distinct l_partkey) as packs from lineitem group by 1",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.countDistinct("l_suppkey").alias("shops"), F.countDistinct("l_partkey").alias("packs")
    )


@query(
    "agg_hidden_key",
    """select l_suppkey, units from (select l_suppkey, l_returnflag, cast(sum(l_quantity) as bigint) as units
       from lineitem group by all)""",
)
def _(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return sums.drop("l_returnflag")


# --- windows, sorts, limits, set operations --------------------------------------------------


@query(
    "win_global_min",
    """select distinct o_custkey, cast(min(o_orderdate) over (partition by o_custkey) as date) as first_order,
       cast(min(o_orderdate) over () as date) as first_of_all from orders""",
)
def _(t: Tables) -> DataFrame:
    date = F.col("o_orderdate").cast("date")
    per_customer = t.orders.groupBy("o_custkey").agg(F.min(date).alias("first_order"))
    overall = t.orders.agg(F.min(date).alias("first_of_all"))
    return per_customer.crossJoin(F.broadcast(overall))


@query(
    "win_count",
    "select o_orderkey, o_orderstatus, count(*) over (partition by o_orderstatus) as n from orders",
)
def _(t: Tables) -> DataFrame:
    # A count joined back: a window would bring a whole status into one task.
    counts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return t.orders.select("o_orderkey", "o_orderstatus").join(counts, "o_orderstatus")


@query(
    "win_row_number",
    """select o_orderkey, o_orderstatus, row_number() over (partition by o_orderstatus order by o_totalprice desc, o_orderkey)
       as rn from orders""",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    by_price = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return ordered.row_numbers(rows, by_price, "rn", t.staging(), ["o_orderstatus"]).drop("o_totalprice")


@query(
    "win_global_rank",
    "select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as rn from orders",
)
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_totalprice")
    by_price = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return ordered.row_numbers(rows, by_price, "rn", t.staging()).drop("o_totalprice")


@query(
    "win_trailing_months",
    """with m as (select p_brand, cast(year(l_shipdate) * 12 + month(l_shipdate) as int) as mi,
                  cast(sum(l_quantity) as bigint) as units
                  from lineitem join part on p_partkey = l_partkey group by all)
       select a.p_brand, a.mi, a.units, cast(sum(b.units) as bigint) as nine_before from m a
       left join m b on a.p_brand = b.p_brand and b.mi between a.mi - 9 and a.mi - 1 group by all""",
)
def _(t: Tables) -> DataFrame:
    sold = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    index = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    months = sold.groupBy("p_brand", index.alias("mi")).agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return trailing_sums(months, ["p_brand"], "mi", "units", 9, "nine_before", t.staging())


@query(
    "win_trailing_years",
    """with m as (select l_suppkey, cast(year(l_shipdate) * 12 + month(l_shipdate) as int) as mi,
                  cast(sum(l_quantity) as bigint) as units
                  from lineitem group by all)
       select a.l_suppkey, a.mi, a.units, cast(sum(b.units) as bigint) as two_years_before from m a
       left join m b on a.l_suppkey = b.l_suppkey and b.mi between a.mi - 24 and a.mi - 1 group by all""",
)
def _(t: Tables) -> DataFrame:
    index = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    months = t.lineitem.groupBy("l_suppkey", index.alias("mi")).agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return trailing_sums(months, ["l_suppkey"], "mi", "units", 24, "two_years_before", t.staging())


@query("top_n", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 50")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query(
    "sort_multi",
    """select o_orderstatus, o_orderpriority, count(*) as orders from orders group by all
       order by o_orderstatus desc, o_orderpriority""",
)
def _(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("orders"))
    return counts.orderBy(F.desc("o_orderstatus"), "o_orderpriority")


@query(
    "union_all",
    """select l_suppkey as shop, cast(l_quantity as bigint) as units from lineitem where l_returnflag = 'A'
       union all select l_suppkey, -cast(l_quantity as bigint) from lineitem where l_returnflag = 'R'""",
)
def _(t: Tables) -> DataFrame:
    units = F.col("l_quantity").cast("bigint")
    sold = t.lineitem.where(F.col("l_returnflag") == "A").select(F.col("l_suppkey").alias("shop"), units.alias("units"))
    back = t.lineitem.where(F.col("l_returnflag") == "R").select((-units).alias("units"), F.col("l_suppkey").alias("shop"))
    return sold.unionByName(back)


# --- scalar functions ------------------------------------------------------------------------


@query(
    "str_substring",
    "select p_partkey, p_type[1:3] as atc2, substr(p_brand, 7, 2) as brand_no from part",
)
def _(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.substring("p_type", 1, 3).alias("atc2"), F.substring("p_brand", 7, 2).alias("brand_no")
    )


@query("str_left_right", "select c_custkey, left(c_name, 4) as l, right(c_name, 5) as r from customer")
def _(t: Tables) -> DataFrame:
    name = F.col("c_name")
    return t.customer.select("c_custkey", F.left(name, F.lit(4)).alias("l"), F.right(name, F.lit(5)).alias("r"))


@query(
    "str_zero_pad",
    """select l_orderkey, l_partkey, right(repeat('0', 4) || left(l_orderkey::varchar, 4), 4) as code4,
       right(repeat('0', 8) || left(l_partkey::varchar, 8), 8) as code8 from lineitem""",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        c.zero_pad(F.col("l_orderkey"), 4).alias("code4"),
        c.zero_pad(F.col("l_partkey"), 8).alias("code8"),
    )


@query(
    "str_concat",
    f"""select cycle_id, account_id, cycle_id || '-' || bonus as plus,
        concat(cycle_id, '-', bonus) as parts from ({_LOG})""",
)
def _(t: Tables) -> DataFrame:
    cycle, bonus = F.col("cycle_id").cast("string"), F.col("bonus").cast("string")
    return t.standin("log_pp").select(
        "cycle_id",
        "account_id",
        F.concat(cycle, F.lit("-"), bonus).alias("plus"),
        c.text_concat(cycle, F.lit("-"), bonus).alias("parts"),
    )


@query("null_coalesce", f"select cycle_id, coalesce(is_deleted, 0) as is_deleted, coalesce(bonus, unit) as value from ({_LOG})")
def _(t: Tables) -> DataFrame:
    return t.standin("log_pp").select(
        "cycle_id",
        c.isnull(F.col("is_deleted"), F.lit("0"), "int").alias("is_deleted"),
        c.isnull(F.col("bonus"), F.col("unit"), "int").alias("value"),
    )


@query(
    "cast_types",
    """select o_orderkey, cast(o_orderkey as varchar) as text, cast(cast(o_orderkey as varchar) as int) as number,
       cast(o_custkey as double) as float, cast(cast(cast(o_totalprice as decimal(12,2)) as decimal(18,3)) as double) as exact
       from orders""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        key.cast("string").alias("text"),
        key.cast("string").cast("int").alias("number"),
        F.col("o_custkey").cast("double").alias("float"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(18,3)").cast("double").alias("exact"),
    )


def _per_day(t: Tables, **columns: Column) -> DataFrame:
    """Orders per day with expressions on the day."""
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("orders"))
    return days.select("day", "orders", *[v.alias(k) for k, v in columns.items()])


def _days_sql(columns: str) -> str:
    return f"select day, orders, {columns} from (select cast(o_orderdate as date) as day, count(*) as orders from orders group by 1)"


@query(
    "date_format_styles",
    _days_sql(
        "strftime(day, '%Y%m%d') as s112, strftime(day, '%m/%d/%Y') as s101, "
        "monthname(day)[1:3] || ' ' || lpad(day(day)::varchar, 2, ' ') || ' ' || year(day) as s100"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    return _per_day(t, s112=dt.style_112(day), s101=dt.style_101(day), s100=dt.style_100(day))


@query(
    "date_parse",
    """select cast(strptime(ym || '01', '%Y%m%d') as date) as first_day, orders from
       (select strftime(o_orderdate, '%Y%m') as ym, count(*) as orders from orders group by 1)""",
)
def _(t: Tables) -> DataFrame:
    months = t.orders.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("ym")).agg(F.count("*").alias("orders"))
    return months.select(F.to_date(F.concat("ym", F.lit("01")), "yyyyMMdd").alias("first_day"), "orders")


@query(
    "date_parts",
    _days_sql(
        "day(day) as d, month(day) as m, quarter(day) as q, year(day) as y, dayofweek(day) + 1 as dw, dayofyear(day) as dy"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    parts = {"d": F.dayofmonth, "m": F.month, "q": F.quarter, "y": F.year, "dw": F.dayofweek, "dy": F.dayofyear}
    return _per_day(t, **{k: f(day).cast("bigint") for k, f in parts.items()})


@query("date_names", _days_sql("dayname(day) as weekday, monthname(day) as month_name"))
def _(t: Tables) -> DataFrame:
    return _per_day(t, weekday=F.date_format("day", "EEEE"), month_name=F.date_format("day", "MMMM"))


@query(
    "date_add",
    _days_sql(
        "cast(day - 7 as date) as week_before, cast(day + interval 1 month as date) as next_month, "
        "cast(day + interval 3 month as date) as next_quarter, cast(day - interval 1 year as date) as year_before"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    return _per_day(
        t,
        week_before=F.date_sub(day, 7),
        next_month=F.add_months(day, 1),
        next_quarter=F.add_months(day, 3),
        year_before=F.add_months(day, -12),
    )


@query(
    "date_diff",
    _days_sql(
        "datediff('day', date '1995-01-01', day) as days, datediff('quarter', date '1995-01-01', day) as quarters"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    quarters = (F.year(day) - 1995) * 4 + F.quarter(day) - 1
    return _per_day(t, days=F.datediff(day, F.lit("1995-01-01").cast("date")), quarters=quarters)


@query(
    "date_bounds",
    _days_sql(
        "cast(date_trunc('month', day) as date) as m0, last_day(day) as m1, cast(date_trunc('quarter', day) as date) as q0, "
        "cast(date_trunc('quarter', day) + interval 3 month as date) - 1 as q1, make_date(year(day), 1, 1) as y0, "
        "make_date(year(day), 12, 31) as y1"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    return _per_day(
        t,
        m0=dt.month_start(day),
        m1=F.last_day(day),
        q0=dt.quarter_start(day),
        q1=F.last_day(F.add_months(dt.quarter_start(day), 2)),
        y0=dt.year_start(day),
        y1=F.make_date(F.year(day), F.lit(12), F.lit(31)),
    )


@query(
    "date_suffix",
    _days_sql(
        "day(day) || case when day(day) in (1, 21, 31) then 'st' when day(day) in (2, 22) then 'nd' "
        "when day(day) in (3, 23) then 'rd' else 'th' end as suffix"
    ),
)
def _(t: Tables) -> DataFrame:
    return _per_day(t, suffix=dt.day_suffix(F.col("day")))


_WW = "(select count(*) from generate_series(date_trunc('year', {0}) + interval 1 day, {0}::timestamp, interval 1 day) g(x) where dayofweek(x) = 0) + 1"


@query(
    "date_weeks",
    f"""select *, ww - first_ww + 1 as week_of_month, datediff('day', date_trunc('quarter', day), day) // 7 + 1 as week_of_quarter
        from ({_days_sql(_WW.format('day') + ' as ww, ' + _WW.format("date_trunc('month', day)") + ' as first_ww')})""",
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    return _per_day(
        t,
        ww=dt.week_of_year(day),
        first_ww=dt.week_of_year(dt.month_start(day)),
        week_of_month=dt.week_of_month(day),
        week_of_quarter=dt.week_of_quarter(day),
    )


@query(
    "date_labels",
    _days_sql(
        "month(day) - 3 * (quarter(day) - 1) as mq, ['First', 'Second', 'Third', 'Fourth'][quarter(day)] as q, "
        "'CY ' || year(day) as cy, monthname(day)[1:3] || '-' || year(day) as my, strftime(day, '%m%Y') as mmyyyy"
    ),
)
def _(t: Tables) -> DataFrame:
    day = F.col("day")
    return _per_day(
        t,
        mq=dt.month_of_quarter(day),
        q=dt.pick(dt.QUARTER_NAMES, F.quarter(day)),
        cy=F.concat(F.lit("CY "), F.year(day).cast("string")),
        my=F.concat(F.date_format(day, "MMM"), F.lit("-"), F.year(day).cast("string")),
        mmyyyy=dt.mmyyyy(F.month(day), F.year(day)),
    )


@query(
    "math_round",
    "select l_orderkey, cast(round(cast(l_extendedprice as decimal(18,2)) * 5 / 10, 0) as int) as half from lineitem",
)
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", c.round_to_int(money("l_extendedprice") * 5 / 10).alias("half"))


@query(
    "math_pct_change",
    """with y as (select l_suppkey, cast(sum(case when year(l_shipdate) = 1999 then l_quantity end) as bigint) as p,
                  cast(sum(case when year(l_shipdate) = 2000 then l_quantity end) as bigint) as c from lineitem group by 1)
       select l_suppkey, round(abs(100.0 * (c - p) / p), 3) as change from y""",
)
def _(t: Tables) -> DataFrame:
    def units(year: int) -> Column:
        return F.sum(F.when(F.year("l_shipdate") == year, F.col("l_quantity"))).cast("bigint")

    sums = t.lineitem.groupBy("l_suppkey").agg(units(1999).alias("p"), units(2000).alias("c"))
    change = F.when(F.col("p") != 0, F.abs(F.lit(100.0) * (F.col("c") - F.col("p")) / F.col("p")))
    return sums.select("l_suppkey", F.round(change, 3).alias("change"))


@query(
    "math_int_div",
    "select l_suppkey, cast(sum(l_quantity) as bigint) // 9 as nine_month_mean from lineitem group by 1",
)
def _(t: Tables) -> DataFrame:
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").cast("bigint").alias("units"))
    return sums.select("l_suppkey", c.int_div(F.col("units"), F.lit(9)).alias("nine_month_mean"))


@query(
    "json_extract",
    "select event_id, cast(json_extract_string(props, '$.k') as int) as k, json_extract_string(props, '$.none') as none from events",
)
def _(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.get_json_object("props", "$.none").alias("none"),
    )
