"""Projection queries. The SQL keeps one GROUP BY per level, a self-join running sum and one
join per lookup, so that it shares no plan idea with the Spark jobs."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.operators.levels import one_level
from dispensa.plans import projection as pj
from dispensa.sources.standins import standin, standin_sql
from dispensa.sources.staging import Staging
from dispensa.sources.tables import control_value

FOLDED = {"AFRICA": "AFRICA/MIDDLE EAST", "MIDDLE EAST": "AFRICA/MIDDLE EAST"}


def inputs(spark: SparkSession, folder: str, staging: Staging) -> pj.Inputs:
    """The stand-ins; the two control tables are stored, since a real run finds them as tables."""

    def t(name: str) -> DataFrame:
        return standin(spark, folder, name)

    return pj.Inputs(
        sellin=t("sellin"),
        sellout=t("sellout_tx"),
        shops_raw=t("shops_raw"),
        brick_region=t("brick_region"),
        region_name=t("region_name"),
        packs_raw=t("packs_raw"),
        pfg=t("pfg"),
        prod_flag=t("prod_flag"),
        oper=staging.keep(t("oper"), "oper"),
        months=staging.keep(control_value(t("ctrl"), "MthsAvg", "int", "MthsAvg"), "months"),
        folded_regions=FOLDED,
    )


def run(spark: SparkSession, folder: str) -> pj.Projection:
    staging = Staging(spark)
    return pj.Projection(inputs(spark, folder, staging), staging)


# --- the oracle ------------------------------------------------------------------------------

# The levels from the finest to the coarsest, written out here, so that the jobs' own order is held against it.
LEVELS = ("Brand", "ATC4", "ATC3", "ATC2", "ATC1", "Basket", "Rx")
ALL_LEVELS = ("Class", "Brand", "ATC4", "ATC3", "ATC2", "ATC1", "Basket", "Rx")
_STRATUM = ("PdID", "Region", "TSC", "Chain")
_ATTRS = "Brand, ATC1, ATC2, ATC3, ATC4, Basket, Rx, Class"
_INPUTS = (
    "sellin", "sellout_tx", "shops_raw", "brick_region", "region_name", "packs_raw", "pfg", "prod_flag", "ctrl", "oper",
)


def _levels_sql(prefix: str, base: str) -> dict[str, str]:
    """One GROUP BY per level over ``base``."""
    return {
        f"{prefix}_{level}": f"""select {', '.join(_STRATUM)}, {level},
            cast(sum(Units) as bigint) // (select m from months) as u from {base} group by all"""
        for level in ALL_LEVELS
    }


def _attach_sql(prefix: str, table: str, base: str) -> str:
    def same(alias: str, mine: str, theirs: str) -> str:
        strata = " and ".join(f"b.{k} = {alias}.{k}" for k in _STRATUM)
        return f"{strata} and b.{mine} = {alias}.{theirs}"

    joins = [f"left join {table}_Class k on {same('k', 'Brand', 'Class')}"]
    joins += [f"left join {table}_{lv} {lv.lower()}_m on {same(lv.lower() + '_m', lv, lv)}" for lv in LEVELS]
    cases = " ".join(f"when b.Class = b.{lv} then {lv.lower()}_m.u" for lv in LEVELS)
    values = ", ".join(f"{lv.lower()}_m.u as {prefix}Wx{lv}Units" for lv in LEVELS)
    return (
        f"select b.PdID, b.ShopID, b.PackID, b.Region, b.TSC, b.Chain, b.Brand, b.ATC1, b.ATC2, b.ATC3, b.ATC4, "
        f"b.Basket, b.Rx, b.Class, case {cases} else k.u end as {prefix}WxClassUnits, {values} "
        f"from {base} b " + " ".join(joins)
    )


def _orphan_levels_sql() -> str:
    joins, values = [], []
    for lv in ALL_LEVELS:
        keys = f"{', '.join(_STRATUM)}, {lv}"
        on_p = " and ".join(f"o.{k} = p_{lv}.{k}" for k in (*_STRATUM, lv))
        on_u = " and ".join(f"o.{k} = u_{lv}.{k}" for k in (*_STRATUM, lv))
        joins.append(
            f"left join (select distinct {keys}, PanelWx{lv}Units from panel_levels "
            f"where PanelWx{lv}Units is not null) p_{lv} on {on_p} "
            f"left join (select distinct {keys}, UnvrsWx{lv}Units from potential) u_{lv} on {on_u}"
        )
        values.append(f"u_{lv}.UnvrsWx{lv}Units, p_{lv}.PanelWx{lv}Units")
    return f"select o.*, {', '.join(values)} from orphans o " + " ".join(joins)


def _fallback_sql() -> str:
    pf = " ".join(
        f"when coalesce(PanelWx{lv}Units, 0) > 0 then UnvrsWx{lv}Units::double / PanelWx{lv}Units" for lv in ALL_LEVELS
    )
    value = " ".join(f"when coalesce(PanelWx{lv}Units, 0) > 0 then {lv}" for lv in ALL_LEVELS)
    return f"""select PdID, ShopID, PackID, case {pf} end as PF, Region, TSC, Chain, case {value} end as Class,
               1 as Orphan from orphan_levels"""


def _ctes() -> dict[str, str]:
    prior = "(select max(pd_id) // 100 - 1 from oper)"
    known = "pfc in (select substring(bridge_code, 2, 7) from packs_raw) and customer_code in (select imscode from base where onUnvrs = 1)"
    out = {name: standin_sql(name) for name in _INPUTS}
    out |= {
        "months": "select cast(val as int) as m from ctrl where param = 'MthsAvg'",
        "numbered": """select cast((cast(left(period, 4) as int) - min(cast(left(period, 4) as int)) over ()) * 12
            + cast(right(period, 2) as int) as int) as PdNbr, period as PdID from (select distinct period from sellin)""",
        "pd": """select a.PdNbr, a.PdID, b.PdNbr as ProcPdNbr, o.pd_id as ProcPdID
            from numbered a, months, oper o, numbered b
            where strptime(a.PdID || '01', '%Y%m%d') between strptime(o.pd_id::varchar || '01', '%Y%m%d') - to_months(m)
                  and strptime(o.pd_id::varchar || '01', '%Y%m%d') - to_months(1)
              and b.PdID = o.pd_id::varchar""",
        "base": """select imscode, case when bolge in ('AFRICA', 'MIDDLE EAST') then 'AFRICA/MIDDLE EAST' else bolge end
            as Region, on_universe as onUnvrs, on_panel as onPanel
            from shops_raw left join brick_region on brick1 = brick left join region_name on brickcode = tcode""",
        "turnover": f"""select customer_code, cast(sum(total_unit) as bigint) as Units from sellin
            where cast(period as int) between {prior} * 100 + 1 and {prior} * 100 + 12 and {known}
            group by customer_code""",
        "lone_shops": f"""select distinct customer_code from sellin
            where (period in (select PdID from pd) or cast(period as int) in (select ProcPdID from pd))
              and customer_code not in (select customer_code from turnover) and {known}""",
        "shop_units": """select cast(customer_code as int) as ShopID, Region, onPanel, Units
            from (select * from turnover union all select customer_code, null from lone_shops)
            join base on imscode = customer_code""",
        "medians": """select Region, cast(floor(median(Units)) as bigint) as UnitsAvg from shop_units
            where Units is not null group by Region""",
        "filled": """select s.Region, ShopID, onPanel, coalesce(Units, UnitsAvg) as Units
            from shop_units s join medians m on s.Region = m.Region""",
        "ranked": "select *, row_number() over (order by Units desc, ShopID) as rn from filled",
        "cumulated": """select a.ShopID, a.Region, a.onPanel, a.Units, cast(sum(b.Units) as bigint) as UnitsCUM
            from ranked a join ranked b on a.rn >= b.rn group by all""",
        "shops": """select ShopID, Region, case when UnitsCUM::double / (select max(UnitsCUM) from cumulated) < 0.5 then 3
            when UnitsCUM::double / (select max(UnitsCUM) from cumulated) > 0.8 then 1 else 2 end as TSC,
            1 as Chain, onPanel from cumulated""",
        "packs": """select cast(bridge_code as int) as PackID, prod_desc as Brand, class_code[1:1] as ATC1,
            class_code[1:3] as ATC2, class_code[1:4] as ATC3, class_code as ATC4, g.pfg as Basket,
            case pack_flag when 'PRESC' then '1' else '0' end as Rx,
            case lower(prod_flag) when 'pfc' then cast(cast(bridge_code as int) as varchar) when 'brand' then prod_desc
                 when 'atc1' then class_code[1:1] when 'atc2' then class_code[1:3] when 'atc3' then class_code[1:4]
                 when 'atc4' then class_code when 'rx' then case pack_flag when 'PRESC' then '1' else '0' end
                 else g.pfg end as Class
            from packs_raw p join pfg g on bridge_code = lpad(g.pfc, 8, '0')
            left join prod_flag f on bridge_code = lpad(f.pfc, 8, '0')""",
        "unvrs": """select ProcPdID as PdID, ShopID, PackID, cast(sum(total_unit) as bigint) as Units
            from sellin join pd on PdID = period join shops on lpad(ShopID::varchar, 7, '0') = customer_code
            join packs on lpad(PackID::varchar, 7, '0') = pfc group by all""",
        "panel": """select distinct ProcPdID as PdID, ShopID, PackID
            from sellout_tx join pd on ProcPdID = cast(strftime(sale_date, '%Y%d') as int)
            join shops on lpad(ShopID::varchar, 7, '0') = shop_code join packs on lpad(PackID::varchar, 7, '0') = pfc
            where record_type <> '03' and onPanel = 1""",
        "unvrs_base": f"""select PdID, u.ShopID, u.PackID, Region, TSC, Chain, {_ATTRS}, Units
            from unvrs u join shops s on u.ShopID = s.ShopID join packs p on u.PackID = p.PackID""",
    }
    out |= _levels_sql("um", "unvrs_base")
    out["unvrs_levels"] = _attach_sql("Unvrs", "um", "unvrs_base")
    out["panel_base"] = """select * from unvrs_base b
        where exists (select 1 from panel p where p.PdID = b.PdID and p.ShopID = b.ShopID)"""
    out |= _levels_sql("pm", "panel_base")
    out["panel_hit"] = "select b.* from panel p join panel_base b using (PdID, ShopID, PackID)"
    out["panel_levels"] = _attach_sql("Panel", "pm", "panel_hit")
    out["potential"] = f"""select distinct {', '.join(_STRATUM)}, {_ATTRS},
        {', '.join(f'UnvrsWx{lv}Units' for lv in ALL_LEVELS)} from unvrs_levels"""
    out["orphans"] = f"""select x.PdID, x.ShopID, x.PackID, Region, TSC, Chain, {_ATTRS}
        from panel x join shops s on x.ShopID = s.ShopID join packs p on x.PackID = p.PackID
        where not exists (select 1 from unvrs_base b
                          where b.PdID = x.PdID and b.ShopID = x.ShopID and b.PackID = x.PackID)"""
    out["orphan_levels"] = _orphan_levels_sql()
    out["regular"] = """select distinct p.PdID, ShopID, PackID, case when PanelWxClassUnits > 0
        then UnvrsWxClassUnits::double / PanelWxClassUnits end as PF, p.Region, p.TSC, p.Chain, p.Class, 0 as Orphan
        from panel_levels p join (select distinct PdID, Region, TSC, Chain, Class, UnvrsWxClassUnits from potential) u
          on p.PdID = u.PdID and p.Region = u.Region and p.TSC = u.TSC and p.Chain = u.Chain and p.Class = u.Class"""
    out["fallback"] = _fallback_sql()
    out["factors"] = "select * from regular union all select * from fallback"
    return out


def oracle(final: str) -> str:
    body = ",\n".join(f"{name} as materialized ({text})" for name, text in _ctes().items())
    return f"with {body}\n{final}"


def _long_means_sql(prefix: str) -> str:
    strata = ", ".join(_STRATUM)
    return " union all ".join(
        f"select {strata}, '{lv}' as Level, {lv} as Value, u as Units from {prefix}_{lv}" for lv in ALL_LEVELS
    )


def _panel_groups(job: pj.Projection) -> DataFrame:
    return job.means().where(F.col("onPanel") == 1)


def _long_means(job: pj.Projection, prefix: str) -> DataFrame:
    means = job.means() if prefix == "Unvrs" else _panel_groups(job)
    return means.select(*_STRATUM, "Level", "Value", F.col(f"{prefix}Units").alias("Units"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _period_index(spark: SparkSession, folder: str) -> DataFrame:
    return pj.month_index(pj.distinct_periods(standin(spark, folder, "sellin")))


def _period_window(spark: SparkSession, folder: str) -> DataFrame:
    i = inputs(spark, folder, Staging(spark))
    return pj.expand_periods(pj.month_index(pj.distinct_periods(i.sellin)), i.oper, i.months)


def _projected_units(job: pj.Projection) -> DataFrame:
    return _rounded(pj.apply_factors(job.inputs.sellout, job.factors(), job.inputs.oper), "ProjUnits")


_ROUNDED_FACTORS = "select * replace (round(PF, 6) as PF) from "

_CHECK_SQL = "select Region, {} , count(distinct ShopID) as Stores_TOT from shops group by Region".format(
    ", ".join(f"count(distinct ShopID) filter (TSC = {c}) as Stores_TSC{c}" for c in (1, 2, 3))
)

_PROJECTED_SQL = """select Region, count(distinct ShopID) as No_of_Shops, count(distinct PackID) as No_of_Packs,
    cast(sum(pr_unit) as bigint) as Units, round(sum(pr_unit * PF), 6) as ProjUnits
    from sellout_tx join factors on PdID = cast(strftime(sale_date, '%Y%d') as int)
     and lpad(ShopID::varchar, 7, '0') = lpad(shop_code, 7, '0') and lpad(PackID::varchar, 8, '0') = lpad(pfc, 8, '0')
    group by Region"""

# Stages of one run, with the SQL that ends the oracle's chain.
STAGES: dict[str, tuple[Callable[[pj.Projection], DataFrame], str]] = {
    "shop_region": (lambda j: j.shop_base(), "select * from base"),
    "shop_turnover": (lambda j: pj.prior_year_turnover(j.shop_sales()), "select * from turnover"),
    "orphan_shops": (lambda j: pj.orphan_shops(j.shop_sales()), "select * from lone_shops"),
    "shop_universe": (lambda j: j.shop_universe(), "select * from shop_units"),
    "group_median": (lambda j: j.median(), "select * from medians"),
    "impute_median": (lambda j: j.imputed(), "select * from filled"),
    "running_sum": (lambda j: j.cumulative(), "select * from cumulated"),
    "size_class": (lambda j: j.shops(), "select * from shops"),
    "size_class_check": (lambda j: pj.size_class_check(j.shops()), _CHECK_SQL),
    "pack_hierarchy": (lambda j: j.packs().drop("Class"), "select * exclude (Class) from packs"),
    "projection_class": (lambda j: j.packs().select("PackID", "Class"), "select PackID, Class from packs"),
    "universe": (lambda j: j.universe(), "select * from unvrs"),
    "panel": (lambda j: j.panel(), "select * from panel"),
    "universe_base": (lambda j: j.universe_base(), "select * from unvrs_base"),
    "level_means_universe": (lambda j: _long_means(j, "Unvrs"), _long_means_sql("um")),
    "universe_levels": (lambda j: j.universe_levels(), "select * from unvrs_levels"),
    "panel_base": (lambda j: j.panel_base(), "select * from panel_base"),
    "level_means_panel": (lambda j: _long_means(j, "Panel"), _long_means_sql("pm")),
    "panel_levels": (lambda j: j.panel_levels(), "select * from panel_levels"),
    "potential": (lambda j: j.potential(), "select * from potential"),
    "orphan_packs": (lambda j: j.orphans(), "select * from orphans"),
    "orphan_levels": (lambda j: j.orphan_levels(), "select * from orphan_levels"),
    "factor_regular": (lambda j: _rounded(j.factor_regular(), "PF"), _ROUNDED_FACTORS + "regular"),
    "factor_orphan": (lambda j: _rounded(j.factor_orphan(), "PF"), _ROUNDED_FACTORS + "fallback"),
    "projection_factors": (lambda j: _rounded(j.factors(), "PF"), _ROUNDED_FACTORS + "factors"),
    "projected_units": (_projected_units, _PROJECTED_SQL),
}
for _lv in ALL_LEVELS:
    STAGES[f"level_means_universe_{_lv.lower()}"] = (
        lambda j, lv=_lv: one_level(j.means(), lv, "UnvrsUnits", f"UnvrsWx{lv}Units"),
        f"select PdID, Region, TSC, Chain, {_lv}, u as UnvrsWx{_lv}Units from um_{_lv}",
    )
    STAGES[f"level_means_panel_{_lv.lower()}"] = (
        lambda j, lv=_lv: one_level(_panel_groups(j), lv, "PanelUnits", f"PanelWx{lv}Units"),
        f"select PdID, Region, TSC, Chain, {_lv}, u as PanelWx{_lv}Units from pm_{_lv}",
    )



def _universe_long(spark: SparkSession, folder: str) -> DataFrame:
    """The universe over windows of 24 months; one pass over the sell-in sums what these and the run's own need."""
    staging = Staging(spark)
    given, months = inputs(spark, folder, staging), spark.sql("select 24 as MthsAvg")
    needed = pj.needed_periods(given.oper, given.months).unionByName(pj.needed_periods(given.oper, months)).distinct()
    monthly = staging.keep(pj.monthly_sellin(given.sellin, needed), "monthly")
    job = pj.Projection(dataclasses.replace(given, kept=monthly), staging)
    window = staging.keep(pj.window_periods(pj.distinct_periods(monthly), given.oper, months), "window")
    of_windows = F.broadcast(window.select(F.col("PdID").alias("period")).distinct())
    return pj.universe(monthly.join(of_windows, "period", "left_semi"), window, job.shops(), job.packs())


_LONG_SQL = """select pd_id as PdID, ShopID, PackID, cast(sum(total_unit) as bigint) as Units
    from oper join sellin on cast(left(period, 4) as int) * 12 + cast(right(period, 2) as int)
        between (pd_id // 100) * 12 + pd_id % 100 - 24 and (pd_id // 100) * 12 + pd_id % 100 - 1
    join shops on lpad(ShopID::varchar, 7, '0') = customer_code join packs on lpad(PackID::varchar, 7, '0') = pfc
    where pd_id::varchar in (select period from sellin) group by all"""

_SELLIN = "customer_code string, pfc string, total_unit int, period string"


def _incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Sell-in sums that are kept, after the last month got a late correction: a unit more for each of its rows."""
    root = Staging(spark).root
    sellin = standin(spark, folder, "sellin")
    sellin.hint("rebalance", "period").write.partitionBy("period").parquet(f"{root}/sellin")
    sums = pj.monthly_sums(spark, f"{root}/sellin", _SELLIN, f"{root}/sums")
    sums.refresh()
    last = sellin.agg(F.max("period").alias("period"))
    late = sellin.join(F.broadcast(last), "period").withColumn("total_unit", F.lit(1))
    late.write.mode("append").partitionBy("period").parquet(f"{root}/sellin")
    sums.refresh()
    return sums.store.read()


_INCREMENTAL_SQL = f"""with sellin as ({standin_sql('sellin')})
    select period, customer_code, pfc, cast(sum(total_unit) as bigint) as total_unit
    from (select * from sellin union all
          select period, customer_code, pfc, 1 from sellin where period = (select max(period) from sellin))
    group by period, customer_code, pfc"""

QUERIES: dict[str, Query] = {
    "monthly_incremental": Query(_incremental, _INCREMENTAL_SQL),
    "universe_24": Query(_universe_long, oracle(_LONG_SQL)),
    "period_index": Query(_period_index, oracle("select * from numbered")),
    "period_window": Query(_period_window, oracle("select * from pd")),
    **{
        key: Query(lambda spark, folder, pick=pick: pick(run(spark, folder)), oracle(final))
        for key, (pick, final) in STAGES.items()
    },
}
