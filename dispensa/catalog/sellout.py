"""Sell-out queries. The SQL joins every fact row to the dimensions and aggregates once."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.operators.distinct import bitmaps, counts, merged
from dispensa.plans import sellout as so
from dispensa.sources.periods import PeriodTable
from dispensa.sources.snapshots import Snapshots
from dispensa.sources.standins import standin, standin_sql
from dispensa.sources.staging import Staging

PHARMACY, PERIOD, MARKET = "0000001", "0003", "ILAC"


def _numbers(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def _accounts(spark: SparkSession, folder: str) -> DataFrame:
    tables = [standin(spark, folder, n) for n in ("account", "shops_raw", "brick_region", "region_name")]
    return Staging(spark).keep(so.account_regions(*tables), "accounts")


def _market(spark: SparkSession, folder: str, market: so.Market) -> DataFrame:
    t = {n: standin(spark, folder, n) for n in ("month_src", "price_list", "atc_names")}
    return so.market_sellout(t["month_src"], [market], t["price_list"], _accounts(spark, folder), t["atc_names"])


def mart(spark: SparkSession, folder: str, period: str | None = None) -> DataFrame:
    t = {n: standin(spark, folder, n) for n in ("month_src", "price_list", "atc_names")}
    return so.sellout_mart(t["month_src"], t["price_list"], _accounts(spark, folder), t["atc_names"], period)


def _union(spark: SparkSession, folder: str) -> DataFrame:
    facts = standin(spark, folder, "month_src")
    drug, other = (
        so.require_not_null(so.union_sources(facts, m), so.FACT_COLUMNS).withColumn("market", F.lit(m.label))
        for m in (so.DRUG, so.NON_DRUG)
    )
    return _numbers(drug.unionByName(other))


def _store(spark: SparkSession) -> Snapshots:
    return so.mart_store(spark, Staging(spark).root + "/mart")


def _load(store: Snapshots, folder: str, facts: DataFrame, accounts: DataFrame) -> so.LoadReport:
    dims = [standin(store.spark, folder, n) for n in ("price_list", "atc_names")]
    return so.load_mart(store, facts, dims[0], accounts, dims[1])


def _published(spark: SparkSession, folder: str) -> DataFrame:
    """The stored mart, as reports read it."""
    store = _store(spark)
    _load(store, folder, standin(spark, folder, "month_src"), _accounts(spark, folder))
    return store.read()


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    """What the versions of a mart hold: a whole load, the returns of some months alone, and the first one again."""
    store, accounts = _store(spark), _accounts(spark, folder)
    facts = standin(spark, folder, "month_src")
    first = _load(store, folder, facts, accounts).version
    _load(store, folder, facts.where("source in ('R', 'RP') and period like '%6'"), accounts)
    store.restore(first)
    found = [
        store.read(v).groupBy("DONEM", "PazarTipi").agg(
            F.count("*").alias("n"), F.sum(F.col("KUTU").cast("bigint")).alias("boxes"), F.sum("TL").alias("value")
        ).select(F.lit(v).alias("version"), "*")
        for v in store.versions()
    ]
    return functools.reduce(DataFrame.unionByName, found)


def _load_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The nulls that loads of delivered facts meet, source by source and as a whole, and the version that each makes."""
    store, accounts = _store(spark), _accounts(spark, folder)
    raw, rows = standin(spark, folder, "month_raw"), []
    whole = standin(spark, folder, "month_src")
    for name, facts in (("raw", raw), ("raw sales", raw.where("source = 'T'")), ("whole", whole)):
        report = _load(store, folder, facts, accounts)
        rows += [(name, c, report.rows, n, report.version) for c, n in report.nulls.items()]
    return spark.createDataFrame(rows, "load string, column string, rows bigint, nulls bigint, version int")


_MART_NULLABLE = ("AccountName", "Urun", "TL", "Kategori1", "Bolge", "OldCode")


def _violations(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls in the 19 columns that must be filled, and in those of a delivery that lacks some values."""
    raw = standin(spark, folder, "month_raw")
    whole = so.not_null_violations(standin(spark, folder, "month_src"), so.FACT_COLUMNS)
    delivered = so.not_null_violations(raw, so.FACT_COLUMNS).select(*[F.col(c).alias(f"raw_{c}") for c in so.FACT_COLUMNS])
    return whole.crossJoin(F.broadcast(delivered))  # one row each


def _mart_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return so.not_null_violations(mart(spark, folder), _MART_NULLABLE)


def _top(spark: SparkSession, folder: str) -> DataFrame:
    periods = standin(spark, folder, "report_period")
    return so.top_products(_published(spark, folder), periods, PHARMACY, PERIOD, MARKET)


def _top_all(spark: SparkSession, folder: str) -> DataFrame:
    return so.top_products_all(_published(spark, folder), standin(spark, folder, "report_period"))


def _rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct shops and products by month, quarter and year; the fact is read for the months alone."""
    facts = standin(spark, folder, "month_src").select(
        "period", F.rtrim("whs").cast("int").alias("shop"), F.rtrim("pfc").cast("int").alias("pack")
    )
    measures = {"shops": F.col("shop"), "packs": F.col("pack")}
    months = Staging(spark).keep(bitmaps(facts, ["period"], measures), "bitmaps")
    year = F.substring("period", 1, 2)
    quarter = F.concat(year, F.lit("Q"), F.quarter(F.to_date(F.concat(F.lit("20"), "period", F.lit("01")), "yyyyMMdd")).cast("string"))
    out = [
        counts(sets, ["span"], list(measures)).select(F.lit(level).alias("level"), "*")
        for level, sets in (
            ("month", months.withColumnRenamed("period", "span")),
            ("quarter", merged(months, [quarter.alias("span")])),
            ("year", merged(months, [year.alias("span")])),
        )
    ]
    return functools.reduce(DataFrame.unionByName, out)


_GROWN = (
    "sale_date date, whs string, pfc string, pr_unit decimal(10,0), pr_price decimal(10,2), setflag bigint, vat decimal(7,2), "
    "is_prescription int, prj_unit double"
)


def _grown(spark: SparkSession, folder: str) -> DataFrame:
    """Months that were written without two columns and with a narrower one, read under today's schema."""
    table = PeriodTable(spark, Staging(spark).root + "/months", _GROWN)
    facts = standin(spark, folder, "month_src")
    names = table.declared.names
    old = facts.select("period", *[c for c in names if c not in ("vat", "is_prescription")])
    new = facts.select("period", *names).withColumn("setflag", F.col("setflag").cast("bigint"))
    for rows, which in ((old, "substring(period, 1, 2) < '98'"), (new, "substring(period, 1, 2) >= '98'")):
        rows.where(which).hint("rebalance", "period").write.mode("append").partitionBy("period").parquet(table.root)
    sums = table.read().groupBy("period").agg(
        F.count("*").alias("n"), F.count("vat").alias("with_vat"), F.sum("vat").cast("double").alias("vat"),
        F.sum("is_prescription").alias("prescriptions"), F.sum("setflag").alias("flags"), F.sum("pr_unit").cast("bigint").alias("units"),
    )
    states = table.report().groupBy("period").agg(
        F.count(F.when(F.col("state") == "missing", 1)).alias("missing"), F.count(F.when(F.col("state") == "widened", 1)).alias("widened")
    )
    return sums.join(states, "period")


# --- the oracle ------------------------------------------------------------------------------

_INPUTS = (
    "month_src", "month_raw", "price_list", "account", "atc_names", "shops_raw", "brick_region", "region_name", "report_period",
)


def _market_sql(sources: str, label: str, price: str, names: str, periods: str = "%") -> str:
    cats = names.split()
    shown = ", ".join(f"{c} as Kategori{i}" for i, c in enumerate(cats, 1))
    keys = ", ".join(c for c in cats if c != "''")
    return f"""select '20' || s.period[1:2] as YIL, s.period as DONEM, rtrim(s.whs) as EczaneKod, account_name as AccountName,
        rtrim(s.pfc) as UrunKod, new_name as Urun, cast(sum(pr_unit + pr_bonus) as int) as KUTU,
        cast(round(sum((pr_unit + pr_bonus) * {price}), 0) as int) as TL, '{label}' as PazarTipi, {shown},
        who_atc as Kategori5, cast(1 as smallint) as Goster, bolge as Bolge, universe_code as UniverseCode
        from month_src s left join (select period, prd_cd, new_name, prod_flag, who_atc, pub_price as list_price, isf
                                    from price_list) l on l.prd_cd = rtrim(s.pfc) and l.period = s.period
        left join account on account_code = rtrim(s.whs)
        left join atc_names n on n.pfc = rtrim(s.pfc)
        left join shops_raw on imscode = universe_code left join brick_region on brick1 = brick
        left join region_name on brickcode = tcode
        where source in ({sources}) and s.period like '{periods}'
        group by s.period, s.whs, s.pfc, account_name, new_name, prod_flag, who_atc, bolge, universe_code, {keys}"""


def _oracle(final: str) -> str:
    ctes = {n: standin_sql(n) for n in _INPUTS}
    ctes["drug"] = _market_sql("'T', 'R'", "ILAC", "list_price", "atc1 atc2 atc3 atc4")
    ctes["other"] = _market_sql("'P', 'RP'", "ILAC DISI", "isf", "nfc1 nfc2 nfc3 ''")
    ctes["mart"] = "select *, cast(null as varchar) as OldCode from (select * from drug union all select * from other)"
    drug = _market_sql("'R'", "ILAC", "list_price", "atc1 atc2 atc3 atc4", "%6")
    other = _market_sql("'RP'", "ILAC DISI", "isf", "nfc1 nfc2 nfc3 ''", "%6")
    ctes["returned"] = f"select *, cast(null as varchar) as OldCode from (({drug}) union all ({other}))"
    ctes["ranked"] = """select UniverseCode, PazarTipi, coalesce(Urun, '') as URUN, coalesce(sum(TL), 0) as TL,
        coalesce(sum(KUTU), 0) as KUTU, DONEM as Donem, AccountName as Eczane,
        row_number() over (partition by UniverseCode, DONEM, PazarTipi
                           order by sum(TL) desc nulls last, Urun nulls first, AccountName nulls first) as RowNo
        from mart join report_period on period = DONEM
        where Goster = 1 and is_active = 1 and UniverseCode is not null
        group by UniverseCode, PazarTipi, Urun, DONEM, AccountName"""
    body = ",\n".join(f"{n} as ({t})" for n, t in ctes.items())
    return f"with {body}\n{final}"


# The fact's columns, written out here, so that the job's own are held against them.
_FACT = (
    "production", "sale_date", "whs", "pfc", "u_code", "pr_unit", "pr_bonus", "pr_price", "ndf_price", "setflag",
    "pub_price", "trd_price", "iskonto", "invoice_date", "invoice_number", "vat", "is_prescription", "prj_unit",
    "prj_value",
)
_DECIMALS = ("pr_unit", "pr_bonus", "pr_price", "ndf_price", "pub_price", "trd_price", "iskonto", "vat")
_UNION_SQL = f"""select period, {', '.join(f'{c}::double as {c}' if c in _DECIMALS else c for c in _FACT)},
    0::double as tpt_price,
    case when source in ('T', 'R') then 'ILAC' else 'ILAC DISI' end as market from month_src"""


def _null_counts(columns: tuple[str, ...], prefix: str = "") -> str:
    return ", ".join(f"count(*) - count({c}) as {prefix}{c}" for c in columns)


def _held(mart: str, version: int) -> str:
    return f"""select {version} as version, DONEM, PazarTipi, count(*) as n, sum(KUTU)::bigint as boxes, sum(TL)::bigint as value
        from {mart} group by DONEM, PazarTipi"""


def _checks(name: str, rows: str, version: str) -> str:
    return " union all ".join(
        f"select '{name}' as load, '{c}' as column, count(*) as rows, count(*) - count({c}) as nulls, {version} as version from {rows}"
        for c in _FACT
    )


_RANKED = "cast(TL as bigint) as TL, cast(KUTU as bigint) as KUTU, Donem, Eczane, RowNo, URUN"

QUERIES: dict[str, Query] = {
    "sellout_union": Query(_union, _oracle(_UNION_SQL)),
    "sellout_drug": Query(lambda s, d: _market(s, d, so.DRUG), _oracle("select * from drug")),
    "sellout_nondrug": Query(lambda s, d: _market(s, d, so.NON_DRUG), _oracle("select * from other")),
    "sellout_mart": Query(_published, _oracle("select * from mart")),
    "not_null_violations": Query(
        _violations,
        _oracle(
            f"select * from (select {_null_counts(_FACT)} from month_src), "
            f"(select {_null_counts(_FACT, 'raw_')} from month_raw)"
        ),
    ),
    "load_checks": Query(
        _load_checks,
        _oracle(
            " union all ".join(
                (
                    _checks("raw", "month_raw", "null::int"),
                    _checks("raw sales", "(select * from month_raw where source = 'T')", "null::int"),
                    _checks("whole", "month_src", "1"),
                )
            )
        ),
    ),
    "mart_version": Query(
        _versions,
        _oracle(
            f"""select * from ({_held('mart', 1)} union all {_held('mart', 3)} union all
                {_held("(select * from mart where DONEM not in (select DONEM from returned) union all select * from returned)", 2)})"""
        ),
    ),
    "distinct_rollup": Query(
        _rollup,
        _oracle(
            " union all ".join(
                f"""select '{level}' as level, {span} as span, count(distinct rtrim(whs)) as shops, count(distinct rtrim(pfc)) as packs
                    from month_src group by 2"""
                for level, span in (
                    ("month", "period"),
                    ("quarter", "period[1:2] || 'Q' || ((period[3:4]::int + 2) // 3)"),
                    ("year", "period[1:2]"),
                )
            )
        ),
    ),
    "period_schema_merge": Query(
        _grown,
        _oracle(
            """select period, count(*) as n, case when old then 0 else count(*) end as with_vat,
                      case when not old then sum(vat)::double end as vat,
                      case when not old then sum(is_prescription)::bigint end as prescriptions, sum(setflag)::bigint as flags,
                      sum(pr_unit)::bigint as units, case when old then 2 else 0 end::bigint as missing,
                      case when old then 1 else 0 end::bigint as widened
               from (select *, period[1:2] < '98' as old from month_src) group by period, old"""
        ),
    ),
    "mart_nulls": Query(_mart_nulls, _oracle(f"select {_null_counts(_MART_NULLABLE)} from mart")),
    "top_products": Query(
        _top,
        _oracle(
            f"select {_RANKED} from ranked where UniverseCode = '{PHARMACY}' and Donem = '{PERIOD}' "
            f"and PazarTipi = '{MARKET}' and RowNo <= 50"
        ),
    ),
    "top_products_all": Query(_top_all, _oracle(f"select UniverseCode, PazarTipi, {_RANKED} from ranked where RowNo <= 50")),
}
