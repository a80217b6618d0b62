"""Monthly sell-out mart of two markets, its publication, and top-N reports on it.

Inputs: facts (one table for the family of monthly tables, partitioned by source and period),
price_list (period, prd_cd, ...), account, atc_names, and the shop-to-region tables.
The jobs work on any set of periods at once; give a period to build one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from dispensa.functions.compat import round_to_int, same_text, trimmed
from dispensa.sources.snapshots import Snapshots
from dispensa.sources.staging import subset_keys
from dispensa.sources.tables import partition_scan

# Columns that the monthly tables must have, all of them filled.
FACT_COLUMNS = (
    "production", "sale_date", "whs", "pfc", "u_code", "pr_unit", "pr_bonus", "pr_price", "ndf_price", "setflag",
    "pub_price", "trd_price", "iskonto", "invoice_date", "invoice_number", "vat", "is_prescription", "prj_unit",
    "prj_value",
)

# Columns of the mart, in order, with their types.
MART_SCHEMA = (
    "YIL string, DONEM string, EczaneKod string, AccountName string, UrunKod string, Urun string, KUTU int, TL int, "
    "PazarTipi string, Kategori1 string, Kategori2 string, Kategori3 string, Kategori4 string, Kategori5 string, "
    "Goster smallint, Bolge string, UniverseCode string, OldCode string"
)


@dataclass(frozen=True)
class Market:
    label: str
    sources: tuple[str, ...]
    price: str
    categories: tuple[str | None, ...]


# The two markets.
DRUG = Market("ILAC", ("T", "R"), "pub_price", ("atc1", "atc2", "atc3", "atc4"))
NON_DRUG = Market("ILAC DISI", ("P", "RP"), "isf", ("nfc1", "nfc2", "nfc3", None))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many nulls each of the columns holds."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` unchanged; the job fails at the first null in one of the columns."""
    checked = {c: F.coalesce(c, F.raise_error(F.lit(f"null in {c}"))) for c in columns}
    return df.withColumns(checked)


def require_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` unchanged; the job fails at the first row with a null in one of the columns, read later on or not.

    As a filter it stays in the plan also where a column is not used any more.
    """
    empty = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    failure = F.raise_error(F.concat(F.lit("null in "), F.concat_ws(", ", *empty))).cast("boolean")
    return df.where(F.when(F.coalesce(*empty).isNotNull(), failure).otherwise(True))


def union_sources(facts: DataFrame, market: Market, period: str | None = None) -> DataFrame:
    """All rows of the market's sources, with a constant report price."""
    rows = facts.where(F.col("source").isin(*market.sources))
    if period is not None:
        rows = partition_scan(rows, period)
    return rows.select("period", *FACT_COLUMNS, F.lit(0).cast("decimal(10,2)").alias("tpt_price"))


def account_regions(
    account: DataFrame, shops: DataFrame, brick_region: DataFrame, region_name: DataFrame
) -> DataFrame:
    """Accounts with their region, joined among the small tables before any fact.

    Store the result: the planner takes a chain of joins for large and a stored table for what it is.
    """
    account, shops = trimmed(account, "account_code", "universe_code"), trimmed(shops, "imscode")
    return (
        account.join(shops, F.col("imscode") == F.col("universe_code"), "left")
        .join(brick_region, F.col("brick1") == F.col("brick"), "left")
        .join(region_name, F.col("brickcode") == F.col("tcode"), "left")
        .select("account_code", "account_name", "universe_code", "bolge")
    )


def _by_market(markets: Sequence[Market], value: Callable[[Market], str]) -> Column:
    """An SQL expression per market, picked by the row's market."""
    cases = " ".join(f"when market = '{m.label}' then {value(m)}" for m in markets)
    return F.expr(f"case {cases} end")


def market_sellout(
    facts: DataFrame,
    markets: Sequence[Market],
    prices: DataFrame,
    accounts: DataFrame,
    atc_names: DataFrame,
    period: str | None = None,
    checked: bool = True,
    shares: int | None = None,
) -> DataFrame:
    """Boxes and value per period, shop and product of the markets, in one pass over the facts.

    Facts are summed to (period, market, shop, product) first; a price holds for that grain, so
    the value is the same. The dimensions are left-joined to the sums, and the last aggregation
    groups by a superset of those keys. The product flag of the price list is part of the grouping
    but not of the output, so visible keys can repeat. Units are whole numbers and add up as such.
    Keys may be blank-padded on either side. A null in any of the columns that the monthly tables must have filled
    fails the job, whether it is used here or not; unless not ``checked``, for facts that are watched otherwise.

    With ``shares``, the rows end up dealt by period and that many shares of its products. The sums are dealt so while
    they are narrow; run inside ``subset_keys``, prices and the last aggregation then need no further exchange.
    """
    if period is not None:
        facts = partition_scan(facts, period)
    cases = " ".join(
        f"when source in ({', '.join(repr(s) for s in m.sources)}) then '{m.label}'" for m in markets
    )
    facts = facts.where(F.col("source").isin(*[s for m in markets for s in m.sources]))
    if checked:
        facts = require_filled(facts, [c for c in FACT_COLUMNS if c in facts.columns])
    facts = trimmed(facts, "whs", "pfc")
    prices, atc_names = trimmed(prices, "prd_cd"), trimmed(atc_names, "pfc")
    sold = (
        facts.withColumn("market", F.expr(f"case {cases} end"))
        .groupBy("period", "market", "whs", "pfc")
        .agg(F.sum((F.col("pr_unit") + F.col("pr_bonus")).cast("bigint")).alias("boxes"))
    )
    price_columns = sorted({m.price for m in markets})
    names = sorted({c for m in markets for c in m.categories if c})
    priced = prices.select(
        "period", F.col("prd_cd").alias("pfc"), "new_name", "prod_flag", "who_atc", *price_columns
    )
    priced_by = ["period", "pfc"]
    categories = [_by_market(markets, lambda m, i=i: m.categories[i] or "''").alias(f"k{i}") for i in range(4)]
    sold = sold.join(atc_names.select("pfc", *names), "pfc", "left").select(*sold.columns, *categories)
    if shares is not None:
        sold, priced = (
            rows.withColumn("share", F.pmod(F.xxhash64("pfc"), F.lit(shares))).repartition("period", "share") for rows in (sold, priced)
        )
        priced_by = ["period", "share", "pfc"]
    joined = (
        sold.join(priced, priced_by, "left")
        .join(accounts, F.col("account_code") == F.col("whs"), "left")
        .withColumn("price", _by_market(markets, lambda m: m.price))
    )
    keys = [*priced_by, "market", "whs", "account_name", "universe_code", "bolge", "new_name", "prod_flag", "who_atc"]
    grouped = joined.groupBy(*keys, *[f"k{i}" for i in range(4)]).agg(
        F.sum("boxes").alias("boxes"), F.sum(F.col("boxes") * F.col("price")).alias("value")
    )
    return grouped.select(
        F.concat(F.lit("20"), F.left(F.col("period"), F.lit(2))).alias("YIL"),
        F.col("period").alias("DONEM"),
        F.col("whs").alias("EczaneKod"),
        F.col("account_name").alias("AccountName"),
        F.col("pfc").alias("UrunKod"),
        F.col("new_name").alias("Urun"),
        F.col("boxes").cast("int").alias("KUTU"),
        round_to_int(F.col("value")).alias("TL"),
        F.col("market").alias("PazarTipi"),
        *[F.col(f"k{i}").alias(f"Kategori{i + 1}") for i in range(4)],
        F.col("who_atc").alias("Kategori5"),
        F.lit(1).cast("smallint").alias("Goster"),
        F.col("bolge").alias("Bolge"),
        F.col("universe_code").alias("UniverseCode"),
    )


def in_mart_columns(rows: DataFrame) -> DataFrame:
    """``rows`` with the mart's columns in order and typed; a missing one is null."""
    declared = [c.strip().split(" ") for c in MART_SCHEMA.split(",")]
    return rows.select(
        *[(F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name) for name, kind in declared]
    )


def sellout_mart(
    facts: DataFrame,
    prices: DataFrame,
    accounts: DataFrame,
    atc_names: DataFrame,
    period: str | None = None,
    checked: bool = True,
    shares: int | None = None,
) -> DataFrame:
    """Both markets in the mart's declared columns; a column that no job fills is null."""
    rows = market_sellout(facts, (DRUG, NON_DRUG), prices, accounts, atc_names, period, checked, shares)
    return in_mart_columns(rows)


def mart_store(spark: SparkSession, root: str) -> Snapshots:
    """The mart in versions, by period."""
    return Snapshots(spark, root, MART_SCHEMA, "DONEM")


#: A load deals the products of each period into one share for so many shuffle partitions; a share is one file.
PARTITIONS_A_SHARE = 50


@dataclass(frozen=True)
class LoadReport:
    """Rows and nulls that the load of a mart met, and the version that it became, if it did."""

    rows: int
    nulls: dict[str, int]
    version: int | None


def load_mart(
    store: Snapshots,
    facts: DataFrame,
    prices: DataFrame,
    accounts: DataFrame,
    atc_names: DataFrame,
    period: str | None = None,
) -> LoadReport:
    """Build the mart of the facts' periods, or of one, and publish it if all columns of the facts are filled.

    Rows and nulls of the 19 columns are counted by a scan before anything is joined or written, so facts that are
    refused cost no more than that, and the mart stays as it was. The pass that writes counts again: what it wrote of
    facts that have changed in between becomes a version only if no null was met there either; otherwise it is deleted.
    A period that is given and has no facts is emptied.
    """
    missing = [c for c in FACT_COLUMNS if c not in facts.columns]
    if missing:
        raise ValueError(f"facts lack the columns {', '.join(missing)}")
    facts = facts.where(F.col("source").isin(*DRUG.sources, *NON_DRUG.sources))
    if period is not None:
        facts = partition_scan(facts, period)
    measures = [F.count("*").alias("rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in FACT_COLUMNS]]
    counts = facts.agg(*measures).first().asDict()
    rows = counts.pop("rows")
    if any(counts.values()):
        return LoadReport(rows, counts, None)
    seen = Observation()
    watched = facts.observe(seen, *measures)
    shares = max(1, int(store.spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_A_SHARE)
    with subset_keys(store.spark):
        load = store.write(sellout_mart(watched, prices, accounts, atc_names, checked=False, shares=shares))
    # The planner drops the counts together with facts that turn out empty; then nothing is written either.
    counts = seen.get if load.folders else {}
    nulls = {c: counts.get(c, 0) for c in FACT_COLUMNS}
    rows = counts.get("rows", 0)
    if any(nulls.values()):
        store.discard(load)
        return LoadReport(rows, nulls, None)
    return LoadReport(rows, nulls, store.commit(load, [] if period is None else [period]))


def publish_mart(mart: DataFrame, path: str) -> None:
    """Replace the periods that ``mart`` holds and leave the others as they are.

    The rebalance spreads a large period over several files and joins small ones.
    """
    (
        mart.hint("rebalance", "DONEM")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("DONEM")
        .parquet(path)
    )


def publish_table(mart: DataFrame, table: str) -> None:
    """The same for a catalog table, made with the declared schema where it does not exist."""
    spark = mart.sparkSession
    if not spark.catalog.tableExists(table):
        spark.sql(
            f"create table {table} ({MART_SCHEMA}) using parquet "
            "options (partitionOverwriteMode 'dynamic') partitioned by (DONEM)"
        )
    target = spark.table(table)  # its partition column comes last, and insertInto goes by position
    mart.hint("rebalance", "DONEM").select(*target.columns).write.insertInto(table, overwrite=True)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MART_SCHEMA).parquet(path)


def _active(mart: DataFrame, report_periods: DataFrame) -> DataFrame:
    active = report_periods.where(F.col("is_active") == 1).select(F.col("period").alias("DONEM"))
    return mart.where(F.col("Goster") == 1).join(active, "DONEM")


def _report_columns(rank: Column) -> list[Column]:
    return [
        rank.alias("RowNo"),
        F.coalesce("Urun", F.lit("")).alias("URUN"),
        F.coalesce("TL", F.lit(0)).alias("TL"),
        F.coalesce("KUTU", F.lit(0)).alias("KUTU"),
        F.col("DONEM").alias("Donem"),
        F.col("AccountName").alias("Eczane"),
    ]


def _by_value() -> tuple[Column, ...]:
    """Highest value first; names break ties."""
    return F.col("TL").desc_nulls_last(), F.col("Urun").asc_nulls_first(), F.col("AccountName").asc_nulls_first()


def top_products(
    mart: DataFrame, report_periods: DataFrame, pharmacy: str, period: str, market: str, n: int = 50
) -> DataFrame:
    """The n products of highest value of one pharmacy, period and market."""
    chosen = (
        (F.col("UniverseCode") == pharmacy)
        & (F.col("DONEM") == period)
        & same_text(F.col("PazarTipi"), F.lit(market))
    )
    best = (
        _active(mart.where(chosen), report_periods)
        .groupBy("Urun", "DONEM", "AccountName")
        .agg(F.sum("TL").alias("TL"), F.sum("KUTU").alias("KUTU"))
        .orderBy(*_by_value())
        .limit(n)
    )
    rank = F.row_number().over(Window.orderBy(*_by_value()))  # over n rows at most
    return best.select(*_report_columns(rank))


def top_products_all(mart: DataFrame, report_periods: DataFrame, n: int = 50) -> DataFrame:
    """The same report for every pharmacy, period and market at once."""
    keys = ["UniverseCode", "DONEM", "PazarTipi"]
    sums = (
        _active(mart.where(F.col("UniverseCode").isNotNull()), report_periods)
        .groupBy(*keys, "Urun", "AccountName")
        .agg(F.sum("TL").alias("TL"), F.sum("KUTU").alias("KUTU"))
    )
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*_by_value()))
    return (
        sums.withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .select("UniverseCode", "PazarTipi", *_report_columns(F.col("_rank")))
    )
