"""Panel-to-universe projection factors per period, shop and pack.

Inputs (column names are the contract):

* sell-in fact: period (text YYYYMM), customer_code (7 digits), pfc (7 digits), total_unit
* sell-out fact: sale_date, shop_code, pfc, record_type, pr_unit
* shops_raw: imscode, brick [, on_universe, on_panel]; brick_region: brick1, tcode;
  region_name: brickcode, bolge
* packs_raw: bridge_code (8 digits), prod_desc, class_code, pack_flag; pfg: pfc, pfg;
  prod_flag: pfc, prod_flag
* oper: pd_id (periods to project); months: one row (MthsAvg)

The facts are read once and summed (sell-in) or made distinct (sell-out) before any join.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dispensa.functions.compat import int_div, zero_pad
from dispensa.operators import levels as lv
from dispensa.operators.levels import LEVELS, STRATUM
from dispensa.operators.ordered import integer_median, running_sum
from dispensa.operators.trailing import events, sums_at
from dispensa.sources.partials import PartialSums
from dispensa.sources.snapshots import Snapshots
from dispensa.sources.staging import Staging, subset_keys

TRIPLE = ("PdID", "ShopID", "PackID")
ATTRIBUTES = ("Brand", "ATC1", "ATC2", "ATC3", "ATC4", "Basket", "Rx", "Class")
UNITS = ("UnvrsUnits", "PanelUnits")
CELL = (*STRATUM, "PackID")

# Regions that are reported as one.
FOLDED_REGIONS = {
    "DOĞU ANADOLU": "DOĞU/GÜNEYDOĞU ANADOLU",
    "GÜNEYDOĞU ANADOLU": "DOĞU/GÜNEYDOĞU ANADOLU",
}


# --- periods ---------------------------------------------------------------------------------


def distinct_periods(sellin: DataFrame) -> DataFrame:
    return sellin.select(F.col("period").alias("PdID")).distinct()


def month_index(periods: DataFrame) -> DataFrame:
    """Number the distinct periods by month, from the January of the earliest year."""
    first = periods.agg(F.min("PdID").alias("first"))
    year = F.substring("PdID", 1, 4).cast("int")
    month = F.substring("PdID", 5, 2).cast("int")
    first_year = F.substring("first", 1, 4).cast("int")
    return periods.crossJoin(F.broadcast(first)).select(
        ((year - first_year) * 12 + month).alias("PdNbr"), "PdID"
    )


def _candidates(oper: DataFrame, months: DataFrame) -> DataFrame:
    """(ProcPdID, PdID): each operated period with the months before it, whether they exist or not."""
    back = F.explode(F.sequence(F.lit(1), F.col("MthsAvg")))
    day = F.to_date(F.concat(F.col("pd_id").cast("string"), F.lit("01")), "yyyyMMdd")
    return (
        oper.crossJoin(F.broadcast(months))
        .where(F.col("MthsAvg") >= 1)
        .select("pd_id", back.alias("_back"))
        .select(
            F.col("pd_id").alias("ProcPdID"),
            F.date_format(F.add_months(day, -F.col("_back")), "yyyyMM").alias("PdID"),
        )
    )


def window_periods(existing: DataFrame, oper: DataFrame, months: DataFrame) -> DataFrame:
    """(ProcPdID, PdID): each existing operated period with the existing periods before it."""
    proc = existing.select(F.col("PdID").cast("int").alias("ProcPdID"))
    return _candidates(oper, months).join(existing, "PdID").join(proc, "ProcPdID")


def expand_periods(numbered: DataFrame, oper: DataFrame, months: DataFrame) -> DataFrame:
    """Each operated period with the existing periods of the months before it, all numbered.

    An operated period that does not exist itself is dropped.
    """
    proc = numbered.select(F.col("PdNbr").alias("ProcPdNbr"), F.col("PdID").cast("int").alias("ProcPdID"))
    return (
        _candidates(oper, months)
        .join(numbered, "PdID")
        .join(proc, "ProcPdID")
        .select("PdNbr", "PdID", "ProcPdNbr", "ProcPdID")
    )


def prior_year(oper: DataFrame) -> DataFrame:
    """The twelve periods of the calendar year before the last operated period."""
    last = oper.agg(F.max("pd_id").alias("last"))
    year = int_div(F.col("last"), F.lit(100)) - 1
    months = last.select(F.explode(F.sequence(year * 100 + 1, year * 100 + 12)).alias("PdID"))
    return months.select(F.col("PdID").cast("string"))


def needed_periods(oper: DataFrame, months: DataFrame) -> DataFrame:
    """Distinct periods that a run reads: windows, operated periods and the prior year."""
    windows = _candidates(oper, months).select("PdID")
    own = oper.select(F.col("pd_id").cast("string").alias("PdID"))
    return windows.unionByName(own).unionByName(prior_year(oper)).distinct()


def monthly_sellin(sellin: DataFrame, needed: DataFrame | None = None) -> DataFrame:
    """Sell-in per period, shop code and pack code; the one pass over the sell-in fact.

    ``needed`` holds at most (months + 1) rows per operated period and twelve more, so it is
    broadcast; on a fact partitioned by period it prunes the partitions.
    """
    if needed is not None:
        sellin = sellin.join(F.broadcast(needed.withColumnRenamed("PdID", "period")), "period", "left_semi")
    return sellin.groupBy("period", "customer_code", "pfc").agg(F.sum("total_unit").alias("total_unit"))


def monthly_sums(spark: SparkSession, fact: str, schema: str, root: str) -> PartialSums:
    """Sell-in per period, shop code and pack code, kept below ``root`` across runs, of a fact stored by period."""
    store = Snapshots(spark, root, "period string, customer_code string, pfc string, total_unit bigint", "period")
    return PartialSums(spark, fact, schema, store, monthly_sellin)


# --- shops -----------------------------------------------------------------------------------


def shop_base(
    shops: DataFrame, brick_region: DataFrame, region_name: DataFrame, folded: dict[str, str] | None = None
) -> DataFrame:
    """Shop with region; the flags come from the input where it has them and are 1 otherwise."""
    region = F.col("bolge")
    for name, into in (FOLDED_REGIONS if folded is None else folded).items():
        region = F.when(F.col("bolge") == name, F.lit(into)).otherwise(region)
    on_universe = F.col("on_universe") if "on_universe" in shops.columns else F.lit(1)
    on_panel = F.col("on_panel") if "on_panel" in shops.columns else F.lit(1)
    return (
        shops.join(brick_region, shops["brick"] == brick_region["brick1"], "left")
        .join(region_name, F.col("brickcode") == F.col("tcode"), "left")
        .select("imscode", region.alias("Region"), on_universe.alias("onUnvrs"), on_panel.alias("onPanel"))
    )


def shop_sales(sellin: DataFrame, packs: DataFrame, base: DataFrame, oper: DataFrame, window: DataFrame) -> DataFrame:
    """Per known shop: units of known packs in the prior year, and whether it sold in the window.

    One pass for both questions: ``measured`` is true where the shop has prior-year rows, and
    ``recent`` where it sold in the window or in an operated period. Shops are filtered after the
    sum, packs before it.
    """
    recent = window.select("PdID").unionByName(window.select(F.col("ProcPdID").cast("string").alias("PdID")))
    periods = (
        prior_year(oper)
        .withColumn("prior", F.lit(1))
        .unionByName(recent.withColumn("prior", F.lit(0)))
        .groupBy(F.col("PdID").alias("period"))
        .agg((F.max("prior") == 1).alias("prior"), (F.min("prior") == 0).alias("recent"))
    )
    codes = packs.select(F.substring("bridge_code", 2, 7).alias("pfc")).distinct()
    shops = base.where(F.col("onUnvrs") == 1).select(F.col("imscode").alias("customer_code")).distinct()
    return (
        sellin.join(F.broadcast(periods), "period")  # a row per period of the run
        .join(codes, "pfc", "left_semi")
        .groupBy("customer_code")
        .agg(
            F.sum(F.when(F.col("prior"), F.col("total_unit"))).alias("Units"),
            F.max("prior").alias("measured"),
            F.max("recent").alias("recent"),
        )
        .join(shops, "customer_code", "left_semi")
    )


def prior_year_turnover(sales: DataFrame) -> DataFrame:
    """Units per shop over the calendar year before the last operated period."""
    return sales.where("measured").select("customer_code", "Units")


def orphan_shops(sales: DataFrame) -> DataFrame:
    """Shops that sell in the window or an operated period and have no turnover in the prior year."""
    return sales.where("recent and not measured").select("customer_code")


def shop_universe(sales: DataFrame, base: DataFrame) -> DataFrame:
    """All shops concerned, with region; orphans have no units yet."""
    return sales.where("measured or recent").join(base, F.col("customer_code") == F.col("imscode")).select(
        F.col("customer_code").cast("int").alias("ShopID"), "Region", "onPanel", "Units"
    )


def region_median(universe: DataFrame, staging: Staging) -> DataFrame:
    """Median of the known units per region, truncated to an integer."""
    return integer_median(universe, ["Region"], "Units", ["ShopID"], "UnitsAvg", staging)


def impute_units(universe: DataFrame, median: DataFrame) -> DataFrame:
    """Unknown units become the region's median; regions without one drop out."""
    return universe.join(median, "Region").select(
        "Region", "ShopID", "onPanel", F.coalesce("Units", "UnitsAvg").alias("Units")
    )


def _by_turnover() -> tuple[Column, ...]:
    """Shops by descending units; the shop number breaks ties."""
    return F.col("Units").desc(), F.col("ShopID").asc(), F.col("Region").asc()


def cumulative_units(imputed: DataFrame, staging: Staging) -> DataFrame:
    """Running sum of units by descending turnover (``UnitsCUM``)."""
    summed = running_sum(imputed, "Units", _by_turnover(), "UnitsCUM", staging)
    return summed.groupBy("ShopID", "Region", "onPanel", "Units").agg(F.sum("UnitsCUM").alias("UnitsCUM"))


def size_class(cumulative: DataFrame) -> DataFrame:
    """Size class by share of turnover: 3 up to a half, 1 beyond four fifths, 2 between."""
    top = cumulative.agg(F.max("UnitsCUM").alias("top"))
    share = F.col("UnitsCUM").cast("double") / F.col("top")
    tsc = F.when(share < 0.5, 3).when(share > 0.8, 1).otherwise(2)
    return cumulative.crossJoin(F.broadcast(top)).select(
        "ShopID", "Region", tsc.alias("TSC"), F.lit(1).alias("Chain"), "onPanel"
    )


def size_class_check(shops: DataFrame) -> DataFrame:
    """Distinct shops per region and size class."""
    counts = [F.countDistinct(F.when(F.col("TSC") == c, F.col("ShopID"))).alias(f"Stores_TSC{c}") for c in (1, 2, 3)]
    return shops.groupBy("Region").agg(*counts, F.countDistinct("ShopID").alias("Stores_TOT"))


# --- packs -----------------------------------------------------------------------------------


def projection_class() -> Column:
    """The value a pack is projected at; unknown and missing flags mean the basket."""
    flag = F.lower(F.coalesce(F.col("prod_flag"), F.lit("basket")))
    by_flag = {"pfc": F.col("PackID").cast("string")} | {lv.lower(): F.col(lv) for lv in LEVELS}
    out = F.col("Basket")
    for name, value in by_flag.items():
        out = F.when(flag == name, value).otherwise(out)
    return out


def pack_hierarchy(packs: DataFrame, pfg: DataFrame, prod_flag: DataFrame) -> DataFrame:
    """Pack with its seven levels and its class; packs without a basket drop out."""
    baskets = pfg.select(zero_pad(F.col("pfc"), 8).alias("bridge_code"), F.col("pfg").alias("Basket"))
    flags = prod_flag.select(zero_pad(F.col("pfc"), 8).alias("bridge_code"), "prod_flag")
    return (
        packs.join(baskets, "bridge_code")
        .join(flags, "bridge_code", "left")
        .select(
            F.col("bridge_code").cast("int").alias("PackID"),
            F.col("prod_desc").alias("Brand"),
            F.substring("class_code", 1, 1).alias("ATC1"),
            F.substring("class_code", 1, 3).alias("ATC2"),
            F.substring("class_code", 1, 4).alias("ATC3"),
            F.col("class_code").alias("ATC4"),
            "Basket",
            F.when(F.col("pack_flag") == "PRESC", "1").otherwise("0").alias("Rx"),
            "prod_flag",
        )
        .withColumn("Class", projection_class())
        .drop("prod_flag")
    )


# --- universe and panel ----------------------------------------------------------------------


def _shop_keys(shops: DataFrame) -> DataFrame:
    return shops.select(zero_pad(F.col("ShopID"), 7).alias("_shop_code"), "ShopID")


def _pack_keys(packs: DataFrame) -> DataFrame:
    return packs.select(zero_pad(F.col("PackID"), 7).alias("_pack_code"), "PackID")


def universe_events(monthly: DataFrame, window: DataFrame, shops: DataFrame, packs: DataFrame) -> DataFrame:
    """Where the monthly units of a shop and pack come into the windows of the operated periods, and where they go.

    A month counts in the windows of neighbouring operated periods, so it has two events at most, whatever the number of
    months; what goes behind the last operated period has none. Few periods make a short list, which is broadcast.
    """
    last = F.broadcast(window.agg(F.max("ProcPdID").alias("_last")))
    spans = window.groupBy(F.col("PdID").alias("period")).agg(
        F.min("ProcPdID").alias("_comes"), (F.max("ProcPdID") + 1).alias("_goes")
    )
    rows = (
        monthly.join(_shop_keys(shops), F.col("_shop_code") == F.col("customer_code"))
        .join(_pack_keys(packs), F.col("_pack_code") == F.col("pfc"))
        .join(F.broadcast(spans.crossJoin(last)), "period")
    )
    return events(rows, ["ShopID", "PackID"], "total_unit", F.col("_comes"), F.col("_goes"), F.col("_last"))


def universe(monthly: DataFrame, window: DataFrame, shops: DataFrame, packs: DataFrame) -> DataFrame:
    """Sell-in units per operated period, shop and pack, over the months before the period, by difference events.

    An event list of a shop and pack has at most two entries for each operated period. Rows appear per period only at
    the end, where they are the result.
    """
    changes = universe_events(monthly, window, shops, packs)
    return sums_at(changes, ["ShopID", "PackID"], window, "ProcPdID", "Units").select(
        F.col("ProcPdID").alias("PdID"), "ShopID", "PackID", "Units"
    )


def swapped_period(date: Column) -> Column:
    """Period of a sell-out date that is stored with day and month exchanged."""
    return F.year(date) * 100 + F.dayofmonth(date)


def swapped_dates(oper: DataFrame) -> DataFrame:
    """(sale_date, PdID): the stored dates of the operated periods; day and month are exchanged in them.

    A period has its month as the day of twelve dates.
    """
    periods = oper.where("pd_id % 100 between 1 and 12").select(F.col("pd_id").alias("PdID")).distinct()
    year, day = int_div(F.col("PdID"), F.lit(100)).cast("int"), (F.col("PdID") % 100).cast("int")
    dates = F.transform(F.sequence(F.lit(1), F.lit(12)), lambda month: F.make_date(year, month, day))
    return periods.select("PdID", F.explode(dates).alias("sale_date"))


def _of_periods(sellout: DataFrame, oper: DataFrame, dates: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Sell-out of the operated periods, with the period.

    The list of dates has a few rows per period, so it is broadcast; joined on the stored date itself it
    prunes the partitions of a fact partitioned by date, and other periods never reach a shuffle.
    """
    return sellout.join(F.broadcast(dates(oper)), "sale_date")


def panel_codes(
    sellout: DataFrame, oper: DataFrame, dates: Callable[[DataFrame], DataFrame] = swapped_dates
) -> DataFrame:
    """Distinct (period, shop code, pack code) of sales and returns in the operated periods.

    Stock records are left out.
    """
    rows = _of_periods(sellout.where(F.col("record_type") != "03"), oper, dates)
    return rows.select("PdID", "shop_code", "pfc").distinct()


def panel(codes: DataFrame, window: DataFrame, shops: DataFrame, packs: DataFrame) -> DataFrame:
    """Distinct (period, shop, pack) of the panel, in the periods that have a window.

    The codes are distinct and each side has a code once, so the joins keep the rows distinct.
    """
    periods = F.broadcast(window.select(F.col("ProcPdID").alias("PdID")).distinct())
    return (
        codes.join(periods, "PdID", "left_semi")
        .join(_shop_keys(shops.where(F.col("onPanel") == 1)).distinct(), F.col("_shop_code") == F.col("shop_code"))
        .join(_pack_keys(packs).distinct(), F.col("_pack_code") == F.col("pfc"))
        .select(*TRIPLE)
    )


def _strata(shops: DataFrame) -> DataFrame:
    return shops.select("ShopID", "Region", "TSC", "Chain")


def with_shops(rows: DataFrame, shops: DataFrame) -> DataFrame:
    return rows.join(_strata(shops), "ShopID")


def universe_base(unvrs: DataFrame, shops: DataFrame, packs: DataFrame) -> DataFrame:
    """The universe with shop and pack attributes."""
    return with_shops(unvrs, shops).join(packs, "PackID").select(*TRIPLE, "Region", "TSC", "Chain", *ATTRIBUTES, "Units")


def on_panel(base: DataFrame, panel_rows: DataFrame) -> DataFrame:
    """Universe rows of shops that are on the panel in that period, whatever the pack."""
    return base.join(panel_rows.select("PdID", "ShopID").distinct(), ["PdID", "ShopID"], "left_semi")


def panel_and_universe(unvrs: DataFrame, panel_rows: DataFrame, shops: DataFrame) -> DataFrame:
    """Every triple of either side once, with its stratum and three flags.

    ``inUniverse`` and ``inPanel`` tell which side knows the triple; ``onPanel`` tells whether the
    shop is on the panel in that period at all.
    """
    both = (
        unvrs.withColumn("inUniverse", F.lit(1))
        .join(panel_rows.withColumn("inPanel", F.lit(1)), list(TRIPLE), "full")
        .select(
            *TRIPLE,
            "Units",
            F.coalesce("inUniverse", F.lit(0)).alias("inUniverse"),
            F.coalesce("inPanel", F.lit(0)).alias("inPanel"),
        )
    )
    reporting = panel_rows.select("PdID", "ShopID").distinct().withColumn("onPanel", F.lit(1))
    flagged = both.join(reporting, ["PdID", "ShopID"], "left").withColumn(
        "onPanel", F.coalesce("onPanel", F.lit(0))
    )
    return with_shops(flagged, shops)


def level_cells(pairs: DataFrame, packs: DataFrame) -> DataFrame:
    """Universe units summed to (stratum, pack), for all shops and for panel shops, with levels."""
    sums = (
        pairs.where(F.col("inUniverse") == 1)
        .groupBy(*STRATUM, "PackID")
        .agg(
            F.sum("Units").alias("UnvrsUnits"),
            F.sum(F.when(F.col("onPanel") == 1, F.col("Units"))).alias("PanelUnits"),
            F.max("onPanel").alias("onPanel"),
            F.max("inPanel").alias("inPanel"),
        )
    )
    return sums.join(packs, "PackID")


def potential(attached: DataFrame) -> DataFrame:
    """Distinct strata, levels and universe means."""
    columns = [*STRATUM, *ATTRIBUTES, *[f"UnvrsWx{level}Units" for level in lv.ALL_LEVELS]]
    return attached.select(*columns).distinct()


def orphan_packs(pairs: DataFrame, packs: DataFrame) -> DataFrame:
    """Panel triples without a universe row, with shop and pack attributes."""
    alone = pairs.where(F.col("inUniverse") == 0)
    return alone.join(packs, "PackID").select(*TRIPLE, "Region", "TSC", "Chain", *ATTRIBUTES)


def fallback_lookup(attached: DataFrame) -> DataFrame:
    """Long table (stratum, Level, Value, PanelUnits, UnvrsUnits) for the fallback.

    Panel means count where some known panel triple uses the cell. The full outer join of the two
    distinct lists is joined once later, with the same rows as joining one list after the other.
    """
    keys = [*STRATUM, "Level", "Value"]
    used = attached.where(F.col("inPanel") == 1)
    measured = lv.distinct_values(used, "Panel").where(F.col("PanelUnits").isNotNull())
    return measured.join(lv.distinct_values(attached, "Unvrs"), keys, "full")


def orphan_levels(orphans: DataFrame, lookup: DataFrame) -> DataFrame:
    """Orphans with the panel and universe means of all eight levels."""
    out = orphans
    for level in lv.ALL_LEVELS:
        names = {"UnvrsUnits": f"UnvrsWx{level}Units", "PanelUnits": f"PanelWx{level}Units"}
        out = lv.join_level(out, lookup, level, level, **names)
    return out


def with_class_means(attached: DataFrame) -> DataFrame:
    """Add ClassMeans, the distinct universe means that the rows of the same stratum and class have, null among them.

    A class has as many as it has brands at most. A row without a class finds none.
    """
    same_class = Window.partitionBy(*STRATUM, "Class")
    means = F.collect_set(F.struct("UnvrsWxClassUnits")).over(same_class)
    return attached.withColumn("ClassMeans", F.when(F.col("Class").isNotNull(), means))


def factor_regular(panel_attached: DataFrame) -> DataFrame:
    """Factors of panel triples that the universe knows: universe mean over panel mean of the class.

    ``panel_attached`` has a row per triple with PanelWxClassUnits and ClassMeans, so that no join is left to do.
    """
    factor = "case when PanelWxClassUnits > 0 then cast(UnvrsWxClassUnits as double) / PanelWxClassUnits end as PF"
    return (
        panel_attached.select(*TRIPLE, "Region", "TSC", "Chain", "Class", "PanelWxClassUnits", F.inline("ClassMeans"))
        .selectExpr(*TRIPLE, factor, "Region", "TSC", "Chain", "Class", "0 as Orphan")
        .distinct()
    )


def factor_orphan(orphans_attached: DataFrame) -> DataFrame:
    """Factors of panel triples that the universe does not know.

    The first level at which the panel has a positive mean gives the factor and the class.
    """
    levels = [(level, f"PanelWx{level}Units", f"UnvrsWx{level}Units") for level in lv.ALL_LEVELS]
    factor = " ".join(f"when {p} > 0 then cast({u} as double) / {p}" for _, p, u in levels)
    value = " ".join(f"when {p} > 0 then {level}" for level, p, _ in levels)
    return orphans_attached.selectExpr(
        *TRIPLE, f"case {factor} end as PF", "Region", "TSC", "Chain", f"case {value} end as Class", "1 as Orphan"
    )


def apply_factors(
    sellout: DataFrame, factors: DataFrame, oper: DataFrame, dates: Callable[[DataFrame], DataFrame] = swapped_dates
) -> DataFrame:
    """Per region: shops, packs, units and projected units of the panel's sell-out.

    Both facts are summed per (region, shop, pack) before the distinct counts.
    """
    sold = (
        _of_periods(sellout, oper, dates)
        .select(
            "PdID",
            zero_pad(F.col("shop_code"), 7).alias("_shop_code"),
            zero_pad(F.col("pfc"), 8).alias("_pack_code"),
            "pr_unit",
        )
        .groupBy("PdID", "_shop_code", "_pack_code")
        .agg(F.sum("pr_unit").alias("Units"))
    )
    keyed = factors.withColumns(
        {"_shop_code": zero_pad(F.col("ShopID"), 7), "_pack_code": zero_pad(F.col("PackID"), 8)}
    )
    return (
        sold.join(keyed, ["PdID", "_shop_code", "_pack_code"])
        .groupBy("Region", "ShopID", "PackID")
        .agg(F.sum("Units").alias("Units"), F.sum(F.col("Units") * F.col("PF")).alias("ProjUnits"))
        .groupBy("Region")
        .agg(
            F.countDistinct("ShopID").alias("No_of_Shops"),
            F.countDistinct("PackID").alias("No_of_Packs"),
            F.sum("Units").alias("Units"),
            F.sum("ProjUnits").alias("ProjUnits"),
        )
    )


# --- the whole job ---------------------------------------------------------------------------


@dataclass
class Inputs:
    sellin: DataFrame
    sellout: DataFrame
    shops_raw: DataFrame
    brick_region: DataFrame
    region_name: DataFrame
    packs_raw: DataFrame
    pfg: DataFrame
    prod_flag: DataFrame
    oper: DataFrame
    months: DataFrame
    folded_regions: dict[str, str] | None = None
    dates: Callable[[DataFrame], DataFrame] = swapped_dates
    fix_class_key: bool = False
    kept: DataFrame | None = None  # sell-in per period, shop code and pack code, where earlier runs have left it


class Projection:
    """The stages of one run; each stage that later ones share is written once."""

    def __init__(self, inputs: Inputs, staging: Staging):
        self.inputs = inputs
        self.staging = staging
        self._made: dict[str, DataFrame] = {}

    def _once(self, name: str, make: Callable[[], DataFrame], keep: bool = True) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.staging.keep(make(), name) if keep else make()
        return self._made[name]

    def _dealt(self, name: str, make: Callable[[], DataFrame], keys: Sequence[str]) -> DataFrame:
        """Like ``_once``, dealt by keys that later joins and groupings have."""
        if name not in self._made:
            self._made[name] = self.staging.keep_bucketed(make(), name, keys)
        return self._made[name]

    def monthly(self) -> DataFrame:
        i = self.inputs
        needed = needed_periods(i.oper, i.months)
        if i.kept is None:
            return self._once("monthly", lambda: monthly_sellin(i.sellin, needed))
        of_run = F.broadcast(needed.withColumnRenamed("PdID", "period"))  # as in monthly_sellin
        return self._once("monthly", lambda: i.kept.join(of_run, "period", "left_semi"))

    def window(self) -> DataFrame:
        i = self.inputs
        return self._once(
            "window", lambda: window_periods(distinct_periods(self.monthly()), i.oper, i.months)
        )

    def shop_base(self) -> DataFrame:
        i = self.inputs
        return self._once(
            "shop_base", lambda: shop_base(i.shops_raw, i.brick_region, i.region_name, i.folded_regions), keep=False
        )

    def shop_sales(self) -> DataFrame:
        i = self.inputs
        return shop_sales(self.monthly(), i.packs_raw, self.shop_base(), i.oper, self.window())

    def shop_universe(self) -> DataFrame:
        return self._once("shop_universe", lambda: shop_universe(self.shop_sales(), self.shop_base()))

    def median(self) -> DataFrame:
        return self._once("median", lambda: region_median(self.shop_universe(), self.staging), keep=False)

    def imputed(self) -> DataFrame:
        return self._once("imputed", lambda: impute_units(self.shop_universe(), self.median()), keep=False)

    def cumulative(self) -> DataFrame:
        return self._once("cumulative", lambda: cumulative_units(self.imputed(), self.staging), keep=False)

    def shops(self) -> DataFrame:
        return self._once("shops", lambda: size_class(self.cumulative()))

    def packs(self) -> DataFrame:
        i = self.inputs
        return self._once("packs", lambda: pack_hierarchy(i.packs_raw, i.pfg, i.prod_flag))

    def universe(self) -> DataFrame:
        return universe(self.monthly(), self.window(), self.shops(), self.packs())

    def panel_codes(self) -> DataFrame:
        i = self.inputs
        return self._once("panel_codes", lambda: panel_codes(i.sellout, i.oper, i.dates))

    def read_inputs(self) -> None:
        """Run the stages that depend on inputs alone at the same time, as separate Spark jobs."""
        with ThreadPoolExecutor(max_workers=3) as pool:
            for done in [pool.submit(stage) for stage in (self.monthly, self.panel_codes, self.packs)]:
                done.result()

    def panel(self) -> DataFrame:
        def make() -> DataFrame:
            self.read_inputs()
            return panel(self.panel_codes(), self.window(), self.shops(), self.packs())

        return self._once("panel", make)

    def universe_base(self) -> DataFrame:
        return universe_base(self.universe(), self.shops(), self.packs())

    def panel_base(self) -> DataFrame:
        return on_panel(self.universe_base(), self.panel())

    def pairs(self) -> DataFrame:
        def make() -> DataFrame:
            reporting = self.panel()
            return panel_and_universe(self.universe(), reporting, self.shops())

        return self._dealt("pairs", make, CELL)

    def cells(self) -> DataFrame:
        return self._dealt("cells", lambda: level_cells(self.pairs(), self.packs()), STRATUM)

    def means(self) -> DataFrame:
        """All level means, of the universe and of the panel shops."""
        return self._dealt("means", lambda: lv.level_means(self.cells(), self.inputs.months, UNITS), STRATUM)

    def attach(self) -> DataFrame:
        """(stratum, pack) with the eight universe means, the eight panel means and the means of its class, not stored."""
        prefixes = dict(zip(("Unvrs", "Panel"), UNITS, strict=True))
        rows = self.cells().drop(*UNITS)
        return with_class_means(lv.attach_levels(rows, self.means(), prefixes, self.inputs.fix_class_key))

    def attached(self) -> DataFrame:
        """The same, stored. Cells and means lie by stratum, which has a row for each pack at most: joins run where they lie."""
        rows = self.attach()
        with subset_keys(self.staging.spark):
            return self._dealt("attached", lambda: rows, CELL)

    def _levels(self, pairs: DataFrame, prefix: str) -> DataFrame:
        means = [f"{prefix}Wx{level}Units" for level in lv.ALL_LEVELS]
        more = ["ClassMeans"] if prefix == "Panel" else []
        attached = self.attached().select(*STRATUM, "PackID", *ATTRIBUTES, *means, *more)
        return pairs.select(*TRIPLE, "Region", "TSC", "Chain").join(attached, [*STRATUM, "PackID"])

    def universe_levels(self) -> DataFrame:
        """Universe rows with the eight universe means."""
        return self._levels(self.pairs().where(F.col("inUniverse") == 1), "Unvrs")

    def _panel_levels(self) -> DataFrame:
        known = (F.col("inUniverse") == 1) & (F.col("inPanel") == 1)
        return self._levels(self.pairs().where(known), "Panel")

    def panel_levels(self) -> DataFrame:
        """Panel triples that the universe knows, with the eight panel means."""
        return self._panel_levels().drop("ClassMeans")

    def potential(self) -> DataFrame:
        return potential(self.attached())

    def orphans(self) -> DataFrame:
        return orphan_packs(self.pairs(), self.packs())

    def lookup(self) -> DataFrame:
        return self._once("lookup", lambda: fallback_lookup(self.attached()))

    def orphan_levels(self) -> DataFrame:
        """Orphans with all means; the eight joins run on cells, not on triples."""
        whole = F.struct(*ATTRIBUTES).alias("_attributes")
        orphans = self.orphans()
        cells = orphans.select(*STRATUM, "PackID", *ATTRIBUTES).distinct()
        attached = orphan_levels(cells, self.lookup())
        attached = attached.select("*", whole).drop(*ATTRIBUTES)
        joined = orphans.select("*", whole).join(attached, [*STRATUM, "PackID", "_attributes"])
        return joined.drop("_attributes")

    def factor_regular(self) -> DataFrame:
        return factor_regular(self._panel_levels())

    def factor_orphan(self) -> DataFrame:
        return factor_orphan(self.orphan_levels())

    def factors(self) -> DataFrame:
        return self.factor_regular().unionByName(self.factor_orphan())
