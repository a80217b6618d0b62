"""Calendar queries: the calendar spans the ship dates and carries each day's sales.

The SQL numbers days with windows over a generated series and walks the fiscal years one after
the other, where the Spark jobs use closed forms.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.plans import calendar as cal
from dispensa.sources.staging import Staging
from dispensa.sources.tables import parquet_table

START, FIRST_YEAR, FIRST_LEAP, EVERY = datetime.date(1994, 12, 26), 1995, 1996, 3
RULE_445 = cal.rule_445(START, FIRST_YEAR, FIRST_LEAP, EVERY)
RULE_454 = cal.rule_454(START, FIRST_YEAR, FIRST_LEAP, EVERY)


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and units per ship date: the one pass over the fact, stored, since spans and sales both come from it."""
    lines = parquet_table(spark, folder, "lineitem")
    sums = lines.groupBy(F.col("l_shipdate").cast("date").alias("Date")).agg(
        F.count("*").alias("lines"), F.sum(F.col("l_quantity").cast("bigint")).alias("units")
    )
    return Staging(spark).keep(sums, "sales")


def _span(sales: DataFrame) -> DataFrame:
    return cal.bounds(sales, "Date")


def _last_year(sales: DataFrame) -> DataFrame:
    return sales.agg(F.max(F.year("Date")).alias("last_year"))


def _with_sales(days: DataFrame, sales: DataFrame) -> DataFrame:
    out = days.join(sales, "Date", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("lines", "units")})


def _query(days: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query of days that come from the sales' dates, with the sales of each."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        sales = _sales(spark, folder)
        return _with_sales(days(sales), sales)

    return run


def _dimension(sales: DataFrame) -> DataFrame:
    return cal.date_dimension(_span(sales))


def _holidays(*names: str) -> Callable[[SparkSession, str], DataFrame]:
    chosen = tuple(h for h in cal.HOLIDAYS if h.name in names)
    return _query(
        lambda sales: cal.date_dimension(_span(sales), chosen).where(F.col("IsHoliday") == 1).select("Date", "HolidayName")
    )


def _flag(spark: SparkSession, folder: str) -> DataFrame:
    days = _query(_dimension)(spark, folder)
    return days.groupBy("Year", "IsHoliday", "IsWeekday").agg(
        F.count("*").alias("days"), F.sum("lines").alias("lines"), F.sum("units").alias("units")
    )


def _flag_as_written(sales: DataFrame) -> DataFrame:
    return cal.date_dimension(_span(sales), cal.holidays_as_written()).select("Date", "IsHoliday", "HolidayName")


def _columns(*names: str) -> Callable[[SparkSession, str], DataFrame]:
    return _query(lambda sales: _dimension(sales).select("Date", *names))


def _fiscal(rule: cal.FiscalRule) -> Callable[[SparkSession, str], DataFrame]:
    columns = ("Date", "FiscalDayOfYear", "FiscalWeekOfYear", "FiscalMonth", "FiscalQuarter", "FiscalYear")
    return _query(lambda sales: cal.fiscal_calendar(_last_year(sales), rule).select(*columns))


def _fiscal_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """Sales per fiscal month, with the bounds of month, quarter and year."""
    days = _query(lambda sales: cal.fiscal_bounds(cal.fiscal_days(_last_year(sales), RULE_445)))(spark, folder)
    keys = [c for c in days.columns if c not in ("Date", "FiscalDayOfYear", "FiscalWeekOfYear", "lines", "units")]
    return days.groupBy(*keys).agg(F.sum("lines").alias("lines"), F.sum("units").alias("units"))


def _fiscal_labels(sales: DataFrame) -> DataFrame:
    days = cal.fiscal_labels(cal.fiscal_days(_last_year(sales), RULE_445))
    return days.select("Date", "FiscalQuarterName", "FiscalYearName", "FiscalMonthYear", "FiscalMMYYYY")


def _full(sales: DataFrame) -> DataFrame:
    return cal.date_dimension_full(_span(sales), _last_year(sales), RULE_445)


def _monthly(spark: SparkSession, folder: str) -> DataFrame:
    sales = _sales(spark, folder)
    sold = sales.groupBy(F.concat(F.lit("M"), F.date_format("Date", "yyyyMM")).alias("PeriodDatakey")).agg(
        F.sum("lines").alias("lines")
    )
    span = sales.agg(F.min("Date").alias("start"), F.max("Date").alias("end"))
    return cal.month_periods(span).join(sold, "PeriodDatakey", "left")


def _spine_months(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per month, from the month of the first order to that of the last."""
    orders = parquet_table(spark, folder, "orders")
    sold = orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count("*").alias("orders"), F.min(F.col("o_orderdate").cast("date")).alias("first")
    )
    sold = Staging(spark).keep(sold, "orders")
    span = sold.agg(F.min("first").alias("start"), F.last_day(F.max("month")).alias("end"))
    months = cal.month_spine(span).select("Date", F.trunc("Date", "month").alias("month"))
    return months.join(sold, "month", "left").select("Date", "orders")


def _spine_leap_years(spark: SparkSession, folder: str) -> DataFrame:
    sales = _sales(spark, folder)
    sold = sales.groupBy(F.year("Date").alias("leapyear")).agg(F.sum("lines").alias("lines"))
    return cal.leap_years(_last_year(sales), FIRST_LEAP, EVERY).join(sold, "leapyear", "left")


# --- the oracle ------------------------------------------------------------------------------


def _months_sql(weeks: tuple[int, int, int], long_month: int) -> str:
    """A CASE per month end, with one week more from the long month on."""
    end, cases = 0, []
    for m in range(1, 12):
        end += weeks[(m - 1) % 3]
        cases.append(f"when wk <= {end}{' + leap' if m >= long_month else ''} then {m}")
    return f"case {' '.join(cases)} else 12 end"


def _nth(of: str) -> str:
    return f"row_number() over (partition by {of}, dayofweek(Date) order by Date)"


def _oracle(final: str, weeks: tuple[int, int, int] = (4, 4, 5), long_month: int = 11) -> str:
    leap = f"y >= {FIRST_LEAP} and y < (select last_year from span) and (y - {FIRST_LEAP}) % {EVERY} = 0"
    nth_m = _nth("year(Date), month(Date)")
    rules = [
        ("Election Day", "lag(dayname(Date) = 'Monday' and month(Date) = 11 and nth = 1) over (order by Date)"),
        ("Christmas Day", "month(Date) = 12 and day(Date) = 25"),
        ("Thanksgiving Day", "month(Date) = 11 and dayname(Date) = 'Thursday' and nth = 4"),
        ("Veterans Day", "month(Date) = 11 and day(Date) = 11"),
        ("Halloween", "month(Date) = 10 and day(Date) = 31"),
        ("Columbus Day", "month(Date) = 10 and dayname(Date) = 'Monday' and nth = 2"),
        ("Labor Day", "Date in (select min(Date) from days where month(Date) = 9 and dayname(Date) = 'Monday' group by year(Date))"),
        ("Independance Day", "month(Date) = 7 and day(Date) = 4"),
        ("Father's Day", "month(Date) = 6 and dayname(Date) = 'Sunday' and nth = 3"),
        ("Mother's Day", "month(Date) = 5 and dayname(Date) = 'Sunday' and nth = 2"),
        ("Memorial Day", "Date in (select max(Date) from days where month(Date) = 5 and dayname(Date) = 'Monday' group by year(Date))"),
        ("Saint Patrick's Day", "month(Date) = 3 and day(Date) = 17"),
        ("President's Day", "month(Date) = 2 and dayname(Date) = 'Monday' and nth = 3"),
        ("Valentine's Day", "month(Date) = 2 and day(Date) = 14"),
        ("Martin Luther King, Jr. Day", "month(Date) = 1 and dayname(Date) = 'Monday' and nth = 3"),
        ("New Year's Day", "month(Date) = 1 and day(Date) = 1"),
    ]
    cases = " ".join("when {} then '{}'".format(test, name.replace("'", "''")) for name, test in rules)
    ctes = {
        "span": """select cast(min(l_shipdate) as date) as s, cast(max(l_shipdate) as date) as e,
            cast(max(year(l_shipdate)) as int) as last_year from lineitem""",
        "days": "select cast(unnest(generate_series(s, e, interval 1 day)) as date) as Date from span",
        "sales": """select cast(l_shipdate as date) as Date, count(*) as lines,
            cast(sum(cast(l_quantity as bigint)) as bigint) as units from lineitem group by 1""",
        "counted": f"""select Date, {nth_m} as nth, {_nth('year(Date), quarter(Date)')} as nth_q,
            {_nth('year(Date)')} as nth_y,
            (select count(*) from generate_series(date_trunc('year', Date) + interval 1 day, Date, interval 1 day) g(x)
             where dayofweek(x) = 0) + 1 as wk from days""",
        "named": f"select *, case {cases} end as holiday from counted",
        "dim": """select cast(strftime(Date, '%Y%m%d') as int) as DateKey, Date, strftime(Date, '%m/%d/%Y') as FullDate,
            cast(day(Date) as varchar) as DayOfMonth,
            day(Date) || case when day(Date) in (1, 21, 31) then 'st' when day(Date) in (2, 22) then 'nd'
                when day(Date) in (3, 23) then 'rd' else 'th' end as DaySuffix,
            dayname(Date) as DayName, cast(dayofweek(Date) + 1 as varchar) as DayOfWeek,
            cast(nth as varchar) as DayOfWeekInMonth, cast(nth_y as varchar) as DayOfWeekInYear,
            cast(nth_q as varchar) as DayOfQuarter, cast(dayofyear(Date) as varchar) as DayOfYear,
            cast(wk + 1 - (select count(*) from generate_series(date_trunc('year', Date) + interval 1 day,
                date_trunc('month', Date)::timestamp, interval 1 day) g(x) where dayofweek(x) = 0) - 1 as varchar) as WeekOfMonth,
            cast(date_diff('day', date_trunc('quarter', Date), Date) // 7 + 1 as varchar) as WeekOfQuarter,
            cast(wk as varchar) as WeekOfYear, cast(month(Date) as varchar) as Month, monthname(Date) as MonthName,
            cast(month(Date) - 3 * (quarter(Date) - 1) as varchar) as MonthOfQuarter, cast(quarter(Date) as varchar) as Quarter,
            case quarter(Date) when 1 then 'First' when 2 then 'Second' when 3 then 'Third' else 'Fourth' end as QuarterName,
            cast(year(Date) as varchar) as Year, 'CY ' || year(Date) as YearName,
            monthname(Date)[1:3] || '-' || year(Date) as MonthYear, strftime(Date, '%m%Y') as MMYYYY,
            cast(date_trunc('month', Date) as date) as FirstDayOfMonth, last_day(Date) as LastDayOfMonth,
            cast(date_trunc('quarter', Date) as date) as FirstDayOfQuarter,
            cast(date_trunc('quarter', Date) + interval 3 month - interval 1 day as date) as LastDayOfQuarter,
            make_date(year(Date), 1, 1) as FirstDayOfYear, make_date(year(Date), 12, 31) as LastDayOfYear,
            case when holiday is null then 0 else 1 end as IsHoliday,
            case when dayname(Date) in ('Saturday', 'Sunday') then 0 else 1 end as IsWeekday, holiday as HolidayName
            from named""",
        "fy": f"""select {FIRST_YEAR} as y, date '{START}' as s,
                  case when {leap.replace('y ', f'{FIRST_YEAR} ')} then 1 else 0 end as leap
            union all
            select y + 1, cast(s + to_days(7 * (52 + leap)) as date),
                   case when {leap.replace('y >=', 'y + 1 >=').replace('y <', 'y + 1 <').replace('(y -', '(y + 1 -')} then 1 else 0 end
            from fy where year(s + to_days(7 * (52 + leap))) <= (select last_year from span)""",
        "fday": """select y, leap, cast(unnest(generate_series(s, s + to_days(7 * (52 + leap) - 1), interval 1 day)) as date)
            as Date from fy""",
        "fnum": """select y, leap, Date, cast(row_number() over (partition by y order by Date) as int) as dn
            from fday where year(Date) <= (select last_year from span)""",
        "fweek": "select *, (dn - 1) // 7 + 1 as wk from fnum",
        "fmonth": f"select *, {_months_sql(weeks, long_month)} as m from fweek",
        "fiscal": """select Date, y, m, (m - 1) // 3 + 1 as q, dn, wk from fmonth""",
        "ftext": """select Date, cast(dn as varchar) as FiscalDayOfYear, cast(wk as varchar) as FiscalWeekOfYear,
            cast(m as varchar) as FiscalMonth, cast(q as varchar) as FiscalQuarter, cast(y as varchar) as FiscalYear,
            ['First', 'Second', 'Third', 'Fourth'][q] as FiscalQuarterName, 'FY ' || y as FiscalYearName,
            monthname(make_date(2000, m, 1))[1:3] || '-' || y as FiscalMonthYear, lpad(m::varchar, 2, '0') || y as FiscalMMYYYY
            from fiscal""",
        "fb": """select a.Date, mm.f as FiscalFirstDayOfMonth, mm.l as FiscalLastDayOfMonth, qq.f as FiscalFirstDayOfQuarter,
            qq.l as FiscalLastDayOfQuarter, yy.f as FiscalFirstDayOfYear, yy.l as FiscalLastDayOfYear
            from fiscal a join (select y, m, min(Date) as f, max(Date) as l from fiscal group by all) mm using (y, m)
            join (select y, q, min(Date) as f, max(Date) as l from fiscal group by all) qq using (y, q)
            join (select y, min(Date) as f, max(Date) as l from fiscal group by all) yy using (y)""",
    }
    body = ",\n".join(f"{n} as ({t})" for n, t in ctes.items())
    return f"with recursive {body}\n{final}"


def _sold(columns: str, table: str = "dim", where: str = "true") -> str:
    return f"""select t.Date, {columns}, coalesce(lines, 0) as lines, coalesce(units, 0) as units
        from {table} t left join sales on sales.Date = t.Date where {where}"""


def _holiday_sql(*names: str) -> str:
    listed = ", ".join("'" + n.replace("'", "''") + "'" for n in names)
    return _oracle(_sold("HolidayName", where=f"HolidayName in ({listed})"))


_FIXED = [h.name for h in cal.HOLIDAYS if h.day is not None]
_NTH = [h.name for h in cal.HOLIDAYS if h.weekday and h.name not in ("Memorial Day", "Labor Day", "Election Day")]

_FISCAL_COLUMNS = "FiscalDayOfYear, FiscalWeekOfYear, FiscalMonth, FiscalQuarter, FiscalYear"

_PERIODS_SQL = """select 'M' || strftime(d, '%Y%m') as PeriodDatakey, 1.0::double as PeriodFactor,
    'C00' || strftime(d, '%Y%m') as PeriodId, 'M' || strftime(d, '%Y%m') as IdPeriod,
    monthname(d)[1:3] || ' ' || lpad(day(d)::varchar, 2, ' ') || ' ' || year(d) || ' ' || year(d) as "Month", lines, {empty}
    from (select cast(unnest(generate_series(s, e, interval 1 month)) as date) as d from span)
    left join (select year(l_shipdate) as y, month(l_shipdate) as m, count(*) as lines from lineitem group by all)
      on y = year(d) and m = month(d)""".format(
    empty=", ".join(
        f"'' as \"{c}\"" for c in cal.PERIOD_COLUMNS
        if c not in ("PeriodDatakey", "PeriodFactor", "PeriodId", "IdPeriod", "Month")
    )
)

QUERIES: dict[str, Query] = {
    "date_dimension": Query(
        _query(_dimension),
        _oracle("select t.*, coalesce(lines, 0) as lines, coalesce(units, 0) as units from dim t left join sales using (Date)"),
    ),
    "nth_weekday": Query(
        _columns("DayOfWeekInMonth", "DayOfQuarter", "DayOfWeekInYear"),
        _oracle(_sold("DayOfWeekInMonth, DayOfQuarter, DayOfWeekInYear")),
    ),
    "holidays_fixed": Query(_holidays(*_FIXED), _holiday_sql(*_FIXED)),
    "holidays_nth": Query(_holidays(*_NTH), _holiday_sql(*_NTH)),
    "holidays_extreme": Query(
        _holidays("Memorial Day", "Labor Day"), _holiday_sql("Memorial Day", "Labor Day")
    ),
    "holiday_election": Query(_holidays("Election Day"), _holiday_sql("Election Day")),
    "holiday_flag": Query(
        _flag,
        _oracle(
            """select Year, IsHoliday, IsWeekday, count(*) as days, cast(coalesce(sum(lines), 0) as bigint) as lines,
               cast(coalesce(sum(units), 0) as bigint) as units from dim left join sales using (Date) group by all"""
        ),
    ),
    "holiday_flag_as_written": Query(
        _query(_flag_as_written),
        _oracle(
            "select Date, case when h is null then 0 else 1 end as IsHoliday, h as HolidayName, coalesce(lines, 0) as lines, "
            "coalesce(units, 0) as units from (select Date, case "
            + " ".join(
                f"when month(Date) = {h.month} and day(Date) = {h.day} then '{h.name.replace(chr(39), chr(39) * 2)}'"
                for h in cal.holidays_as_written()
            )
            + " end as h from days) left join sales using (Date)"
        ),
    ),
    "fiscal_calendar": Query(_fiscal(RULE_445), _oracle(_sold(_FISCAL_COLUMNS, "ftext"))),
    "fiscal_calendar_454": Query(_fiscal(RULE_454), _oracle(_sold(_FISCAL_COLUMNS, "ftext"), (4, 5, 4), 12)),
    "fiscal_bounds": Query(
        _fiscal_bounds,
        _oracle(
            """select y as FiscalYear, q as FiscalQuarter, m as FiscalMonth, fb.* exclude (Date),
               cast(coalesce(sum(lines), 0) as bigint) as lines, cast(coalesce(sum(units), 0) as bigint) as units
               from fiscal join fb using (Date) left join sales using (Date) group by all"""
        ),
    ),
    "fiscal_labels": Query(
        _query(_fiscal_labels),
        _oracle(_sold("FiscalQuarterName, FiscalYearName, FiscalMonthYear, FiscalMMYYYY", "ftext")),
    ),
    "date_dimension_full": Query(
        _query(_full),
        _oracle(
            """select dim.*, ftext.* exclude (Date), fb.* exclude (Date), coalesce(lines, 0) as lines,
               coalesce(units, 0) as units from dim left join ftext using (Date) left join fb using (Date)
               left join sales using (Date)"""
        ),
    ),
    "month_periods": Query(_monthly, _oracle(_PERIODS_SQL)),
    "spine_days": Query(
        _query(lambda sales: cal.day_spine(_span(sales)).select("Date")),
        _oracle("select Date, coalesce(lines, 0) as lines, coalesce(units, 0) as units from days left join sales using (Date)"),
    ),
    "spine_months": Query(
        _spine_months,
        """with recursive b as (select cast(min(o_orderdate) as date) as s, last_day(cast(max(o_orderdate) as date)) as e from orders),
           walk as (select s as Date, e from b union all
                    select cast(Date + interval 1 month as date), e from walk where cast(Date + interval 1 month as date) <= e)
           select Date, n as orders from walk left join
             (select date_trunc('month', o_orderdate) as m, count(*) as n from orders group by 1)
             on m = date_trunc('month', Date)""",
    ),
    "spine_leap_years": Query(
        _spine_leap_years,
        f"""select y as leapyear, lines from (select unnest(range({FIRST_LEAP}, cast((select max(year(l_shipdate)) from lineitem) as int), {EVERY})) as y)
            left join (select year(l_shipdate) as yy, count(*) as lines from lineitem group by 1) on yy = y""",
    ),
}
