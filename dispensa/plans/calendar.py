"""Date dimension with holidays and a 4-4-5 fiscal calendar, and month periods.

Spines come from ``sequence`` over a one-row DataFrame of bounds; every column is an expression
on the date, so there is no walk from day to day and no shuffle but for the fiscal bounds.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dispensa.functions import dates as d
from dispensa.functions.compat import int_div

# --- spines ----------------------------------------------------------------------------------


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row (start, end): the first date and the day after the last one."""
    date = F.col(column).cast("date")
    return df.agg(F.min(date).alias("start"), F.date_add(F.max(date), 1).alias("end"))


def day_spine(span: DataFrame) -> DataFrame:
    """One row per day from ``start`` up to, not including, ``end``."""
    days = F.sequence(F.col("start"), F.date_sub("end", 1), F.expr("interval 1 day"))
    return span.where(F.col("start") < F.col("end")).select("start", "end", F.explode(days).alias("Date"))


def month_spine(span: DataFrame) -> DataFrame:
    """One row per month step from ``start`` to ``end`` inclusive.

    Steps are taken one after the other, so a day that a short month cuts stays cut: from
    January 31 to February 28 and then March 28.
    """
    first = d.month_start(F.col("start"))
    last = d.month_start(F.col("end"))
    months = span.where(F.col("start") <= F.col("end")).select(
        "start", "end", F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_month")
    )
    so_far = Window.partitionBy("start").orderBy("_month").rowsBetween(Window.unboundedPreceding, 0)
    shortest = F.min(F.dayofmonth(F.last_day("_month"))).over(so_far)
    day = F.least(F.dayofmonth("start"), shortest)
    stepped = months.withColumn("Date", F.date_add("_month", day - 1))
    return stepped.where(F.col("Date") <= F.col("end")).select("start", "end", "Date")


def leap_years(span: DataFrame, first: int, every: int = 6) -> DataFrame:
    """Fiscal years with 53 weeks: every ``every``-th year from ``first``, before ``last_year``."""
    years = F.sequence(F.lit(first), F.col("last_year") - 1, F.lit(every))
    return span.where(F.col("last_year") > first).select(F.explode(years).alias("leapyear"))


# --- calendar columns ------------------------------------------------------------------------


def calendar_columns(days: DataFrame) -> DataFrame:
    """The 32 columns of the dimension for rows (start, end, Date); holidays are still empty.

    The weekday counters start at ``start``, so a first period that is not whole counts from there.
    """
    date, start = F.col("Date"), F.col("start")

    def text(c: Column) -> Column:
        return c.cast("string")

    year = F.year(date)
    return days.select(
        "start",
        "end",
        d.style_112(date).cast("int").alias("DateKey"),
        "Date",
        d.style_101(date).alias("FullDate"),
        text(F.dayofmonth(date)).alias("DayOfMonth"),
        d.day_suffix(date).alias("DaySuffix"),
        F.date_format(date, "EEEE").alias("DayName"),
        text(F.dayofweek(date)).alias("DayOfWeek"),
        text(d.nth_weekday(date, d.month_start(date), start)).alias("DayOfWeekInMonth"),
        text(d.nth_weekday(date, d.year_start(date), start)).alias("DayOfWeekInYear"),
        text(d.nth_weekday(date, d.quarter_start(date), start)).alias("DayOfQuarter"),
        text(F.dayofyear(date)).alias("DayOfYear"),
        text(d.week_of_month(date)).alias("WeekOfMonth"),
        text(d.week_of_quarter(date)).alias("WeekOfQuarter"),
        text(d.week_of_year(date)).alias("WeekOfYear"),
        text(F.month(date)).alias("Month"),
        F.date_format(date, "MMMM").alias("MonthName"),
        text(d.month_of_quarter(date)).alias("MonthOfQuarter"),
        text(F.quarter(date)).alias("Quarter"),
        d.pick(d.QUARTER_NAMES, F.quarter(date)).alias("QuarterName"),
        text(year).alias("Year"),
        F.concat(F.lit("CY "), text(year)).alias("YearName"),
        F.concat(F.date_format(date, "MMM"), F.lit("-"), text(year)).alias("MonthYear"),
        d.mmyyyy(F.month(date), year).alias("MMYYYY"),
        d.month_start(date).alias("FirstDayOfMonth"),
        F.last_day(date).alias("LastDayOfMonth"),
        d.quarter_start(date).alias("FirstDayOfQuarter"),
        F.last_day(F.add_months(d.quarter_start(date), 2)).alias("LastDayOfQuarter"),
        d.year_start(date).alias("FirstDayOfYear"),
        F.make_date(year, F.lit(12), F.lit(31)).alias("LastDayOfYear"),
        F.lit(None).cast("int").alias("IsHoliday"),
        d.is_weekday(date).alias("IsWeekday"),
        F.lit(None).cast("string").alias("HolidayName"),
    )


# --- holidays --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Holiday:
    """A holiday on a day of a month, or on the nth / last / first weekday of a month."""

    name: str
    month: int
    day: int | None = None
    weekday: str | None = None
    nth: int | None = None  # -1: the last one
    since: int | None = None
    plus: int = 0  # days after the date found


# Names and rules, in the order in which later ones overwrite earlier ones.
HOLIDAYS = (
    Holiday("New Year's Day", 1, day=1),
    Holiday("Martin Luther King, Jr. Day", 1, weekday="Monday", nth=3, since=1983),
    Holiday("Valentine's Day", 2, day=14),
    Holiday("President's Day", 2, weekday="Monday", nth=3),
    Holiday("Saint Patrick's Day", 3, day=17),
    Holiday("Memorial Day", 5, weekday="Monday", nth=-1),
    Holiday("Mother's Day", 5, weekday="Sunday", nth=2),
    Holiday("Father's Day", 6, weekday="Sunday", nth=3),
    Holiday("Independance Day", 7, day=4),
    Holiday("Labor Day", 9, weekday="Monday", nth=1),
    Holiday("Columbus Day", 10, weekday="Monday", nth=2),
    Holiday("Halloween", 10, day=31),
    Holiday("Veterans Day", 11, day=11),
    Holiday("Thanksgiving Day", 11, weekday="Thursday", nth=4),
    Holiday("Christmas Day", 12, day=25),
    Holiday("Election Day", 11, weekday="Monday", nth=1, plus=1),
)


def falls_on(h: Holiday) -> Column:
    """Whether a row of the dimension is the holiday.

    The counters see only the days of the dimension, and so does "last": the last Monday is the
    one whose next one is in another month or past the end.
    """
    date = F.date_sub("Date", h.plus)
    in_month = (F.month(date) == h.month) & (date >= F.col("start")) & (F.month("Date") == h.month)
    if h.day is not None:
        return in_month & (F.dayofmonth(date) == h.day)
    hit = in_month & (F.date_format(date, "EEEE") == h.weekday)
    if h.nth == -1:
        following = F.date_add(date, 7)
        return hit & ((F.month(following) != h.month) | (following >= F.col("end")))
    hit = hit & (d.nth_weekday(date, d.month_start(date), F.col("start")) == h.nth)
    return hit & (F.year(date) >= h.since) if h.since else hit


def holidays_as_written() -> tuple[Holiday, ...]:
    """The published rules compare a weekday number with a name, so only fixed days ever match."""
    return tuple(h for h in HOLIDAYS if h.day is not None)


def with_holidays(days: DataFrame, holidays: tuple[Holiday, ...] = HOLIDAYS) -> DataFrame:
    """Fill HolidayName and IsHoliday; the last matching rule wins."""
    name = F.lit(None).cast("string")
    for h in holidays:
        name = F.when(falls_on(h), h.name).otherwise(name)
    return days.withColumn("HolidayName", name).withColumn(
        "IsHoliday", F.when(F.col("HolidayName").isNull(), 0).otherwise(1)
    )


def date_dimension(span: DataFrame, holidays: tuple[Holiday, ...] = HOLIDAYS) -> DataFrame:
    """One row per day of the span with 32 columns."""
    return with_holidays(calendar_columns(day_spine(span)), holidays).drop("start", "end")


# --- fiscal calendar -------------------------------------------------------------------------


@dataclass(frozen=True)
class FiscalRule:
    """52-week years of quarters with months of 4-4-5 (or other) weeks.

    ``start`` is the first day of fiscal year ``first_year``. Every ``every``-th year from
    ``first_leap`` has a 53rd week, which ``long_month`` takes.
    """

    start: datetime.date
    first_year: int
    first_leap: int
    every: int = 6
    weeks: tuple[int, int, int] = (4, 4, 5)
    long_month: int = 11


def rule_445(start: datetime.date, first_year: int, first_leap: int, every: int = 6) -> FiscalRule:
    return FiscalRule(start, first_year, first_leap, every)


def rule_454(start: datetime.date, first_year: int, first_leap: int, every: int = 6) -> FiscalRule:
    return FiscalRule(start, first_year, first_leap, every, (4, 5, 4), 12)


def _is_leap(year: Column, rule: FiscalRule) -> Column:
    listed = (year >= rule.first_leap) & (year < F.col("last_year"))
    return F.when(listed & ((year - rule.first_leap) % rule.every == 0), 1).otherwise(0)


def _leaps_through(year: Column, rule: FiscalRule) -> Column:
    """How many 53-week years there are up to ``year``."""
    last = F.least(year, F.col("last_year") - 1)
    count = int_div(last - rule.first_leap, F.lit(rule.every)) + 1
    return F.when(last >= rule.first_leap, count).otherwise(0).cast("int")


def fiscal_days(last_year: DataFrame, rule: FiscalRule) -> DataFrame:
    """Days of all fiscal years until the end of the calendar year ``last_year`` (one row).

    The start of a fiscal year follows from the number of 53-week years before it.
    """
    number = F.explode(F.sequence(F.lit(0), F.col("last_year") - rule.start.year + 1)).alias("_k")
    before = F.lit(rule.first_year - 1)
    years = last_year.select("last_year", number).select(
        "last_year", (F.col("_k") + rule.first_year).alias("FiscalYear"), "_k"
    )
    extra = _leaps_through(F.col("FiscalYear") - 1, rule) - _leaps_through(before, rule)
    years = years.withColumn("_leap", _is_leap(F.col("FiscalYear"), rule)).withColumn(
        "_start", F.date_add(F.lit(rule.start), (F.col("_k") * 52 + extra).cast("int") * 7)
    )
    day = F.explode(F.sequence(F.lit(0), (F.col("_leap") + 52) * 7 - 1)).alias("_day")
    days = years.select("last_year", "FiscalYear", "_leap", "_start", day)
    dated = days.withColumn("Date", F.date_add("_start", F.col("_day"))).where(F.year("Date") <= F.col("last_year"))
    week = int_div(F.col("_day"), F.lit(7)).cast("int") + 1
    month = F.lit(1)
    end = 0
    for m in range(1, 12):
        end += rule.weeks[(m - 1) % 3]
        last_week = F.lit(end) + (F.col("_leap") if m >= rule.long_month else F.lit(0))
        month = month + (week > last_week).cast("int")
    return dated.select(
        "Date",
        (F.col("_day") + 1).alias("FiscalDayOfYear"),
        week.alias("FiscalWeekOfYear"),
        month.alias("FiscalMonth"),
        (int_div(month - 1, F.lit(3)).cast("int") + 1).alias("FiscalQuarter"),
        "FiscalYear",
    )


def fiscal_bounds(days: DataFrame) -> DataFrame:
    """First and last day of each fiscal month, quarter and year, before any clipping."""
    out = days
    for name, keys in (
        ("Month", ["FiscalYear", "FiscalQuarter", "FiscalMonth"]),
        ("Quarter", ["FiscalYear", "FiscalQuarter"]),
        ("Year", ["FiscalYear"]),
    ):
        whole = Window.partitionBy(*keys)
        out = out.withColumns(
            {
                f"FiscalFirstDayOf{name}": F.min("Date").over(whole),
                f"FiscalLastDayOf{name}": F.max("Date").over(whole),
            }
        )
    return out


def fiscal_labels(days: DataFrame) -> DataFrame:
    """Names of quarter, year and month; numbers become text, as the dimension declares them."""
    year, month = F.col("FiscalYear"), F.col("FiscalMonth")
    named = days.withColumns(
        {
            "FiscalQuarterName": d.pick(d.QUARTER_NAMES, F.col("FiscalQuarter")),
            "FiscalYearName": F.concat(F.lit("FY "), year.cast("string")),
            "FiscalMonthYear": F.concat(d.pick(d.MONTH_ABBREVIATIONS, month), F.lit("-"), year.cast("string")),
            "FiscalMMYYYY": d.mmyyyy(month, year),
        }
    )
    numbers = ("FiscalDayOfYear", "FiscalWeekOfYear", "FiscalMonth", "FiscalQuarter", "FiscalYear")
    return named.withColumns({n: F.col(n).cast("string") for n in numbers})


def fiscal_calendar(last_year: DataFrame, rule: FiscalRule) -> DataFrame:
    """Fiscal columns per day, with bounds and labels."""
    return fiscal_labels(fiscal_bounds(fiscal_days(last_year, rule)))


# The columns of the date dimension, in order, with their types; numbers are text.
DIMENSION_SCHEMA = (
    "DateKey int, Date date, FullDate string, DayOfMonth string, DaySuffix string, DayName string, DayOfWeek string, "
    "DayOfWeekInMonth string, DayOfWeekInYear string, DayOfQuarter string, DayOfYear string, WeekOfMonth string, "
    "WeekOfQuarter string, WeekOfYear string, Month string, MonthName string, MonthOfQuarter string, Quarter string, "
    "QuarterName string, Year string, YearName string, MonthYear string, MMYYYY string, FirstDayOfMonth date, "
    "LastDayOfMonth date, FirstDayOfQuarter date, LastDayOfQuarter date, FirstDayOfYear date, LastDayOfYear date, "
    "IsHoliday int, IsWeekday int, HolidayName string, FiscalDayOfYear string, FiscalWeekOfYear string, "
    "FiscalMonth string, FiscalQuarter string, FiscalQuarterName string, FiscalYear string, FiscalYearName string, "
    "FiscalMonthYear string, FiscalMMYYYY string, FiscalFirstDayOfMonth date, FiscalLastDayOfMonth date, "
    "FiscalFirstDayOfQuarter date, FiscalLastDayOfQuarter date, FiscalFirstDayOfYear date, FiscalLastDayOfYear date"
)


def date_dimension_full(
    span: DataFrame, last_year: DataFrame, rule: FiscalRule, holidays: tuple[Holiday, ...] = HOLIDAYS
) -> DataFrame:
    """The date dimension with its fiscal columns, as declared; days without a fiscal year keep nulls."""
    days = date_dimension(span, holidays).join(fiscal_calendar(last_year, rule), "Date", "left")
    declared = [c.split(" ") for c in DIMENSION_SCHEMA.split(", ")]
    return days.select(*[F.col(name).cast(kind).alias(name) for name, kind in declared])


# --- month periods ---------------------------------------------------------------------------

# The columns of the month-period table, in order.
PERIOD_COLUMNS = (
    "PeriodDatakey", "PeriodFactor", "PeriodId", "IdPeriod", "Bimester", "CalBimesterOrder", "Month",
    "CalMonthOrder", "Quarter", "CalQuarterOrder", "HalfYear", "CalSemesterOrder", "Quadrimester", "CalThirdOrder",
    "Year", "CalYearOrder", "CalYearOrderQ", "Mat", "MatBimesterOrder", "MatQ", "MatQuarterOrder",
    "MatSemesterOrder", "MatThirdOrder", "MatYearOrder", "MatYearOrderQ", "MonthInYear", "MonthYTD",
    "QuarterInYear", "RelMonthOrder", "RelativeBimester", "RelativeHalfYear", "RelativeMonth",
    "RelativeQuadrimester", "RelativeQuarter", "Season", "SeasonOrder", "SeasonYear", "SeasonYearOrder", "YearQ",
    "Ytd", "YtdOrder",
)


def month_periods(span: DataFrame) -> DataFrame:
    """One row per month of the span: key, factor, ids and label; the other columns stay empty."""
    date = F.col("Date")
    month = F.date_format(date, "yyyyMM")
    filled = {
        "PeriodDatakey": F.concat(F.lit("M"), month),
        "PeriodFactor": F.lit(1.0),
        "PeriodId": F.concat(F.lit("C00"), month),
        "IdPeriod": F.concat(F.lit("M"), month),
        "Month": F.concat(d.style_100(date), F.lit(" "), F.year(date).cast("string")),
    }
    return month_spine(span).select(*[filled.get(c, F.lit("")).alias(c) for c in PERIOD_COLUMNS])
