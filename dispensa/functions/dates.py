"""Date expressions of the calendar jobs; all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dispensa.functions.compat import int_div

# Fixed values.
QUARTER_NAMES = ("First", "Second", "Third", "Fourth")
MONTH_ABBREVIATIONS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def style_112(d: Column) -> Column:
    """``yyyymmdd``"""
    return F.date_format(d, "yyyyMMdd")


def style_101(d: Column) -> Column:
    """``mm/dd/yyyy``"""
    return F.date_format(d, "MM/dd/yyyy")


def style_100(d: Column) -> Column:
    """``Mon dd yyyy`` with the day padded by a blank."""
    return F.concat(F.date_format(d, "MMM"), F.lit(" "), F.lpad(F.dayofmonth(d).cast("string"), 2, " "), F.date_format(d, " yyyy"))


def pick(names: tuple[str, ...], number: Column) -> Column:
    """The name with that number, from 1."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def year_start(d: Column) -> Column:
    return F.trunc(d, "year")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def week_of_year(d: Column) -> Column:
    """Week with week 1 holding January 1 and weeks starting on Sunday (not ISO)."""
    return int_div(F.dayofyear(d) + F.dayofweek(year_start(d)) - 2, F.lit(7)).cast("int") + 1


def week_of_month(d: Column) -> Column:
    return week_of_year(d) + 1 - week_of_year(month_start(d))


def week_of_quarter(d: Column) -> Column:
    return int_div(F.datediff(d, quarter_start(d)), F.lit(7)).cast("int") + 1


def nth_weekday(d: Column, period_start: Column, first: Column) -> Column:
    """How many days of this weekday the period has had, counting from ``first`` at the earliest."""
    return int_div(F.datediff(d, F.greatest(period_start, first)), F.lit(7)).cast("int") + 1


def day_suffix(d: Column) -> Column:
    """1st, 2nd, 3rd, 4th, ... with 11th to 13th."""
    day = F.dayofmonth(d)
    ending = (
        F.when(day.between(11, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), ending)


def month_of_quarter(d: Column) -> Column:
    return (F.month(d) - 1) % 3 + 1


def is_weekday(d: Column) -> Column:
    return F.dayofweek(d).between(2, 6).cast("int")


def mmyyyy(month: Column, year: Column) -> Column:
    return F.concat(F.lpad(month.cast("string"), 2, "0"), year.cast("string"))
