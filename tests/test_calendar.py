"""Calendar closed forms against day-by-day walks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dispensa.plans import calendar as cal

DAY = dt.timedelta(days=1)


def span(spark, start, end):
    return spark.createDataFrame([(start, end)], "start date, end date")


def walk(start, end):
    """(month, quarter, year) counters per weekday, counted day by day."""
    counts, out, d, last = {}, {}, start, None
    while d < end:
        keys = {"m": (d.year, d.month), "q": (d.year, (d.month - 1) // 3), "y": d.year}
        w = d.weekday()
        row = []
        for name, key in keys.items():
            counts[(name, key, w)] = counts.get((name, key, w), 0) + 1
            row.append(counts[(name, key, w)])
        out[d] = tuple(row)
        d, last = d + DAY, d
    assert last is not None
    return out


def sunday_week(d):
    """Week number, where a new week begins on each Sunday after January 1."""
    jan1 = dt.date(d.year, 1, 1)
    return 1 + sum(1 for k in range(1, (d - jan1).days + 1) if (jan1 + k * DAY).weekday() == 6)


@pytest.fixture(scope="module")
def dimension(spark):
    start, end = dt.date(2014, 12, 29), dt.date(2031, 5, 20)
    days = cal.date_dimension(span(spark, start, end))
    return start, end, {r["Date"]: r for r in days.collect()}


def test_spine_and_counters(dimension):
    start, end, rows = dimension
    counted = walk(start, end)
    assert set(rows) == set(counted)
    for d, (m, q, y) in counted.items():
        r = rows[d]
        assert (r["DayOfWeekInMonth"], r["DayOfQuarter"], r["DayOfWeekInYear"]) == (str(m), str(q), str(y))


def test_weeks(dimension):
    _, _, rows = dimension
    for d, r in rows.items():
        first = d.replace(day=1)
        quarter = dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
        assert r["WeekOfYear"] == str(sunday_week(d))
        assert r["WeekOfMonth"] == str(sunday_week(d) - sunday_week(first) + 1)
        assert r["WeekOfQuarter"] == str((d - quarter).days // 7 + 1)
    assert rows[dt.date(2028, 12, 31)]["WeekOfYear"] == "54"


def test_plain_columns(dimension):
    _, _, rows = dimension
    r = rows[dt.date(2020, 2, 22)]
    assert r.asDict() | {} == {
        "DateKey": 20200222, "Date": dt.date(2020, 2, 22), "FullDate": "02/22/2020", "DayOfMonth": "22",
        "DaySuffix": "22nd", "DayName": "Saturday", "DayOfWeek": "7", "DayOfWeekInMonth": "4",
        "DayOfWeekInYear": "8", "DayOfQuarter": "8", "DayOfYear": "53", "WeekOfMonth": "4", "WeekOfQuarter": "8",
        "WeekOfYear": "8", "Month": "2", "MonthName": "February", "MonthOfQuarter": "2", "Quarter": "1",
        "QuarterName": "First", "Year": "2020", "YearName": "CY 2020", "MonthYear": "Feb-2020", "MMYYYY": "022020",
        "FirstDayOfMonth": dt.date(2020, 2, 1), "LastDayOfMonth": dt.date(2020, 2, 29),
        "FirstDayOfQuarter": dt.date(2020, 1, 1), "LastDayOfQuarter": dt.date(2020, 3, 31),
        "FirstDayOfYear": dt.date(2020, 1, 1), "LastDayOfYear": dt.date(2020, 12, 31),
        "IsHoliday": 0, "IsWeekday": 0, "HolidayName": None,
    }
    suffixes = {rows[dt.date(2020, 1, k)]["DaySuffix"] for k in (1, 2, 3, 4, 11, 12, 13, 21, 22, 23, 31)}
    assert suffixes == {"1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "23rd", "31st"}


def test_holidays(dimension):
    _, _, rows = dimension
    expected = {
        dt.date(2020, 1, 1): "New Year's Day",
        dt.date(2020, 1, 20): "Martin Luther King, Jr. Day",
        dt.date(2020, 2, 17): "President's Day",
        dt.date(2020, 5, 10): "Mother's Day",
        dt.date(2020, 5, 25): "Memorial Day",
        dt.date(2020, 6, 21): "Father's Day",
        dt.date(2020, 7, 4): "Independance Day",
        dt.date(2020, 9, 7): "Labor Day",
        dt.date(2020, 10, 12): "Columbus Day",
        dt.date(2020, 11, 3): "Election Day",
        dt.date(2020, 11, 26): "Thanksgiving Day",
        dt.date(2020, 12, 25): "Christmas Day",
        dt.date(2016, 11, 8): "Election Day",
        dt.date(2031, 5, 19): "Memorial Day",  # the last Monday before the dimension ends
    }
    for d, name in expected.items():
        assert rows[d]["HolidayName"] == name and rows[d]["IsHoliday"] == 1
    per_year = [d for d, r in rows.items() if d.year == 2020 and r["IsHoliday"] == 1]
    assert len(per_year) == 16


def test_holidays_as_written(spark):
    days = cal.date_dimension(span(spark, dt.date(2020, 1, 1), dt.date(2021, 1, 1)), cal.holidays_as_written())
    assert days.where(F.col("IsHoliday") == 1).count() == 7


def fiscal_walk(start, first_year, last_year, first_leap, every, weeks, long_month):
    leaps = set(range(first_leap, last_year, every))
    d, year, day, out = start, first_year, 1, {}
    while d.year <= last_year:
        week = (day - 1) // 7 + 1
        leap = 1 if year in leaps else 0
        month, upto = 1, 0
        for m in range(1, 13):
            upto += weeks[(m - 1) % 3] + (leap if m == long_month else 0)
            if week <= upto:
                month = m
                break
        out[d] = (day, week, month, (month - 1) // 3 + 1, year)
        d, day = d + DAY, day + 1
        if (day - 1) // 7 + 1 > 52 + leap:
            year, day = year + 1, 1
    return out


@pytest.mark.parametrize(
    ("make", "weeks", "long_month"), [(cal.rule_445, (4, 4, 5), 11), (cal.rule_454, (4, 5, 4), 12)]
)
@pytest.mark.parametrize(("first_leap", "every"), [(2012, 6), (2016, 3), (2015, 5)])
def test_fiscal_days(spark, make, weeks, long_month, first_leap, every):
    start = dt.date(2014, 12, 29)
    last = spark.createDataFrame([(2047,)], "last_year int")
    got = cal.fiscal_days(last, make(start, 2015, first_leap, every)).collect()
    names = ("FiscalDayOfYear", "FiscalWeekOfYear", "FiscalMonth", "FiscalQuarter", "FiscalYear")
    assert {r["Date"]: tuple(r[n] for n in names) for r in got} == fiscal_walk(
        start, 2015, 2047, first_leap, every, weeks, long_month
    )


def test_fiscal_bounds_tile_the_calendar(spark):
    last = spark.createDataFrame([(2040,)], "last_year int")
    rule = cal.rule_445(dt.date(2014, 12, 29), 2015, 2012)
    days = cal.fiscal_calendar(last, rule)
    for part in ("Month", "Quarter", "Year"):
        bounds = sorted(
            tuple(r) for r in days.select(f"FiscalFirstDayOf{part}", f"FiscalLastDayOf{part}").distinct().collect()
        )
        assert all(a[1] + DAY == b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    row = days.where("Date = date '2018-12-24'").first()
    assert row["FiscalYearName"] == "FY 2018" and row["FiscalMMYYYY"] == "122018" and row["FiscalMonthYear"] == "Dec-2018"
    weeks = days.groupBy("FiscalYear").agg(F.max(F.col("FiscalWeekOfYear").cast("int")).alias("w"))
    long = {r["FiscalYear"] for r in weeks.collect() if r["w"] == 53}
    assert long == {"2018", "2024", "2030", "2036"}


def test_leap_years_of_the_shipped_range(spark):
    years = cal.leap_years(spark.createDataFrame([(2100,)], "last_year int"), 2012)
    listed = sorted(r[0] for r in years.collect())
    assert listed[:3] == [2012, 2018, 2024] and listed[-1] == 2096


def test_month_periods(spark):
    rows = cal.month_periods(span(spark, dt.date(2021, 4, 1), dt.date(2021, 6, 1))).collect()
    assert [r["PeriodDatakey"] for r in rows] == ["M202104", "M202105", "M202106"]
    first = rows[0].asDict()
    assert len(first) == 41
    assert first["PeriodId"] == "C00202104" and first["IdPeriod"] == "M202104" and first["PeriodFactor"] == 1.0
    assert first["Month"] == "Apr  1 2021 2021"
    assert sum(1 for v in first.values() if v == "") == 36  # 41 less five filled


@pytest.mark.parametrize("start", [dt.date(2021, 1, 31), dt.date(2023, 12, 30), dt.date(2021, 5, 15)])
def test_month_steps_keep_a_cut_day(spark, start):
    end = dt.date(2025, 3, 29)
    want, d = [], start
    while d <= end:
        want.append(d)
        y, m = (d.year + 1, 1) if d.month == 12 else (d.year, d.month + 1)
        last = (dt.date(y + (m == 12), m % 12 + 1, 1) - DAY).day
        d = dt.date(y, m, min(d.day, last))
    assert sorted(r["Date"] for r in cal.month_spine(span(spark, start, end)).collect()) == want


def test_empty_spans(spark):
    empty = span(spark, dt.date(2021, 2, 1), dt.date(2021, 2, 1))
    assert cal.day_spine(empty).count() == 0
    assert cal.month_spine(empty).count() == 1


def test_the_dimension_is_as_declared(spark):
    span = spark.sql("select date '1999-12-20' as start, date '2000-01-10' as end")
    rule = cal.rule_445(dt.date(1994, 12, 26), 1995, 1996, 3)
    full = cal.date_dimension_full(span, spark.sql("select 2000 as last_year"), rule)
    assert ", ".join(f"{c} {t}" for c, t in full.dtypes) == cal.DIMENSION_SCHEMA
    assert len(full.columns) == 47 and full.count() == 21
    assert full.columns[:3] == ["DateKey", "Date", "FullDate"] and full.columns[32:34] == ["FiscalDayOfYear", "FiscalWeekOfYear"]


def test_a_holiday_that_began_in_1983(spark):
    span = spark.sql("select date '1981-01-01' as start, date '1985-12-31' as end")
    days = cal.date_dimension(span).where("HolidayName like 'Martin%'").select("Date").collect()
    assert sorted(r["Date"] for r in days) == [dt.date(1983, 1, 17), dt.date(1984, 1, 16), dt.date(1985, 1, 21)]
