"""Dates: parsing, differences, calendar parts, integer keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(value: DateLike) -> Column:
    return F.lit(str(value)).cast("date")


def as_timestamp(value: dt.datetime | dt.date | str) -> Column:
    return F.lit(str(value)).cast("timestamp")


def parse_date(c: Column) -> Column:
    """String to date; unparsable text gives NULL, never an exception."""
    return c.try_cast("date")


def years_by_days(start: Column, end: Column) -> Column:
    """Whole years counted as blocks of 365 days."""
    return F.floor(F.datediff(end, start) / F.lit(365)).cast("int")


def _month_day(c: Column) -> Column:
    return F.month(c) * 100 + F.dayofmonth(c)


def _birthdays(start: Column, end: Column) -> Column:
    not_reached = F.when(_month_day(end) < _month_day(start), 1).otherwise(0)
    return F.year(end) - F.year(start) - not_reached


def years_by_calendar(start: Column, end: Column) -> Column:
    """Whole years by anniversary: the count changes on the same month and day."""
    years = F.when(end >= start, _birthdays(start, end)).otherwise(-_birthdays(end, start))
    return F.when(start.isNotNull() & end.isNotNull(), years).cast("int")


def weeks_between(start: Column, end: Column) -> Column:
    """Whole weeks from start to end."""
    return F.floor(F.datediff(end, start) / F.lit(7)).cast("int")


def date_key(c: Column) -> Column:
    """Integer ``yyyymmdd``."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def fiscal_year(c: Column, first_month: int = 7) -> Column:
    """Calendar year in which the fiscal year began."""
    return F.when(F.month(c) >= first_month, F.year(c)).otherwise(F.year(c) - 1)


def fiscal_quarter(c: Column, first_month: int = 7) -> Column:
    return F.floor(F.pmod(F.month(c) - first_month, F.lit(12)) / 3).cast("int") + 1


def calendar_parts(c: Column, fiscal_start: int = 7) -> dict[str, Column]:
    """The attribute columns of a date dimension for the date ``c``."""
    weekday = F.dayofweek(c) - 1  # 0 = Sunday
    return {
        "year": F.year(c),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "week": F.weekofyear(c),
        "day": F.dayofmonth(c),
        "day_name": F.date_format(c, "EEEE"),
        "day_of_week": weekday,
        "is_weekend": weekday.isin(0, 6),
        "fiscal_year": fiscal_year(c, fiscal_start),
        "fiscal_quarter": fiscal_quarter(c, fiscal_start),
    }
