"""Calendar ranges as half-open comparisons on the bare column, so scans can use them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The reporting day: a literal for repeatable runs, today by default."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


Bounds = tuple[Column, Column | None]  # first day, and the first day after the range if it ends


def within(day: Column, bounds: Bounds) -> Column:
    start, end = bounds
    return day >= start if end is None else (day >= start) & (day < end)


def within_month(month: Column, bounds: Bounds) -> Column:
    """The months a range touches, for tables partitioned by month (first day of it)."""
    start, end = bounds
    first = month >= F.trunc(start, "MONTH")
    return first if end is None else first & (month < end)


def last_days(as_of: Column, days: int) -> Bounds:
    """Rolling window with a lower bound only."""
    return F.date_sub(as_of, days), None


def year_of(as_of: Column, offset: int = 0) -> Bounds:
    start = F.trunc(as_of, "YEAR")
    return F.add_months(start, 12 * offset), F.add_months(start, 12 * (offset + 1))


def month_of(as_of: Column, offset: int = 0) -> Bounds:
    start = F.trunc(as_of, "MONTH")
    return F.add_months(start, offset), F.add_months(start, offset + 1)


def quarter_of(as_of: Column, offset: int = 0) -> Bounds:
    start = F.trunc(as_of, "QUARTER")
    return F.add_months(start, 3 * offset), F.add_months(start, 3 * (offset + 1))


GRAINS = {"day": None, "week": "WEEK", "month": "MONTH", "quarter": "QUARTER", "year": "YEAR"}


def truncate(day: Column, grain: str) -> Column:
    """First day of the period as a DATE."""
    unit = GRAINS[grain.lower()]
    return day if unit is None else F.trunc(day, unit)
