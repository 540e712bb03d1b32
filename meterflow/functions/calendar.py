"""Date predicates written as ranges on the bare column, so that scans can prune."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | None


def as_date(as_of: AsOf) -> Column:
    """The reporting day as a column: the given date, or today."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def as_instant(as_of: dt.datetime | None) -> Column:
    """The reporting instant as a column: the given time, or now."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def days_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day))


def in_month_of(col: str | Column, as_of: AsOf) -> Column:
    """True for dates in the calendar month that holds ``as_of``."""
    col = F.col(col) if isinstance(col, str) else col
    start = month_start(as_date(as_of))
    return (col >= start) & (col < F.add_months(start, 1))


def on_day(col: str, as_of: AsOf) -> Column:
    return F.col(col) == as_date(as_of)


def last_days(col: str, as_of: AsOf, days: int) -> Column:
    """True from ``days`` days before ``as_of`` on, without an upper bound."""
    return F.col(col) >= F.date_sub(as_date(as_of), days)


def last_months(col: str, as_of: AsOf, months: int) -> Column:
    """True from the start of the month ``months`` before that of ``as_of`` on."""
    return F.col(col) >= F.add_months(month_start(as_date(as_of)), -months)


def last_hours(col: str, as_of: dt.datetime | None, hours: int) -> Column:
    return F.col(col) >= as_instant(as_of) - F.make_dt_interval(hours=F.lit(hours))
