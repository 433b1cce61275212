"""Calendar buckets, week keys and year ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.cleaning import as_col
from blotter.roles import ROLES, Roles

_BUCKETS = {
    "month": F.month,
    "hour": F.hour,
    "dow": F.dayofweek,
    "year": F.year,
}

# Buckets that recur every year or less, with their first and last value.
BUCKET_RANGE = {"month": (1, 12), "hour": (0, 23), "dow": (1, 7)}

# Short names in bucket order; day 1 is Sunday.
MONTH_NAMES = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")


def bucket(period: str, ts: Column | str) -> Column:
    """Calendar bucket of a timestamp: month, hour, dow (1 = Sunday) or year."""
    if period not in _BUCKETS:
        raise ValueError(f"unknown period {period!r}; use one of {sorted(_BUCKETS)}")
    return _BUCKETS[period](as_col(ts))


def bucket_name(period: str, c: Column | str) -> Column:
    """Short name of a month or weekday bucket."""
    names = {"month": MONTH_NAMES, "dow": DAY_NAMES}[period]
    return F.try_element_at(F.array(*map(F.lit, names)), as_col(c))


def year_start(year: int) -> Column:
    return F.lit(dt.date(year, 1, 1))


def since(df: DataFrame, year: int, roles: Roles = ROLES) -> DataFrame:
    """Rows dated in ``year`` or later; undated rows drop.

    A range on the timestamp itself reaches the file scan, which a test on
    ``year(ts)`` would not.
    """
    kept = df.filter(F.col(roles.ts) >= year_start(year))
    if roles.year_part:
        kept = kept.filter(F.col(roles.year_part) >= year)
    return kept


def between_years(df: DataFrame, first: int, last: int, roles: Roles = ROLES) -> DataFrame:
    """Rows dated from ``first`` to ``last``, both included."""
    kept = since(df, first, roles).filter(F.col(roles.ts) < year_start(last + 1))
    if roles.year_part:
        kept = kept.filter(F.col(roles.year_part) <= last)
    return kept


def week_keys(ts: Column | str, mode: str = "iso") -> tuple[Column, Column]:
    """(year, week) of a timestamp.

    ``iso`` pairs the ISO week with the ISO year it belongs to; ``calendar``
    pairs it with the calendar year, so 2018-12-31 lands in week 1 of 2018.
    """
    c = as_col(ts)
    if mode == "iso":
        year = F.extract(F.lit("YEAROFWEEK"), c)
    elif mode == "calendar":
        year = F.year(c)
    else:
        raise ValueError(f"week mode must be 'iso' or 'calendar', not {mode!r}")
    return year.cast("int"), F.weekofyear(c)


def week_monday(year: Column | str, week: Column | str) -> Column:
    """Monday of an ISO week. January 4th is always in week 1."""
    first = F.trunc(F.make_date(as_col(year), F.lit(1), F.lit(4)), "week")
    return F.date_add(first, (as_col(week) - 1) * 7)
