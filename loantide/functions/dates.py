"""Date and time expressions. The as-of date is always an argument, never the clock."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: dt.date | str) -> Column:
    return F.lit(as_date(value))


def day_offset(value: dt.date | str, days: int) -> Column:
    return F.lit(as_date(value) + dt.timedelta(days=days))


def yearmonth(value: Column) -> Column:
    """yyyymm as an integer."""
    return (F.year(value) * 100 + F.month(value)).cast("int")


def yearmonth_text(value: Column) -> Column:
    return F.date_format(value, "yyyyMM")


def yearmonth_of_text(value: Column) -> Column:
    """yyyymm text of a yyyy-mm-dd text; null when the text is no date."""
    return yearmonth_text(F.try_to_date(value, "yyyy-MM-dd"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of minute marks passed from start to end (10:00:59 to 10:01:00 is 1)."""
    first = F.unix_timestamp(F.date_trunc("MINUTE", start))
    last = F.unix_timestamp(F.date_trunc("MINUTE", end))
    return ((last - first) / 60).cast("long")


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Full elapsed time in minutes, days included."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60.0


def first_overdue_day(created: Column, dpd: Column) -> Column:
    return F.date_sub(created, dpd.cast("int"))


def signed_days_to(value: Column, as_of: dt.date | str) -> Column:
    """Days from the as-of date to ``value``: negative once it has passed."""
    return F.datediff(value, day(as_of))


def is_weekday_in(value: Column, sunday_based: list[int]) -> Column:
    """Weekday test with Sunday = 1."""
    return F.dayofweek(value).isin(sunday_based)


def display_date(value: Column) -> Column:
    return F.date_format(value, "dd-MM-yyyy")


def parse_date(value: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """Date of a text cell; blank or malformed text becomes null."""
    return F.try_to_date(F.nullif(F.trim(value), F.lit("")), pattern)


def month_pairs(as_of: dt.date | str, count: int = 4) -> list[tuple[dt.date, dt.date]]:
    """(month end, same day of the following month) pairs, newest first.

    The closing day is the as-of day of month, cut to the length of its month.
    """
    anchor = as_date(as_of)
    pairs = []
    closing_month = anchor.replace(day=1)
    for _ in range(count):
        opening = closing_month - dt.timedelta(days=1)
        length = calendar.monthrange(closing_month.year, closing_month.month)[1]
        pairs.append((opening, closing_month.replace(day=min(length, anchor.day))))
        closing_month = opening.replace(day=1)
    return pairs
