"""Numeric expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def millions(value: Column) -> Column:
    return value.cast("double") / F.lit(float(MILLION))


def exact_millions(value: Column) -> Column:
    """Money in millions, kept as a decimal so that sums stay exact."""
    return value.cast("decimal(18,2)") * F.lit(Decimal("0.000001"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; null when the whole is zero or missing."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def whole_div(value: Column, unit: int) -> Column:
    """Integer quotient, truncated towards zero."""
    return F.call_function("div", value, F.lit(unit))


def thousands_text_to_long(value: Column) -> Column:
    """'1,234,567' -> 1234567; text that is no number becomes null."""
    return F.regexp_replace(F.trim(value), ",", "").try_cast("long")


def net_amount(gross: Column, insurance: Column) -> Column:
    return gross - insurance


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
