"""Rule lists, flags and null defaults."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv
from .buckets import labelled_band


def first_match(rules: list[tuple[Column, Any]], default: Any = None) -> Column:
    """Output of the first rule that holds."""
    chain = None
    for test, output in rules:
        value = output if isinstance(output, Column) else F.lit(output)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(default if isinstance(default, Column) else F.lit(default))


def last_match(rules: list[tuple[Column, Any]], default: Any = None) -> Column:
    """Output of the last rule that holds: later rules override earlier ones."""
    return first_match(list(reversed(rules)), default)


def flag(test: Column, yes: str, no: str) -> Column:
    return F.when(test, F.lit(yes)).otherwise(F.lit(no))


def package_type(packagecode: Column) -> Column:
    return F.coalesce(packagecode, F.lit(fv.ORDINARY_LOAN))


def package_name(packagecode: Column) -> Column:
    return flag(packagecode.contains(fv.QUICK_MARK), fv.QUICK_LOAN, fv.ORDINARY_LOAN)


def paper_class(papertype: Column, null_as: str) -> Column:
    """KT1 or KT3; the class of a missing paper type differs between reports."""
    known = flag(papertype == fv.PAPER_OWNED, fv.PAPER_OWNED, fv.PAPER_RENTED)
    return F.when(papertype.isNull(), F.lit(null_as)).otherwise(known)


def loan_size(categorycode: Column, packagecode: Column, net: Column) -> Column:
    """Size label of a net disbursement; only title loans have one.

    Packaged car-title loans have one open band above 200 million, the others
    have 200-300 and above 300.
    """
    label = fv.CAR_TITLE_SIZE_LABELS
    car = first_match(
        [
            (net <= 50_000_000, label["to_50"]),
            (net <= 100_000_000, label["to_100"]),
            (net <= 200_000_000, label["to_200"]),
            (packagecode.isNotNull(), label["over_200"]),
            (net <= 300_000_000, label["to_300"]),
        ],
        label["over_300"],
    )
    return F.when(categorycode.contains(fv.BIKE_TITLE_CODE), labelled_band(net, fv.BIKE_TITLE_SIZES, inclusive=True)).when(
        categorycode.contains(fv.CAR_TITLE_CODE), car
    )


def term_range(frequency: Column) -> Column:
    return labelled_band(frequency, fv.TERM_RANGES, inclusive=True)


def open_type(previous_status: Column, previous_close: Column, fromdate: Column, sleep_days: Column) -> Column:
    """How a contract relates to the customer's previous one."""
    reopened = F.coalesce(
        F.when(sleep_days.isNull(), F.lit(fv.REOPEN_AFTER[0][1])),
        labelled_band(sleep_days, fv.REOPEN_AFTER, inclusive=True),
    )
    return first_match(
        [
            (previous_status.isNull(), fv.FIRST_LOAN),
            (previous_status.isin(fv.BAD_DEBT_STATUSES), fv.BAD_DEBT),
            (previous_status == fv.TOP_UP_STATUS, fv.TOP_UP),
            ((previous_status == fv.CLOSED_STATUS) & (previous_close == fromdate), fv.ROLLOVER),
        ],
        reopened,
    )
