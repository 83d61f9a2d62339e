"""Ordered-band bucketing of a numeric column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv

SCHEMES = {"flow7": fv.FLOW7_BUCKETS, "chip6": fv.CHIP6_BUCKETS, "daily2": fv.DAILY2_BUCKETS}


def band(value: Column, bands: list[tuple], outputs: list, inclusive: bool = False) -> Column:
    """First band whose upper bound exceeds ``value`` (or equals it, if ``inclusive``).

    The last band has no bound and also takes null values, as a SQL CASE with ELSE does.
    """
    result = None
    for (upper, _), output in zip(bands, outputs):
        if upper is None:
            return F.lit(output) if result is None else result.otherwise(F.lit(output))
        test = value <= upper if inclusive else value < upper
        result = F.when(test, F.lit(output)) if result is None else result.when(test, F.lit(output))
    return result


def labelled_band(value: Column, bands: list[tuple], inclusive: bool = False) -> Column:
    return band(value, bands, [label for _, label in bands], inclusive)


def bucket_dpd(dpd: Column, scheme: str = "flow7", closed_when_null: bool = False) -> tuple[Column, Column]:
    """(ordinal, label) of days past due; a missing closing value may mean the contract closed."""
    bands = SCHEMES[scheme]
    ordinal = band(dpd, bands, list(range(len(bands))))
    label = labelled_band(dpd, bands)
    if closed_when_null:
        code, name = fv.CLOSED_BUCKET
        ordinal = F.when(dpd.isNull(), F.lit(code)).otherwise(ordinal)
        label = F.when(dpd.isNull(), F.lit(name)).otherwise(label)
    return ordinal, label
