"""Customers over their limit of active contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.dates import as_date
from ..functions.text import has_none_of
from ..operators.lookups import drop_matching, keep_matching
from ..operators.sets import reindex
from .flows import real_shop

NEWEST_AFTER = "2019-11-18"
MAX_ACTIVE = 4


def over_active_limit(contracts: DataFrame, categories: DataFrame, newest_after: dt.date | str = NEWEST_AFTER,
                      max_active: int = MAX_ACTIVE) -> DataFrame:
    """Customers with more than ``max_active`` active contracts and a recent one, with their contracts."""
    active = contracts.where(
        ~F.col("status").isin(fv.INACTIVE_STATUSES) & has_none_of(F.col("codeno"), fv.TEST_SHOP_MARKS)
    )
    over = (
        active.groupBy("customerid")
        .agg(F.max("fromdate").alias("last_contract"), F.count("codeno").alias("active_pawn_count"))
        .where((F.col("last_contract") > F.lit(as_date(newest_after))) & (F.col("active_pawn_count") > max_active))
    )
    listed = contracts.where(~F.col("status").isin(fv.LISTED_INACTIVE_STATUSES)).select(
        "customerid", "codeno", "categorycode", "shopcode", "fromdate", "moneycurrent", "loanmoneyorg"
    )
    names = categories.select(F.col("code").alias("categorycode"), F.col("name").alias("categoryname"))
    return (
        listed.join(over, "customerid")
        .join(names, "categorycode", "left")
        .select("customerid", "last_contract", "active_pawn_count", "codeno", "categoryname", "shopcode", "fromdate",
                "moneycurrent", "loanmoneyorg")
    )


def over_title_limit(snapshot: DataFrame, contracts: DataFrame, as_of: dt.date | str,
                     new_since: dt.date | str | None = None, max_active: int = 1) -> DataFrame:
    """Customers with several motorbike-title loans, one of them new and not a rollover.

    A rollover starts on the day a closed title loan of the same customer ended.
    """
    as_of = as_date(as_of)
    titles = snapshot.where((F.col("created") == F.lit(as_of)) & F.col("categoryname").contains(fv.BIKE_TITLE))
    several = titles.groupBy("customerid").agg(F.count("pawnid").alias("active_pawn")).where(
        F.col("active_pawn") > max_active
    )
    rollovers = contracts.where(
        F.col("categorycode").contains(fv.BIKE_TITLE_CODE) & (F.col("status") == fv.CLOSED_STATUS)
    ).select("customerid", F.col("closedate").alias("fromdate"))
    fresh = drop_matching(keep_matching(titles.where(real_shop()), several, "customerid"), rollovers,
                          ["customerid", "fromdate"])
    newest = fresh.groupBy("customerid", "customername").agg(F.max("fromdate").alias("newest"))
    recent = newest.where(F.col("newest") >= F.lit(as_date(new_since or as_of)))
    return reindex(keep_matching(fresh, recent, "customerid"), fv.LIMIT_COLUMNS)
