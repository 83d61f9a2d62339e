"""Balance against target per shop."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.dates import as_date
from ..functions.numbers import thousands_text_to_long
from ..functions.text import after_prefix, has_none_of
from ..operators.aggregates import attainment
from .flows import real_shop

CODE_PREFIX = 4
MEASURES = ["balance_target", "lead_target", "sale_target", "traffic_target"]
TARGET_KEYS = ["kpi_year", "kpi_month", "shopname", "province", "region", "manager", "area_manager"]


def kpi_targets(sheet: DataFrame) -> DataFrame:
    """Target sheet with its text numbers parsed, head office left out, summed per shop and month."""
    parsed = sheet.where(has_none_of(F.col("shopname"), [fv.HEAD_OFFICE])).withColumns({
        **{m: thousands_text_to_long(F.col(m)) for m in MEASURES},
        "kpi_year": F.col("kpi_year").try_cast("int"),
        "kpi_month": F.col("kpi_month").try_cast("int"),
    })
    return parsed.groupBy(*TARGET_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def write_off_periods(write_offs: DataFrame, prefix: int = CODE_PREFIX) -> DataFrame:
    """Write-off month per contract code suffix."""
    return write_offs.select(after_prefix(F.col("codeno"), prefix).alias("code"), "write_off_period")


def performing_balance(snapshot: DataFrame, write_offs: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Balance per shop of contracts under 11 days past due and not written off by the as-of month."""
    as_of = as_date(as_of)
    this_month = as_of.year * 100 + as_of.month
    open_rows = snapshot.where(
        (F.col("created") == F.lit(as_of))
        & ~F.col("categoryname").contains(fv.TRACKER_MARK)
        & real_shop()
        & (F.col("tuoino") < fv.PERFORMING_DPD)
    ).select("created", "shopid", "shopcode", "shopname", "currentmoney",
             after_prefix(F.col("contractcode"), CODE_PREFIX).alias("code"))
    period = F.coalesce("write_off_period", F.lit(fv.NEVER_WRITTEN_OFF))
    return (
        open_rows.join(write_off_periods(write_offs), "code", "left")
        .where(period > this_month)
        .groupBy("created", "shopid", "shopcode", "shopname")
        .agg(F.sum("currentmoney").alias("currentmoney"))
    )


def kpi_status(snapshot: DataFrame, write_offs: DataFrame, sheet: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Performing balance against the month's target: gap and completion rate."""
    as_of = as_date(as_of)
    month_targets = kpi_targets(sheet).where((F.col("kpi_year") == as_of.year) & (F.col("kpi_month") == as_of.month))
    status = performing_balance(snapshot, write_offs, as_of).join(month_targets, "shopname", "left")
    return attainment(status, "currentmoney", "balance_target", "bal_gap", "complete_rate")


def active_shops(shop_sheet: DataFrame, code: str = "shopcode") -> DataFrame:
    """Shop sheet without rows that carry no shop code."""
    return shop_sheet.where(F.coalesce(F.col(code), F.lit("")) != "")
