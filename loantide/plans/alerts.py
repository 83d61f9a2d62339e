"""Chip installation and GPS alerts per contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.buckets import bucket_dpd
from ..functions.dates import as_date, day_offset, days_between, yearmonth
from ..functions.numbers import exact_millions
from ..functions.text import after_prefix, is_blank
from ..operators.latest import descending_nulls_last, extreme_rows
from ..operators.lookups import keep_matching
from .flows import is_title

CODE_PREFIX = 5
ALERT_FIELDS = ["warningcreated", "dpd", "warningnumber", "numberday", "warningcontent", "commentcat",
                "commentcontent", "commentcreated", "processstatus", "distance"]


def until(created: str, as_of: dt.date | str) -> Column:
    """Happened up to the end of the as-of day."""
    return F.col(created) < day_offset(as_of, 1)


def latest_chips(chips: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Newest chip event per contract."""
    return extreme_rows(
        chips.where(until("created", as_of)),
        ["pawnid"],
        {"chip": ("max", ["created", "chip_id"], ["chipserial", "isginno"])},
    )


def first_and_last_alerts(alerts: DataFrame, as_of: dt.date | str) -> DataFrame:
    """First and last alert per contract, the heavier overdue one of a tie, in one aggregation."""
    return extreme_rows(
        alerts.where(until("warningcreated", as_of)),
        ["codeno"],
        {
            "last": ("max", ["warningcreated", "dpd", "alert_id"], ALERT_FIELDS),
            "first": ("min", ["warningcreated", descending_nulls_last(F.col("dpd")), "alert_id"], ALERT_FIELDS),
        },
    )


def response(comment: Column) -> Column:
    return rules.flag(is_blank(comment), fv.NO_RESPONSE, fv.RESPONDED)


def alert_base(snapshot: DataFrame, shops: DataFrame, chips: DataFrame, alerts: DataFrame, write_offs: DataFrame,
               shop_info: DataFrame, as_of: dt.date | str, cutoff: dt.date | str = fv.CHIP_CUTOFF) -> DataFrame:
    """Title contracts of the day with bucket, chip, first and last alert, write-off month and region."""
    as_of = as_date(as_of)
    title = snapshot.where((F.col("created") == F.lit(as_of)) & is_title())
    _, bucket = bucket_dpd(F.col("tuoino"), "chip6")
    # Only the day's contracts: their keys cut the histories down before anything of them is aggregated.
    fitted = latest_chips(keep_matching(chips, title, "pawnid"), as_of)
    codes = title.select(F.col("contractcode").alias("codeno"))
    warned = first_and_last_alerts(keep_matching(alerts, codes, "codeno"), as_of)
    joined = (
        title.join(fitted, "pawnid", "left")
        .join(warned.withColumnRenamed("codeno", "contractcode"), "contractcode", "left")
        .withColumn("shorten_code", after_prefix(F.col("contractcode"), CODE_PREFIX))
        .join(write_offs.select(after_prefix(F.col("codeno"), CODE_PREFIX).alias("shorten_code"), "write_off_period"),
              "shorten_code", "left")
        .join(shops.select(F.col("name").alias("shopname"), "areaid"), "shopname", "left")
        .join(shop_info, "shopcode", "left")
    )
    last, first = F.col("last"), F.col("first")
    return joined.select(
        "created",
        "yearmonth",
        "pawnid",
        "contractcode",
        "shorten_code",
        "categoryname",
        "shopname",
        "shopcode",
        exact_millions(F.col("currentmoney")).alias("currentmoney"),
        "papertype",
        rules.paper_class(F.col("papertype"), null_as=fv.PAPER_OWNED).alias("kt"),
        "fromdate",
        "todate",
        yearmonth(F.col("fromdate")).alias("brr_ym"),
        F.col("chipserial").alias("pos_seri"),
        F.col("chip.isginno").alias("isginno"),
        F.col("chip.chipserial").alias("sys_seri"),
        rules.flag(F.col("fromdate") > F.lit(as_date(cutoff)), fv.BORROWED_AFTER, fv.BORROWED_BEFORE).alias("brr_tick"),
        rules.flag(F.col("chip.isginno") == 1, fv.CHIP_INSTALLED, fv.CHIP_MISSING).alias("have_chip"),
        "tuoino",
        rules.package_type(F.col("packagecode")).alias("package_type"),
        bucket.alias("bucket"),
        "packagecode",
        last["warningcreated"].alias("last_warning_date"),
        yearmonth(last["warningcreated"]).alias("last_warning_ym"),
        last["warningnumber"].alias("warningnumber"),
        last["numberday"].alias("numberday"),
        last["warningcontent"].alias("warningcontent"),
        last["commentcat"].alias("commentcat"),
        last["commentcontent"].alias("commentcontent"),
        last["commentcreated"].alias("commentcreated"),
        days_between(last["warningcreated"], last["commentcreated"]).alias("last_warning_response_day"),
        last["processstatus"].alias("processstatus"),
        last["distance"].alias("distance"),
        last["dpd"].alias("dpd_at_last_warning"),
        first["warningcreated"].alias("first_warning_date"),
        yearmonth(first["warningcreated"]).alias("first_warning_ym"),
        first["dpd"].alias("dpd_at_first_warning"),
        first["numberday"].alias("first_warning_numberday"),
        first["commentcontent"].alias("first_warning_cmt"),
        response(first["commentcat"]).alias("first_warning_response"),
        first["warningcontent"].alias("first_warning_des"),
        response(last["commentcat"]).alias("shop_response_warning"),
        "areaid",
        "write_off_period",
        "region",
        "province",
        "opened_month",
        "opened_year",
    )


def in_alert_month(as_of: dt.date | str) -> Column:
    """Last alert raised in the as-of month."""
    day = as_date(as_of)
    return F.col("last_warning_ym") == day.year * 100 + day.month


def alert_list(base: DataFrame, as_of: dt.date | str) -> DataFrame:
    return base.where(in_alert_month(as_of))


def overdue_no_alert(base: DataFrame) -> DataFrame:
    """Over 30 days past due, chip installed, never an alert."""
    return base.where(
        (F.col("tuoino") > 30) & (F.col("have_chip") == fv.CHIP_INSTALLED) & F.col("last_warning_date").isNull()
    )


def overdue_with_chip(base: DataFrame) -> DataFrame:
    return base.where((F.col("have_chip") == fv.CHIP_INSTALLED) & (F.col("tuoino") > 0))


def overdue_written_off(base: DataFrame) -> DataFrame:
    """Overdue contracts with a chip that stand in the write-off list."""
    return overdue_with_chip(base).where(F.col("write_off_period").isNotNull())


def no_chip_after_cutoff(base: DataFrame, category: str = fv.CAR_TITLE) -> DataFrame:
    """Title contracts opened after the cut-off without a chip."""
    return base.where(
        (F.col("brr_tick") == fv.BORROWED_AFTER)
        & (F.col("have_chip") == fv.CHIP_MISSING)
        & (F.col("categoryname") == category)
    ).select("created", "areaid", "pawnid", "contractcode", "categoryname", "shopname", "shopcode", "currentmoney",
             "fromdate", "todate", "brr_ym", "pos_seri", "sys_seri", "isginno", "brr_tick", "have_chip")
