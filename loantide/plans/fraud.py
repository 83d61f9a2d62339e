"""Rules that pick contracts to be checked for fraud.

Each rule covers the days from ``first`` to ``last`` in one pass; a daily run passes the same day twice.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.dates import as_date, day, day_offset, days_between, elapsed_minutes, is_weekday_in, minute_boundaries, yearmonth_text
from ..functions.text import has_none_of
from ..operators.lookups import keep_matching
from ..operators.sets import reindex, union_all
from .flows import is_title

NEAR_MINUTES = 15
SUNDAY, FRIDAY, SATURDAY = 1, 6, 7


@dataclass(frozen=True)
class OfficeHours:
    """Contracts handled up to ``early`` or from ``late`` o'clock are looked at."""

    early: int = 9
    late: int = 19

    def outside(self, moment: Column) -> Column:
        return (F.hour(moment) <= self.early) | (F.hour(moment) >= self.late)


def _on_days(moment: str, first: dt.date | str, last: dt.date | str) -> Column:
    return (F.col(moment) >= day(first)) & (F.col(moment) < day_offset(last, 1))


def first_disbursements(transactions: DataFrame, wanted: DataFrame) -> DataFrame:
    """Completion time (first disbursement) of the wanted contracts only."""
    paid = transactions.where(F.col("action_name") == fv.DISBURSEMENT).select(
        F.col("contract_no").alias("codeno"), "created"
    )
    return keep_matching(paid, wanted.select("codeno"), "codeno").groupBy("codeno").agg(
        F.min("created").alias("complete")
    )


def count_window(fund_counts: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """First and last cash count per shop and day."""
    return (
        fund_counts.where(_on_days("created", first, last))
        .groupBy("shop_id", "shop_name", F.to_date("created").alias("extract_date"))
        .agg(F.min("created").alias("min_cash_count"), F.max("created").alias("max_cash_count"))
    )


def cash_count_window(fund_counts: DataFrame, contracts: DataFrame, times: DataFrame, transactions: DataFrame,
                      categories: DataFrame, thresholds: DataFrame, first: dt.date | str, last: dt.date | str,
                      hours: OfficeHours = OfficeHours(), near: int = NEAR_MINUTES) -> DataFrame:
    """Contracts handled around the cash counts of their shop.

    All contracts opened or closed before the first or after the last count are
    kept. Those handled within ``near`` minutes inside the window are kept only
    when their processing time is outside the thresholds of their category.
    """
    opened, closed = F.col("openhour"), F.col("closehour")
    handled = times.where(_on_days("openhour", first, last) | _on_days("closehour", first, last)).where(
        hours.outside(opened) | hours.outside(closed)
    )
    on_opening = F.when(_on_days("openhour", first, last), F.to_date(opened))
    on_closing = F.when(_on_days("closehour", first, last), F.to_date(closed))
    handled = handled.withColumn(
        "extract_date", F.explode(F.array_distinct(F.array_compact(F.array(on_opening, on_closing))))
    ).select("codeno", "customer", "openhour", "closehour", "extract_date")
    contract = contracts.select("codeno", "shopid", "shopcode", "categorycode", "status", "inittime")
    started = F.when(~F.col("status").isin(fv.VOID_STATUSES) & opened.isNotNull(), F.col("inittime"))
    window = count_window(fund_counts, first, last).withColumnRenamed("shop_id", "shopid")
    low, high = F.col("min_cash_count"), F.col("max_cash_count")
    group = rules.first_match(
        [
            ((opened <= low) | (closed <= low), fv.BEFORE_FIRST_COUNT),
            ((opened >= high) | (closed >= high), fv.AFTER_LAST_COUNT),
            ((minute_boundaries(low, opened) <= near) | (minute_boundaries(low, closed) <= near), fv.NEAR_DAY_START),
            ((minute_boundaries(opened, high) <= near) | (minute_boundaries(closed, high) <= near), fv.NEAR_DAY_END),
        ],
        fv.OTHER_TIME,
    )
    names = categories.select(F.col("code").alias("categorycode"), F.col("name").alias("category_name"))
    base = (
        handled.join(contract, "codeno")
        .join(window, ["shopid", "extract_date"])
        .join(names, "categorycode", "left")
        .join(first_disbursements(transactions, handled), "codeno", "left")
        .withColumns({
            "pawn_fraud_group": group,
            "time_processing": minute_boundaries(started, F.col("complete")),
            "year_month": yearmonth_text(F.col("extract_date")),
        })
        .join(thresholds, "category_name", "left")
    )
    name, kind = F.col("category_name"), F.col("pawn_fraud_group")
    judged = name.isNull() | ~name.isin(fv.CAR_TITLE, fv.CAR, fv.BIKE)
    unusual = (F.col("time_processing") <= F.col("lower_threshold")) | (
        F.col("time_processing") >= F.col("upper_threshold")
    )
    return base.where(
        kind.isin(fv.BEFORE_FIRST_COUNT, fv.AFTER_LAST_COUNT)
        | (kind.isin(fv.NEAR_DAY_START, fv.NEAR_DAY_END) & judged & unusual)
    )


def open_processing(contracts: DataFrame, times: DataFrame, transactions: DataFrame, categories: DataFrame,
                    shops: DataFrame, users: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Contracts opened on the days with both staff roles and minutes from start to completion."""
    opened = times.where(_on_days("openhour", first, last)).select(
        "codeno", "customer", "openhour", "categorycode", F.col("extrac_date").alias("extract_date")
    )
    valid = contracts.where(~F.col("status").isin(fv.VOID_STATUSES)).select(
        "codeno", "shopcode", "inittime", "firstsupportid", "createdby"
    )
    support = users.select(F.col("user_wid").alias("firstsupportid"), F.col("user_code").alias("support_staff"))
    creator = users.select(F.col("user_wid").alias("createdby"), F.col("user_code").alias("created_staff"))
    return (
        opened.join(valid, "codeno", "left")
        .join(first_disbursements(transactions, opened), "codeno", "left")
        .join(categories.select(F.col("code").alias("categorycode"), F.col("name").alias("category_name")),
              "categorycode", "left")
        .join(shops.select(F.col("code").alias("shopcode"), F.col("name").alias("shop_name")), "shopcode", "left")
        .join(support, "firstsupportid", "left")
        .join(creator, "createdby", "left")
        .withColumn("init_to_comple", elapsed_minutes(F.col("inittime"), F.col("complete")))
        .select("extract_date", "support_staff", "created_staff", "shopcode", "codeno", "customer", "category_name",
                "openhour", "inittime", "complete", "shop_name", "init_to_comple")
    )


def processing_time(processing: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Contracts completed faster or slower than the thresholds of their category."""
    name, minutes = F.col("category_name"), F.col("init_to_comple")
    judged = processing.where(name.isNull() | ~name.isin(fv.CAR_TITLE, fv.CAR, fv.BIKE, fv.TRACKER)).join(
        thresholds, "category_name", "left"
    )
    # A row breaks both bounds when the thresholds cross; it is then listed once per bound.
    broken = F.array_compact(F.array(
        F.when(minutes <= F.col("lower_threshold"), F.lit(fv.OPENED_TOO_FAST)),
        F.when(minutes >= F.col("upper_threshold"), F.lit(fv.OPENED_TOO_SLOW)),
    ))
    return judged.withColumns({
        "pawn_fraud_group": F.explode(broken), "year_month": yearmonth_text(F.col("extract_date")),
    })


def quick_close(contracts: DataFrame, shops: DataFrame, customers: DataFrame, categories: DataFrame,
                first: dt.date | str, last: dt.date | str, min_days: int = 2, max_days: int = 5) -> DataFrame:
    """Ordinary contracts of returning customers closed within days of opening, Friday to Sunday left out.

    A customer returns when an earlier contract of the same category exists, so
    one smallest (date, id) per customer and category decides; no history is sorted.
    """
    ordinary = contracts.where(
        F.col("closedate").isNotNull()
        & has_none_of(F.col("categorycode"), [fv.BIKE_TITLE_CODE, fv.CAR_TITLE_CODE])
        & ~F.col("status").isin(fv.VOID_STATUSES)
    )
    term = days_between(F.col("fromdate"), F.col("closedate"))
    closed = ordinary.where(
        F.col("closedate").between(F.lit(as_date(first)), F.lit(as_date(last)))
        & term.between(min_days, max_days)
        & ~is_weekday_in(F.col("closedate"), [SUNDAY, FRIDAY, SATURDAY])
    ).select("pawnid", "codeno", "shopcode", "customerid", "categorycode", "fromdate", "todate", "closedate")
    keys = ["customerid", "categorycode"]
    history = keep_matching(ordinary.select(*keys, "fromdate", "pawnid"), closed.select(*keys), keys)
    earliest = history.groupBy(*keys).agg(F.min(F.struct("fromdate", "pawnid")).alias("first_contract"))
    return (
        closed.join(earliest, keys)
        .where(F.struct("fromdate", "pawnid") > F.col("first_contract"))
        .join(shops.select(F.col("code").alias("shopcode"), F.col("name").alias("shop_name")), "shopcode", "left")
        .join(customers.select("customerid", F.col("customername").alias("customer")), "customerid", "left")
        .join(categories.select(F.col("code").alias("categorycode"), F.col("name").alias("category_name")),
              "categorycode", "left")
        .select(
            yearmonth_text(F.col("closedate")).alias("year_month"),
            F.col("closedate").alias("extract_date"),
            "pawnid", "codeno", "shopcode", "shop_name", "customer", "fromdate", "todate", "closedate",
            F.dayofweek("closedate").alias("week_day"),
            F.lit(fv.RETURNING_CUSTOMER).alias("cus_type"),
            term.alias("real_loan_days"),
            "category_name",
            F.lit(fv.CLOSED_EARLY).alias("pawn_fraud_group"),
        )
    )


def overdue_close(contracts: DataFrame, snapshots: DataFrame, shops: DataFrame, first: dt.date | str,
                  last: dt.date | str, grace: int = 5) -> DataFrame:
    """Ordinary contracts paid off while overdue, judged by the snapshot of the day before closing."""
    closed = contracts.where(
        (F.col("status") == fv.CLOSED_STATUS)
        & F.col("closedate").between(F.lit(as_date(first)), F.lit(as_date(last)))
        & has_none_of(F.col("shopcode"), fv.OVERDUE_CLOSE_SHOP_MARKS)
    ).select("pawnid", "shopcode", "codeno", "fromdate", "closedate", "moneycurrent",
             F.date_sub("closedate", 1).alias("created"))
    day_before = snapshots.where(
        F.col("created").between(day_offset(first, -1), day_offset(last, -1)) & ~is_title() & (F.col("tuoino") > grace)
    ).select("pawnid", "created", F.col("customername").alias("customer"), F.col("categoryname").alias("category_name"),
             (F.col("tuoino") + 1).alias("dpd"))
    return (
        closed.join(day_before, ["pawnid", "created"])
        .join(shops.select(F.col("code").alias("shopcode"), F.col("name").alias("shop_name")), "shopcode", "left")
        .select(
            yearmonth_text(F.col("closedate")).alias("year_month"),
            F.col("closedate").alias("extract_date"),
            "pawnid", "shop_name", "shopcode", "customer", "codeno", "category_name", "fromdate", "closedate",
            "moneycurrent", "dpd",
            F.lit(fv.PAID_LATE).alias("pawn_fraud_group"),
        )
    )


def fraud_checklist(*findings: DataFrame) -> DataFrame:
    """All findings in the layout of the checking log; rows without category are left out."""
    columns = ["year_month", "extract_date", "shop_name", "shopcode", "customer", "codeno", "category_name",
               "pawn_fraud_group"]
    found = union_all(*[reindex(f, columns) for f in findings]).where(F.col("category_name").isNotNull())
    return found.withColumnsRenamed({
        "extract_date": "extrac_date", "shop_name": "shopname", "customer": "cusname", "category_name": "cate",
        "pawn_fraud_group": "reason_check",
    }).withColumn("risk_type", F.lit(fv.FRAUD))
