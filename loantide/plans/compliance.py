"""Facts about new contracts that the compliance score-card is applied to."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.dates import as_date, days_between, minute_boundaries, yearmonth_of_text
from ..functions.numbers import net_amount, ratio
from ..operators.latest import dated_slices, last_value_per_key, previous_since
from ..operators.lookups import keep_matching
from .fraud import first_disbursements


def shop_check_history(log: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Per shop: days and contracts checked for compliance in the as-of month, also per day of the month."""
    as_of = as_date(as_of)
    month = log.where(
        (F.col("risk_type") == fv.COMPLIANCE) & (yearmonth_of_text(F.col("extrac_date")) == as_of.strftime("%Y%m"))
    )
    return (
        month.groupBy("shopname")
        .agg(F.countDistinct("extrac_date").alias("shop_nums_checked_day"), F.count("codeno").alias("total_num_checked_pawn"))
        .withColumn("nums_day_in_month", F.lit(as_of.day))
        .withColumns({
            "shop_checked_rate": ratio(F.col("shop_nums_checked_day"), F.col("nums_day_in_month")),
            "average_nums_checked_pawn": ratio(F.col("total_num_checked_pawn"), F.col("nums_day_in_month")),
        })
    )


def focus_shops(sheet: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Focus level of each shop from its newest range that covers the day."""
    valid = sheet.where(F.lit(as_date(as_of)).between(F.col("shop_update_date"), F.col("shop_to_date")))
    return valid.groupBy("shop").agg(
        F.max_by("shop_focus_level", F.struct("shop_update_date", "shop_to_date", "shop_focus_level")).alias("shop_focus_level")
    )


def focus_packages(sheet: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Package ranges that cover the day."""
    return sheet.where(F.lit(as_date(as_of)).between(F.col("package_from_date"), F.col("package_to_date")))


def latest_scores(scores: DataFrame, wanted: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Newest score of the wanted customers up to the day."""
    known = scores.where(F.col("data_date") <= F.lit(as_date(as_of)))
    return last_value_per_key(
        keep_matching(known, wanted.select("customerid"), "customerid"),
        ["customerid"], [F.col("data_date"), F.col("score_id")], "customer_score", "customer_score",
    )


def mean_score(contracts: DataFrame, scores: DataFrame, first: dt.date | str, last: dt.date | str) -> Column:
    """Mean customer score over the contracts that are scored, from the few columns it needs."""
    scored = contracts.where(
        F.col("fromdate").between(F.lit(as_date(first)), F.lit(as_date(last)))
        & F.col("status").isin(fv.NEW_CONTRACT_STATUSES)
        & ~F.col("categoryname").isin(fv.CAR_TITLE, fv.CAR)
    ).select("customerid")
    return scored.join(latest_scores(scores, scored, last), "customerid").select(F.avg("customer_score")).scalar()


def with_previous_contracts(contracts: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Contracts opened on the days with what the customer had before, over all earlier contracts."""
    low, high = F.lit(as_date(first)), F.lit(as_date(last))
    rows = contracts.where(F.col("fromdate").between(low, high))
    older = contracts.where(F.col("fromdate") < low)
    order, part = ["fromdate", "pawnid"], dated_slices("fromdate", "pawnid")
    in_category = previous_since(rows, older, ["customerid", "categorycode"], order, ["codeno", "closedate"],
                                 "previous_in_category", slice_by=part)
    return previous_since(in_category, older, ["customerid"], order, ["status", "closedate"], "previous_any",
                          slice_by=part, tails_of=rows)


def compliance_features(contracts: DataFrame, times: DataFrame, transactions: DataFrame, images: DataFrame,
                        opening_days: DataFrame, scores: DataFrame, categories: DataFrame, first: dt.date | str,
                        last: dt.date | str, category: Column | None = None) -> DataFrame:
    """One row per new contract that has an opening time.

    ``opening_days`` is the snapshot table; only each contract's row of its first
    day is used. ``category`` narrows the contracts, e.g. to car titles.
    """
    in_range = F.col("fromdate").between(F.lit(as_date(first)), F.lit(as_date(last)))
    is_new = F.col("status").isin(fv.NEW_CONTRACT_STATUSES)
    per_shop = contracts.where(in_range & is_new).groupBy("fromdate", "shopcode").agg(
        F.count("pawnid").alias("num_created_pawn")
    )
    new = with_previous_contracts(contracts, first, last).where(is_new)
    if category is not None:
        new = new.where(category)
    wanted = contracts.where(in_range & is_new).select("pawnid", "codeno", "customerid")
    first_day = opening_days.where(in_range & (F.col("created") == F.col("fromdate"))).select(
        "pawnid",
        "papertype",
        F.col("customername").alias("customer_name"),
        ratio(net_amount(F.col("moneyorg"), F.col("insurrancemoney")), F.col("moneyappraisal")).alias("ltv_index"),
    )
    uploads = keep_matching(images, wanted.select("pawnid"), "pawnid").groupBy("pawnid").agg(
        F.count("pawnassetfileid").alias("nums_image"),
        F.min("uploaded").alias("first_upload"),
        F.max("uploaded").alias("last_upload"),
    )
    names = categories.select(F.col("code").alias("categorycode"), F.col("name").alias("category_name"))
    net = net_amount(F.col("loanmoneyorg"), F.col("insurrancemoney"))
    before, in_category = F.col("previous_any"), F.col("previous_in_category")
    sleep = days_between(before["closedate"], F.col("fromdate"))
    return (
        new.select("pawnid", "codeno", "customerid", "shopcode", "packagecode", "fromdate", "frequency", "categorycode",
                   "loanmoneyorg", "insurrancemoney", "inittime", "previous_any", "previous_in_category")
        .join(uploads, "pawnid", "left")
        .join(first_day, "pawnid", "left")
        .join(times.where(F.col("openhour").isNotNull()).select("codeno", "openhour"), "codeno")
        .join(first_disbursements(transactions, wanted), "codeno", "left")
        .join(latest_scores(scores, wanted, last), "customerid", "left")
        .join(per_shop, ["fromdate", "shopcode"], "left")
        .join(names, "categorycode", "left")
        .select(
            F.col("fromdate").alias("extract_date"),
            "customer_name",
            "shopcode",
            "packagecode",
            "fromdate",
            "pawnid",
            "codeno",
            "category_name",
            rules.package_name(F.col("packagecode")).alias("package_name"),
            "papertype",
            "ltv_index",
            net.alias("net_disbur"),
            rules.loan_size(F.col("categorycode"), F.col("packagecode"), net).alias("package_money_range"),
            rules.term_range(F.col("frequency")).alias("package_time_range"),
            rules.flag(in_category["codeno"].isNull(), fv.NEW_CUSTOMER, fv.RETURNING_CUSTOMER).alias("cus_type"),
            rules.open_type(before["status"], in_category["closedate"], F.col("fromdate"), sleep).alias("open_type"),
            "num_created_pawn",
            "customer_score",
            "nums_image",
            "complete",
            "openhour",
            F.hour("openhour").alias("open_hour_extracted"),
            minute_boundaries(F.col("inittime"), F.col("complete")).alias("processing_minute"),
            "first_upload",
            "last_upload",
            minute_boundaries(F.col("openhour"), F.col("first_upload")).alias("first_upload_to_open"),
            minute_boundaries(F.col("openhour"), F.col("last_upload")).alias("last_upload_to_open"),
        )
    )


def car_title_features(contracts: DataFrame, *others: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """``compliance_features`` of car-title contracts."""
    return compliance_features(contracts, *others, first, last,
                               category=F.col("categorycode").contains(fv.CAR_TITLE_CODE))


def with_shop_facts(features: DataFrame, shops: DataFrame, shop_info: DataFrame, focus: DataFrame, history: DataFrame,
                    predicted: DataFrame) -> DataFrame:
    """Add shop name, province, focus level, check history and predicted score of the shop."""
    return (
        features.join(shops.select(F.col("code").alias("shopcode"), F.col("name").alias("shop_name")), "shopcode", "left")
        .join(shop_info.select("shopcode", "province"), "shopcode", "left")
        .join(focus.withColumnRenamed("shop", "shop_name"), "shop_name", "left")
        .join(history.withColumnRenamed("shopname", "shop_name"), "shop_name", "left")
        .join(predicted.select(F.col("shopname").alias("shop_name"), "ols_pred_score"), "shop_name", "left")
    )
