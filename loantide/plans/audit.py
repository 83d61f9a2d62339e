"""Samples of scored contracts for the compliance check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.dates import yearmonth_text
from ..operators.sampling import quota_sample

TITLES, OTHERS = "title", "other"
QUOTAS = {
    TITLES: round(fv.AUDIT_SAMPLE_SIZE * fv.AUDIT_TITLE_SHARE),
    OTHERS: round(fv.AUDIT_SAMPLE_SIZE * fv.AUDIT_OTHER_SHARE),
}


def audit_sample(scored: DataFrame, quotas: dict[str, int] | DataFrame = QUOTAS, per: list[str] | None = None) -> DataFrame:
    """The riskiest motorbike titles and other contracts, up to the quota of each group; a table of quotas has columns
    ``stratum`` (title or other) and ``quota``."""
    group = rules.flag(F.col("category_name") == fv.BIKE_TITLE, TITLES, OTHERS)
    return quota_sample(scored, group, quotas, F.desc("total_score"), F.col("pawnid"), per=per)


def car_title_sample(features: DataFrame, each: int = 1, per: list[str] | None = None) -> DataFrame:
    """The largest car-title disbursements, quick loans and others apart."""
    group = rules.flag(F.col("package_name") == fv.QUICK_LOAN, fv.QUICK_LOAN, OTHERS)
    return quota_sample(features, group, {fv.QUICK_LOAN: each, OTHERS: each}, F.desc("net_disbur"), F.col("pawnid"), per=per)


def as_checking_rows(sample: DataFrame, risk_type: str, shop_name: Column | None = None) -> DataFrame:
    """A sample in the layout of the checking log."""
    return sample.select(
        yearmonth_text(F.col("extract_date")).alias("year_month"),
        F.col("extract_date").alias("extrac_date"),
        (F.col("shop_name") if shop_name is None else shop_name).alias("shopname"),
        "shopcode",
        F.col("customer_name").alias("cusname"),
        "codeno",
        F.col("category_name").alias("cate"),
        F.lit(None).cast("string").alias("reason_check"),
        F.lit(risk_type).alias("risk_type"),
    ).dropDuplicates()
