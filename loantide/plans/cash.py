"""Daily check of shop cash counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.dates import day, day_offset
from ..functions.text import has_any, joined_lower, strip_punctuation, word_count
from ..operators.sets import reindex, with_costly_column


def cash_counts_between(counts: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Counts of the days with the sign of their difference; words are counted before punctuation goes."""
    difference = rules.first_match(
        [(F.col("diff") < -fv.CASH_TOLERANCE, fv.CASH_SURPLUS), (F.col("diff") > fv.CASH_TOLERANCE, fv.CASH_SHORTAGE)],
        fv.OK,
    )
    counted = counts.where((F.col("created") >= day(first)) & (F.col("created") < day_offset(last, 1)))
    worded = with_costly_column(counted, "reason", joined_lower(F.col("not_minus"), F.col("note_add")))
    return with_costly_column(worded, "stripped", strip_punctuation(F.col("reason"))).select(
        F.to_date("created").alias("ext_date"),
        F.col("created").alias("last_count_time"),
        "shop",
        F.col("net").alias("pos_cash_amt"),
        F.col("moneyred").alias("actual_count_amt"),
        "diff",
        F.col("stripped").alias("diff_reason"),
        difference.alias("diff_type"),
        word_count(F.col("reason")).alias("reason_length"),
    )


def cash_count_check(counts: DataFrame, limits: DataFrame, first: dt.date | str, last: dt.date | str | None = None,
                     allowance: int = 0) -> DataFrame:
    """Counts over the cash limit or with a missing, vague or unknown explanation.

    Covers one day, or all days from ``first`` to ``last``.
    """
    checked = cash_counts_between(counts, first, last or first).join(limits.select("shop", "limit_amt"), "shop", "left")
    reason, length = F.col("diff_reason"), F.col("reason_length")
    over = rules.flag(F.col("actual_count_amt") > F.col("limit_amt") + F.lit(allowance), fv.OVER_CASH_LIMIT, fv.OK)
    explanation = rules.last_match(
        [
            ((length < fv.REASON_MIN_WORDS) & (F.col("diff_type") != fv.OK), fv.REASON_MISSING),
            (has_any(reason, fv.UNCLEAR_WORDS) | (length >= fv.REASON_MAX_WORDS), fv.REASON_UNCLEAR),
            (has_any(reason, fv.UNKNOWN_WORDS), fv.REASON_UNKNOWN),
        ],
        fv.OK,
    )
    flagged = with_costly_column(checked.withColumn("limit_check", over), "diff_reason_check", explanation)
    return reindex(
        flagged.where((F.col("diff_reason_check") != fv.OK) | (F.col("limit_check") != fv.OK)), fv.TREASURY_COLUMNS
    )
