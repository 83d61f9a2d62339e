"""Overdue ordinary contracts not yet moved to liquidation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.dates import as_date, first_overdue_day
from ..functions.text import has_none_of
from ..operators.lookups import drop_matching

GRACE_DAYS = 5


def liquidation_backlog(snapshot: DataFrame, exempt: DataFrame, as_of: dt.date | str,
                        grace: int = GRACE_DAYS) -> DataFrame:
    """Contracts past the grace days that are neither title loans, bad debt nor exempt, with days late."""
    late = snapshot.where(
        (F.col("created") == F.lit(as_date(as_of)))
        & has_none_of(F.col("categorycode"), fv.LIQUIDATION_EXCLUDED_CODES)
        & ~F.col("status").isin(fv.BAD_DEBT_STATUSES)
        & (F.col("tuoino") > grace)
    )
    return drop_matching(late, exempt, "contractcode").select(
        F.col("created").alias("ngay_check"),
        first_overdue_day(F.col("created"), F.col("tuoino")).alias("ngay_bat_dau_qua_han"),
        F.col("shopname").alias("ten_pgd"),
        F.col("customername").alias("ten_kh"),
        "pawnid",
        F.col("fromdate").alias("ngay_vay"),
        F.col("contractcode").alias("ma_hd"),
        F.col("categoryname").alias("loai_ts"),
        F.col("currentmoney").alias("gia_cho_vay"),
        F.col("assetvalue").alias("gia_tri_ts"),
        "tuoino",
        (F.col("tuoino") - grace).alias("so_ngay_chua_chuyen_thanh_ly"),
    )
