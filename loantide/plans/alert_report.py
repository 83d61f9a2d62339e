"""The cross-tabs over ``alerts.alert_base`` and the report that stacks them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.dates import as_date
from ..functions.numbers import ratio
from ..operators.aggregates import SUMMARY, describe, whole_number_summary
from ..operators.crosstab import ALL, crosstab_long, crosstab_wide, key_text
from .alerts import in_alert_month


@dataclass(frozen=True)
class Tab:
    """One cross-tab: conditions by name, index and column keys, what is measured, totals or not."""

    index: list[str]
    columns: list[str]
    where: list[str] = field(default_factory=list)
    count: bool = True
    amount: bool = False
    margins: bool = True


MONTH, RESPONDED_ONLY, LOST, NOT_LOST = "alert_month", "responded", "lost_signal", "not_lost_signal"
AFTER, CAR, BIKE, INSTALLED = "after_cutoff", "car_title", "bike_title", "chip_installed"

TABS: dict[str, Tab] = {
    "overview": Tab(["have_chip", "areaid"], ["categoryname", "package_type"]),
    "alert_overview": Tab(["areaid"], ["categoryname", "package_type"], [MONTH]),
    "install_car": Tab(["areaid", "package_type"], ["have_chip"], [AFTER, CAR]),
    "install_bike": Tab(["areaid", "package_type"], ["have_chip"], [AFTER, BIKE]),
    "responses": Tab(["bucket", "warningcontent"], ["categoryname", "shop_response_warning"], [MONTH]),
    "alert_cohort": Tab(["warningcontent"], ["brr_ym"], [MONTH]),
    "response_type": Tab(["warningcontent"], ["commentcat"], [MONTH, RESPONDED_ONLY]),
    "chip_by_bucket": Tab(["categoryname", "have_chip"], ["bucket"]),
    "alert_by_bucket": Tab(["warningcontent"], ["bucket"], [INSTALLED]),
    "responded_overview": Tab(["areaid"], ["categoryname", "package_type"], [MONTH, RESPONDED_ONLY]),
    "response_by_region": Tab(["warningcontent", "region"], ["categoryname", "shop_response_warning"], [MONTH], amount=True),
    "alert_by_region": Tab(["warningcontent"], ["region"], [MONTH], amount=True),
    "response_by_shop": Tab(["region", "shopname"], ["shop_response_warning"], [MONTH, NOT_LOST]),
    "install_period": Tab(["categoryname", "brr_tick"], ["have_chip"], amount=True),
    "bike_alert_by_paper": Tab(["region", "warningcontent"], ["kt", "bucket"], [BIKE, MONTH], count=False, amount=True,
                               margins=False),
    "alert_by_bucket_money": Tab(["warningcontent", "categoryname"], ["bucket"], [MONTH], count=False, amount=True),
    "signal_by_region": Tab(["categoryname", "shop_response_warning"], ["region"], [MONTH, NOT_LOST], amount=True,
                            margins=False),
    "lost_signal_by_bucket": Tab(["bucket"], ["categoryname"], [MONTH, LOST], count=False, amount=True, margins=False),
    "lost_signal_bike_by_paper": Tab(["bucket"], ["kt"], [MONTH, LOST, BIKE], amount=True),
}

# Sections of the daily report in order; the response-day summary stands between them.
RESPONSE_DAYS = "response_days"
SECTIONS = [
    "overview", "responded_overview", "alert_overview", "install_period", "alert_by_region", "install_car",
    "install_bike", "responses", "alert_cohort", RESPONSE_DAYS, "response_type", "chip_by_bucket", "alert_by_bucket",
    "alert_by_bucket_money", "response_by_region", "signal_by_region", "lost_signal_by_bucket",
    "lost_signal_bike_by_paper",
]


def conditions(as_of: dt.date | str) -> dict[str, Column]:
    lost = F.col("warningcontent").contains(fv.LOST_SIGNAL)
    return {
        MONTH: in_alert_month(as_of),
        RESPONDED_ONLY: F.col("shop_response_warning") == fv.RESPONDED,
        LOST: lost,
        NOT_LOST: ~lost,
        AFTER: F.col("brr_tick") == fv.BORROWED_AFTER,
        CAR: F.col("categoryname") == fv.CAR_TITLE,
        BIKE: F.col("categoryname") == fv.BIKE_TITLE,
        INSTALLED: F.col("have_chip") == fv.CHIP_INSTALLED,
    }


def _test(tab: Tab, known: dict[str, Column]) -> Column:
    test = F.lit(True)
    for name in tab.where:
        test = test & known[name]
    return test


def tab(base: DataFrame, name: str, as_of: dt.date | str) -> DataFrame:
    """One cross-tab in long form."""
    spec = TABS[name]
    return crosstab_long(
        base.where(_test(spec, conditions(as_of))),
        spec.index,
        spec.columns,
        count="pawnid" if spec.count else None,
        total="currentmoney" if spec.amount else None,
        margins=spec.margins,
    )


def signal_by_region(base: DataFrame, as_of: dt.date | str, lost: bool = False) -> DataFrame:
    """The signal table by region; the report leaves lost-signal alerts out, ``lost`` shows only them."""
    spec = TABS["signal_by_region"]
    known = conditions(as_of)
    rows = base.where(known[MONTH] & known[LOST if lost else NOT_LOST])
    return crosstab_long(rows, spec.index, spec.columns, "pawnid", "currentmoney", spec.margins)


def response_rate_by_shop(base: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Shops by number of alerts with the share they responded to, busiest first."""
    spec = TABS["response_by_shop"]
    wide = crosstab_wide(tab(base, "response_by_shop", as_of), spec.index, [fv.NO_RESPONSE, fv.RESPONDED, ALL])
    return wide.withColumn("response_rate", ratio(F.col(fv.RESPONDED), F.col(ALL))).orderBy(
        F.desc(ALL), *spec.index
    )


def response_days(base: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Distribution of the days a shop took to respond, per kind of alert."""
    known = conditions(as_of)
    rows = base.where(known[MONTH] & known[RESPONDED_ONLY] & F.col("warningcontent").isNotNull())
    return describe(rows, ["warningcontent"], "last_warning_response_day")


def _stacked_cells(base: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Cells of all sections from one pass: each row is counted in every section it belongs to."""
    known = conditions(as_of)
    entries = []
    for number, name in enumerate(SECTIONS, start=1):
        # The response-day section counts contracts per day; its summary is taken from those counts.
        spec = TABS.get(name, Tab(["warningcontent"], ["last_warning_response_day"], [MONTH, RESPONDED_ONLY]))
        complete = _test(spec, known)
        for key in [*spec.index, *spec.columns]:
            complete = complete & F.col(key).isNotNull()
        entry = F.struct(
            F.lit(number).alias("section_no"),
            key_text(spec.index).alias("row_key"),
            key_text(spec.columns).alias("col_key"),
        )
        entries.append(F.when(complete, entry))
    exploded = base.select("pawnid", "currentmoney", F.explode(F.array_compact(F.array(*entries))).alias("cell"))
    return exploded.groupBy("cell.section_no", "cell.row_key", "cell.col_key").agg(
        F.count("pawnid").alias("pawn_count"), F.sum("currentmoney").alias("balance")
    )


def _sections(test) -> list[int]:
    return [n for n, name in enumerate(SECTIONS, start=1) if name in TABS and test(TABS[name])]


def alert_report(base: DataFrame, as_of: dt.date | str) -> DataFrame:
    """All report sections in long form: section, as-of, row key, column key, measure, value."""
    section, measure = F.col("section_no"), F.col("measure")
    in_summary = section == SECTIONS.index(RESPONSE_DAYS) + 1
    row_total, col_total = F.col("row_total") == 1, F.col("col_total") == 1
    summary = whole_number_summary(F.col("days"), F.col("pawn_count"))
    totals = (
        _stacked_cells(base, as_of)
        .withColumn("days", F.when(in_summary, F.col("col_key").cast("long")))
        .groupingSets(
            [["section_no", "row_key", "col_key"], ["section_no", "row_key"], ["section_no", "col_key"], ["section_no"]],
            "section_no", "row_key", "col_key",
        )
        .agg(
            F.grouping("row_key").alias("row_total"),
            F.grouping("col_key").alias("col_total"),
            F.sum("pawn_count").cast("double").alias("pawn_count"),
            F.sum("balance").cast("double").alias("balance"),
            *[c.cast("double").alias(name) for name, c in summary.items()],
        )
    )
    measures = ["pawn_count", "balance", *SUMMARY]
    plain = (~row_total & ~col_total) | section.isin(_sections(lambda t: t.margins))
    wanted = (
        (plain & (measure == "pawn_count") & section.isin(_sections(lambda t: t.count)))
        | (plain & (measure == "balance") & section.isin(_sections(lambda t: t.amount)))
        | (in_summary & ~row_total & col_total & measure.isin(SUMMARY))
    )
    title = F.element_at(F.array(*[F.lit(name) for name in SECTIONS]), section)
    return (
        totals.unpivot(["section_no", "row_key", "col_key", "row_total", "col_total"], measures, "measure", "value")
        .where(wanted)
        .select(
            "section_no",
            title.alias("section_title"),
            F.lit(as_date(as_of).strftime("%d-%m-%Y")).alias("as_of"),
            F.when(row_total, F.lit(ALL)).otherwise(F.col("row_key")).alias("row_key"),
            F.when(in_summary, F.lit("last_warning_response_day")).when(col_total, F.lit(ALL))
            .otherwise(F.col("col_key")).alias("col_key"),
            "measure",
            "value",
        )
    )
