"""Movement of contracts between delinquency buckets across two snapshot days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import rules
from ..functions.buckets import bucket_dpd
from ..functions.dates import as_date, month_pairs, yearmonth
from ..functions.numbers import millions, or_zero, ratio, whole_div
from ..functions.text import has_none_of
from ..operators.aggregates import count_when, sum_when, with_group_totals
from ..operators.lookups import left_lookup
from ..sources.readers import snapshot_at

PAIR = ["ob_date", "cb_date"]


def is_title(category: str = "categoryname") -> Column:
    return F.col(category).contains(fv.TITLE_MARK)


def real_shop(shopcode: str = "shopcode") -> Column:
    return has_none_of(F.col(shopcode), fv.TEST_SHOP_MARKS)


def movement(scheme: str, down: str = fv.CURED) -> dict[str, Column]:
    """Bucket and flow columns of rows that carry ob_dpd and cb_dpd."""
    ob_bucket, ob_name = bucket_dpd(F.col("ob_dpd"), scheme)
    cb_bucket, cb_name = bucket_dpd(F.col("cb_dpd"), scheme, closed_when_null=True)
    return {
        "ob_bucket": ob_bucket,
        "ob_bucket_name": ob_name,
        "cb_bucket": cb_bucket,
        "cb_bucket_name": cb_name,
        "flow": rules.first_match([(cb_bucket > ob_bucket, fv.ROLLED), (cb_bucket == ob_bucket, fv.STUCK)], down),
    }


def transitions(opening: DataFrame, closing: DataFrame, ob: dt.date | str, cb: dt.date | str,
                scheme: str = "flow7", down: str = fv.CURED) -> DataFrame:
    """Opening rows with their closing bucket; a contract gone from the closing day has closed.

    Only the contract id and its days past due are read from the closing day.
    """
    after = closing.select("pawnid", F.col("tuoino").alias("cb_dpd"))
    return (
        opening.withColumnRenamed("tuoino", "ob_dpd")
        .join(after, "pawnid", "left")
        .withColumns({"ob_date": F.lit(as_date(ob)), "cb_date": F.lit(as_date(cb)), **movement(scheme, down)})
    )


def panel_transitions(panel: DataFrame, pairs: list[tuple[dt.date, dt.date]], scheme: str = "flow7",
                      opening_filter: Column | None = None, columns: list[str] | None = None) -> DataFrame:
    """``transitions`` for several date pairs of a snapshot table in one join.

    The dates are literals, so partition pruning happens at planning time. An
    opening day may occur in one pair only.
    """
    closing_of = {ob: cb for ob, cb in pairs}
    cb_date = F.create_map(*[F.lit(d) for pair in closing_of.items() for d in pair])[F.col("created")]
    opening = panel.where(F.col("created").isin(list(closing_of)))
    if opening_filter is not None:
        opening = opening.where(opening_filter)
    if columns is not None:
        opening = opening.select("created", "pawnid", "tuoino", *columns)
    opening = opening.withColumn("cb_date", cb_date).withColumnsRenamed({"created": "ob_date", "tuoino": "ob_dpd"})
    closing = panel.where(F.col("created").isin(sorted({cb for _, cb in pairs}))).select(
        "pawnid", F.col("created").alias("cb_date"), F.col("tuoino").alias("cb_dpd")
    )
    return opening.join(closing, ["pawnid", "cb_date"], "left").withColumns(movement(scheme))


def _flow_rates(moves: DataFrame) -> DataFrame:
    bucket = W.partitionBy(*PAIR, "categoryname", "ob_bucket")
    # The bucket totals are windows over the few aggregated rows, not over contracts.
    return (
        moves.groupBy(*PAIR, "categoryname", "flow", "ob_bucket", "ob_bucket_name")
        .agg(F.sum("currentmoney").alias("moved"), F.count("pawnid").alias("transit_pawn_count"))
        .withColumns({
            "opened": F.sum("moved").over(bucket),
            "ob_pawn": F.sum("transit_pawn_count").over(bucket),
        })
        .select(
            F.col("ob_date").alias("from_date"),
            F.col("cb_date").alias("to_date"),
            "categoryname",
            "flow",
            "ob_bucket_name",
            millions(F.col("opened")).alias("ob_bal"),
            millions(F.col("moved")).alias("transit_bal"),
            ratio(F.col("moved"), F.col("opened")).alias("flow_rate"),
            "ob_pawn",
            "transit_pawn_count",
        )
    )


def _title_rows(snapshot: DataFrame) -> DataFrame:
    return snapshot.where(is_title() & real_shop())


def flow_rate(opening: DataFrame, closing: DataFrame, ob: dt.date | str, cb: dt.date | str) -> DataFrame:
    """Per title category, opening bucket and flow: balance, share of the bucket and counts."""
    return _flow_rates(transitions(_title_rows(opening), closing, ob, cb))


def flow_history(panel: DataFrame, as_of: dt.date | str, months: int = 4) -> DataFrame:
    """``flow_rate`` of the last month pairs."""
    return _flow_rates(
        panel_transitions(panel, month_pairs(as_of, months), "flow7", is_title() & real_shop(),
                          ["categoryname", "currentmoney"])
    )


def flow_detail(opening: DataFrame, closing: DataFrame, shops: DataFrame, ob: dt.date | str,
                cb: dt.date | str) -> DataFrame:
    """Title contracts with their movement and the totals of their shop and opening bucket."""
    title = _title_rows(opening)
    bucket, _ = bucket_dpd(F.col("tuoino"), "flow7")
    moves = left_lookup(
        transitions(title, closing, ob, cb),
        shops.select(F.col("name").alias("shopname"), "areaid"),
        "shopname",
    )
    detail = with_group_totals(
        moves, title.withColumn("ob_bucket", bucket), ["shopname", "ob_bucket"],
        "currentmoney", "pawnid", "ob_bucket_bal", "ob_bucket_pawn_count",
    )
    return detail.select(
        *PAIR,
        "areaid",
        "categoryname",
        "pawnid",
        "contractcode",
        "chipserial",
        "fromdate",
        yearmonth(F.col("fromdate")).alias("brr_ym"),
        whole_div(F.col("frequency"), 30).alias("duration"),
        "principalpaymentday",
        rules.paper_class(F.col("papertype"), null_as=fv.PAPER_RENTED).alias("kt"),
        "currentmoney",
        "shopname",
        "shopcode",
        rules.package_type(F.col("packagecode")).alias("package_type"),
        "ob_dpd",
        "cb_dpd",
        "ob_bucket",
        "ob_bucket_name",
        "cb_bucket",
        "cb_bucket_name",
        "ob_bucket_bal",
        "ob_bucket_pawn_count",
        "flow",
    )


def _rolled_by_shop(moves: DataFrame) -> DataFrame:
    rolled = F.col("flow") == fv.ROLLED
    return (
        moves.groupBy(*PAIR, "shopname", "ob_bucket")
        .agg(
            sum_when(rolled, F.col("currentmoney")).alias("balance"),
            F.sum("currentmoney").alias("bucket_bal"),
            F.count("pawnid").alias("bucket_pawn_count"),
            count_when(rolled).alias("pawn_count"),
        )
        .where(F.col("pawn_count") > 0)
        .withColumns({
            "flow": F.lit(fv.ROLLED),
            "flow_rate_bal": ratio(F.col("balance"), F.col("bucket_bal")),
            "flow_rate_pawn_count": ratio(F.col("pawn_count"), F.col("bucket_pawn_count")),
        })
    )


def _in_term_title_codes() -> Column:
    code = F.col("categorycode")
    wanted = code.contains(fv.BIKE_TITLE_CODE) | code.contains(fv.CAR_TITLE_CODE)
    return wanted & real_shop() & (F.col("tuoino") < 1)


def rolled_per_shop(opening: DataFrame, closing: DataFrame, ob: dt.date | str, cb: dt.date | str) -> DataFrame:
    """Shops by the share of their in-term title balance that rolled, highest first."""
    moves = transitions(opening.where(_in_term_title_codes()), closing, ob, cb)
    return _rolled_by_shop(moves).orderBy(F.desc("flow_rate_bal"), "shopname")


def rolled_history(panel: DataFrame, as_of: dt.date | str, months: int = 4) -> DataFrame:
    """``rolled_per_shop`` of the last month pairs."""
    moves = panel_transitions(panel, month_pairs(as_of, months), "flow7", _in_term_title_codes(),
                              ["shopname", "currentmoney"])
    return _rolled_by_shop(moves)


def flow_matrix(opening: DataFrame, closing: DataFrame, shops: DataFrame, ob: dt.date | str, cb: dt.date | str,
                areas: list[int]) -> DataFrame:
    """Opening bucket by (area, flow): balances, all-area totals and roll rates.

    Areas and flows are known, so every cell is one conditional sum of a single aggregation.
    """
    moves = left_lookup(
        transitions(_title_rows(opening), closing, ob, cb).select(
            *PAIR, "ob_bucket_name", "flow", "shopname", "currentmoney"
        ),
        shops.select(F.col("name").alias("shopname"), "areaid"),
        "shopname",
    )
    flows = [fv.CURED, fv.STUCK, fv.ROLLED]
    cells = [
        sum_when((F.col("areaid") == a) & (F.col("flow") == f), F.col("currentmoney")).alias(f"{f.lower()}_{a}")
        for a in areas
        for f in flows
    ]
    table = moves.where(F.col("areaid").isNotNull()).groupBy(*PAIR, "ob_bucket_name").agg(*cells)

    def add(names: list[str]) -> Column:
        total = F.col(names[0])
        for name in names[1:]:
            total = total + F.col(name)
        return total

    table = table.withColumns({f"{f.lower()}_all": add([f"{f.lower()}_{a}" for a in areas]) for f in flows})
    table = table.withColumns({f"ob_bal_{a}": add([f"{f.lower()}_{a}" for f in flows]) for a in [*areas, "all"]})
    return table.withColumns(
        {f"rolled_rate_{a}": ratio(F.col(f"rolled_{a}"), F.col(f"ob_bal_{a}")) for a in [*areas, "all"]}
    )


def daily_roll(opening: DataFrame, closing: DataFrame, shop_info: DataFrame, ob: dt.date | str,
               cb: dt.date | str) -> DataFrame:
    """Per shop: performing balance of the opening day and the parts that closed or rolled."""
    performing = opening.where(
        ~F.col("categoryname").contains(fv.TRACKER_MARK) & real_shop() & (F.col("tuoino") < fv.PERFORMING_DPD)
    )
    moves = transitions(performing, closing, ob, cb, "daily2", down=fv.CLOSED)
    title, money = is_title(), F.col("currentmoney")
    closed, rolled = F.col("flow") == fv.CLOSED, F.col("flow") == fv.ROLLED
    per_shop = moves.groupBy(*PAIR, "shopcode", "shopname").agg(
        F.sum(money).alias("total_bal"),
        sum_when(title, money).alias("title_bal"),
        sum_when(~title, money).alias("normal_bal"),
        sum_when(closed, money).alias("total_close_bal"),
        sum_when(closed & title, money).alias("title_closed_bal"),
        sum_when(closed & ~title, money).alias("normal_closed_bal"),
        sum_when(rolled, money).alias("total_rolled_bal"),
        sum_when(rolled & title, money).alias("title_rolled_bal"),
        sum_when(rolled & ~title, money).alias("normal_rolled_bal"),
    )
    return left_lookup(per_shop, shop_info, "shopcode")


def daily_roll_on(panel: DataFrame, shop_info: DataFrame, as_of: dt.date | str, days_back: int = 2) -> DataFrame:
    """``daily_roll`` between two neighbouring days of a snapshot table, counted back from the run day."""
    ob = as_date(as_of) - dt.timedelta(days=days_back)
    cb = ob + dt.timedelta(days=1)
    return daily_roll(snapshot_at(panel, ob), snapshot_at(panel, cb), shop_info, ob, cb)


def bucket_profile(snapshot: DataFrame, scheme: str) -> DataFrame:
    """Contracts and balance per bucket of one snapshot day."""
    ordinal, label = bucket_dpd(F.col("tuoino"), scheme)
    return (
        snapshot.groupBy(ordinal.alias("bucket_no"), label.alias("bucket"))
        .agg(F.count("pawnid").alias("pawn_count"), or_zero(F.sum("currentmoney")).alias("balance"))
    )
