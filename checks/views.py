"""Spark views of the test tables as the entities of the library."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loantide.functions.dates import as_date
from loantide.sources import schemas

from . import params as P

NTZ = "timestamp_ntz"
MONEY = "decimal(18,2)"
# Longest possible life of a contract in the view below: 360 days of term, closed up to 199 days late.
LONGEST_LIFE = 559


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A raw table; the lazy frame is kept, so its footer is read once per session."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def local(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _category(position: int) -> Column:
    chain = None
    for row in P.PRIORITY_CATEGORY:
        test = F.col("o_orderpriority") == row[0]
        chain = F.when(test, row[position]) if chain is None else chain.when(test, row[position])
    return chain


def _plus(base: Column, days=0, hours=0, minutes=0, seconds=0) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return base.cast(NTZ) + F.make_dt_interval(
        as_col(days).cast("int"), as_col(hours).cast("int"), as_col(minutes).cast("int"),
        as_col(seconds).cast("decimal(18,6)")
    )


@lru_cache(maxsize=64)
def contract_core(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts from orders alone: no shop, no customer attributes."""
    key = F.col("o_orderkey")
    money = (F.col("o_totalprice").cast(MONEY) * F.lit(100)).cast(MONEY)
    base = table(spark, sf, "orders").select(
        key.alias("pawnid"),
        F.col("o_custkey").alias("customerid"),
        F.concat(F.lit("HDCC/"), key.cast("string")).alias("codeno"),
        F.to_date("o_orderdate").alias("fromdate"),
        F.col("o_orderdate").alias("opened_ts"),
        (F.lit(30) * (1 + key % 12)).cast("int").alias("frequency"),
        F.when(key % 13 != 0, key % 28 + 1).cast("int").alias("principalpaymentday"),
        ((key * 37) % 260 - 60).cast("int").alias("offset"),
        _category(1).alias("categorycode"),
        _category(2).alias("categoryname"),
        money.alias("currentmoney"),
        F.when(key % 3 == 1, F.concat(F.lit("NHANH0"), (key % 2).cast("string")))
        .when(key % 3 == 2, F.lit("G02")).alias("packagecode"),
        F.element_at(F.array(*[F.lit(v) for v in (14, 77, 11, 22, 10, 10, 1, 1)]), (key % 8 + 1).cast("int"))
        .alias("status"),
        F.when(key % 2 == 1, F.concat(F.lit("POS"), key.cast("string"))).alias("chipserial"),
    )
    key = F.col("pawnid")
    return (
        base.withColumns({
            "todate": F.date_add("fromdate", F.col("frequency")),
            "insurrancemoney": (F.col("currentmoney") * F.lit(0.01).cast("decimal(3,2)") * (key % 5)).cast(MONEY),
            "moneyappraisal": (F.col("currentmoney") * F.lit(0.1).cast("decimal(2,1)")
                               * F.when(key % 97 == 0, F.lit(0)).otherwise(10 + key % 8)).cast(MONEY),
        })
        .withColumns({
            "closedate": F.greatest(F.date_add("fromdate", 1), F.date_add("todate", F.col("offset"))),
            "openhour": _plus(F.col("fromdate"), hours=7, minutes=(key * 17) % 840, seconds=key % 60),
            "moneyorg": F.col("currentmoney"),
            "loanmoneyorg": F.col("currentmoney"),
            "moneycurrent": F.col("currentmoney"),
            "assetvalue": F.col("moneyappraisal"),
            "firstsupportid": key % 50,
            "createdby": (key * 3) % 50,
        })
        .withColumns({
            "closehour": _plus(F.col("closedate"), hours=8, minutes=(key * 11) % 720, seconds=(key * 7) % 60),
            "inittime": F.col("openhour") - F.make_dt_interval(
                F.lit(0), F.lit(0), (key % 50).cast("int"), F.lit(20).cast("decimal(18,6)")),
        })
        .drop("offset")
    )


@lru_cache(maxsize=64)
def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer attributes with the shop the customer belongs to."""
    nation = table(spark, sf, "nation")
    key = F.col("c_nationkey")
    return (
        table(spark, sf, "customer")
        .join(nation, key == nation.n_nationkey, "left")
        .select(
            F.col("c_custkey").alias("customerid"),
            F.col("c_name").alias("customername"),
            F.when(F.col("c_mktsegment") == "BUILDING", "KT1")
            .when(F.col("c_mktsegment") != "AUTOMOBILE", "KT3").alias("papertype"),
            _shopcode(key).alias("shopcode"),
            F.col("n_name").alias("shopname"),
            key.alias("shopid"),
        )
        # One row per customer, stated so that Catalyst drops the join where no attribute is read.
        .dropDuplicates(["customerid"])
    )


def _shopcode(nationkey: Column) -> Column:
    text = nationkey.cast("string")
    return (
        F.when(nationkey == 23, F.lit("HS23"))
        .when(nationkey == 24, F.lit("TEST24"))
        .otherwise(F.concat(F.lit("S"), text))
    )


@lru_cache(maxsize=64)
def shops(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        _shopcode(F.col("n_nationkey")).alias("code"),
        F.col("n_name").alias("name"),
        (1 + F.col("n_regionkey") % 2).alias("areaid"),
    )


def shop_info(spark: SparkSession, sf: str) -> DataFrame:
    """Shop sheet; one shop is missing from it."""
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation").where(F.col("n_nationkey") != 5)
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        _shopcode(F.col("n_nationkey")).alias("shopcode"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("province"),
        (1 + F.col("n_nationkey") % 12).alias("opened_month"),
        (1990 + F.col("n_nationkey") % 5).alias("opened_year"),
    )


@lru_cache(maxsize=64)
def contracts(spark: SparkSession, sf: str) -> DataFrame:
    """The contract table: core attributes plus shop, paper type and customer name."""
    return contract_core(spark, sf).join(customers(spark, sf), "customerid", "left")


def _alive(created: dt.date) -> Column:
    """Open on the day; the bounds on the raw timestamp reach the parquet scan."""
    day = dt.datetime.combine(created, dt.time())
    return (
        (F.col("opened_ts") < F.lit(day + dt.timedelta(days=1)).cast(NTZ))
        & (F.col("opened_ts") >= F.lit(day - dt.timedelta(days=LONGEST_LIFE)).cast(NTZ))
        & (F.col("closedate") > F.lit(created))
    )


def _as_snapshot(alive: DataFrame) -> DataFrame:
    return alive.withColumns({
        "yearmonth": (F.year("created") * 100 + F.month("created")).cast("int"),
        "tuoino": F.datediff("created", "todate"),
        "contractcode": F.col("codeno"),
    })


def snapshot(spark: SparkSession, sf: str, created: str, with_shop: bool = True) -> DataFrame:
    """Contracts open on one day with their days past due on that day."""
    day = as_date(created)
    base = contract_core(spark, sf).where(_alive(day))
    if with_shop:
        base = base.join(customers(spark, sf), "customerid", "left")
    return _as_snapshot(base.withColumn("created", F.lit(day)))


def panel(spark: SparkSession, sf: str, days: list[dt.date], with_shop: bool = True) -> DataFrame:
    """Snapshots of several days from one pass over the contracts."""
    open_days = F.filter(
        F.array(*[F.lit(d) for d in days]), lambda d: (d >= F.col("fromdate")) & (d < F.col("closedate"))
    )
    base = contract_core(spark, sf).withColumn("created", F.explode(open_days))
    if with_shop:
        base = base.join(customers(spark, sf), "customerid", "left")
    return _as_snapshot(base)


@lru_cache(maxsize=64)
def _event_day(spark: SparkSession, sf: str) -> DataFrame:
    """Events on the shifted calendar, each tied to a contract."""
    return table(spark, sf, "events").select(
        "event_id",
        "event_type",
        "user_id",
        "value",
        (F.floor(F.col("event_id") / 8) * 11 + F.col("event_id") % 2).alias("pawnid"),
        (F.col("ts").cast(NTZ) - F.make_dt_interval(F.lit(P.EVENT_SHIFT_DAYS))).alias("at"),
    )


def chip_events(spark: SparkSession, sf: str) -> DataFrame:
    return _event_day(spark, sf).where(F.col("event_type").isin("click", "view")).select(
        F.col("event_id").alias("chip_id"),
        "pawnid",
        F.concat(F.lit("SN"), F.col("event_id").cast("string")).alias("chipserial"),
        F.when(F.col("event_id") % 5 != 0, 1).otherwise(0).alias("isginno"),
        F.col("at").alias("created"),
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """GPS alerts; creation times are cut to the hour so that some tie."""
    key = F.col("event_id")
    content = None
    for kind, text in P.ALERT_CONTENT:
        test = F.col("event_type") == kind
        content = F.when(test, text) if content is None else content.when(test, text)
    raised = F.date_trunc("HOUR", "at").cast(NTZ)
    return _event_day(spark, sf).where(~F.col("event_type").isin("click", "view")).select(
        key.alias("alert_id"),
        F.concat(F.lit("HDCC/"), F.col("pawnid").cast("string")).alias("codeno"),
        raised.alias("warningcreated"),
        F.when(key % 9 != 0, (key % 200).cast("int")).alias("dpd"),
        (1 + key % 4).cast("int").alias("warningnumber"),
        (key % 15).cast("int").alias("numberday"),
        content.alias("warningcontent"),
        F.when(key % 3 == 1, F.lit("")).when(key % 3 == 2, F.concat(F.lit("cat"), (key % 4).cast("string")))
        .alias("commentcat"),
        F.concat(F.lit("note "), key.cast("string")).alias("commentcontent"),
        F.when(key % 3 == 2, _plus(raised, days=key % 5)).alias("commentcreated"),
        F.when(key % 2 == 0, "open").otherwise("done").alias("processstatus"),
        F.col("value").alias("distance"),
    )


def write_offs(spark: SparkSession, sf: str) -> DataFrame:
    """Write-off list: every seventh supplier-sized block of contracts."""
    key = F.col("o_orderkey")
    periods = F.array(*[F.lit(p) for p in P.WRITE_OFF_PERIODS])
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(
        F.element_at(periods, (key % 4 + 1).cast("int")).alias("write_off_period"),
        F.concat(F.lit("WOFF/"), key.cast("string")).alias("codeno"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
    )


def kpi_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Target sheet as text, one row per supplier and shop; head office rows included."""
    nation = table(spark, sf, "nation")
    sup = table(spark, sf, "supplier")
    key = F.col("s_suppkey")
    text = lambda c: c.cast("string")
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey, "left").select(
        F.when(key % 11 == 0, "1999").otherwise("2000").alias("kpi_year"),
        text(5 + key % 3).alias("kpi_month"),
        F.when(key % 13 == 0, F.lit("Hội Sở 1")).otherwise(F.col("n_name")).alias("shopname"),
        F.concat(F.lit("P"), text(F.col("n_nationkey"))).alias("province"),
        F.concat(F.lit("R"), text(F.col("n_regionkey"))).alias("region"),
        F.lit("M1").alias("manager"),
        F.lit("A1").alias("area_manager"),
        F.format_number((F.floor(F.col("s_acctbal")) * 100000).cast("long"), 0).alias("balance_target"),
        text(key % 50).alias("lead_target"),
        text(key % 20).alias("sale_target"),
        F.format_number(1000 + key * 7, 0).alias("traffic_target"),
    )


def cash_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Cash counts per shop with explanations, some of them whole documents."""
    key = F.col("event_id")
    events = _event_day(spark, sf)
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("event_id"), "text")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("shop"))
    net = (F.col("value").cast(MONEY) * F.lit(1000)).cast(MONEY)
    red = (F.col("value").cast(MONEY) * F.lit(1000) - (key % 41 - 20) * 1000).cast(MONEY)
    notes = F.array(*[F.lit(n) for n in P.CASH_NOTES])
    return (
        events.join(docs, "event_id", "left")
        .join(nation, F.col("user_id") % 25 == F.col("n_nationkey"), "left")
        .select(
            key.alias("count_id"),
            F.date_trunc("SECOND", "at").cast(NTZ).alias("created"),
            "shop",
            net.alias("net"),
            red.alias("moneyred"),
            (net - red).cast(MONEY).alias("diff"),
            F.when(key % 6 < 5, F.element_at(notes, (key % 5 + 1).cast("int"))).alias("not_minus"),
            F.col("text").alias("note_add"),
        )
    )


def cash_limits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").where(F.col("n_nationkey") != 7).select(
        F.col("n_name").alias("shop"), (F.col("n_nationkey") * 10000 + 40000).cast(MONEY).alias("limit_amt")
    )


def fund_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Cash count events: one per event, spread between 08:00 and 20:00 of its day."""
    minute = F.hour("at") * 60 + F.minute("at")
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("shop_name"))
    return (
        _event_day(spark, sf)
        .withColumn("shop_id", (F.col("user_id") % 25).cast("int"))
        .join(nation, F.col("shop_id") == F.col("n_nationkey"), "left")
        .select("shop_id", "shop_name",
                _plus(F.to_date("at"), hours=8, minutes=F.floor(minute / 2), seconds=F.second("at")).alias("created"))
    )


def contract_times(spark: SparkSession, sf: str) -> DataFrame:
    """Open and close times per contract; every third one is not closed yet."""
    c = contract_core(spark, sf)
    return c.select("codeno", "openhour", F.when(F.col("pawnid") % 3 != 0, F.col("closehour")).alias("closehour"), "categorycode", F.col("fromdate").alias("extrac_date"),
                    F.concat(F.lit("Customer#"), F.lpad(F.col("customerid").cast("string"), 9, "0")).alias("customer"))


@lru_cache(maxsize=64)
def _lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    opened = contract_core(spark, sf).select("pawnid", "codeno", "openhour")
    return lines.join(opened, F.col("l_orderkey") == F.col("pawnid"))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    minute = (F.col("l_linenumber") * 9 + F.col("l_partkey")) % 240
    return _lines(spark, sf).select(
        F.col("pawnid").alias("pawn_wid"),
        F.col("codeno").alias("contract_no"),
        _plus(F.col("openhour"), minutes=minute, seconds=F.col("l_suppkey") % 60).alias("created"),
        F.when(F.col("l_returnflag") == "N", "Cho vay").otherwise("Thu lãi").alias("action_name"),
    )


def images(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        "pawnid",
        F.col("l_partkey").alias("pawnassetfileid"),
        _plus(F.col("openhour"), minutes=F.col("l_partkey") % 200 - 100).alias("uploaded"),
    )


def category_dim(spark: SparkSession) -> DataFrame:
    return local(spark, [(code, name) for _, code, name in P.PRIORITY_CATEGORY], "code string, name string")


def users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("user_wid"), F.concat(F.lit("U"), F.col("s_suppkey").cast("string")).alias("user_code")
    )


def customer_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score history: one row per order of two thirds of the customers."""
    return table(spark, sf, "orders").where(F.col("o_custkey") % 3 != 0).select(
        F.col("o_custkey").alias("customerid"),
        F.floor(F.col("o_totalprice") % 1000).cast("double").alias("customer_score"),
        F.to_date("o_orderdate").alias("data_date"),
        F.col("o_orderkey").alias("score_id"),
    )


def exempt_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Contracts whose asset is known to be missing."""
    return table(spark, sf, "orders").where(F.col("o_orderstatus") == "F").where(F.col("o_custkey") % 2 == 0).select(
        F.concat(F.lit("HDCC/"), F.col("o_orderkey").cast("string")).alias("contractcode")
    )


def checking_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log of earlier checks, all cells as text."""
    c = contracts(spark, sf)
    return c.select(
        F.date_format("fromdate", "yyyyMM").alias("year_month"),
        F.date_format("fromdate", "yyyy-MM-dd").alias("extrac_date"),
        "shopname",
        "shopcode",
        F.col("customername").alias("cusname"),
        "codeno",
        F.col("categoryname").alias("cate"),
        F.lit(None).cast("string").alias("reason_check"),
        F.when(F.col("pawnid") % 2 == 0, "Tuân thủ").otherwise("Gian lận").alias("risk_type"),
    )


def focus_shops(spark: SparkSession, sf: str) -> DataFrame:
    """Focus sheet: one validity range per supplier, many per shop, some starting on the same day."""
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("shop"))
    sup = table(spark, sf, "supplier")
    start = F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("s_suppkey") % 200).cast("int"))
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey).select(
        start.alias("shop_update_date"),
        F.date_add(start, (F.col("s_suppkey") % 5 * 40).cast("int")).alias("shop_to_date"),
        F.lit("Active").alias("shop_active_stt"),
        "shop",
        F.element_at(F.array(F.lit("High"), F.lit("Low"), F.lit("Medium")), (F.col("s_suppkey") % 3 + 1).cast("int"))
        .alias("shop_focus_level"),
    )


def shop_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """Shop sheet with rows that carry no code."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.when(key % 7 == 0, "").when(key % 7 != 1, F.concat(F.lit("S"), F.col("s_nationkey").cast("string"))).alias("shopcode"),
        F.col("s_name").alias("shopname"),
    )


def predicted_scores(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").where(F.col("n_nationkey") % 4 != 0).select(
        F.col("n_name").alias("shopname"), (F.col("n_nationkey") * 20).cast("double").alias("ols_pred_score")
    )


def categorical_card(spark: SparkSession) -> DataFrame:
    return local(spark, P.CATEGORICAL_CARD, schemas.CATEGORICAL_CARD)


def numeric_card(spark: SparkSession) -> DataFrame:
    return local(spark, P.NUMERIC_CARD, schemas.NUMERIC_CARD)


def thresholds(spark: SparkSession) -> DataFrame:
    return local(spark, P.THRESHOLDS, schemas.THRESHOLD)


def focus_packages(spark: SparkSession) -> DataFrame:
    rows = [(n, c, as_date(a), as_date(b), s, level) for n, c, a, b, s, level in P.FOCUS_PACKAGES]
    return local(spark, rows, schemas.FOCUS_PACKAGE)


def contacts(spark: SparkSession) -> DataFrame:
    return local(spark, P.CONTACTS, schemas.CONTACT)


def _actions(rows: DataFrame, key, quality, plan_since: str, assignee, risk_owner, content) -> DataFrame:
    """An action list: status and dates around the as-of date from a whole number of each row."""
    as_of = F.lit(as_date(P.AS_OF))
    day = lambda c: F.date_add(as_of, c.cast("int"))
    return rows.select(
        key.cast("string").alias("no"),
        F.concat(F.lit("/"), (200001 + key % 6).cast("string")).alias("yearmonth"),
        F.when(quality, "Chưa thực hiện").when(key % 5 == 0, "Đã hoàn thành")
        .when(key % 5 != 1, "Đang thực hiện").alias("status"),
        day(-(key % 9)).alias(plan_since),
        day(-(key % 40)).alias("start_date"),
        F.when(key % 17 != 0, day(-(key % 11))).alias("update_date"),
        day(key % 21 - 10).alias("deadline"),
        assignee.alias("assignee"),
        risk_owner.alias("risk_owner"),
        content.alias("content"),
    )


def action_list(spark: SparkSession, sf: str) -> DataFrame:
    """Risk recommendations: one per document."""
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rows = table(spark, sf, "documents").join(labels, "doc_id", "left")
    return _actions(rows, F.col("doc_id"), F.col("quality") == 1, "recommend_date", F.col("source"), F.col("lang"), F.col("text"))


def audit_list(spark: SparkSession, sf: str) -> DataFrame:
    """Audit recommendations: one per turn of a conversation."""
    key = F.col("conv_id") * 100 + F.col("turn")
    assignee = F.concat(F.lit("src"), (key % 7).cast("string"))
    return _actions(table(spark, sf, "conversations"), key, key % 4 == 1, "recommend_date", assignee, F.col("role"), F.col("text"))


def issue_list(spark: SparkSession, sf: str) -> DataFrame:
    """Issues: one per page; they carry the day they were concluded instead of one of recommendation."""
    key = F.col("page_id")
    assignee = F.concat(F.lit("src"), (key % 7).cast("string"))
    return _actions(table(spark, sf, "pages"), key, key % 3 == 1, "concluded_date", assignee, F.lit("ops"), F.col("url"))
