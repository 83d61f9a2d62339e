"""Declared schemas of the warehouse entities the plans read."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

SNAPSHOT = T.StructType([
    T.StructField("created", T.DateType()),
    T.StructField("yearmonth", T.IntegerType()),
    T.StructField("pawnid", T.LongType()),
    T.StructField("contractcode", T.StringType()),
    T.StructField("customerid", T.LongType()),
    T.StructField("customername", T.StringType()),
    T.StructField("categoryname", T.StringType()),
    T.StructField("categorycode", T.StringType()),
    T.StructField("shopname", T.StringType()),
    T.StructField("shopcode", T.StringType()),
    T.StructField("shopid", T.IntegerType()),
    T.StructField("currentmoney", MONEY),
    T.StructField("moneyorg", MONEY),
    T.StructField("insurrancemoney", MONEY),
    T.StructField("moneyappraisal", MONEY),
    T.StructField("assetvalue", MONEY),
    T.StructField("papertype", T.StringType()),
    T.StructField("packagecode", T.StringType()),
    T.StructField("fromdate", T.DateType()),
    T.StructField("todate", T.DateType()),
    T.StructField("frequency", T.IntegerType()),
    T.StructField("principalpaymentday", T.IntegerType()),
    T.StructField("chipserial", T.StringType()),
    T.StructField("tuoino", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
])

CONTRACT = T.StructType([
    T.StructField("pawnid", T.LongType()),
    T.StructField("codeno", T.StringType()),
    T.StructField("customerid", T.LongType()),
    T.StructField("categorycode", T.StringType()),
    T.StructField("shopcode", T.StringType()),
    T.StructField("shopid", T.IntegerType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("fromdate", T.DateType()),
    T.StructField("todate", T.DateType()),
    T.StructField("closedate", T.DateType()),
    T.StructField("inittime", T.TimestampType()),
    T.StructField("firstsupportid", T.LongType()),
    T.StructField("createdby", T.LongType()),
    T.StructField("packagecode", T.StringType()),
    T.StructField("frequency", T.IntegerType()),
    T.StructField("loanmoneyorg", MONEY),
    T.StructField("insurrancemoney", MONEY),
    T.StructField("moneycurrent", MONEY),
])

SHOP = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("areaid", T.IntegerType()),
])

CHIP_EVENT = T.StructType([
    T.StructField("chip_id", T.LongType()),
    T.StructField("pawnid", T.LongType()),
    T.StructField("chipserial", T.StringType()),
    T.StructField("isginno", T.IntegerType()),
    T.StructField("created", T.TimestampType()),
])

ALERT = T.StructType([
    T.StructField("alert_id", T.LongType()),
    T.StructField("codeno", T.StringType()),
    T.StructField("warningcreated", T.TimestampType()),
    T.StructField("dpd", T.IntegerType()),
    T.StructField("warningnumber", T.IntegerType()),
    T.StructField("numberday", T.IntegerType()),
    T.StructField("warningcontent", T.StringType()),
    T.StructField("commentcat", T.StringType()),
    T.StructField("commentcontent", T.StringType()),
    T.StructField("commentcreated", T.TimestampType()),
    T.StructField("processstatus", T.StringType()),
    T.StructField("distance", T.DoubleType()),
])

CASH_COUNT = T.StructType([
    T.StructField("created", T.TimestampType()),
    T.StructField("shop", T.StringType()),
    T.StructField("net", MONEY),
    T.StructField("moneyred", MONEY),
    T.StructField("diff", MONEY),
    T.StructField("not_minus", T.StringType()),
    T.StructField("note_add", T.StringType()),
])

WRITE_OFF = T.StructType([
    T.StructField("write_off_period", T.IntegerType()),
    T.StructField("codeno", T.StringType()),
    T.StructField("amount", MONEY),
])

# The target sheet arrives as text; kpi.clean_targets parses it.
KPI_TARGET = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("kpi_year", "kpi_month", "shopname", "province", "region", "manager", "area_manager",
                 "balance_target", "lead_target", "sale_target", "traffic_target")
])

CATEGORICAL_CARD = T.StructType([
    T.StructField("categoryname", T.StringType()),
    T.StructField("field_check", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
])

NUMERIC_CARD = T.StructType([
    T.StructField("categoryname", T.StringType()),
    T.StructField("field_check", T.StringType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("package_name", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
])

THRESHOLD = T.StructType([
    T.StructField("category_name", T.StringType()),
    T.StructField("lower_threshold", T.DoubleType()),
    T.StructField("upper_threshold", T.DoubleType()),
])

FOCUS_SHOP = T.StructType([
    T.StructField("shop_update_date", T.DateType()),
    T.StructField("shop_to_date", T.DateType()),
    T.StructField("shop_active_stt", T.StringType()),
    T.StructField("shop", T.StringType()),
    T.StructField("shop_focus_level", T.StringType()),
])

FOCUS_PACKAGE = T.StructType([
    T.StructField("package_name", T.StringType()),
    T.StructField("package_code", T.StringType()),
    T.StructField("package_from_date", T.DateType()),
    T.StructField("package_to_date", T.DateType()),
    T.StructField("package_active_stt", T.StringType()),
    T.StructField("package_focus_level", T.StringType()),
])

CONTACT = T.StructType([
    T.StructField("assignee", T.StringType()),
    T.StructField("contact", T.StringType()),
])

CHECKING_LOG = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("year_month", "extrac_date", "shopname", "shopcode", "cusname", "codeno", "cate",
                 "reason_check", "risk_type")
])
