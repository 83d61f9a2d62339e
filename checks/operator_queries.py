"""Single operators and functions over whole tables: Spark queries and SQL twins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from loantide.functions import buckets, dates, numbers, rules, text
from loantide.operators import aggregates, crosstab, latest, lookups, sampling, sets
from loantide.plans import alert_report, kpi
from loantide.sources.readers import run_sql

from . import params as P
from . import views as V
from .alert_queries import base as alert_base
from .alert_queries import _BASE
from .duck_views import query, snapshot


def previous_contracts(spark, sf):
    """Previous contract of every contract: code and status, days since it closed."""
    c = V.contract_core(spark, sf).select("pawnid", "customerid", "codeno", "status", "fromdate", "closedate")
    rows = latest.previous_row(c, ["customerid"], ["fromdate", "pawnid"], ["codeno", "status", "closedate"], "previous",
                               slice_by=latest.dated_slices("fromdate", "pawnid"))
    before = F.col("previous")
    return rows.select(
        "pawnid", "customerid", before["codeno"].alias("previous_codeno"), before["status"].alias("previous_status"),
        dates.days_between(before["closedate"], F.col("fromdate")).alias("sleep_day"),
        rules.flag(before["codeno"].isNull(), "Khách mới", "Khách cũ").alias("cus_type"),
    )


def last_contract_per_customer(spark, sf):
    c = V.contract_core(spark, sf)
    return latest.last_value_per_key(c, ["customerid"], [F.col("fromdate"), F.col("pawnid")], "fromdate", "last_contract")


def newest_focus_rows(spark, sf):
    """Focus rows of the newest update date of each shop; ties are all kept."""
    return latest.latest_with_ties(V.focus_shops(spark, sf), ["shop"], "shop_update_date")


def newest_orders_with_ties(spark, sf):
    o = V.table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return latest.latest_with_ties(o, ["o_custkey"], "day")


def top_balances(spark, sf):
    c = V.contract_core(spark, sf).select("pawnid", "categoryname", "currentmoney")
    return sampling.top_n(c, 25, F.desc("currentmoney"), F.col("pawnid"))


def quota_per_category(spark, sf):
    c = V.contract_core(spark, sf).select("pawnid", "categoryname", "currentmoney")
    quotas = {"Đăng ký xe máy": 6, "Đăng ký Ô tô": 3, "Điện thoại": 9}
    return sampling.quota_sample(c, F.col("categoryname"), quotas, F.desc("currentmoney"), F.col("pawnid"))


def parameterised_sql(spark, sf):
    return run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n, sum(cast(o_totalprice AS decimal(18,2))) AS total FROM {orders} "
        "WHERE o_orderdate >= :low AND o_orderdate < :high GROUP BY o_orderstatus",
        {"orders": V.table(spark, sf, "orders")},
        low=dt.date(1998, 1, 1), high=dt.date(2000, 1, 1),
    )


def distinct_values(spark, sf):
    return V.alerts(spark, sf).select("warningcontent", "commentcat").distinct()


def global_summary(spark, sf):
    return V.contract_core(spark, sf).agg(
        F.max("fromdate").alias("newest"), F.max(dates.yearmonth(F.col("fromdate"))).alias("newest_month"),
        F.avg(F.col("currentmoney").cast("double")).alias("mean_balance"), F.count("pawnid").alias("n"),
    )


def active_shops(spark, sf):
    return kpi.active_shops(V.shop_sheet(spark, sf))


def union_and_reindex(spark, sf):
    """Alerts and chip events in one layout; what one of them lacks is null."""
    alerts = V.alerts(spark, sf).select(F.col("alert_id").alias("id"), "codeno", "warningcontent")
    chips = V.chip_events(spark, sf).select(F.col("chip_id").alias("id"), "chipserial", "isginno")
    return sets.reindex(sets.union_all(alerts, chips), ["id", "codeno", "chipserial", "warningcontent", "remark"])


def contracts_without_alert(spark, sf):
    return lookups.drop_matching(V.contract_core(spark, sf).select("codeno", "categoryname"), V.alerts(spark, sf), "codeno")


def contracts_with_alert(spark, sf):
    return lookups.keep_matching(V.contract_core(spark, sf).select("codeno", "categoryname"), V.alerts(spark, sf), "codeno")


def line_price_bins(spark, sf):
    """Global bins by quantity and bins per return flag by discount, both as range look-ups."""
    quantity = V.local(spark, [(0.0, 10.0, "small"), (10.0, 30.0, "medium"), (30.0, 51.0, "large")],
                       "min_value double, max_value double, size string")
    discount = V.local(spark, [("A", 0.0, 0.03, 1), ("A", 0.03, 1.0, 2), ("N", 0.0, 0.05, 3), ("N", 0.05, 1.0, 4)],
                       "flag string, min_value double, max_value double, grade int")
    lines = V.table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_returnflag")
    sized = lookups.bin_lookup(lines, quantity, F.col("l_quantity"))
    graded = lookups.bin_lookup(sized, discount, F.col("l_discount"), {"l_returnflag": "flag"})
    return graded.groupBy("l_returnflag", "size", "grade").agg(F.count(F.lit(1)).alias("n"))


def chip_by_bucket_wide(spark, sf):
    spec = alert_report.TABS["chip_by_bucket"]
    labels = ["1.Trong hạn", "2.1-30", "3.31-60", "4.61-90", "5.91-120", "6.>120", "All"]
    long = alert_report.tab(alert_base(spark, sf), "chip_by_bucket", P.ALERT_AS_OF)
    return crosstab.crosstab_wide(long, spec.index, labels).withColumnsRenamed(
        {label: f"b{k}" for k, label in enumerate(labels)})


def describe_balances(spark, sf):
    return aggregates.describe(V.snapshot(spark, sf, P.AS_OF, with_shop=False), ["categoryname"], "tuoino")


def describe_money(spark, sf):
    """Large amounts, where a variance from sums of squares loses its digits."""
    return aggregates.describe(V.snapshot(spark, sf, P.AS_OF, with_shop=False), ["categoryname"], "currentmoney")


def money_fences(spark, sf):
    """Fences over a nearly continuous column."""
    return aggregates.outlier_fence(V.contract_core(spark, sf), ["categoryname"], "currentmoney")


def group_totals(spark, sf):
    """Every contract with the balance and count of its category and term, joined back."""
    c = V.contract_core(spark, sf).select("pawnid", "categoryname", "frequency", "currentmoney")
    return aggregates.with_group_totals(c, c, ["categoryname", "frequency"], "currentmoney", "pawnid", "group_bal", "group_count")


def text_functions(spark, sf):
    t = F.col("text")
    return V.table(spark, sf, "documents").select(
        "doc_id",
        text.word_count(t).alias("words"),
        text.strip_punctuation(F.lower(t)).alias("stripped"),
        text.after_prefix(F.col("source"), 3).alias("source_no"),
        text.joined_lower(F.col("lang"), F.when(F.col("doc_id") % 3 == 0, F.col("source"))).alias("joined"),
        F.upper("source").alias("upper_source"),
        text.has_any(t, ["the", "een", "qu"]).cast("int").alias("any_mark"),
        text.matches_any(t, ["[0-9]{3}", "qu"]).cast("int").alias("any_pattern"),
        text.has_all_of(t, ["e", "a", "r"]).cast("int").alias("all_marks"),
        text.has_none_of(t, ["tion", "http"]).cast("int").alias("no_mark"),
        text.blank_to_null(F.when(F.col("doc_id") % 2 == 0, "").otherwise(F.col("lang"))).alias("lang_or_null"),
    )


def date_functions(spark, sf):
    c = V.contract_core(spark, sf)
    start, end = F.col("openhour"), F.col("closehour")
    return c.select(
        "pawnid",
        dates.yearmonth(F.col("fromdate")).alias("ym"),
        dates.yearmonth_text(F.col("fromdate")).alias("ym_text"),
        dates.yearmonth_of_text(F.col("fromdate").cast("string")).alias("ym_of_text"),
        dates.days_between(F.col("fromdate"), F.col("closedate")).alias("days"),
        dates.minute_boundaries(F.col("inittime"), start).alias("minutes"),
        dates.minute_boundaries(start, end).alias("minutes_open"),
        dates.elapsed_minutes(F.col("inittime"), start).alias("elapsed"),
        F.hour(start).alias("hour"),
        F.dayofweek("fromdate").alias("weekday"),
        F.dayofmonth("fromdate").alias("day_of_month"),
        dates.is_weekday_in(F.col("closedate"), [1, 6, 7]).cast("int").alias("weekend"),
        dates.first_overdue_day(F.col("closedate"), F.datediff("closedate", "todate")).alias("first_overdue"),
        dates.signed_days_to(F.col("todate"), P.AS_OF).alias("to_due"),
        dates.display_date(F.col("todate")).alias("shown"),
        dates.parse_date(F.when(F.col("pawnid") % 4 == 0, "").when(F.col("pawnid") % 4 == 1, "not a date")
                         .otherwise(F.col("todate").cast("string"))).alias("parsed"),
    )


def number_functions(spark, sf):
    c = V.contract_core(spark, sf)
    net = numbers.net_amount(F.col("currentmoney"), F.col("insurrancemoney"))
    return c.select(
        "pawnid",
        numbers.millions(F.col("currentmoney")).alias("in_millions"),
        numbers.exact_millions(F.col("currentmoney")).alias("exact_millions"),
        numbers.ratio(net, F.col("moneyappraisal")).alias("ltv"),
        numbers.whole_div(F.col("frequency"), 30).alias("duration"),
        numbers.thousands_text_to_long(F.format_number(F.col("pawnid") * 1234, 0)).alias("parsed"),
        numbers.or_zero(F.when(F.col("pawnid") % 2 == 0, F.col("frequency"))).alias("or_zero"),
        F.abs(F.col("frequency") - 200).alias("distance"),
        rules.loan_size(F.col("categorycode"), F.col("packagecode"), net).alias("size"),
        rules.term_range(F.col("frequency")).alias("term"),
        rules.package_type(F.col("packagecode")).alias("package_type"),
        rules.package_name(F.col("packagecode")).alias("package_name"),
        buckets.labelled_band(F.col("frequency"), [(60, "short"), (200, "middle"), (None, "long")], True).alias("band"),
        rules.first_match([(F.col("pawnid") % 2 == 0, "two"), (F.col("pawnid") % 3 == 0, "three")], "none").alias("first_rule"),
        rules.last_match([(F.col("pawnid") % 2 == 0, "two"), (F.col("pawnid") % 3 == 0, "three")], "none").alias("last_rule"),
    )


def paper_classes(spark, sf):
    c = V.customers(spark, sf)
    return c.select(
        "customerid",
        rules.paper_class(F.col("papertype"), "KT1").alias("null_as_kt1"),
        rules.paper_class(F.col("papertype"), "KT3").alias("null_as_kt3"),
    )


QUERIES = {f.__name__: f for f in (
    previous_contracts, last_contract_per_customer, newest_focus_rows, newest_orders_with_ties, top_balances,
    quota_per_category, parameterised_sql, distinct_values, global_summary, active_shops, union_and_reindex,
    contracts_without_alert, contracts_with_alert, line_price_bins, chip_by_bucket_wide, describe_balances, describe_money,
    money_fences, group_totals,
    text_functions, date_functions, number_functions, paper_classes,
)}

_NET = "(currentmoney - insurrancemoney)"

SQL = {
    "previous_contracts": query("""
        SELECT pawnid, customerid, lag(codeno) OVER w AS previous_codeno, lag(status) OVER w AS previous_status,
               date_diff('day', lag(closedate) OVER w, fromdate) AS sleep_day,
               CASE WHEN lag(codeno) OVER w IS NULL THEN 'Khách mới' ELSE 'Khách cũ' END AS cus_type
        FROM contract_core WINDOW w AS (PARTITION BY customerid ORDER BY fromdate, pawnid)"""),
    "last_contract_per_customer": query("""
        SELECT DISTINCT customerid, CAST(last_value(fromdate) OVER (PARTITION BY customerid ORDER BY fromdate
               RANGE BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS VARCHAR) AS last_contract FROM contract_core"""),
    "newest_focus_rows": query("""
        SELECT CAST(shop_update_date AS VARCHAR) AS shop_update_date, CAST(shop_to_date AS VARCHAR) AS shop_to_date,
               shop_active_stt, shop, shop_focus_level
        FROM focus_shops JOIN (SELECT shop, max(shop_update_date) AS shop_update_date FROM focus_shops GROUP BY shop)
             USING (shop, shop_update_date)"""),
    "newest_orders_with_ties": query("""
        SELECT o_custkey, o_orderkey, CAST(day AS VARCHAR) AS day
        FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
                     rank() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC) AS r FROM orders) WHERE r = 1"""),
    "top_balances": query("""
        SELECT pawnid, categoryname, CAST(currentmoney AS DOUBLE) AS currentmoney FROM contract_core
        ORDER BY contract_core.currentmoney DESC, pawnid LIMIT 25"""),
    "quota_per_category": query("""
        SELECT pawnid, categoryname, CAST(currentmoney AS DOUBLE) AS currentmoney, categoryname AS stratum, sample_rank
        FROM (SELECT *, row_number() OVER (PARTITION BY categoryname ORDER BY currentmoney DESC, pawnid) AS sample_rank
              FROM contract_core)
        WHERE sample_rank <= CASE categoryname WHEN 'Đăng ký xe máy' THEN 6 WHEN 'Đăng ký Ô tô' THEN 3
                                               WHEN 'Điện thoại' THEN 9 ELSE 0 END"""),
    "parameterised_sql": """
        SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
        WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '2000-01-01' GROUP BY o_orderstatus""",
    "distinct_values": query("SELECT DISTINCT warningcontent, commentcat FROM alerts"),
    "global_summary": query("""
        SELECT CAST(max(fromdate) AS VARCHAR) AS newest, CAST(max(strftime(fromdate, '%Y%m')) AS BIGINT) AS newest_month,
               round(CAST(sum(currentmoney) AS DOUBLE) / count(*), 6) AS mean_balance, count(pawnid) AS n FROM contract_core"""),
    "active_shops": query("SELECT * FROM shop_sheet WHERE shopcode <> ''"),
    "union_and_reindex": query("""
        SELECT alert_id AS id, codeno, CAST(NULL AS VARCHAR) AS chipserial, warningcontent, CAST(NULL AS VARCHAR) AS remark
        FROM alerts UNION ALL SELECT chip_id, NULL, chipserial, NULL, NULL FROM chip_events"""),
    "contracts_without_alert": query("""
        SELECT codeno, categoryname FROM contract_core WHERE codeno NOT IN (SELECT codeno FROM alerts)"""),
    "contracts_with_alert": query("""
        SELECT codeno, categoryname FROM contract_core WHERE codeno IN (SELECT codeno FROM alerts)"""),
    "line_price_bins": """
        SELECT l_returnflag, CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size,
               CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_discount < 0.03 THEN 1 ELSE 2 END
                    ELSE CASE WHEN l_discount < 0.05 THEN 3 ELSE 4 END END AS grade, count(*) AS n
        FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_quantity >= 0 AND l_quantity < 51 AND l_discount >= 0 AND l_discount < 1
        GROUP BY 1, 2, 3""",
    "chip_by_bucket_wide": query("""
        SELECT categoryname, have_chip, count(*) FILTER (bucket = '1.Trong hạn') AS b0, count(*) FILTER (bucket = '2.1-30') AS b1,
               count(*) FILTER (bucket = '3.31-60') AS b2, count(*) FILTER (bucket = '4.61-90') AS b3,
               count(*) FILTER (bucket = '5.91-120') AS b4, count(*) FILTER (bucket = '6.>120') AS b5, count(*) AS b6
        FROM (SELECT categoryname, have_chip, bucket FROM base UNION ALL SELECT 'All', '', bucket FROM base)
        GROUP BY categoryname, have_chip""", base=_BASE),
    "describe_balances": query(f"""
        SELECT categoryname, count(tuoino) AS count, round(avg(tuoino), 6) AS mean, round(stddev_samp(tuoino), 6) AS std,
               CAST(min(tuoino) AS DOUBLE) AS min, quantile_cont(tuoino, 0.25) AS p25, quantile_cont(tuoino, 0.5) AS p50,
               quantile_cont(tuoino, 0.75) AS p75, CAST(max(tuoino) AS DOUBLE) AS max
        FROM {snapshot(P.AS_OF, 'contract_core')} GROUP BY categoryname"""),
    "describe_money": query(f"""
        SELECT categoryname, count(v) AS count, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min,
               quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max
        FROM (SELECT categoryname, CAST(currentmoney AS DOUBLE) AS v FROM {snapshot(P.AS_OF, 'contract_core')})
        GROUP BY categoryname"""),
    "money_fences": query("""
        SELECT categoryname, q1, q3, q1 - 1.5 * (q3 - q1) AS lower_threshold, q3 + 1.5 * (q3 - q1) AS upper_threshold
        FROM (SELECT categoryname, quantile_cont(CAST(currentmoney AS DOUBLE), 0.25) AS q1,
                     quantile_cont(CAST(currentmoney AS DOUBLE), 0.75) AS q3 FROM contract_core GROUP BY categoryname)"""),
    "group_totals": query("""
        SELECT pawnid, categoryname, frequency, CAST(currentmoney AS DOUBLE) AS currentmoney,
               CAST(sum(currentmoney) OVER w AS DOUBLE) AS group_bal, count(pawnid) OVER w AS group_count
        FROM contract_core WINDOW w AS (PARTITION BY categoryname, frequency)"""),
    "text_functions": """
        SELECT doc_id, len(string_split(text, ' ')) AS words,
               regexp_replace(lower(text), '[^\\p{L}\\p{N}_\\s\\p{Z}]', '', 'g') AS stripped, substr(source, 4) AS source_no,
               lower(concat(lang, ' ', CASE WHEN doc_id % 3 = 0 THEN source END)) AS joined, upper(source) AS upper_source,
               CAST(regexp_matches(text, 'the|een|qu') AS BIGINT) AS any_mark,
               CAST(regexp_matches(text, '[0-9]{3}|qu') AS BIGINT) AS any_pattern,
               CAST(text LIKE '%e%' AND text LIKE '%a%' AND text LIKE '%r%' AS BIGINT) AS all_marks,
               CAST(text NOT LIKE '%tion%' AND text NOT LIKE '%http%' AS BIGINT) AS no_mark,
               CASE WHEN doc_id % 2 <> 0 THEN lang END AS lang_or_null
        FROM documents""",
    "date_functions": query(f"""
        SELECT pawnid, CAST(strftime(fromdate, '%Y%m') AS BIGINT) AS ym, strftime(fromdate, '%Y%m') AS ym_text,
               strftime(fromdate, '%Y%m') AS ym_of_text, closedate - fromdate AS days,
               date_diff('minute', inittime, openhour) AS minutes, date_diff('minute', openhour, closehour) AS minutes_open,
               round((epoch(openhour) - epoch(inittime)) / 60, 6) AS elapsed, hour(openhour) AS hour,
               dayofweek(fromdate) + 1 AS weekday, day(fromdate) AS day_of_month,
               CAST(dayofweek(closedate) IN (0, 5, 6) AS BIGINT) AS weekend,
               CAST(closedate - CAST(closedate - todate AS INTEGER) AS VARCHAR) AS first_overdue,
               todate - DATE '{P.AS_OF}' AS to_due, strftime(todate, '%d-%m-%Y') AS shown,
               CASE WHEN pawnid % 4 > 1 THEN CAST(todate AS VARCHAR) END AS parsed
        FROM contract_core"""),
    "number_functions": query(f"""
        SELECT pawnid, round(CAST(currentmoney AS DOUBLE) / 1000000, 6) AS in_millions,
               round(CAST(currentmoney AS DOUBLE) / 1000000, 6) AS exact_millions,
               round(CAST({_NET} AS DOUBLE) / nullif(CAST(moneyappraisal AS DOUBLE), 0), 6) AS ltv, frequency // 30 AS duration,
               pawnid * 1234 AS parsed, CASE WHEN pawnid % 2 = 0 THEN frequency ELSE 0 END AS or_zero,
               abs(frequency - 200) AS distance,
               CASE WHEN categorycode = 'C17' THEN
                        CASE WHEN {_NET} <= 3000000 THEN '0. <=3tr' WHEN {_NET} <= 10000000 THEN '1. 3-10tr'
                             WHEN {_NET} <= 15000000 THEN '2. 10-15tr' WHEN {_NET} <= 25000000 THEN '3. 15-25tr' ELSE '4. >25tr' END
                    WHEN categorycode = 'C15' THEN
                        CASE WHEN {_NET} <= 50000000 THEN '0. <=50tr' WHEN {_NET} <= 100000000 THEN '1. 50-100tr'
                             WHEN {_NET} <= 200000000 THEN '2. 100-200tr' WHEN packagecode IS NOT NULL THEN '4. >200tr'
                             WHEN {_NET} <= 300000000 THEN '3. 200-300tr' ELSE '4. >300tr' END END AS size,
               CASE WHEN frequency <= 30 THEN '1. Kỳ hạn 1 tháng' WHEN frequency <= 90 THEN '2. Kỳ hạn 3 tháng'
                    WHEN frequency <= 180 THEN '3. Kỳ hạn 6 tháng' WHEN frequency <= 270 THEN '4. Kỳ hạn 9 tháng'
                    WHEN frequency <= 360 THEN '5. Kỳ hạn 12 tháng' ELSE '6. >12 tháng' END AS term,
               coalesce(packagecode, 'Vay thường') AS package_type,
               CASE WHEN packagecode LIKE '%NHANH%' THEN 'Vay nhanh' ELSE 'Vay thường' END AS package_name,
               CASE WHEN frequency <= 60 THEN 'short' WHEN frequency <= 200 THEN 'middle' ELSE 'long' END AS band,
               CASE WHEN pawnid % 2 = 0 THEN 'two' WHEN pawnid % 3 = 0 THEN 'three' ELSE 'none' END AS first_rule,
               CASE WHEN pawnid % 3 = 0 THEN 'three' WHEN pawnid % 2 = 0 THEN 'two' ELSE 'none' END AS last_rule
        FROM contract_core"""),
    "paper_classes": query("""
        SELECT customerid, CASE WHEN papertype NOT LIKE 'KT1' THEN 'KT3' ELSE 'KT1' END AS null_as_kt1,
               CASE WHEN papertype LIKE 'KT1' THEN 'KT1' ELSE 'KT3' END AS null_as_kt3 FROM customers"""),
}
