"""SQL twins of the entity views, as common table expressions over the raw tables."""

from __future__ import annotations

import re

from . import params as P

_CASE_CODE = " ".join(f"WHEN '{p}' THEN '{code}'" for p, code, _ in P.PRIORITY_CATEGORY)
_CASE_NAME = " ".join(f"WHEN '{p}' THEN '{name}'" for p, _, name in P.PRIORITY_CATEGORY)
_CASE_CONTENT = " ".join(f"WHEN '{k}' THEN '{text}'" for k, text in P.ALERT_CONTENT)
_NOTES = "[" + ", ".join(f"'{n}'" for n in P.CASH_NOTES) + "]"
_PERIODS = "[" + ", ".join(str(p) for p in P.WRITE_OFF_PERIODS) + "]"


def shopcode(key: str) -> str:
    return f"CASE {key} WHEN 23 THEN 'HS23' WHEN 24 THEN 'TEST24' ELSE 'S' || {key} END"


def flow7(dpd: str) -> str:
    return (f"CASE WHEN {dpd} < 1 THEN 0 WHEN {dpd} < 31 THEN 1 WHEN {dpd} < 61 THEN 2 WHEN {dpd} < 91 THEN 3 "
            f"WHEN {dpd} < 121 THEN 4 WHEN {dpd} < 151 THEN 5 ELSE 6 END")


def flow7_name(bucket: str) -> str:
    return (f"CASE {bucket} WHEN -1 THEN '-1. Đã đóng' WHEN 0 THEN '0.Trong hạn' WHEN 1 THEN '1.1-30 ngày' "
            f"WHEN 2 THEN '2.31-60 ngày' WHEN 3 THEN '3.61-90 ngày' WHEN 4 THEN '4.91-120 ngày' "
            f"WHEN 5 THEN '5.121-150 ngày' ELSE '6.151++' END")


def _actions(source: str, key: str, waiting: str, planned: str, assignee: str, owner: str, content: str) -> str:
    """An action list: status and dates around the as-of date from a whole number of each row."""
    back = lambda days: f"DATE '{P.AS_OF}' - CAST({key} % {days} AS INTEGER)"
    return f"""
        SELECT CAST({key} AS VARCHAR) AS no, '/' || (200001 + {key} % 6) AS yearmonth,
               CASE WHEN {waiting} THEN 'Chưa thực hiện' WHEN {key} % 5 = 0 THEN 'Đã hoàn thành'
                    WHEN {key} % 5 <> 1 THEN 'Đang thực hiện' END AS status,
               {back(9)} AS {planned}, {back(40)} AS start_date, CASE WHEN {key} % 17 <> 0 THEN {back(11)} END AS update_date,
               DATE '{P.AS_OF}' + CAST({key} % 21 - 10 AS INTEGER) AS deadline,
               {assignee} AS assignee, {owner} AS risk_owner, {content} AS content
        FROM {source}"""


VIEWS: dict[str, str] = {
    "contract_base": f"""
        SELECT o_orderkey AS pawnid, o_custkey AS customerid, 'HDCC/' || o_orderkey AS codeno,
               CAST(o_orderdate AS DATE) AS fromdate,
               CAST(30 * (1 + o_orderkey % 12) AS INTEGER) AS frequency,
               CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 28 + 1 AS INTEGER) END AS principalpaymentday,
               CAST((o_orderkey * 37) % 260 - 60 AS INTEGER) AS late_by,
               CASE o_orderpriority {_CASE_CODE} END AS categorycode,
               CASE o_orderpriority {_CASE_NAME} END AS categoryname,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS currentmoney,
               CASE o_orderkey % 3 WHEN 1 THEN 'NHANH0' || (o_orderkey % 2) WHEN 2 THEN 'G02' END AS packagecode,
               CASE o_orderkey % 8 WHEN 0 THEN 14 WHEN 1 THEN 77 WHEN 2 THEN 11 WHEN 3 THEN 22
                    WHEN 4 THEN 10 WHEN 5 THEN 10 ELSE 1 END AS status,
               CASE WHEN o_orderkey % 2 = 1 THEN 'POS' || o_orderkey END AS chipserial
        FROM orders""",
    "contract_core": """
        SELECT *, fromdate + frequency AS todate,
               greatest(fromdate + 1, fromdate + frequency + late_by) AS closedate,
               CAST(currentmoney * CAST(0.01 AS DECIMAL(3,2)) * (pawnid % 5) AS DECIMAL(18,2)) AS insurrancemoney,
               CAST(currentmoney * CAST(0.1 AS DECIMAL(2,1))
                    * (CASE WHEN pawnid % 97 = 0 THEN 0 ELSE 10 + pawnid % 8 END) AS DECIMAL(18,2)) AS moneyappraisal,
               CAST(fromdate AS TIMESTAMP) + to_minutes(420 + (pawnid * 17) % 840) + to_seconds(pawnid % 60) AS openhour,
               CAST(fromdate AS TIMESTAMP) + to_minutes(420 + (pawnid * 17) % 840) + to_seconds(pawnid % 60)
                   - to_minutes(pawnid % 50) - to_seconds(20) AS inittime,
               CAST(greatest(fromdate + 1, fromdate + frequency + late_by) AS TIMESTAMP)
                   + to_minutes(480 + (pawnid * 11) % 720) + to_seconds((pawnid * 7) % 60) AS closehour,
               pawnid % 50 AS firstsupportid, (pawnid * 3) % 50 AS createdby
        FROM contract_base""",
    "customers": f"""
        SELECT c_custkey AS customerid, c_name AS customername,
               CASE WHEN c_mktsegment = 'BUILDING' THEN 'KT1' WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'KT3' END AS papertype,
               {shopcode('c_nationkey')} AS shopcode, n_name AS shopname, c_nationkey AS shopid
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "shops": f"""
        SELECT {shopcode('n_nationkey')} AS code, n_name AS name, 1 + n_regionkey % 2 AS areaid FROM nation""",
    "shop_info": f"""
        SELECT {shopcode('n_nationkey')} AS shopcode, r_name AS region, 'P' || n_nationkey AS province,
               1 + n_nationkey % 12 AS opened_month, 1990 + n_nationkey % 5 AS opened_year
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 5""",
    "contracts": """
        SELECT c.*, k.customername, k.papertype, k.shopcode, k.shopname, k.shopid
        FROM contract_core c LEFT JOIN customers k USING (customerid)""",
    "event_day": f"""
        SELECT event_id, event_type, user_id, value, (event_id // 8) * 11 + event_id % 2 AS pawnid,
               ts - to_days({P.EVENT_SHIFT_DAYS}) AS happened
        FROM events""",
    "chip_events": """
        SELECT event_id AS chip_id, pawnid, 'SN' || event_id AS chipserial,
               CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END AS isginno, happened AS created
        FROM event_day WHERE event_type IN ('click', 'view')""",
    "alerts": f"""
        SELECT event_id AS alert_id, 'HDCC/' || pawnid AS codeno,
               CAST(date_trunc('hour', happened) AS TIMESTAMP) AS warningcreated,
               CASE WHEN event_id % 9 <> 0 THEN event_id % 200 END AS dpd,
               1 + event_id % 4 AS warningnumber, event_id % 15 AS numberday,
               CASE event_type {_CASE_CONTENT} END AS warningcontent,
               CASE event_id % 3 WHEN 1 THEN '' WHEN 2 THEN 'cat' || (event_id % 4) END AS commentcat,
               'note ' || event_id AS commentcontent,
               CASE WHEN event_id % 3 = 2
                    THEN CAST(date_trunc('hour', happened) AS TIMESTAMP) + to_days(CAST(event_id % 5 AS INTEGER)) END AS commentcreated,
               CASE WHEN event_id % 2 = 0 THEN 'open' ELSE 'done' END AS processstatus,
               value AS distance
        FROM event_day WHERE event_type NOT IN ('click', 'view')""",
    "write_offs": f"""
        SELECT {_PERIODS}[CAST(o_orderkey % 4 + 1 AS INTEGER)] AS write_off_period, 'WOFF/' || o_orderkey AS codeno,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount
        FROM orders WHERE o_orderstatus = 'P'""",
    "kpi_sheet": """
        SELECT CASE WHEN s_suppkey % 11 = 0 THEN '1999' ELSE '2000' END AS kpi_year,
               CAST(5 + s_suppkey % 3 AS VARCHAR) AS kpi_month,
               CASE WHEN s_suppkey % 13 = 0 THEN 'Hội Sở 1' ELSE n_name END AS shopname,
               'P' || n_nationkey AS province, 'R' || n_regionkey AS region, 'M1' AS manager, 'A1' AS area_manager,
               format('{:,}', CAST(floor(s_acctbal) * 100000 AS BIGINT)) AS balance_target,
               CAST(s_suppkey % 50 AS VARCHAR) AS lead_target, CAST(s_suppkey % 20 AS VARCHAR) AS sale_target,
               format('{:,}', 1000 + s_suppkey * 7) AS traffic_target
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "cash_counts": f"""
        SELECT event_id AS count_id, CAST(date_trunc('second', happened) AS TIMESTAMP) AS created, n_name AS shop,
               CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS DECIMAL(18,2)) AS net,
               CAST(CAST(value AS DECIMAL(18,2)) * 1000 - (event_id % 41 - 20) * 1000 AS DECIMAL(18,2)) AS moneyred,
               CAST((event_id % 41 - 20) * 1000 AS DECIMAL(18,2)) AS diff,
               CASE WHEN event_id % 6 < 5 THEN {_NOTES}[CAST(event_id % 5 + 1 AS INTEGER)] END AS not_minus,
               text AS note_add
        FROM event_day LEFT JOIN documents ON event_id = doc_id
        LEFT JOIN nation ON user_id % 25 = n_nationkey""",
    "cash_limits": """
        SELECT n_name AS shop, CAST(n_nationkey * 10000 + 40000 AS DECIMAL(18,2)) AS limit_amt
        FROM nation WHERE n_nationkey <> 7""",
    "fund_counts": """
        SELECT CAST(user_id % 25 AS INTEGER) AS shop_id, n_name AS shop_name,
               CAST(CAST(happened AS DATE) AS TIMESTAMP) + to_hours(8)
                   + to_minutes((hour(happened) * 60 + minute(happened)) // 2) + to_seconds(second(happened)) AS created
        FROM event_day LEFT JOIN nation ON user_id % 25 = n_nationkey""",
    "contract_times": """
        SELECT codeno, openhour, CASE WHEN pawnid % 3 <> 0 THEN closehour END AS closehour, categorycode, fromdate AS extrac_date,
               'Customer#' || lpad(CAST(customerid AS VARCHAR), 9, '0') AS customer
        FROM contract_core""",
    "lines": """
        SELECT l_partkey, l_suppkey, l_linenumber, l_returnflag, pawnid, codeno, openhour
        FROM lineitem JOIN contract_core ON l_orderkey = pawnid""",
    "transactions": """
        SELECT pawnid AS pawn_wid, codeno AS contract_no,
               openhour + to_minutes((l_linenumber * 9 + l_partkey) % 240) + to_seconds(l_suppkey % 60) AS created,
               CASE WHEN l_returnflag = 'N' THEN 'Cho vay' ELSE 'Thu lãi' END AS action_name
        FROM lines""",
    "images": """
        SELECT pawnid, l_partkey AS pawnassetfileid, openhour + to_minutes(l_partkey % 200 - 100) AS uploaded FROM lines""",
    "category_dim": "SELECT * FROM (VALUES " + P.sql_values([(c, n) for _, c, n in P.PRIORITY_CATEGORY]) + ") t(code, name)",
    "users": "SELECT s_suppkey AS user_wid, 'U' || s_suppkey AS user_code FROM supplier",
    "customer_scores": """
        SELECT o_custkey AS customerid, floor(o_totalprice % 1000) AS customer_score,
               CAST(o_orderdate AS DATE) AS data_date, o_orderkey AS score_id
        FROM orders WHERE o_custkey % 3 <> 0""",
    "exempt_contracts": """
        SELECT 'HDCC/' || o_orderkey AS contractcode FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 2 = 0""",
    "checking_log": """
        SELECT strftime(fromdate, '%Y%m') AS year_month, strftime(fromdate, '%Y-%m-%d') AS extrac_date, shopname,
               shopcode, customername AS cusname, codeno, categoryname AS cate, CAST(NULL AS VARCHAR) AS reason_check,
               CASE WHEN pawnid % 2 = 0 THEN 'Tuân thủ' ELSE 'Gian lận' END AS risk_type
        FROM contracts""",
    "focus_shops": """
        SELECT DATE '2000-01-01' + CAST(s_suppkey % 200 AS INTEGER) AS shop_update_date,
               DATE '2000-01-01' + CAST(s_suppkey % 200 + s_suppkey % 5 * 40 AS INTEGER) AS shop_to_date,
               'Active' AS shop_active_stt, n_name AS shop,
               CASE s_suppkey % 3 WHEN 0 THEN 'High' WHEN 1 THEN 'Low' ELSE 'Medium' END AS shop_focus_level
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "shop_sheet": """
        SELECT CASE WHEN s_suppkey % 7 = 0 THEN '' WHEN s_suppkey % 7 <> 1 THEN 'S' || s_nationkey END AS shopcode,
               s_name AS shopname FROM supplier""",
    "predicted_scores": """
        SELECT n_name AS shopname, CAST(n_nationkey * 20 AS DOUBLE) AS ols_pred_score
        FROM nation WHERE n_nationkey % 4 <> 0""",
    "categorical_card": "SELECT * REPLACE (CAST(risk_score AS DOUBLE) AS risk_score) FROM (VALUES " + P.sql_values(P.CATEGORICAL_CARD)
                        + ") t(categoryname, field_check, value, risk_score)",
    "numeric_card": "SELECT * REPLACE (CAST(risk_score AS DOUBLE) AS risk_score) FROM (VALUES " + P.sql_values(P.NUMERIC_CARD)
                    + ") t(categoryname, field_check, min_value, max_value, package_name, risk_score)",
    "thresholds": "SELECT * FROM (VALUES " + P.sql_values(P.THRESHOLDS)
                  + ") t(category_name, lower_threshold, upper_threshold)",
    "focus_packages": "SELECT package_name, package_code, CAST(f AS DATE) AS package_from_date, "
                      "CAST(t AS DATE) AS package_to_date, package_active_stt, package_focus_level FROM (VALUES "
                      + P.sql_values(P.FOCUS_PACKAGES)
                      + ") v(package_name, package_code, f, t, package_active_stt, package_focus_level)",
    "contacts": "SELECT * FROM (VALUES " + P.sql_values(P.CONTACTS) + ") t(assignee, contact)",
    "action_list": _actions("documents LEFT JOIN labels USING (doc_id)", "doc_id", "quality = 1", "recommend_date",
                            "source", "lang", "text"),
    "audit_list": _actions("conversations", "(conv_id * 100 + turn)", "(conv_id * 100 + turn) % 4 = 1", "recommend_date",
                           "'src' || (conv_id * 100 + turn) % 7", "role", "text"),
    "issue_list": _actions("pages", "page_id", "page_id % 3 = 1", "concluded_date", "'src' || page_id % 7", "'ops'", "url"),
}


def snapshot(day: str, source: str = "contracts") -> str:
    """Body of a snapshot of one day; inline it as a subquery."""
    return (f"(SELECT *, DATE '{day}' AS created, CAST(strftime(DATE '{day}', '%Y%m') AS INTEGER) AS yearmonth, "
            f"CAST(date_diff('day', todate, DATE '{day}') AS INTEGER) AS tuoino, codeno AS contractcode, "
            f"currentmoney AS moneyorg, moneyappraisal AS assetvalue "
            f"FROM {source} WHERE fromdate <= DATE '{day}' AND closedate > DATE '{day}')")


def query(body: str, **extra: str) -> str:
    """A full statement: the views the body needs (directly or not), then ``extra`` CTEs, then the body."""
    if body.lstrip().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    needed: set[str] = set()
    pending = [body, *extra.values()]
    while pending:
        text = pending.pop()
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(VIEWS[name])
    parts = [f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed]
    parts += [f"{name} AS ({sql})" for name, sql in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
