"""Compliance, score-card, sample and reminder products: Spark queries and SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from loantide.functions import fixed_values as fv
from loantide.operators.sets import union_distinct
from loantide.plans import audit, compliance, reminders, scorecard

from . import params as P
from . import sql_parts
from . import views as V
from .duck_views import query

FIRST, LAST = "1999-07-01", "2000-06-29"
AS_OF = P.AS_OF


def _sources(spark, sf):
    contracts = V.contracts(spark, sf)
    opening = V.contracts(spark, sf).withColumn("created", F.col("fromdate"))
    return (contracts, V.contract_times(spark, sf), V.transactions(spark, sf), V.images(spark, sf), opening,
            V.customer_scores(spark, sf), V.category_dim(spark))


def features(spark, sf):
    return compliance.compliance_features(*_sources(spark, sf), FIRST, LAST)


def car_title_features(spark, sf):
    return compliance.car_title_features(*_sources(spark, sf), first=FIRST, last=LAST)


def shop_check_history(spark, sf):
    return compliance.shop_check_history(V.checking_log(spark, sf), AS_OF)


def focus_shops(spark, sf):
    return compliance.focus_shops(V.focus_shops(spark, sf), AS_OF)


def scored(spark, sf):
    rows = compliance.with_shop_facts(
        features(spark, sf), V.shops(spark, sf), V.shop_info(spark, sf), focus_shops(spark, sf),
        shop_check_history(spark, sf), V.predicted_scores(spark, sf),
    )
    return scorecard.scorecard(rows, V.categorical_card(spark), V.numeric_card(spark),
                               compliance.focus_packages(V.focus_packages(spark), AS_OF),
                               compliance.mean_score(V.contract_core(spark, sf), V.customer_scores(spark, sf), FIRST, LAST))


def audit_sample(spark, sf):
    return audit.as_checking_rows(audit.audit_sample(scored(spark, sf)), fv.COMPLIANCE)


def car_title_sample(spark, sf):
    rows = car_title_features(spark, sf).join(
        V.shops(spark, sf).select(F.col("code").alias("shopcode"), F.col("name").alias("shop_name")), "shopcode", "left")
    return audit.as_checking_rows(audit.car_title_sample(rows), fv.CAR_TITLE_REVIEW)


def all_samples(spark, sf):
    return union_distinct(audit_sample(spark, sf), car_title_sample(spark, sf))


def outbox(kind, actions):
    return lambda spark, sf: reminders.reminders(
        actions(spark, sf), V.contacts(spark), kind, AS_OF, P.ACTION_LINK, P.ESCALATE_TO)


def reminder_errors(spark, sf):
    return reminders.reminder_errors(V.action_list(spark, sf), V.contacts(spark), fv.RISK_RECOMMENDATION, AS_OF)


QUERIES = {
    "shop_check_history": shop_check_history,
    "focus_shops": focus_shops,
    "compliance_features": features,
    "car_title_features": car_title_features,
    "scorecard": scored,
    "audit_sample": audit_sample,
    "car_title_sample": car_title_sample,
    "all_samples": all_samples,
    "reminders_risk_recommendation": outbox(fv.RISK_RECOMMENDATION, V.action_list),
    "reminders_audit_recommendation": outbox(fv.AUDIT_RECOMMENDATION, V.audit_list),
    "reminders_audit_issue": outbox(fv.AUDIT_ISSUE, V.issue_list),
    "reminder_errors": reminder_errors,
}

_HISTORY = f"""
    SELECT shopname, count(DISTINCT extrac_date) AS shop_nums_checked_day, count(codeno) AS total_num_checked_pawn,
           CAST(29 AS BIGINT) AS nums_day_in_month, count(DISTINCT extrac_date) / 29 AS shop_checked_rate,
           count(codeno) / 29 AS average_nums_checked_pawn
    FROM checking_log WHERE risk_type = 'Tuân thủ' AND replace(substr(extrac_date, 1, 7), '-', '') = '200006'
    GROUP BY shopname"""

_FOCUS = f"""
    SELECT shop, shop_focus_level
    FROM (SELECT *, row_number() OVER (PARTITION BY shop ORDER BY shop_update_date DESC, shop_to_date DESC,
                                                       shop_focus_level DESC) AS rn FROM focus_shops
          WHERE DATE '{AS_OF}' BETWEEN shop_update_date AND shop_to_date) WHERE rn = 1"""

_CAR_SIZES = {key: sql_parts.text(label) for key, label in fv.CAR_TITLE_SIZE_LABELS.items()}
# A new contract's own facts, then one aggregate for each thing looked up about it. What the customer had before is the
# greatest earlier contract by day and number, found by a join on the customer rather than by a window.
_FEATURES = f"""
    WITH fresh AS (
        SELECT *, currentmoney - insurrancemoney AS net FROM contracts
        WHERE {sql_parts.one_of('status', fv.NEW_CONTRACT_STATUSES)} AND fromdate BETWEEN DATE '{FIRST}' AND DATE '{LAST}'),
    earlier AS (
        SELECT now.pawnid,
               arg_max({{'status': old.status, 'ended': old.closedate}}, {{'day': old.fromdate, 'no': old.pawnid}}) AS any_loan,
               arg_max({{'code': old.codeno, 'ended': old.closedate}}, {{'day': old.fromdate, 'no': old.pawnid}})
                   FILTER (old.categorycode IS NOT DISTINCT FROM now.categorycode) AS same_kind
        FROM fresh now JOIN contracts old
          ON old.customerid = now.customerid
         AND (old.fromdate < now.fromdate OR (old.fromdate = now.fromdate AND old.pawnid < now.pawnid))
        GROUP BY now.pawnid),
    rated AS (
        SELECT customerid, arg_max({{'score': customer_score}}, {{'day': data_date, 'no': score_id}}).score AS customer_score
        FROM customer_scores WHERE data_date <= DATE '{LAST}' GROUP BY customerid),
    daily AS (SELECT fromdate, shopcode, count(pawnid) AS num_created_pawn FROM fresh GROUP BY fromdate, shopcode),
    files AS (
        SELECT pawnid, count(pawnassetfileid) AS nums_image, min(uploaded) AS first_upload, max(uploaded) AS last_upload
        FROM images GROUP BY pawnid),
    payouts AS (
        SELECT contract_no AS codeno, min(created) AS complete
        FROM transactions WHERE action_name = {sql_parts.text(fv.DISBURSEMENT)} GROUP BY contract_no),
    facts AS (
        SELECT fresh.*, any_loan, same_kind, customer_score, num_created_pawn, nums_image, first_upload, last_upload, complete,
               contract_times.openhour, category_dim.name AS category_name,
               date_diff('day', any_loan.ended, fresh.fromdate) AS idle_days
        FROM fresh
        JOIN contract_times ON contract_times.codeno = fresh.codeno AND contract_times.openhour IS NOT NULL
        LEFT JOIN earlier ON earlier.pawnid = fresh.pawnid
        LEFT JOIN rated ON rated.customerid = fresh.customerid
        LEFT JOIN daily ON daily.fromdate = fresh.fromdate AND daily.shopcode = fresh.shopcode
        LEFT JOIN files ON files.pawnid = fresh.pawnid
        LEFT JOIN payouts ON payouts.codeno = fresh.codeno
        LEFT JOIN category_dim ON category_dim.code = fresh.categorycode)
    SELECT fromdate AS extract_date, customername AS customer_name, shopcode, packagecode, fromdate, pawnid, codeno, category_name,
           if(contains(coalesce(packagecode, ''), '{fv.QUICK_MARK}'), '{fv.QUICK_LOAN}', '{fv.ORDINARY_LOAN}') AS package_name,
           papertype, CAST(net AS DOUBLE) / nullif(CAST(moneyappraisal AS DOUBLE), 0) AS ltv_index, net AS net_disbur,
           CASE WHEN contains(categorycode, '{fv.BIKE_TITLE_CODE}') THEN {sql_parts.band('net', fv.BIKE_TITLE_SIZES, inclusive=True)}
                WHEN NOT contains(categorycode, '{fv.CAR_TITLE_CODE}') THEN NULL
                WHEN net > 200000000 AND packagecode IS NOT NULL THEN {_CAR_SIZES['over_200']}
                ELSE ([{_CAR_SIZES['to_50']}, {_CAR_SIZES['to_100']}, {_CAR_SIZES['to_200']}, {_CAR_SIZES['to_300']}, {_CAR_SIZES['over_300']}])
                     [1 + len(list_filter([50, 100, 200, 300], lambda edge: net > edge * 1000000))] END AS package_money_range,
           {sql_parts.band('frequency', fv.TERM_RANGES, inclusive=True)} AS package_time_range,
           if(same_kind IS NULL, '{fv.NEW_CUSTOMER}', '{fv.RETURNING_CUSTOMER}') AS cus_type,
           CASE WHEN any_loan.status IS NULL THEN '{fv.FIRST_LOAN}'
                WHEN {sql_parts.one_of('any_loan.status', fv.BAD_DEBT_STATUSES)} THEN '{fv.BAD_DEBT}'
                WHEN any_loan.status = {fv.TOP_UP_STATUS} THEN '{fv.TOP_UP}'
                WHEN any_loan.status = {fv.CLOSED_STATUS} AND same_kind.ended = fromdate THEN '{fv.ROLLOVER}'
                ELSE {sql_parts.band('idle_days', fv.REOPEN_AFTER, inclusive=True)} END AS open_type,
           num_created_pawn, customer_score, nums_image, complete, openhour, hour(openhour) AS open_hour_extracted,
           date_diff('minute', inittime, complete) AS processing_minute, first_upload, last_upload,
           date_diff('minute', openhour, first_upload) AS first_upload_to_open,
           date_diff('minute', openhour, last_upload) AS last_upload_to_open
    FROM facts"""

_TEXT_DATES = ("CAST(extract_date AS VARCHAR) AS extract_date, CAST(fromdate AS VARCHAR) AS fromdate, "
               "CAST(complete AS VARCHAR) AS complete, CAST(openhour AS VARCHAR) AS openhour, "
               "CAST(first_upload AS VARCHAR) AS first_upload, CAST(last_upload AS VARCHAR) AS last_upload, "
               "round(ltv_index, 6) AS ltv_index, round(CAST(net_disbur AS DOUBLE), 6) AS net_disbur")

_ENRICHED = f"""
    SELECT f.* REPLACE (coalesce(customer_score, avg(customer_score) OVER ()) AS customer_score,
                        CAST(net_disbur AS DOUBLE) / 1000000 AS net_disbur),
           name AS shop_name, province, shop_focus_level,
           shop_nums_checked_day, total_num_checked_pawn, shop_checked_rate,
           coalesce(nums_day_in_month, day(extract_date)) AS nums_day_in_month,
           coalesce(average_nums_checked_pawn, 0) AS average_nums_checked_pawn,
           coalesce(ols_pred_score, 250.0) AS ols_pred_score
    FROM (SELECT * FROM features WHERE category_name IS NULL OR category_name NOT IN ('Đăng ký Ô tô', 'Ô tô')) f
    LEFT JOIN shops ON shops.code = f.shopcode LEFT JOIN shop_info ON shop_info.shopcode = f.shopcode
    LEFT JOIN focus ON focus.shop = name LEFT JOIN history ON history.shopname = name
    LEFT JOIN predicted_scores p ON p.shopname = name"""

_GLOBAL = {"cus_score": "customer_score", "num_created_pawn": "num_created_pawn", "ols_pred_score": "ols_pred_score",
           "open_hour_extracted": "open_hour_extracted", "average_nums_checked_pawn": "average_nums_checked_pawn"}
_SPECIFIC = {"first_upload_to_open": "first_upload_to_open", "last_upload_to_open": "last_upload_to_open",
             "ltv_index": "ltv_index", "nums_image": "nums_image", "package_money_range": "net_disbur",
             "processing_minute": "processing_minute"}
_ENDS = {"cus_score": ("NULL", 1000), "ols_pred_score": (-1000, "NULL"), "average_nums_checked_pawn": (0, 10),
         "ltv_index": (0, 2), "nums_image": (0, 999), "package_money_range": (0, 9999),
         "first_upload_to_open": (-99999, 99999), "last_upload_to_open": (-99999, 99999),
         "processing_minute": (-99999, 99999)}


def _score_joins():
    joins, scores = [], []
    for i, (field, value) in enumerate({**_GLOBAL, **_SPECIFIC}.items()):
        lo, hi = _ENDS.get(field, ("NULL", "NULL"))
        test = f"n{i}.field_check = '{field}' AND {value} >= coalesce(n{i}.min_value, {lo}) AND {value} < coalesce(n{i}.max_value, {hi})"
        test += f" AND n{i}.categoryname = " + ("'All'" if field in _GLOBAL else "e.category_name")
        if field == "processing_minute":
            test += f" AND coalesce(n{i}.package_name, 'Vay thường') = e.package_name"
        joins.append(f"JOIN numeric_card n{i} ON {test}")
        scores.append((f"n{i}.risk_score", field))
    for i, field in enumerate(("papertype", "open_type", "cus_type", "package_time_range")):
        test = f"c{i}.field_check = '{field}' AND c{i}.value = e.{field}"
        if field == "package_time_range":
            test += f" AND c{i}.categoryname = e.category_name"
        joins.append(f"LEFT JOIN categorical_card c{i} ON {test}")
        scores.append((f"c{i}.risk_score", field))
    return joins, scores


_JOINS, _SCORES = _score_joins()
_SCORED = f"""
    SELECT e.*, {', '.join(f'{s} AS {f}_risk_score' for s, f in _SCORES)}, package_code, package_from_date,
           package_to_date, package_active_stt, package_focus_level,
           {' + '.join(f'coalesce({s}, 0)' for s, _ in _SCORES)} AS total_score
    FROM enriched e {' '.join(_JOINS)}
    LEFT JOIN (SELECT * EXCLUDE (package_name) FROM focus_packages
               WHERE DATE '{AS_OF}' BETWEEN package_from_date AND package_to_date) fp
        ON fp.package_code = e.packagecode AND e.category_name = 'Đăng ký xe máy'"""

_CTES = {"features": _FEATURES, "history": _HISTORY, "focus": _FOCUS, "enriched": _ENRICHED, "scored": _SCORED}


def _checking(risk_type, source):
    return f"""
    SELECT DISTINCT strftime(extract_date, '%Y%m') AS year_month, CAST(extract_date AS VARCHAR) AS extrac_date,
           shop_name AS shopname, shopcode, customer_name AS cusname, codeno, category_name AS cate,
           CAST(NULL AS VARCHAR) AS reason_check, '{risk_type}' AS risk_type FROM ({source})"""


_AUDIT = _checking("Tuân thủ", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category_name = 'Đăng ký xe máy'
                                                ORDER BY total_score DESC, pawnid) AS rn FROM scored)
    WHERE rn <= CASE WHEN category_name = 'Đăng ký xe máy' THEN 26 ELSE 14 END""")
_CARS = _checking("Hậu kiểm thẩm định ĐKOT", """
    SELECT * FROM (SELECT f.*, name AS shop_name, row_number() OVER (PARTITION BY package_name = 'Vay nhanh'
                                                                    ORDER BY net_disbur DESC, pawnid) AS rn
                   FROM features f LEFT JOIN shops ON shops.code = f.shopcode WHERE category_name = 'Đăng ký Ô tô')
    WHERE rn <= 1""")

def _due(actions, planned):
    return f"""
    SELECT *, CASE WHEN status LIKE '%Đang%' AND due >= 0 AND due < 3 THEN 4 WHEN status LIKE '%Đang%' AND due < 0 THEN 3
                   WHEN status LIKE '%Đang%' AND updated <= -6 THEN 2 WHEN status LIKE '%Chưa%' AND planned <= -2 THEN 1 END AS warning_type
    FROM (SELECT *, date_diff('day', DATE '{AS_OF}', deadline) AS due, date_diff('day', DATE '{AS_OF}', update_date) AS updated,
                 date_diff('day', DATE '{AS_OF}', {planned}) AS planned FROM {actions})"""


def _outbox_sql(kind, actions="action_list", planned="recommend_date"):
    escalated = ";".join(P.ESCALATE_TO)
    return query(f"""
    SELECT '{kind}' AS kind, no, assignee, warning_type,
           CASE WHEN warning_type >= 3 THEN contact || ';{escalated}' ELSE contact END AS recipients,
           '[CẢNH BÁO NỘI BỘ] CẬP NHẬT TIẾN ĐỘ THỰC HIỆN {kind} TẠI ' || upper(risk_owner) AS subject,
           concat_ws(chr(10), 'Dear ' || assignee || ',',
               CASE warning_type
                   WHEN 1 THEN '{kind} số ' || no || yearmonth || ' đã ' || abs(planned) || ' ngày Chưa chốt kế hoạch thực hiện'
                   WHEN 2 THEN '{kind} số ' || no || yearmonth || ' đã ' || abs(updated) || ' ngày Chưa có cập nhật mới về tiến độ thực hiện'
                   WHEN 3 THEN '{kind} số ' || no || yearmonth || ' đã quá Dealine cam kết hoàn thành ' || abs(due) || ' ngày.'
                   ELSE '{kind} số ' || no || yearmonth || '  Đang thực hiện còn ' || abs(due) || ' ngày nữa sẽ đến Deadline cam kết.' END,
               ' ',
               CASE warning_type
                   WHEN 1 THEN 'Bạn cần liên hệ với đại diện ' || risk_owner || ' thực hiện Chốt kế hoạch sớm nhất có thể'
                   WHEN 2 THEN 'Bạn cần liên hệ với ' || risk_owner || ' cập nhật tiến độ thực hiện mới nhất của khuyến nghị này.'
                   ELSE 'Bạn cần liên hệ với ' || risk_owner || ' cập nhật lại tiến độ thực hiện mới nhất của khuyến nghị này.' END,
               'Chi tiết Khuyến nghị', content, 'Truy cập Link Quản lý Khuyến nghị/Sự vụ sau để cập nhật: ', '{P.ACTION_LINK}',
               '-------------', 'Trân trọng') AS body
    FROM ({_due(actions, planned)}) JOIN contacts USING (assignee) WHERE warning_type IS NOT NULL""")


SQL = {
    "shop_check_history": query(
        f"SELECT * REPLACE (round(shop_checked_rate, 6) AS shop_checked_rate, "
        f"round(average_nums_checked_pawn, 6) AS average_nums_checked_pawn) FROM ({_HISTORY})"),
    "focus_shops": query(_FOCUS),
    "compliance_features": query(f"SELECT * REPLACE ({_TEXT_DATES}) FROM features", features=_FEATURES),
    "car_title_features": query(
        f"SELECT * REPLACE ({_TEXT_DATES}) FROM features WHERE category_name = 'Đăng ký Ô tô'", features=_FEATURES),
    "scorecard": query(
        f"SELECT * REPLACE ({_TEXT_DATES.rsplit(', round', 1)[0]}, CAST(package_from_date AS VARCHAR) AS package_from_date, "
        "CAST(package_to_date AS VARCHAR) AS package_to_date, round(customer_score, 6) AS customer_score, "
        "CAST(round(CAST(net_disbur AS DECIMAL(18,8)), 6) AS DOUBLE) AS net_disbur, "
        "round(shop_checked_rate, 6) AS shop_checked_rate, round(average_nums_checked_pawn, 6) AS average_nums_checked_pawn, "
        "round(total_score, 6) AS total_score) FROM scored", **_CTES),
    "audit_sample": query(_AUDIT, **_CTES),
    "car_title_sample": query(_CARS, features=_FEATURES),
    "all_samples": query(f"{_AUDIT} UNION {_CARS}", **_CTES),
    "reminders_risk_recommendation": _outbox_sql("KHUYẾN NGHỊ QTRR"),
    "reminders_audit_recommendation": _outbox_sql("KHUYẾN NGHỊ KTNB", "audit_list"),
    "reminders_audit_issue": _outbox_sql("SỰ VỤ", "issue_list", "concluded_date"),
    "reminder_errors": query(f"""
        SELECT 'KHUYẾN NGHỊ QTRR' AS kind, no, assignee, warning_type FROM ({_due('action_list', 'recommend_date')})
        WHERE warning_type IS NOT NULL AND assignee NOT IN (SELECT assignee FROM contacts)"""),
}
