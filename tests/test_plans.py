import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loantide.plans import alerts, audit, cash, compliance, flows, fraud, limits, reminders, scorecard
from loantide.sources import schemas

D = dt.date


def snapshot_row(pawnid, dpd, created, category="Đăng ký xe máy", shop="S1", code="C17", money=100, customer=1, fromdate=D(2020, 1, 1)):
    values = {"created": created, "yearmonth": created.year * 100 + created.month, "pawnid": pawnid,
              "contractcode": f"HDCC/{pawnid}", "customerid": customer, "customername": "n", "categoryname": category,
              "categorycode": code, "shopname": shop and f"shop {shop}", "shopcode": shop, "currentmoney": Decimal(money),
              "fromdate": fromdate, "frequency": 65, "tuoino": dpd, "status": 10}
    return tuple(values.get(f) for f in schemas.SNAPSHOT.fieldNames())


def snap(spark, *data):
    return spark.createDataFrame(list(data), schemas.SNAPSHOT)


OB, CB = D(2020, 5, 31), D(2020, 6, 29)


def test_flow_rate_partitions_each_bucket(spark):
    opening = snap(spark, *[snapshot_row(i, d, OB, money=10 + i) for i, d in enumerate([0, 0, 0, 1, 30, 31, 151, None])],
                   snapshot_row(50, 0, OB, shop="TEST9"), snapshot_row(51, 0, OB, shop="HS1"), snapshot_row(52, 0, OB, category="Xe máy"))
    closing = snap(spark, *[snapshot_row(i, d, CB) for i, d in [(0, 0), (1, 5), (3, 0), (4, 29), (5, 200)]])
    got = flows.flow_rate(opening, closing, OB, CB).collect()
    by_bucket = {}
    for r in got:
        by_bucket.setdefault(r["ob_bucket_name"], []).append(r)
    assert {k: sorted((r["flow"], r["transit_pawn_count"]) for r in v) for k, v in by_bucket.items()} == {
        "0.Trong hạn": [("Cured", 1), ("Rolled", 1), ("Stuck", 1)],
        "1.1-30 ngày": [("Cured", 1), ("Stuck", 1)],
        "2.31-60 ngày": [("Rolled", 1)],
        "6.151++": [("Cured", 2)],
    }
    for group in by_bucket.values():
        assert sum(r["flow_rate"] for r in group) == pytest.approx(1.0)
        assert sum(r["transit_pawn_count"] for r in group) == group[0]["ob_pawn"]


def test_flow_history_equals_single_pairs(spark):
    days = [D(2020, 4, 30), D(2020, 5, 29), D(2020, 5, 31), D(2020, 6, 29)]
    panel = snap(spark, *[snapshot_row(i, (d - D(2020, 5, 1)).days + 7 * i, d) for d in days for i in range(9) if (i + d.day) % 4])
    history = flows.flow_history(panel, "2020-06-29", 2)
    single = [flows.flow_rate(panel.where(F.col("created") == a), panel.where(F.col("created") == b), a, b)
              for a, b in [(days[2], days[3]), (days[0], days[1])]]
    assert rows(history) == rows(single[0].unionByName(single[1]))


def test_flow_detail_keeps_rows_without_shop(spark):
    opening = snap(spark, snapshot_row(1, 0, OB), snapshot_row(2, 0, OB, shop="S2"))
    shops = spark.createDataFrame([("S1", "shop S1", 1)], schemas.SHOP)
    got = flows.flow_detail(opening, opening, shops, OB, CB).select("pawnid", "areaid", "duration", "ob_bucket_pawn_count")
    assert rows(got) == [(1, 1, 2, 1), (2, None, 2, 1)]


def test_alert_cutoff_is_end_of_day(spark):
    data = [(1, "HDCC/1", dt.datetime(2020, 6, 15, 23, 59, 59), 3), (2, "HDCC/1", dt.datetime(2020, 6, 16, 0, 0, 0), 9)]
    df = spark.createDataFrame([(a, c, t, d, None, None, "x", "", None, None, None, None) for a, c, t, d in data], schemas.ALERT)
    got = alerts.first_and_last_alerts(df, "2020-06-15").select("first.dpd", "last.dpd")
    assert rows(got) == [(3, 3)]
    assert rows(alerts.first_and_last_alerts(df, "2020-06-16").select("first.dpd", "last.dpd")) == [(3, 9)]


def cash_row(diff, minus, add, red=0):
    return (dt.datetime(2020, 6, 1, 9), "A", Decimal(0), Decimal(red), Decimal(diff), minus, add)


def test_cash_rules_override_in_order(spark):
    counts = spark.createDataFrame(
        [cash_row(20000, "lệch", None), cash_row(20000, "nhập, NHẦM", None), cash_row(20000, "nhầm", "chưa, rõ"),
         cash_row(0, "đủ", None), cash_row(0, "đủ", None, red=51), cash_row(-10001, " ".join(["a"] * 30), None)],
        schemas.CASH_COUNT)
    limits_ = spark.createDataFrame([("A", Decimal(50))], "shop string, limit_amt decimal(18,2)")
    got = cash.cash_count_check(counts, limits_, "2020-06-01").select("diff_reason", "diff_type", "limit_check", "diff_reason_check")
    assert rows(got) == sorted([
        ("lệch ", "âm quỹ", "ok", "Không có lý do"),
        ("nhập nhầm ", "âm quỹ", "ok", "Lý do lệch không rõ ràng"),
        ("nhầm chưa rõ", "âm quỹ", "ok", "Lệch không rõ nguyên nhân"),
        ("đủ ", "ok", "Vượt hạn mức dư quỹ", "ok"),
        (" ".join(["a"] * 30) + " ", "dương quỹ", "ok", "Lý do lệch không rõ ràng"),
    ], key=repr)


def contract(pawnid, fromdate, closedate=None, status=1, customer=1, category="C02", shop="S1"):
    values = {"pawnid": pawnid, "codeno": f"HDCC/{pawnid}", "customerid": customer, "categorycode": category, "shopcode": shop,
              "status": status, "fromdate": fromdate, "closedate": closedate, "todate": fromdate}
    return tuple(values.get(f) for f in schemas.CONTRACT.fieldNames())


def test_quick_close_needs_an_earlier_contract(spark):
    wed = D(2020, 6, 3)
    contracts = spark.createDataFrame([
        contract(1, D(2020, 1, 1), D(2020, 2, 1)), contract(2, D(2020, 6, 1), wed),          # returning: listed
        contract(3, D(2020, 6, 1), wed, customer=2),                                          # first loan
        contract(4, D(2020, 1, 1), D(2020, 2, 1), customer=3, category="C01"),
        contract(5, D(2020, 6, 1), wed, customer=3),                                          # other category before
        contract(6, D(2020, 6, 1), D(2020, 6, 5)),                                            # a Friday
        contract(7, D(2020, 6, 1), wed, customer=4), contract(8, D(2020, 6, 1), wed, customer=4),  # same day: the later id
    ], schemas.CONTRACT)
    shops = spark.createDataFrame([("S1", "one", 1)], schemas.SHOP)
    people = spark.createDataFrame([(1, "a"), (4, "d")], "customerid long, customername string")
    names = spark.createDataFrame([("C02", "Điện thoại")], "code string, name string")
    got = fraud.quick_close(contracts, shops, people, names, wed, D(2020, 6, 5))
    assert rows(got.select("pawnid", "real_loan_days", "customer")) == [(2, 2, "a"), (8, 2, "d")]


def test_title_limit_ignores_rollovers(spark):
    day = D(2020, 6, 10)
    titles = snap(spark, snapshot_row(1, 0, day, customer=1, fromdate=D(2020, 1, 1)), snapshot_row(2, 0, day, customer=1, fromdate=day),
                  snapshot_row(3, 0, day, customer=2, fromdate=D(2020, 1, 1)), snapshot_row(4, 0, day, customer=2, fromdate=day),
                  snapshot_row(5, 0, day, customer=3, fromdate=day))
    closed = spark.createDataFrame([contract(9, D(2019, 1, 1), day, customer=2, category="C17")], schemas.CONTRACT)
    assert rows(limits.over_title_limit(titles, closed, day).select("pawnid")) == [(1,), (2,)]


def features(spark, **change):
    base = {"pawnid": 1, "category_name": "Điện thoại", "package_name": "Vay thường", "packagecode": None, "papertype": "KT1",
            "open_type": "o", "cus_type": "c", "package_time_range": "t", "customer_score": 5.0, "num_created_pawn": 1,
            "ols_pred_score": 1.0, "open_hour_extracted": 9, "average_nums_checked_pawn": 0.0, "first_upload_to_open": 1,
            "last_upload_to_open": 1, "ltv_index": 0.5, "nums_image": 1, "net_disbur": Decimal(2_000_000),
            "processing_minute": 10, "extract_date": D(2020, 6, 9), "nums_day_in_month": None}
    kinds = ("pawnid long, category_name string, package_name string, packagecode string, papertype string, open_type string, "
             "cus_type string, package_time_range string, customer_score double, num_created_pawn long, ols_pred_score double, "
             "open_hour_extracted int, average_nums_checked_pawn double, first_upload_to_open long, last_upload_to_open long, "
             "ltv_index double, nums_image long, net_disbur decimal(18,2), processing_minute long, extract_date date, "
             "nums_day_in_month int")
    cases = change.pop("cases", [{}])
    return spark.createDataFrame([tuple({**base, "pawnid": i, **case}.values()) for i, case in enumerate(cases)], kinds)


def cards(spark, extra=()):
    everywhere = ["cus_score", "num_created_pawn", "ols_pred_score", "open_hour_extracted", "average_nums_checked_pawn"]
    own = ["first_upload_to_open", "last_upload_to_open", "ltv_index", "nums_image", "package_money_range", "processing_minute"]
    numeric = [("All", f, 0.0, 100.0, None, 1.0) for f in everywhere] + [("Điện thoại", f, None, None, None, 1.0) for f in own]
    categorical = [("All", "papertype", "KT1", 2.0), ("x", "papertype", "KT1", 2.0), ("Điện thoại", "package_time_range", "t", 4.0)]
    return (spark.createDataFrame(categorical, schemas.CATEGORICAL_CARD),
            spark.createDataFrame(numeric + list(extra), schemas.NUMERIC_CARD))


def no_packages(spark):
    return spark.createDataFrame([], schemas.FOCUS_PACKAGE)


def test_scorecard_misses(spark):
    cases = [{}, {"papertype": "KT9"}, {"ltv_index": 2.0}, {"ltv_index": 1.99}, {"customer_score": None},
             {"category_name": "Đăng ký Ô tô"}, {"ltv_index": None}, {"package_name": "Vay nhanh"}, {"customer_score": 100.0}]
    scored = scorecard.scorecard(features(spark, cases=cases), *cards(spark), no_packages(spark))
    got = {r["pawnid"]: r for r in scored.collect()}
    assert set(got) == {0, 1, 3, 4}
    assert got[0]["total_score"] == 17.0 and got[1]["total_score"] == 15.0
    assert got[4]["customer_score"] == pytest.approx((5.0 * 6 + 100) / 7)
    assert got[0]["nums_day_in_month"] == 9 and got[0]["net_disbur"] == 2.0


def test_overlapping_bins_fail_loudly(spark):
    clash = [("Điện thoại", "nums_image", 5.0, 9.0, None, 1.0)]
    with pytest.raises(Exception, match="overlapping bins in nums_image"):
        scorecard.scorecard(features(spark), *cards(spark, clash), no_packages(spark)).collect()


def test_scorecard_with_a_large_card(spark):
    """200,000 lines of one field; each contract still finds its own."""
    categorical, numeric = cards(spark)
    many = spark.range(200_000).select(
        F.lit("Điện thoại").alias("categoryname"), F.lit("nums_image").alias("field_check"), F.col("id").cast("double").alias("min_value"),
        (F.col("id") + 1).cast("double").alias("max_value"), F.lit(None).cast("string").alias("package_name"),
        (F.col("id") % 7).cast("double").alias("risk_score"))
    numeric = numeric.where("field_check <> 'nums_image'").unionByName(many)
    cases = [{"nums_image": n} for n in (0, 5, 100_000, 199_999, 200_000)]
    scored = scorecard.scorecard(features(spark, cases=cases), categorical, numeric, no_packages(spark), F.lit(1.0))
    got = {r["pawnid"]: r["nums_image_risk_score"] for r in scored.collect()}
    assert got == {0: 0.0, 1: 5.0, 2: float(100_000 % 7), 3: float(199_999 % 7)}


def test_scorecard_plan(spark):
    """One join meets both cards, on places; no lines are gathered, and a card that is no small one is shuffled."""
    scored = scorecard.scorecard(features(spark), *cards(spark), no_packages(spark), F.lit(1.0))
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(struct(low" not in plan and plan.count("line_place") >= 2 and "filter(" not in plan
    blank = spark.createDataFrame([("All", "papertype", None, 3.0)], schemas.CATEGORICAL_CARD)
    categorical, numeric = cards(spark)
    got = scorecard.scorecard(features(spark, cases=[{"papertype": None}, {"package_name": None}]), categorical.unionByName(blank), numeric, no_packages(spark)).collect()
    assert [(r["pawnid"], r["papertype_risk_score"]) for r in got] == [(0, 3.0)]


def test_audit_quotas():
    assert audit.QUOTAS == {"title": 26, "other": 14}


def test_focus_and_history(spark):
    sheet = spark.createDataFrame([(D(2020, 1, 1), D(2020, 12, 31), "on", "A", "Low"), (D(2020, 5, 1), D(2020, 12, 31), "on", "A", "High"),
                                   (D(2020, 7, 1), D(2020, 12, 31), "on", "A", "Later")], schemas.FOCUS_SHOP)
    assert rows(compliance.focus_shops(sheet, "2020-06-09")) == [("A", "High")]
    log = spark.createDataFrame([("", d, "A", "a", "c", str(i), "x", None, r) for i, (d, r) in enumerate(
        [("2020-06-01", "Tuân thủ"), ("2020-06-01", "Tuân thủ"), ("2020-06-03", "Tuân thủ"), ("2020-05-31", "Tuân thủ"),
         ("2020-06-02", "Gian lận"), ("bad", "Tuân thủ")])], schemas.CHECKING_LOG)
    assert rows(compliance.shop_check_history(log, "2020-06-10")) == [("A", 2, 3, 10, 0.2, 0.3)]


def action(no, status, recommend, update, deadline, assignee="a"):
    as_of = D(2020, 6, 10)
    shift = lambda n: None if n is None else as_of + dt.timedelta(days=n)
    return (no, "/202006", status, shift(recommend), shift(update), shift(deadline), assignee, "ops", "detail")


def test_reminders(spark):
    kinds = ("no string, yearmonth string, status string, recommend_date date, update_date date, deadline date, assignee string, "
             "risk_owner string, content string")
    data = [action("1", "Chưa làm", -2, None, -9), action("2", "Chưa làm", -1, None, -9), action("3", "Đang làm", -9, -6, 5),
            action("4", "Đang làm", -9, -6, -1), action("5", "Đang làm", -9, -6, 0), action("6", "Đang làm", -9, -6, 3),
            action("7", "Đang làm", -9, -5, None), action("8", None, -9, -9, -9), action("9", "Đang làm", -9, -6, 2, "nobody")]
    # Issues carry the day they were concluded; recommendations carry the day they were made.
    actions = spark.createDataFrame(data, kinds.replace("recommend_date", "concluded_date"))
    contacts = spark.createDataFrame([("a", "a@example.org")], schemas.CONTACT)
    made = reminders.due_actions(spark.createDataFrame(data, kinds), "KHUYẾN NGHỊ QTRR", "2020-06-10")
    assert rows(made.select("no", "warning_type", "days"))[0] == ("1", 1, 2)
    out = reminders.reminders(actions, contacts, "SỰ VỤ", "2020-06-10", "link", ["boss@example.org"])
    assert rows(out.select("no", "warning_type")) == [("1", 1), ("3", 2), ("4", 3), ("5", 4), ("6", 2)]
    mails = {r["no"]: r for r in out.collect()}
    assert mails["1"]["recipients"] == ["a@example.org"]
    assert mails["4"]["recipients"] == ["a@example.org", "boss@example.org"]
    assert mails["4"]["body"].split("\n")[1] == "SỰ VỤ số 4/202006 đã quá Dealine cam kết hoàn thành 1 ngày."
    assert mails["1"]["subject"].endswith("SỰ VỤ TẠI OPS")
    assert rows(reminders.reminder_errors(actions, contacts, "SỰ VỤ", "2020-06-10").select("no")) == [("9",)]


def test_contracts_near_the_counts(spark):
    """Inside the window but near a count: kept only when the processing time is unusual for the category."""
    at = lambda h, m=0: dt.datetime(2020, 6, 9, h, m)
    counts = spark.createDataFrame([(1, "S", at(8)), (1, "S", at(12)), (1, "S", at(19, 30))], "shop_id int, shop_name string, created timestamp")
    opened = {"start": at(8, 10), "start_usual": at(8, 15), "late_start": at(8, 16), "end": at(19, 15), "early_end": at(19, 14),
              "before": at(8), "after": at(19, 30), "bike": at(8, 10)}
    times = spark.createDataFrame([(c, "x", t, None) for c, t in opened.items()],
                                  "codeno string, customer string, openhour timestamp, closehour timestamp")
    contracts = spark.createDataFrame([(c, 1, "s", "B" if c == "bike" else "A", 14, t) for c, t in opened.items()],
                                      "codeno string, shopid int, shopcode string, categorycode string, status int, inittime timestamp")
    minutes = {c: 30 if c == "start_usual" else 200 for c in opened}
    paid = spark.createDataFrame([(c, t + dt.timedelta(minutes=minutes[c]), "Cho vay") for c, t in opened.items()],
                                 "contract_no string, created timestamp, action_name string")
    categories = spark.createDataFrame([("A", "Điện thoại"), ("B", "Xe máy")], "code string, name string")
    limits_ = spark.createDataFrame([(n, 5.0, 100.0) for n in ("Điện thoại", "Xe máy")],
                                    "category_name string, lower_threshold double, upper_threshold double")
    got = fraud.cash_count_window(counts, contracts, times, paid, categories, limits_, "2020-06-09", "2020-06-09")
    from loantide.functions import fixed_values as labels

    assert dict(tuple(r) for r in got.select("codeno", "pawn_fraud_group").collect()) == {
        "start": labels.NEAR_DAY_START, "end": labels.NEAR_DAY_END, "before": labels.BEFORE_FIRST_COUNT, "after": labels.AFTER_LAST_COUNT}


def test_card_lines_stay_short(spark):
    """Each open end stands once in the expression of a line; copies of it once doubled with every field, too long to compile."""
    lines = scorecard.numeric_lines(cards(spark)[1])
    assert len(lines._jdf.queryExecution().optimizedPlan().toString()) < 4_000
    open_ends = [("Điện thoại", f, None, None, None, 1.0) for f in ("ltv_index", "cus_score", "num_created_pawn")]
    got = scorecard.numeric_lines(spark.createDataFrame(open_ends, schemas.NUMERIC_CARD)).select("field_check", "low", "high")
    assert sorted(map(tuple, got.collect())) == [("cus_score", None, 1000.0), ("ltv_index", 0.0, 2.0), ("num_created_pawn", None, None)]
