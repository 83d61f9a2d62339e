import datetime as dt
import re

from pyspark.sql import functions as F

from loantide.functions import dates, numbers, rules, text
from loantide.functions.buckets import SCHEMES, bucket_dpd


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_bucket_edges(spark):
    values = [-3, 0, 1, 30, 31, 60, 61, 90, 91, 120, 121, 150, 151, None]
    df = spark.createDataFrame([(v,) for v in values], "d int")
    ordinal, label = bucket_dpd(F.col("d"), "flow7")
    got = one(df, ordinal, label)
    assert [g[0] for g in got] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]
    assert all(int(name[0]) == code for code, name in got)
    closing, name = bucket_dpd(F.col("d"), "flow7", closed_when_null=True)
    assert one(df, closing, name)[-1] == (-1, "-1. Đã đóng")


def test_daily_and_chip_buckets(spark):
    df = spark.createDataFrame([(v,) for v in (0, 10, 11, 120, 121)], "d int")
    assert [r[0] for r in one(df, bucket_dpd(F.col("d"), "daily2")[0])] == [0, 0, 1, 1, 1]
    assert [r[0] for r in one(df, bucket_dpd(F.col("d"), "chip6")[0])] == [0, 1, 1, 4, 5]
    assert all(bands[-1][0] is None for bands in SCHEMES.values())


def test_later_rules_override(spark):
    df = spark.createDataFrame([(1,), (6,), (4,)], "x int")
    tests = [(F.col("x") > 0, "any"), (F.col("x") > 3, "big"), (F.col("x") > 5, "huge")]
    assert [r[0] for r in one(df, rules.last_match(tests, "none"))] == ["any", "huge", "big"]
    assert {r[0] for r in one(df, rules.first_match(tests, "none"))} == {"any"}


def test_minute_boundaries_and_elapsed(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1, 10, 0, 59), dt.datetime(2020, 1, 1, 10, 1, 0)),
         (dt.datetime(2020, 1, 1, 10, 0, 0), dt.datetime(2020, 1, 1, 10, 0, 59)),
         (dt.datetime(2020, 1, 2, 0, 0, 10), dt.datetime(2020, 1, 1, 23, 59, 50)),
         (dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 3, 0, 1, 0))], "a timestamp, b timestamp")
    assert [r[0] for r in one(df, dates.minute_boundaries(F.col("a"), F.col("b")))] == [1, 0, -1, 2881]
    assert one(df, dates.elapsed_minutes(F.col("a"), F.col("b")))[3][0] == 2881.0


def test_month_pairs_cross_the_year():
    assert dates.month_pairs("2021-03-30", 4) == [
        (dt.date(2021, 2, 28), dt.date(2021, 3, 30)),
        (dt.date(2021, 1, 31), dt.date(2021, 2, 28)),
        (dt.date(2020, 12, 31), dt.date(2021, 1, 30)),
        (dt.date(2020, 11, 30), dt.date(2020, 12, 30)),
    ]


def test_text_matches_python(spark):
    samples = ["Nhầm, (2) tiền!", "áb_c-d", "  hai  ô ", "", "x y…z", "số 5%"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = one(df, text.strip_punctuation(F.col("s")), text.word_count(F.col("s")))
    assert got == [(re.sub(r"[^\w\s]", "", s), len(s.split(" "))) for s in samples]


def test_prefix_and_thousands(spark):
    df = spark.createDataFrame([("HDCC/77", "1,234,567"), ("HD", "n/a"), (None, " 12 ")], "c string, n string")
    assert [r[0] for r in one(df, text.after_prefix(F.col("c"), 5))] == ["77", "", None]
    assert [r[0] for r in one(df, numbers.thousands_text_to_long(F.col("n")))] == [1234567, None, 12]


def test_null_paper_type_depends_on_report(spark):
    df = spark.createDataFrame([("KT1",), ("KT2",), (None,)], "p string")
    assert [r[0] for r in one(df, rules.paper_class(F.col("p"), "KT1"))] == ["KT1", "KT3", "KT1"]
    assert [r[0] for r in one(df, rules.paper_class(F.col("p"), "KT3"))] == ["KT1", "KT3", "KT3"]


def test_open_type_rules(spark):
    day = dt.date(2020, 5, 1)
    data = [(None, None, None), (77, day, 5), (14, None, None), (1, day, 0), (1, dt.date(2020, 4, 1), 30),
            (1, dt.date(2020, 3, 31), 31), (1, dt.date(2019, 1, 1), 181), (10, None, None)]
    df = spark.createDataFrame(data, "s int, c date, d int")
    got = [r[0] for r in one(df, rules.open_type(F.col("s"), F.col("c"), F.lit(day), F.col("d")))]
    assert got == ["KH mới vay lần đầu", "KH đang nợ xấu", "7.Vay thêm", "0.Đáo hạn", "1.Mở lại từ 1-30 ngày",
                   "2.Mở lại từ 31-60 ngày", "5.Mở lại từ 181 ngày", "1.Mở lại từ 1-30 ngày"]


def test_parse_date_of_dirty_text(spark):
    df = spark.createDataFrame([("2020-02-29",), ("",), ("29/02",), (None,)], "s string")
    assert [r[0] for r in one(df, dates.parse_date(F.col("s")))] == [dt.date(2020, 2, 29), None, None, None]
