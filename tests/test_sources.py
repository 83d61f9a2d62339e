import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loantide.functions import fixed_values as fv
from loantide.sources import readers, schemas, versions, writers


def log_rows(spark, day, risk, codes):
    return spark.createDataFrame([("202006", day, "S", "s1", "c", code, "cat", None, risk) for code in codes],
                                 schemas.CHECKING_LOG)


def test_log_append_replaces_exactly_its_run(spark, folder):
    path = f"{folder}/log"
    add = lambda run, day, risk, codes: writers.append_log(log_rows(spark, day, risk, codes), path, fv.CHECKING_COLUMNS, run)
    add("fraud-0601", "2020-06-01", "Gian lận", ["a", "b"])
    add("cash-0601", "2020-06-01", "Gian lận", ["c", "d"])
    add("fraud-0602", "2020-06-02", "Gian lận", ["e"])
    add("audit-0602", "2020-06-02", "Tuân thủ", ["f"])
    log = lambda: readers.read_checking_log(spark, path)
    assert rows(log().select("codeno")) == [("a",), ("b",), ("c",), ("d",), ("e",), ("f",)]
    assert dict(log().dtypes)["extrac_date"] == "string" and log().columns == schemas.CHECKING_LOG.fieldNames()
    add("fraud-0602", "2020-06-02", "Gian lận", ["e", "g"])
    writers.append_log(log_rows(spark, "2020-06-02", "Tuân thủ", ["f"]).limit(0), path, fv.CHECKING_COLUMNS, "audit-0602")
    assert rows(log().select("codeno")) == [("a",), ("b",), ("c",), ("d",), ("e",), ("g",)]


def test_samples_feed_the_next_days_history(spark, folder):
    from loantide.plans import compliance

    for day, codes in (("2020-06-01", ["a", "b"]), ("2020-06-02", ["c"])):
        writers.append_log(log_rows(spark, day, fv.COMPLIANCE, codes), f"{folder}/log", fv.CHECKING_COLUMNS, f"audit-{day}")
    history = compliance.shop_check_history(readers.read_checking_log(spark, f"{folder}/log"), "2020-06-03")
    assert rows(history.select("shopname", "shop_nums_checked_day", "total_num_checked_pawn")) == [("S", 2, 3)]


def test_plain_append_aligns_columns_by_name(spark, folder):
    path = f"{folder}/t"
    writers.append_rows(spark.createDataFrame([(1, "x")], "id int, a string").select("a", "id"), path, ["id", "a"])
    writers.append_rows(spark.createDataFrame([(2,)], "id int"), path, ["id", "a"])
    writers.back_up(spark.createDataFrame([(3, "z", 9)], "id int, a string, extra int"), ["id", "a"], path)
    assert rows(readers.read_parquet(spark, path)) == [(1, "x"), (2, None), (3, "z")]


def failing(df, when):
    """``df`` with a row that fails the job: before anything is written (a shuffle first), or while other tasks have written."""
    broken = df.withColumn("id", F.when(F.col("id") == df.count() - 1, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")))
    return broken.orderBy("id") if when == "before" else broken


@pytest.mark.parametrize("when", ["before", "during"])
def test_failed_overwrites_leave_the_old_rows(spark, folder, when):
    path, name = f"{folder}/t", f"t_{uuid.uuid4().hex}"
    new = spark.range(0, 1_000, 1, 8)
    writers.write_overwrite(spark.range(5), path)
    writers.write_table(spark.range(5), name, f"{folder}/table")
    held = readers.read_output(spark, path)
    for write in (lambda: writers.write_overwrite(failing(new, when), path), lambda: writers.write_table(failing(new, when), name, f"{folder}/table")):
        with pytest.raises(Exception, match="broken row"):
            write()
    assert readers.read_output(spark, path).count() == 5 and spark.table(name).count() == 5
    writers.write_overwrite(new, path)
    writers.write_table(new.withColumn("more", F.lit("x")), name, f"{folder}/table")
    assert readers.read_output(spark, path).count() == 1_000 and spark.table(name).columns == ["id", "more"]
    assert held.count() == 5  # a reader that began on the version before keeps it
    spark.sql(f"DROP VIEW {name}")


@pytest.mark.parametrize("when", ["before", "during"])
def test_failed_runs_leave_the_log_as_it_was(spark, folder, when):
    path, schema = f"{folder}/log", spark.createDataFrame([], "id long, day string, kind string").schema
    rows_of = lambda n: spark.range(0, n, 1, 8).select("id", F.lit("d1").alias("day"), F.lit("k").alias("kind"))
    add = lambda df, run: writers.append_log(df, path, ["id", "day", "kind"], run, ["day", "kind"])
    assert readers.read_log(spark, path, schema).count() == 0
    add(rows_of(3), "a")
    for run in ("a", "b"):  # a repeated run, and one that never ended
        with pytest.raises(Exception, match="broken row"):
            add(failing(rows_of(800), when), run)
    assert rows(readers.read_log(spark, path, schema)) == [(k, "d1", "k") for k in range(3)]
    add(rows_of(2), "b")
    add(rows_of(0), "a")
    assert rows(readers.read_log(spark, path, schema)) == [(0, "d1", "k"), (1, "d1", "k")]


def test_versions_are_kept_and_dropped(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    for k in range(1, 6):
        versions.publish(spark.range(k), path, part="xy"[k % 2])
    assert versions.read_current(spark, path).count() == 4 + 5
    versions.publish(versions.read_current(spark, path).limit(7), path, part="x")  # from the output to itself
    assert versions.drop_old(spark, path, keep=1) == 4 and versions.drop_old(spark, path, keep=1) == 0
    assert versions.read_current(spark, path).count() == 5 + 7
    # Two jobs wrote the same number: one of them is current, whichever way the records are listed.
    record = versions._records(spark, path).where("part = 'y'").orderBy(F.desc("version")).first()
    folder = f"versions/{versions.COLUMN}=zz"
    spark.range(9).write.parquet(f"{path}/{folder}")
    spark.createDataFrame([("y", record["version"], folder)], versions.RECORD).coalesce(1).write.mode("append").json(f"{path}/_commits")
    assert versions.read_current(spark, path).count() == 9 + 7


def test_snapshot_days_are_partitions(spark, folder):
    path = f"{folder}/snap"
    days = [dt.date(2020, 6, d) for d in (1, 2, 3)]
    panel = spark.createDataFrame([(d, i) for d in days for i in range(10)], "created date, pawnid long")
    writers.write_snapshot(panel, path)
    writers.write_snapshot(panel.where(F.col("created") == days[2]).limit(4), path)
    stored = readers.read_parquet(spark, path)
    assert stored.count() == 24
    one_day = readers.snapshot_at(stored, "2020-06-02")
    assert one_day.count() == 10
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created" in plan


def test_bucketed_snapshots_join_without_shuffle(spark):
    days = [spark.createDataFrame([(dt.date(2020, 6, d), i, d + i) for i in range(50)], "created date, pawnid long, tuoino int")
            for d in (1, 2)]
    name = f"snap_{uuid.uuid4().hex}"
    try:
        for day in days:
            writers.write_snapshot_table(day, name, 4)
        stored = readers.read_table(spark, name)
        a, b = readers.snapshot_at(stored, "2020-06-01"), readers.snapshot_at(stored, "2020-06-02")
        joined = a.hint("merge").join(b.select("pawnid", F.col("tuoino").alias("cb_dpd")), "pawnid", "left")
        assert joined.where(F.col("cb_dpd") == F.col("tuoino") + 1).count() == 50
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        writers.write_snapshot_table(days[1].limit(7), name, 4)
        counts = readers.read_table(spark, name).groupBy("created").count()
        assert rows(counts.select("count")) == [(50,), (7,)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_report_sections_are_partitions(spark, folder):
    report = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "section_no int, row_key string, value double")
    writers.write_report(report, f"{folder}/r")
    assert readers.read_parquet(spark, f"{folder}/r").where("section_no = 2").count() == 1


def test_titles(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 1),), (dt.date(2020, 6, 9),)], "created date")
    assert writers.newest_day_title(df, "Report").collect()[0][0] == "Report 09-06-2020"
    assert df.select(writers.as_of_title("Report", "2020-06-05")).collect()[0][0] == "Report 05-06-2020"


def test_sheets(spark, folder):
    path = f"{folder}/sheet.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write('title,,\nnote,,\nshop,limit,day\n"A, b",10.5,2020-01-02\nC,,bad\n')
    schema = "shop string, limit decimal(18,2), day date"
    typed = readers.read_typed_sheet(spark, path, spark.createDataFrame([], schema).schema, skip_rows=3)
    got = rows(typed)
    assert [(r[0], None if r[1] is None else float(r[1]), r[2]) for r in got] == [
        ("A, b", 10.5, dt.date(2020, 1, 2)), ("C", None, None)]
    assert rows(readers.read_typed_sheet(spark, path, typed.schema, 3, ["shop"])) == [("A, b",), ("C",)]
    text = readers.read_text_sheet(spark, path, ["shop", "limit", "day"], skip_rows=3)
    assert rows(text) == [("A, b", "10.5", "2020-01-02"), ("C", "", "bad")]


def test_sheets_of_several_files(spark, folder):
    """Title rows of each file go, blank ones too; columns go by their names; line breaks may stand in quotes."""
    with open(f"{folder}/a.csv", "w", encoding="utf-8") as out:
        out.write('title,\n\nshop,n\n"A\nB ""x""",1\n')
    with open(f"{folder}/b.csv", "w", encoding="utf-8") as out:
        out.write("title,\r\nnote,\r\nn,shop\r\n2,C\r\n,D\r\n")
    got = rows(readers.read_text_sheet(spark, folder, ["shop", "n"], skip_rows=3))
    assert got == [('A\nB "x"', "1"), ("C", "2"), ("D", "")]
    with pytest.raises(Exception, match="no column area"):
        readers.read_text_sheet(spark, folder, ["shop", "area"], skip_rows=3).collect()


@pytest.mark.parametrize("split", [32, 100, 1_000_000])
def test_sheets_in_splits(spark, folder, split):
    """A file read in many splits gives the rows of the file read as one: quoted breaks of any kind may reach over splits."""
    import csv
    import random

    rng = random.Random(split)
    cells = ["plain", "", 'say ""x""', "a,b", "two\nlines", "two\r\nlines", "old\rline", "\n\n\n", "é" * 40, '"', "x" * 90]
    want = [("\ufeffk", "v", "w")] + [(str(k), rng.choice(cells), rng.choice(cells)) for k in range(120)]
    with open(f"{folder}/a.csv", "w", encoding="utf-8", newline="") as out:
        writer = csv.writer(out, lineterminator="\r\n")
        writer.writerows(want)
        out.write("\r\n\r\n121,last,without end")
    with open(f"{folder}/b.csv", "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([("w", "v", "k"), ("z", 'y\n"', "b1")])
    settings = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        assert (spark.read.text(f"{folder}/a.csv").rdd.getNumPartitions() > 20) == (split < 1_000)
        got = rows(readers.read_text_sheet(spark, folder, ["k", "v", "w"]))
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert got == sorted([*want[1:], ("121", "last", "without end"), ("b1", 'y\n"', "z")], key=repr)


def test_lines_of_sheets_stay_where_they_are_read(spark, folder):
    """Texts of very many quoted breaks: only headers are shuffled, and records that reach over splits."""
    said = spark.range(40).select("id", F.concat(F.col("id"), F.repeat(F.lit('",\n"'), 5_000)).alias("said"))
    said.repartition(4).write.option("header", True).option("quoteAll", True).option("escape", '"').csv(f"{folder}/many")
    sheet = readers.read_text_sheet(spark, f"{folder}/many", ["said", "id"])
    assert {(int(r.id), len(r.said)) for r in sheet.collect()} == {(k, len(str(k)) + 20_000) for k in range(40)}

    def moved(node):
        """Bytes that the shuffles of an executed plan wrote."""
        name = node.getClass().getSimpleName()
        below = [node.executedPlan()] if name == "AdaptiveSparkPlanExec" else [node.plan()] if name.endswith("QueryStageExec") else []
        below += [node.children().apply(k) for k in range(node.children().size())]
        own = node.metrics().apply("dataSize").value() if name == "ShuffleExchangeExec" else 0
        return own + sum(moved(n) for n in below)

    assert moved(sheet._jdf.queryExecution().executedPlan()) < 20_000  # of 1,200,000 bytes


def test_an_open_quote_is_an_error(spark, folder):
    with open(f"{folder}/a.csv", "w", encoding="utf-8") as out:
        out.write('k,v\n1,"never closed\n2,x\n')
    with pytest.raises(Exception, match="never closed"):
        readers.read_text_sheet(spark, folder, ["k", "v"]).collect()


def test_rectangles(spark, folder):
    """As a sheet's range: left column, right column, first and last row; the header stands in the first row."""
    path = f"{folder}/sheet.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write("no,mail,name,name\n1,a@x,A,other\n2,b@x,B,other\n\n4,d@x,D,other\n5,e@x,E,other\n")
    read = lambda start, end, columns=("name", "mail"): rows(readers.read_text_sheet(spark, path, list(columns), start=start, end=end))
    assert read("B1", "C5") == [("A", "a@x"), ("B", "b@x"), ("D", "d@x")]  # the blank row counts
    assert read("B1", None) == [("A", "a@x"), ("B", "b@x"), ("D", "d@x"), ("E", "e@x")]
    assert read("D1", "D3", ["name"]) == [("other",), ("other",)]
    with pytest.raises(Exception, match="no column mail"):
        read("C1", "D9")
    with pytest.raises(Exception, match="no column no"):
        read("B1", "C60", ["no"])
    assert read("B3", "C5", ["b@x"]) == [("d@x",)] and read("A1", "B1", ["no"]) == []
    typed = readers.read_typed_sheet(spark, path, spark.createDataFrame([], "no int, mail string").schema, start="A1", end="B3")
    assert rows(typed) == [(1, "a@x"), (2, "b@x")]
    assert [readers._cell_at(x) for x in ("A1", "Z9", "AA10", "BC60")] == [(1, 1), (9, 26), (10, 27), (60, 55)]


def test_header_row_only(spark, folder):
    path = f"{folder}/sheet.csv"
    with open(path, "w", encoding="utf-8") as out:
        out.write("shop,n\nA,1\n")
    assert rows(readers.read_text_sheet(spark, path, ["shop", "n"])) == [("A", "1")]


def test_sql_parameters_are_bound(spark):
    df = spark.createDataFrame([("a'; DROP",), ("b",)], "v string")
    assert readers.run_sql(spark, "SELECT * FROM {t} WHERE v = :x", {"t": df}, x="a'; DROP").count() == 1


def test_jdbc_options(spark):
    """No database is at hand: the reader must fail on the driver class, not before."""
    with pytest.raises(Exception, match="(?i)no suitable driver|ClassNotFound|driver"):
        readers.read_warehouse(spark, {"url": "jdbc:none://host/db"}, "t", "id", ("0", "10"), 4)
