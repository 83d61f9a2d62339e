import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from loantide.operators import aggregates, crosstab, latest, lookups, sampling, sets


def history(n=600, seed=3):
    """Rows of which one key holds a third; several share a day."""
    rng = random.Random(seed)
    start = dt.date(2020, 1, 1)
    return [("hot" if rng.random() < 0.34 else rng.choice("abcdef") if rng.random() < 0.95 else None,
             start + dt.timedelta(days=rng.randrange(90)), i, f"c{i}") for i in range(n)]


def brute_previous(data):
    groups, out = defaultdict(list), {}
    for row in data:
        groups[row[0]].append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]))
        for before, row in zip([None, *group], group):
            out[row[2]] = before and before[3]
    return out


@pytest.mark.parametrize("slices", ["none", "month", "day and block", "levels"])
def test_previous_row_matches_brute_force(spark, slices):
    data = history()
    df = spark.createDataFrame(data, "k string, d date, id long, code string")
    by = {"none": None, "month": F.date_trunc("MONTH", "d"), "day and block": latest.dated_slice("d", "id", 40),
          "levels": latest.dated_slices("d", "id", 4)}[slices]
    got = latest.previous_row(df, ["k"], ["d", "id"], ["code"], "p", by).select("id", "p.code")
    assert dict(tuple(r) for r in got.collect()) == brute_previous(data)


def test_sliced_previous_row_shuffles_rows_once(spark):
    df = spark.createDataFrame(history(), "k string, d date, id long, code string")
    got = latest.previous_row(df, ["k"], ["d", "id"], ["code"], "p", latest.dated_slice("d", "id")).hint("merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows by (key, slice); tails by (key, slice), then by key, then back to (key, slice)
    assert plan.count("Exchange hashpartitioning") == 4


def test_previous_since_looks_back(spark):
    data = history()
    assert any(r[0] is None for r in data)
    df = spark.createDataFrame(data, "k string, d date, id long, code string")
    cut = F.lit(dt.date(2020, 3, 1))
    got = latest.previous_since(df.where(F.col("d") >= cut), df.where(F.col("d") < cut), ["k"], ["d", "id"], ["code"], "p",
                                latest.dated_slice("d", "id", 50)).select("id", "p.code")
    want = brute_previous(data)
    late = {r[2]: want[r[2]] for r in data if r[1] >= dt.date(2020, 3, 1)}
    assert dict(tuple(r) for r in got.collect()) == late


def test_first_and_last_with_ties_and_nulls(spark):
    t = dt.datetime(2020, 1, 1)
    data = [("a", t, None, 1), ("a", t, 5, 2), ("a", t, 9, 3), ("a", t + dt.timedelta(1), None, 4),
            ("a", t + dt.timedelta(1), 2, 5), ("b", t, None, 6)]
    df = spark.createDataFrame(data, "k string, t timestamp, dpd int, id long")
    got = latest.extreme_rows(df, ["k"], {
        "last": ("max", ["t", "dpd", "id"], ["id"]),
        "first": ("min", ["t", latest.descending_nulls_last(F.col("dpd")), "id"], ["id"]),
    }).select("k", "last.id", "first.id")
    assert rows(got) == [("a", 5, 3), ("b", 6, 6)]


def test_latest_with_ties_keeps_all(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, d int, v string")
    assert rows(latest.latest_with_ties(df, ["k"], "d").select("k", "v")) == [("a", "y"), ("a", "z"), ("b", "w")]


def test_crosstab_margins_equal_cell_sums(spark):
    data = [("n", 1, "x", 10, 2.0), ("n", 1, "y", 11, 3.0), ("n", 2, "x", 12, 4.0), ("s", 1, "x", 13, None),
            (None, 1, "x", 14, 5.0), ("s", 2, None, 15, 6.0)]
    df = spark.createDataFrame(data, "area string, kind int, col string, pawnid long, currentmoney double")
    long = crosstab.crosstab_long(df, ["area", "kind"], ["col"], "pawnid", "currentmoney")
    got = {(r["area"], r["kind"], r["col_key"]): (r["n"], r["amount"]) for r in long.collect()}
    assert got[("All", "", "All")] == (4, 9.0)
    assert got[("n", "1", "All")] == (2, 5.0)
    assert got[("All", "", "x")] == (3, 6.0)
    assert got[("s", "1", "x")] == (1, None)
    inner = [v for (a, _, c), v in got.items() if a != "All" and c != "All"]
    assert sum(n for n, _ in inner) == got[("All", "", "All")][0]
    wide = crosstab.crosstab_wide(long, ["area", "kind"], ["x", "y", "All"])
    assert {tuple(r) for r in wide.collect()} >= {("n", "2", 1, 0, 1), ("All", "", 3, 1, 4)}


def test_crosstab_all_value_in_data_is_not_a_margin(spark):
    df = spark.createDataFrame([("All", "x", 1), ("n", "x", 2)], "area string, col string, pawnid long")
    plain = crosstab.crosstab_long(df, ["area"], ["col"], margins=False)
    assert rows(plain) == [("All", "x", 1), ("n", "x", 1)]


def test_crosstab_keys_stay_apart(spark):
    data = [("All", "x|y", "z", 1), ("n", "x", "y|z", 2), ("n", "All", None, 3), ("n", "x\\", "|y", 4), ("n", "x", "\\|y", 5)]
    df = spark.createDataFrame(data, "area string, a string, b string, pawnid long")
    long = crosstab.crosstab_long(df, ["area"], ["a", "b"])
    cells = {(r["area"], r["col_key"]): r["n"] for r in long.collect()}
    assert len({c for a, c in cells if c != "All"}) == 4 and cells[("All", "All")] == 4
    assert (cells[("\\All", "All")], cells[("n", "All")]) == (1, 3)
    wide = crosstab.crosstab_wide(long, ["area"], ["All"])
    assert rows(wide) == [("All", 4), ("\\All", 1), ("n", 3)]
    one = crosstab.crosstab_wide(crosstab.crosstab_long(df, ["area"], ["a"]), ["area"], ["\\All", "All"])
    assert ("n", 1, 4) in rows(one)


def test_quantiles_match_numpy(spark):
    import random

    random.seed(5)
    data = [("a", random.lognormvariate(3, 4)) for _ in range(700)] + [("b", -random.random()) for _ in range(31)] + [("c", 2.0)] * 9
    df = spark.createDataFrame([*data, ("a", None)], "k string, v double")
    got = {r["k"]: r for r in aggregates.outlier_fence(df, ["k"], "v").collect()}
    np = pytest.importorskip("numpy")
    for k in "abc":
        want = np.quantile([v for g, v in data if g == k], [0.25, 0.75])
        assert [got[k]["q1"], got[k]["q3"]] == pytest.approx(list(want))


def test_null_keys_in_joins(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert rows(lookups.left_lookup(left, right, "k").select("v", "w")) == [(1, None), (2, 20)]
    assert rows(lookups.null_safe_join(left, right, ["k"]).select("v", "w")) == [(1, 10), (2, 20)]
    assert rows(lookups.drop_matching(left, right, "k").select("v")) == [(1,)]
    assert rows(lookups.left_lookup(left, right.withColumnRenamed("k", "j"), {"k": "j"}).select("v", "w")) == [(1, None), (2, 20)]


def test_bin_bounds(spark):
    bins = spark.createDataFrame([(0.0, 10.0, "low"), (10.0, 20.0, "high")], "min_value double, max_value double, name string")
    df = spark.createDataFrame([(0.0,), (9.9,), (10.0,), (20.0,), (None,)], "x double")
    assert rows(lookups.bin_lookup(df, bins, F.col("x"))) == [(0.0, "low"), (10.0, "high"), (9.9, "low")]


def test_many_keyed_bins(spark):
    """200,000 bins of one key: no limit on the lines of a look-up."""
    bins = spark.range(200_000).select(F.lit("k").alias("flag"), F.col("id").cast("double").alias("min_value"),
                                       (F.col("id") + 1).cast("double").alias("max_value"), F.col("id").alias("n"))
    df = spark.createDataFrame([("k", 0.0), ("k", 123_456.5), ("k", 199_999.9), ("k", 200_000.0), ("x", 5.0)], "g string, v double")
    assert rows(lookups.bin_lookup(df, bins, F.col("v"), {"g": "flag"}).select("n")) == [(0,), (123_456,), (199_999,)]


def test_group_totals_of_a_hot_group(spark):
    df = spark.createDataFrame([("a", i, 1.0) for i in range(50)] + [(None, 99, 2.0)], "k string, id long, m double")
    got = aggregates.with_group_totals(df, df, ["k"], "m", "id", "total", "n").select("id", "total", "n")
    assert set(tuple(r)[1:] for r in got.collect()) == {(50.0, 50), (2.0, 1)}
    assert got.count() == 51


def test_describe_and_fence(spark):
    pd = pytest.importorskip("pandas")
    values = [1, 2, 2, 3, 10, 40]
    df = spark.createDataFrame([("a", v) for v in values] + [("a", None), ("b", 7)], "k string, v int")
    got = {r["k"]: r for r in aggregates.describe(df, ["k"], "v").collect()}
    want = pd.Series(values).describe()
    for name, label in zip(["count", "mean", "std", "min", "25%", "50%", "75%", "max"],
                           ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]):
        assert got["a"][label] == pytest.approx(want[name])
    assert got["b"]["std"] is None
    fence = {r["k"]: r for r in aggregates.outlier_fence(df, ["k"], "v").collect()}["a"]
    large = spark.createDataFrame([(None, 1e9 + k) for k in range(3)], "k string, v double")
    got = aggregates.describe(large, ["k"], "v").first()
    assert (got["std"], got["p25"], got["count"]) == (1.0, 1e9 + 0.5, 3)
    assert fence["upper_threshold"] == pytest.approx(want["75%"] + 1.5 * (want["75%"] - want["25%"]))


def test_quota_sample_and_ties(spark):
    df = spark.createDataFrame([(i, "t" if i % 3 else "o", float(i // 4)) for i in range(100)], "id long, g string, score double")
    got = sampling.quota_sample(df, F.col("g"), {"t": 5, "o": 2}, F.desc("score"), F.col("id"))
    picked = defaultdict(list)
    for r in got.collect():
        picked[r["g"]].append(r["id"])
    ranked = sorted(((-float(i // 4), i) for i in range(100)))
    assert sorted(picked["t"]) == sorted([i for _, i in ranked if i % 3][:5])
    assert sorted(picked["o"]) == sorted([i for _, i in ranked if not i % 3][:2])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_union_and_reindex(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    assert rows(sets.reindex(sets.union_all(a, b), ["b", "id", "c"])) == [("y", 2, None), (None, 1, None)]
    assert sets.union_distinct(a, a).count() == 1


def test_costly_column_is_not_copied_into_filters(spark):
    df = spark.createDataFrame([("a!b",), (None,)], "s string")
    once = sets.with_costly_column(df, "t", F.regexp_replace("s", "!", "")).where(F.col("t").contains("ab") | F.col("t").isNull())
    assert rows(once.select("t")) == [("ab",), (None,)]
    assert once._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_global_bins_by_cells(spark):
    inf = float("inf")
    edges = [(0.0, 0.1), (0.1, 0.3), (-5.0, 1e9), (2.0, 2.0), (4.0, 3.0), (1e15, 1e15 + 0.25), (-inf, 0.0), (1e6, inf), (-1e308, 1e308), (None, 3.0), (0.0, 5e-324)]
    edges += [(k * 7.5, k * 7.5 + 7.5) for k in range(-300, 300)]
    values = [0.0, -0.0, 0.1, 0.3, 0.29999999999999999, 7.5, -7.5, 1e15, 1e15 + 0.125, 2.0, 1e307, -inf, inf, float("nan"), None, 3.25, 2_249.999, -2_250.0]
    bins = spark.createDataFrame([(*e, k) for k, e in enumerate(edges)], "min_value double, max_value double, bin int")
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)] * 2, "x double, k int")
    # Spark takes NaN as larger than any number.
    want = [(k, b) for k, v in enumerate(values) for b, (lo, hi) in enumerate(edges) if None not in (v, lo, hi) and v >= lo and v < hi]
    found = lookups.bin_lookup(df, bins, F.col("x"))
    assert sorted((r.k, r.bin) for r in found.collect()) == sorted(want * 2)
    lost = [(k, None) for k in range(len(values)) if k not in {w[0] for w in want}]
    left = lookups.bin_lookup(df, bins, F.col("x"), how="left")
    assert sorted(((r.k, r.bin) for r in left.collect()), key=repr) == sorted((want + lost) * 2, key=repr)
    assert lookups.bin_lookup(df, bins.limit(0), F.col("x")).count() == 0
    assert lookups.bin_lookup(df, bins.limit(0), F.col("x"), how="left").count() == len(values) * 2
    exact = spark.createDataFrame([(Decimal("12345678901234567890.1"),)], "x decimal(25,1)")
    near = spark.createDataFrame([(Decimal("12345678901234567890.0"), Decimal("12345678901234567890.2"), 1)], "min_value decimal(25,1), max_value decimal(25,1), bin int")
    assert [r.bin for r in lookups.bin_lookup(exact, near, F.col("x")).collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "collect_list" not in plan


@pytest.fixture
def shuffled_joins(spark):
    """Joins of two shuffled sides, of which partitions over a few kilobytes count as skewed."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name in changed:
        spark.conf.unset(name)


@pytest.mark.parametrize("hot", [7, None])
def test_membership_splits_a_hot_key(spark, shuffled_joins, hot):
    """Two thirds of the rows on one key, or without any: the join is split where the key list alone would keep it in one task."""
    key = F.when(F.col("id") % 3 == 0, F.col("id") % 1_000).otherwise(F.lit(hot).cast("long")).alias("k")
    fact = spark.range(0, 120_000, 1, 8).select(key, F.md5(F.col("id").cast("string")).alias("v"))
    other = spark.range(0, 2_000, 2, 4).select(F.col("id").alias("k"), F.lit("x").alias("v")).unionByName(spark.range(5_000).select(F.lit(7).cast("long").alias("k"), F.lit("y").alias("v")))
    whole = [r[0] for r in fact.select("k").collect()]
    listed = {*range(0, 2_000, 2), 7}
    for join, want in ((lookups.keep_matching, sum(k in listed for k in whole)), (lookups.drop_matching, sum(k not in listed for k in whole))):
        found = join(fact, other, "k")
        assert found.columns == ["k", "v"]
        assert found.select(F.count("v")).first()[0] == want
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        kind = "LeftSemi" if join is lookups.keep_matching else "LeftAnti"
        if hot or kind == "LeftAnti":  # rows without a key never come to a semi join
            assert f"{kind}" in plan and "skew=true" in plan, plan


def test_rows_meet_only_bins_near_them(spark):
    """200,000 bins of one key: a row meets the few bins of its cell, not those of its key."""
    bins = spark.range(200_000).select(F.lit("k").alias("flag"), F.col("id").cast("double").alias("low"), (F.col("id") + 1).cast("double").alias("high"))
    level = lookups.bin_level(F.col("low"), F.col("high"))
    lines = bins.withColumn("level", level).withColumn("cell", F.explode(lookups.bin_cells(F.col("low"), F.col("high"), F.col("level"))))
    assert lines.select(F.collect_set("level")).first()[0] == [0] and lines.count() == 400_000
    df = spark.range(100).select(F.lit("k").alias("flag"), (F.col("id") * 1_999.5).alias("v"))
    met = df.withColumn("cell", lookups.cell_of(F.col("v"), F.lit(0))).join(lines, ["flag", "cell"])
    assert met.count() == 199  # two bins touch a cell; the first cell has one
    found = lookups.bin_lookup(df, bins, F.col("v"), {"flag": "flag"}, low="low", high="high")
    assert found.count() == 100 and found.columns == ["flag", "v"]
    hints = lookups.bin_lookup(df.hint("merge"), bins, F.col("v"), {"flag": "flag"}, low="low", high="high")._jdf.queryExecution().executedPlan().toString()
    assert "__cell" in hints.split("SortMergeJoin")[1].split("]")[0]


def test_bins_by_key_match_brute_force(spark):
    rng = random.Random(8)
    edges = [(g, a, a + rng.choice([0.5, 3.0, 40.0])) for g in ("a", "b", None) for a in (rng.uniform(-50, 50) for _ in range(40))]
    bins = spark.createDataFrame([(*e, k) for k, e in enumerate(edges)], "g string, min_value double, max_value double, bin int")
    values = [(rng.choice(["a", "b", "c", None]), rng.uniform(-60, 60), k) for k in range(150)]
    df = spark.createDataFrame(values, "g string, x double, k int")
    want = [(k, b) for g, x, k in values for b, (h, lo, hi) in enumerate(edges) if g is not None and g == h and lo <= x < hi]
    assert sorted((r.k, r.bin) for r in lookups.bin_lookup(df, bins, F.col("x"), {"g": "g"}).collect()) == sorted(want)
    left = lookups.bin_lookup(df, bins, F.col("x"), {"g": "g"}, how="left")
    lost = [(k, None) for *_, k in values if k not in {w[0] for w in want}]
    assert sorted(((r.k, r.bin) for r in left.collect()), key=repr) == sorted(want + lost, key=repr)


def test_quantiles_of_close_values(spark):
    """A million different values within a millionth of each other: what a task orders stays small, the quartiles are exact."""
    n = 1_000_000
    df = spark.range(0, n, 1, 8).select(F.lit("a").alias("k"), (F.lit(1e6) + F.col("id") * 1e-6).alias("v"))
    df = df.unionByName(spark.range(3).select(F.lit("b").alias("k"), F.lit(5.0).alias("v")))
    got = {r["k"]: r for r in aggregates.describe(df, ["k"], "v").collect()}
    want = {r["k"]: r for r in df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])).alias("p"),
                                                   F.stddev_samp("v").alias("s"), F.avg("v").alias("m")).collect()}
    for k in "ab":
        assert [got[k][c] for c in ("p25", "p50", "p75")] == want[k]["p"]
        assert got[k]["std"] == pytest.approx(want[k]["s"], rel=1e-6) and got[k]["mean"] == pytest.approx(want[k]["m"], rel=1e-12)
    # The window over values is the last one, over the parts of parts that hold a rank.
    counts = aggregates._value_counts(df, ["k"], "v")
    keyed = counts.select(aggregates._bucket(F.col("__v")).alias("b"))
    assert keyed.groupBy("b").count().agg(F.max("count")).first()[0] == n  # all of them in one bucket
    plan = aggregates.quantiles(counts, ["k"], {"m": 0.5})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") >= 4
    metrics = order_sizes(aggregates.quantiles(counts, ["k"], {"m": 0.5}))
    assert max(metrics) < 100_000


def order_sizes(df):
    """Rows that came into each sort of the plan as it ran."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Window":
            found.append(rows_of(node.children().apply(0)))
        for k in range(node.children().size()):
            walk(node.children().apply(k))
        return None

    def rows_of(node):
        while True:
            name = node.nodeName()
            if name.startswith("AdaptiveSparkPlan"):
                node = node.executedPlan()
            elif "QueryStage" in name:
                node = node.plan()
            elif node.metrics().contains("numOutputRows"):
                return node.metrics().apply("numOutputRows").value()
            elif node.metrics().contains("shuffleRecordsWritten"):
                return node.metrics().apply("shuffleRecordsWritten").value()
            elif node.children().size() == 0:
                return 0
            else:
                node = node.children().apply(0)

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_quantiles_at_all_scales(spark):
    rng = random.Random(9)
    np = pytest.importorskip("numpy")
    groups = {"tiny": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-320, -300) for _ in range(300)], "zero": [0.0, -0.0, 5e-324, -5e-324, 1e-300],
              "wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 307) for _ in range(500)], "one": [3.5], "big": [1.7e308, -1.7e308, 1.0, 2.0]}
    df = spark.createDataFrame([(k, v) for k, own in groups.items() for v in own], "k string, v double")
    got = {r["k"]: r for r in aggregates.quantiles(aggregates._value_counts(df, ["k"], "v"), ["k"], {"a": 0.25, "b": 0.5, "c": 0.9}).collect()}
    for k, own in groups.items():
        for name, p in (("a", 0.25), ("b", 0.5), ("c", 0.9)):
            assert got[k][name] == pytest.approx(float(np.quantile(own, p)), rel=1e-9, abs=0), (k, name)


def test_previous_row_of_a_hot_key_in_slices_of_one_row(spark):
    """Sparse ids, a slice for nearly every row: the carry goes by levels, so no window takes the key as a whole."""
    n = 200_000
    sparse = (F.col("id") * 3_000_017).alias("id")
    df = spark.range(0, n, 1, 8).select(F.lit("hot").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("d"), sparse)
    got = latest.previous_row(df, ["k"], ["d", "id"], ["id"], "p", latest.dated_slices("d", "id", 1_000_000))
    plain = latest.previous_row(df, ["k"], ["d", "id"], ["id"], "p")
    assert got.select("id", "p.id").exceptAll(plain.select("id", "p.id")).count() == 0 and got.count() == n
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and all("__slice" in line for line in windows)
    # The top window holds the days; the one below it the blocks of a day, a million at most of a million ids each.
    levels = latest.dated_slices("d", "id", 1_000_000)
    sizes = df.select(*[level.alias(f"s{k}") for k, level in enumerate(levels)])
    assert sizes.select("s0").distinct().count() == n and sizes.select("s1").distinct().count() == 3
    small = latest.previous_row(df.limit(3_000), ["k"], ["d", "id"], ["id"], "p", latest.dated_slices("d", "id", 1_000))
    assert small.where("p IS NULL").count() == 1


def test_quotas_from_a_table(spark):
    df = spark.range(0, 4_000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 9 == 0, "none").when(F.col("id") % 2 == 0, "small").alias("g"),
                                            (F.col("id") % 10).alias("score"))
    quotas = spark.createDataFrame([("big", 7), ("small", 2), ("small", 3), ("absent", 50), ("zero", 0), (None, 9)], "stratum string, quota int")
    got = sampling.quota_sample(df, F.col("g"), quotas, F.desc("score"), F.col("id"))
    picked = defaultdict(list)
    for r in got.collect():
        picked[r["stratum"]].append((r["sample_rank"], r["id"]))
    data = [(r["g"], -r["score"], r["id"]) for r in df.collect()]
    want = {g: [i for h, _, i in sorted(d for d in data if d[0] == g)][:n] for g, n in (("big", 7), ("small", 3))}
    assert {g: [i for _, i in sorted(own)] for g, own in picked.items()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and ", 50" in plan  # the bound of the table cuts before the shuffle
    per = sampling.quota_sample(df, F.col("g"), quotas, F.desc("score"), F.col("id"), per=["score"])
    assert per.groupBy("stratum", "score").count().agg(F.max("count")).first()[0] == 7
    assert sampling.quota_sample(df, F.col("g"), quotas.limit(0), F.col("id")).count() == 0
    assert sampling.quota_sample(df, F.col("g"), {}, F.col("id")).count() == 0


def test_margins_of_any_measure(spark):
    rng = random.Random(10)
    data = [(rng.choice(["a", "b|", "All", None]), rng.choice([1, 2]), rng.choice(["x", "y", None]), rng.choice([1.0, 2.0, 2.5, None]), rng.choice(["p", "q", "r", None])) for _ in range(300)]
    data += [("a", 3, "x", None, None)]
    df = spark.createDataFrame(data, "i string, j int, c string, v double, w string")
    asked = {"n": ("count", "v"), "total": ("sum", "v"), "mean": ("mean", "v"), "least": ("min", "v"), "most": ("max", "w"), "kinds": ("nunique", "w"), "values": ("nunique", "v")}

    def brute(rows):
        v, w = [r[3] for r in rows if r[3] is not None], [r[4] for r in rows if r[4] is not None]
        return (len(v), sum(v) if v else None, sum(v) / len(v) if v else None, min(v, default=None), max(w, default=None), len(set(w)), len(set(v)))

    whole = [r for r in data if None not in r[:3]]
    text = lambda x: "\\All" if x == "All" else str(x)
    want = {("All", "", "All"): brute(whole)}
    for r in whole:
        i, j, c = text(r[0]), str(r[1]), text(r[2])
        want[i, j, c] = brute([s for s in whole if s[:3] == r[:3]])
        want[i, j, "All"] = brute([s for s in whole if s[:2] == r[:2]])
        want["All", "", c] = brute([s for s in whole if s[2] == r[2]])
    got = {tuple(r)[:3]: tuple(r)[3:] for r in crosstab.crosstab_measures(df, ["i", "j"], ["c"], asked).collect()}
    assert got.keys() == want.keys()
    for key, own in want.items():
        assert got[key] == pytest.approx(own) if None not in own else got[key][-2:] == own[-2:], key
    cells = crosstab.crosstab_measures(df, ["i", "j"], ["c"], asked, margins=False)
    assert cells.count() == len({r[:3] for r in whole})
    assert crosstab.crosstab_measures(df.limit(0), ["i"], ["c"], {"n": ("count", "v")}).count() == 0
    wide = crosstab.crosstab_wide(crosstab.crosstab_measures(df, ["i"], ["c"], {"m": ("mean", "v")}), ["i"], ["x", "y", "All"], "m", fill=None)
    assert wide.columns == ["i", "x", "y", "All"] and wide.count() == 4
    plan = crosstab.crosstab_measures(df, ["i"], ["c"], {"n": ("count", "v"), "m": ("mean", "v")})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("partial") if "partial" in plan else plan.count("Aggregate [") == 2  # cells first
    with pytest.raises(ValueError):
        crosstab.crosstab_measures(df, ["i"], ["c"], {"m": ("median", "v")})


def test_few_bins_meet_rows_in_many_tasks(spark):
    """Rows of one value and a single bin: without a broadcast or any help of adaptive execution, no task gets them all."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        bins = spark.createDataFrame([("k", 0.0, 10.0, "low")], "flag string, min_value double, max_value double, name string")
        df = spark.range(0, 20_000, 1, 4).select("id", F.lit("k").alias("g"), F.lit(3.5).alias("x"))
        for equal in (None, {"g": "flag"}):
            found = lookups.bin_lookup(df, bins, F.col("x"), equal)
            tasks = [r["count"] for r in found.groupBy(F.spark_partition_id().alias("task")).count().collect()]
            assert sum(tasks) == 20_000 and max(tasks) < 10_000, tasks
        left = lookups.bin_lookup(df, bins, F.col("x") + F.when(F.col("id") < 5, 10.0).otherwise(0.0), how="left")
        assert {(r.name, r["count"]) for r in left.groupBy("name").count().collect()} == {("low", 19_995), (None, 5)}
    finally:
        for name in changed:
            spark.conf.unset(name)
