"""Grouped aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import ratio


def sum_when(test: Column, value: Column) -> Column:
    """Sum of the values on rows passing the test, 0 when there are none."""
    return F.sum(F.when(test, value).otherwise(F.lit(0)))


def count_when(test: Column) -> Column:
    return F.count_if(test)


def with_group_totals(detail: DataFrame, totals_of: DataFrame, keys: list[str], value: str, counted: str,
                      total: str, count: str) -> DataFrame:
    """Attach the sum and count of each key group to every detail row.

    The totals are aggregated map-side first and joined back, so a group with a
    third of all rows is never gathered in one task as a window would do.
    """
    from .lookups import null_safe_join

    totals = totals_of.groupBy(*keys).agg(F.sum(value).alias(total), F.count(counted).alias(count))
    return null_safe_join(detail, totals, keys)


def _value_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group, value, freq): equal values are merged before any percentile is taken."""
    return (
        df.where(F.col(value).isNotNull())
        .select(*group, F.col(value).cast("double").alias("__v"))
        .groupBy(*group, "__v")
        .agg(F.count(F.lit(1)).alias("__n"))
    )


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
SUMMARY = ["count", "mean", "std", "min", *QUARTILES, "max"]
# Buckets per doubling of the value when a quantile is searched for, parts that a bucket is cut into, and how often.
BUCKETS_PER_OCTAVE, PARTS, REFINEMENTS = 256, 65_536, 2


def whole_number_summary(value: Column, freq: Column) -> dict[str, Column]:
    """The summary of whole numbers repeated ``freq`` times, e.g. days; null values add nothing.

    All sums are exact decimals, so the spread keeps its digits. The quartiles hold one entry per distinct number.
    """
    n, v = F.when(value.isNotNull(), freq).cast("decimal(18,0)"), value.cast("decimal(18,0)")
    total = F.sum(n)
    first, second = [F.sum(x).cast("decimal(38,0)") for x in (v * n, v * v * n)]
    spread = (total * second - first * first).cast("double")
    points = F.percentile(value, F.array(*[F.lit(p) for p in QUARTILES.values()]), F.coalesce(n.cast("long"), F.lit(0)))
    return {
        "count": total,
        "mean": first.cast("double") / total.cast("double"),
        "std": F.sqrt(F.try_divide(spread, (total * (total - 1)).cast("double"))),
        "min": F.min(value),
        **{name: points[i] for i, name in enumerate(QUARTILES)},
        "max": F.max(value),
    }


def _bucket(value: Column) -> Column:
    """A number that never falls as the value grows; values that differ by less than a 256th of a doubling share one or two."""
    size = F.when(value == 0, F.lit(0)).otherwise(F.log2(F.abs(value)) + 1_100)
    return F.floor(F.signum(value) * size * BUCKETS_PER_OCTAVE)


def _holding(cells: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """The cells (__g, __cell, __c and __before, the number of values before the first cell) that hold a wanted rank.

    The cells of one bucket of one group are ordered in a task: a few thousand at first, ``PARTS`` of a part at most.
    """
    in_order = W.partitionBy("__g", "__b").orderBy("__cell").rowsBetween(W.unboundedPreceding, 0)
    to = F.col("__before") + F.sum("__c").over(in_order)
    placed = cells.withColumn("__to", to)
    wanted = reduce(lambda a, b: a | b, [_holds(end(rank)) for rank in ranks.values() for end in (F.floor, F.ceil)])
    return placed.where(wanted).withColumn("__before", F.col("__to") - F.col("__c")).drop("__to")


def _holds(rank: Column) -> Column:
    return (rank >= F.col("__to") - F.col("__c")) & (rank < F.col("__to"))


def quantiles(counts: DataFrame, group: list[str], points: dict[str, float], value: str = "__v", freq: str = "__n") -> DataFrame:
    """Exact quantiles with linear interpolation, from one row per (group, value) with its frequency.

    The values are counted into buckets by their size. A bucket that holds a wanted rank is cut into parts between its own
    least and greatest value, and the part that holds the rank once more; only the values of that last part are ordered. A
    bucket spans a 256th of a doubling, in which there are 2^45 doubles at most, so a last part has some ten thousand
    different values, and no task sorts or keeps those of a bucket or group, however close they lie together.
    """
    from .lookups import null_safe_join

    # As a struct the group is never null, and an empty list of group columns is one group.
    keyed = counts.select(F.struct(F.lit(0), *group).alias("__g"), *group, F.col(value).alias("__v"), F.col(freq).alias("__n"))
    keyed = keyed.withColumns({"__b": F.lit(0).cast("long"), "__cell": _bucket(F.col("__v"))})
    ranks = {name: p * (F.col("__total") - 1) for name, p in points.items()}
    sizes = [F.sum("__n").alias("__c"), F.min("__v").alias("__low"), F.max("__v").alias("__high")]
    cells = keyed.groupBy("__g", "__b", "__cell").agg(*sizes).withColumns({
        "__total": F.sum("__c").over(W.partitionBy("__g")), "__before": F.lit(0).cast("long"),
    })
    picked = _holding(cells, ranks)
    for _ in range(REFINEMENTS):
        # A part is named by its bucket's first value rank, which is one of its own in the group, and its place in it.
        inside = null_safe_join(keyed.drop("__b"), picked.drop("__b", "__c"), ["__g", "__cell"], "inner")
        width = F.col("__high") / 2 - F.col("__low") / 2
        place = F.when(width > 0, (F.col("__v") / 2 - F.col("__low") / 2) / width * (PARTS - 1)).otherwise(F.lit(0.0))
        keyed = inside.select("__g", *group, "__v", "__n", "__total", F.col("__before").alias("__b"), F.floor(place).alias("__part"))
        cells = keyed.groupBy("__g", "__b", "__total", F.col("__part").alias("__cell")).agg(*sizes).withColumn("__before", F.col("__b"))
        picked = _holding(cells, ranks).withColumn("__cell", F.struct("__b", "__cell"))
        keyed = keyed.select("__g", *group, "__v", "__n", "__b", F.struct("__b", F.col("__part").alias("__cell")).alias("__cell"))
    values = null_safe_join(keyed.drop("__b"), picked.select("__g", "__cell", "__before", "__total"), ["__g", "__cell"], "inner")
    upto = F.sum("__n").over(W.partitionBy("__g", "__cell").orderBy("__v").rowsBetween(W.unboundedPreceding, 0))
    values = values.withColumn("__to", F.col("__before") + upto).withColumn("__c", F.col("__n"))
    ends = [
        F.max(F.when(_holds(end(rank)), F.col("__v"))).alias(f"{name}_{side}")
        for name, rank in ranks.items() for side, end in (("low", F.floor), ("high", F.ceil))
    ]
    found = values.groupBy("__g", *group, "__total").agg(*ends)

    def between(name: str) -> Column:
        part = ranks[name] - F.floor(ranks[name])
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return F.when(part == 0, low).otherwise((1 - part) * low + part * high)

    return found.select(*group, *[between(name).alias(name) for name in points])


def describe(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """Distribution summary per group; a group without any value has no row.

    All of it comes from one counting of equal values: the spread is summed around the mean, which keeps its digits.
    """
    from .lookups import null_safe_join

    if not group:
        raise ValueError("give group columns; a constant one for the whole table")
    counts = _value_counts(df, group, value)
    n, v = F.col("__n"), F.col("__v")
    sums = counts.groupBy(*group).agg(F.sum(n).alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))
    around = null_safe_join(counts, sums.select(*group, "count", "mean"), group, "inner")
    off = F.col("__v") - F.col("mean")
    # The second sum would be 0 with an exact mean; it takes out what rounding left.
    spread = F.sum(off * off * n) - F.sum(off * n) * F.sum(off * n) / F.first("count")
    spreads = around.groupBy(*group).agg(F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.first("count") - 1)).alias("std"))
    points = quantiles(counts, group, QUARTILES)
    return null_safe_join(null_safe_join(sums, spreads, group), points, group).select(*group, *SUMMARY)


def outlier_fence(df: DataFrame, group: list[str], value: str, reach: float = 1.5) -> DataFrame:
    """Per group: quartiles and the fences one ``reach`` of the quartile range outside them."""
    quartiles = quantiles(_value_counts(df, group, value), group, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        *group,
        "q1",
        "q3",
        (F.col("q1") - reach * spread).alias("lower_threshold"),
        (F.col("q3") + reach * spread).alias("upper_threshold"),
    )


def attainment(df: DataFrame, actual: str, target: str, gap: str, rate: str) -> DataFrame:
    return df.withColumns({
        gap: F.col(target) - F.col(actual),
        rate: ratio(F.col(actual), F.col(target)),
    })
