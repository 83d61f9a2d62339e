"""Joins.

No join here carries a broadcast hint: Spark broadcasts a side when its measured
size is under the session threshold and otherwise shuffles it, with adaptive skew
splitting of the probe side. Membership tests and bins are built so that this works
for them too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def left_lookup(fact: DataFrame, dim: DataFrame, keys: dict[str, str] | list[str] | str) -> DataFrame:
    """Left equi join; with a mapping fact column -> dim column the dim key is dropped."""
    if isinstance(keys, dict):
        renamed = dim.withColumnsRenamed({right: f"__key_{i}" for i, right in enumerate(keys.values())})
        tests = [fact[left] == renamed[f"__key_{i}"] for i, left in enumerate(keys)]
        return fact.join(renamed, tests, "left").drop(*[f"__key_{i}" for i in range(len(keys))])
    return fact.join(dim, keys, "left")


#: Parts that key lists are dealt into again after they were made distinct.
DEALS = 1_024


def _membership(fact: DataFrame, other: DataFrame, keys: list[str] | str, how: str) -> DataFrame:
    """Semi or anti join with the distinct keys of ``other``.

    Distinct keys come out of their aggregate dealt by the key, and a join on the key alone would take them as they are;
    adaptive execution splits a hot key only where both sides come from a shuffle of their own. So the join is on the key and
    a number made from it: the key list, a row for each key by then, is dealt once more, and the rows of a hot key can be split.
    """
    names = [keys] if isinstance(keys, str) else keys
    deal = F.pmod(F.xxhash64(*names), F.lit(DEALS)).alias("__deal")
    wanted = other.select(*names).dropDuplicates().select(*names, deal)
    return fact.select("*", deal).join(wanted, [*names, "__deal"], how).select(*[F.col(f"`{c}`") for c in fact.columns])


def keep_matching(fact: DataFrame, other: DataFrame, keys: list[str] | str) -> DataFrame:
    """The rows whose key occurs in ``other``, each once; a null key matches nothing."""
    return _membership(fact, other, keys, "left_semi")


def drop_matching(fact: DataFrame, other: DataFrame, keys: list[str] | str) -> DataFrame:
    """The rows whose key does not occur in ``other``; rows with a null key stay."""
    return _membership(fact, other, keys, "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi join in which a null key matches a null key."""
    renamed = right.withColumnsRenamed({key: f"__key_{key}" for key in keys})
    tests = [left[key].eqNullSafe(renamed[f"__key_{key}"]) for key in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, tests), how).drop(*[f"__key_{key}" for key in keys])


#: Level of bins without a finite width; their only cell holds every value.
UNBOUNDED = 5_000


def cell_of(x: Column, level: Column) -> Column:
    """The cell of a value among those of the width 2^level; it never falls as the value grows."""
    return F.when(level == UNBOUNDED, F.lit(0).cast("long")).otherwise(F.floor(x.cast("double") / F.pow(F.lit(2.0), level)))


def bin_level(low: Column, high: Column) -> Column:
    """The width of a bin as a power of two."""
    lower, upper = low.cast("double"), high.cast("double")
    width = upper - lower
    # Edges of many digits may be one double; such a bin is as narrow as doubles near it are apart.
    width = F.when(width > 0, width).otherwise(F.greatest(F.abs(lower), F.lit(1e-300)) * 2.0**-52)
    finite = ~F.isnan(width) & (width < float("inf")) & (F.abs(lower) < float("inf")) & (F.abs(upper) < float("inf"))
    return F.when(finite, F.ceil(F.log2(width)).cast("int")).otherwise(UNBOUNDED)


def bin_cells(low: Column, high: Column, level: Column) -> Column:
    """The cells that a bin touches on its level, as an array of at most a few."""
    return F.sequence(cell_of(low, level), cell_of(high, level))


#: Rows that few bins become when each part of the rows gets bins of its own.
DEALT_BINS = 65_536


def bin_lookup(
    fact: DataFrame,
    bins: DataFrame,
    value: Column,
    equal: dict[str, str] | None = None,
    how: str = "inner",
    low: str = "min_value",
    high: str = "max_value",
) -> DataFrame:
    """Join each row to the bins with low <= value < high and, with ``equal`` (fact column -> bin column), equal keys.

    The plan is an equi join on the keys and a coarse place, with the range as residual test: a bin's level is its width as a
    power of two, it lies in at most a few cells of that width, and a row meets the one cell of its value on each level that
    occurs. So a row meets only bins near its value, however many a key has. Bins and rows are both shuffled, unless one side is
    small; only the levels, a few thousand at most for any bins, come from a subquery of the same job. Few bins have few cells,
    and all rows would go to as many tasks: rows are dealt into parts by turns, and each part has its copy of the bins. The more
    bins there are the fewer parts, up to ``DEALT_BINS`` rows in all; from there on bins are not copied.
    """
    equal = equal or {}
    keys = list(equal.values())
    outputs = [c for c in bins.columns if c not in (low, high, *keys)]
    levelled = bins.where(F.col(low) < F.col(high)).withColumn("__level", bin_level(F.col(low), F.col(high)))
    parts = F.greatest(F.lit(1), F.least(F.lit(DEALS), F.floor(F.lit(DEALT_BINS) / F.greatest(F.count("__level"), F.lit(1))).cast("int")))
    measured = levelled.select(F.struct(F.collect_set("__level").alias("levels"), parts.alias("parts"))).scalar()
    dealt = levelled.withColumn("__line_part", F.explode(F.sequence(F.lit(0), measured["parts"] - 1)))
    lines = dealt.select(
        "__line_part", F.col("__level").alias("__line_level"), F.explode(bin_cells(F.col(low), F.col(high), F.col("__level"))).alias("__line_cell"),
        F.col(low).alias("__low"), F.col(high).alias("__high"), *[F.col(c).alias(f"__key{n}") for n, c in enumerate(keys)],
        *[F.col(c).alias(f"__out{n}") for n, c in enumerate(outputs)],
    )
    part = F.pmod(F.monotonically_increasing_id(), measured["parts"]).cast("int")
    rows = fact.select("*", value.alias("__value"), part.alias("__part"))
    if how != "inner":
        rows = rows.withColumn("__row", F.monotonically_increasing_id())
    explode = F.explode if how == "inner" else F.explode_outer
    rows = rows.withColumn("__level", explode(measured["levels"])).withColumn("__cell", cell_of(F.col("__value"), F.col("__level")))
    tests = [rows[left] == lines[f"__key{n}"] for n, left in enumerate(equal)]
    tests += [F.col("__part") == F.col("__line_part"), F.col("__level") == F.col("__line_level"), F.col("__cell") == F.col("__line_cell")]
    tests += [F.col("__value") >= F.col("__low"), F.col("__value") < F.col("__high")]
    joined = rows.join(lines, reduce(lambda a, b: a & b, tests), how)
    if how != "inner":
        # A row that meets no bin on any level comes back once.
        hit = F.col("__low").isNotNull()
        place = F.row_number().over(Window.partitionBy("__row").orderBy(hit.desc()))
        joined = joined.withColumn("__place", place).where(hit | (F.col("__place") == 1))
    return joined.select(*[rows[c] for c in fact.columns], *[F.col(f"__out{n}").alias(c) for n, c in enumerate(outputs)])
