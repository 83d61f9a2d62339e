"""Risk score-card: categorical and numeric lines per field, looked up and summed.

A contract is asked field by field: it becomes one short row a field, all of them
meet the lines of both cards in one equi join on field, category, package and
place (the cell of a bin, or a listed value), and the scores are summed up again
by contract. So a row meets only lines near its value, however many a card has,
and how the join runs is left to the measured size of the cards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.numbers import millions
from ..functions.text import blank_to_null
from ..operators.lookups import bin_cells, bin_level, cell_of

NUMERIC_FIELDS = fv.GLOBAL_NUMERIC_FIELDS + fv.CATEGORY_NUMERIC_FIELDS
FIELDS = fv.CATEGORICAL_FIELDS + NUMERIC_FIELDS
TERM_RANGE = "package_time_range"
# Columns the score of a field is looked up with, where they are named differently.
VALUE_OF = {"cus_score": "customer_score", "package_money_range": "net_disbur"}


def numeric_lines(card: DataFrame) -> DataFrame:
    """(field_check, categoryname, low, high, package, score), open ends filled."""
    field, package = F.col("field_check"), F.coalesce("package_name", F.lit(fv.ORDINARY_LOAN))
    # One branch a field; each end stands once in the expression, since copies of it would double with every field.
    ends = [reduce(lambda made, f: made.when(field == f, F.lit(fv.OPEN_BIN_ENDS[f][side])), fv.OPEN_BIN_ENDS, F) for side in (0, 1)]
    low, high = [F.coalesce(F.col(name), end) for name, end in zip(("min_value", "max_value"), ends)]
    return card.select(
        "field_check", "categoryname", low.cast("double").alias("low"), high.cast("double").alias("high"),
        F.when(field == "processing_minute", package).alias("package"), F.col("risk_score").cast("double").alias("score"),
    )


def categorical_lines(card: DataFrame) -> DataFrame:
    """(field_check, categoryname, value, score), the highest score when a value repeats; the term range keeps its category."""
    category = F.when(F.col("field_check") == TERM_RANGE, F.col("categoryname")).alias("categoryname")
    return card.groupBy("field_check", category, "value").agg(F.max(F.col("risk_score").cast("double")).alias("score"))


def _apart(bins: DataFrame) -> DataFrame:
    """Bins as they are; two of a field, category and package that cover the same value fail the job, since a contract would be
    counted twice."""
    following = F.lead("low").over(W.partitionBy("field_check", "categoryname", "package").orderBy("low", "high"))
    clash = F.raise_error(F.concat(F.lit("overlapping bins in "), F.col("field_check"))).cast("double")
    return bins.withColumn("high", F.when(F.col("high") > following, clash).otherwise(F.col("high")))


def card_lines(categorical: DataFrame, numeric: DataFrame) -> tuple[DataFrame, Column]:
    """All lines of both cards by the place where a contract meets them, and the levels of the bins of each field.

    (line_field, line_scope, line_package, line_place, low, high, score): a line is in the scope of one category or, as the
    empty text, of all. The place of a bin is each cell that it touches on its level, that of a listed value the value itself.
    """
    bins = numeric_lines(numeric).where(F.col("low") < F.col("high"))
    everywhere = F.col("categoryname") == fv.ALL_CATEGORIES
    own, shared = F.col("field_check").isin(fv.CATEGORY_NUMERIC_FIELDS), F.col("field_check").isin(fv.GLOBAL_NUMERIC_FIELDS)
    bins = _apart(bins.where((own & ~everywhere) | (shared & everywhere))).withColumn("level", bin_level(F.col("low"), F.col("high")))
    cells = F.explode(bin_cells(F.col("low"), F.col("high"), F.col("level"))).alias("cell")
    spans = bins.select(
        "field_check", F.when(shared, "").otherwise(F.col("categoryname")).alias("scope"), F.coalesce("package", F.lit("")).alias("package"),
        "level", "low", "high", "score", cells,
    )
    values = categorical_lines(categorical).where(F.col("field_check").isin(fv.CATEGORICAL_FIELDS)).select(
        "field_check", F.when(F.col("field_check") == TERM_RANGE, F.col("categoryname")).otherwise("").alias("scope"), F.lit("").alias("package"),
        _listed(F.col("value")).alias("place"), *[F.lit(None).cast("double").alias(c) for c in ("low", "high")], "score",
    )
    lines = spans.withColumn("place", _binned(F.col("level"), F.col("cell"))).select(*values.columns).unionByName(values)
    levels = bins.groupBy("field_check").agg(F.collect_set("level").alias("levels")).select(
        F.map_from_entries(F.collect_list(F.struct("field_check", "levels")))
    )
    return lines.withColumnsRenamed({"field_check": "line_field", **{c: f"line_{c}" for c in ("scope", "package", "place")}}), levels.scalar()


def _listed(value: Column) -> Column:
    """The place of a listed value. A blank line of the card is one too: it scores contracts without a value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("blank"))


def _binned(level: Column, cell: Column) -> Column:
    return F.concat(level.cast("string"), F.lit(":"), cell.cast("string"))


def _field_rows(rows: DataFrame, key: str) -> DataFrame:
    """One row a field of each contract, and one that carries its facts: key, facts, field, scope, package, value, listed.

    The fields come from a literal and fetch their values by number, which keeps the generated code short.
    """
    numeric = F.array(*[F.col(VALUE_OF.get(f, f)).cast("double") for f in NUMERIC_FIELDS])
    listed = F.array(*[_listed(F.col(f)) for f in fv.CATEGORICAL_FIELDS])
    kinds = [F.struct(F.lit(None).cast("string").alias("field"), F.lit(-1).alias("bin"), F.lit(-1).alias("list"), F.lit(False).alias("own"))]
    for f in FIELDS:
        bin_no, list_no = (names.index(f) if f in names else -1 for names in (NUMERIC_FIELDS, fv.CATEGORICAL_FIELDS))
        own = f == TERM_RANGE or f in fv.CATEGORY_NUMERIC_FIELDS
        kinds.append(F.struct(F.lit(f).alias("field"), F.lit(bin_no).alias("bin"), F.lit(list_no).alias("list"), F.lit(own).alias("own")))
    each = rows.select(
        F.col(key).alias("key"), F.struct(*rows.columns).alias("facts"), numeric.alias("values"), listed.alias("texts"), "category_name", "package_name"
    ).withColumn("f", F.explode(F.array(*kinds)))
    package = F.when(F.col("f.field") == "processing_minute", F.col("package_name")).otherwise(F.lit(""))
    return each.select(
        "key", F.when(F.col("f.field").isNull(), F.col("facts")).alias("facts"), F.col("f.field").alias("field"),
        F.when(F.col("f.own"), F.col("category_name")).otherwise("").alias("scope"), package.alias("package"),
        F.get("values", F.col("f.bin")).alias("value"), F.get("texts", F.col("f.list")).alias("listed"),
    )


def scorecard(features: DataFrame, categorical: DataFrame, numeric: DataFrame, focus_packages: DataFrame,
              mean_score: Column | None = None, key: str = "pawnid") -> DataFrame:
    """Score contracts other than car titles and cars; ``key`` is a column that is unique to a contract.

    A contract outside every bin of a numeric field is left out; an unlisted
    categorical value scores 0. A missing customer score takes the mean of the
    others; ``compliance.mean_score`` gives that mean without a second pass over
    all features.
    """
    name = F.col("category_name")
    rows = features.where(name.isNull() | ~name.isin(fv.CAR_TITLE, fv.CAR))
    if mean_score is None:
        mean_score = rows.select(F.avg("customer_score")).scalar()
    rows = rows.withColumns({
        "customer_score": F.coalesce("customer_score", mean_score),
        "ols_pred_score": F.coalesce("ols_pred_score", F.lit(fv.DEFAULT_PREDICTED_SCORE)),
        "average_nums_checked_pawn": F.coalesce("average_nums_checked_pawn", F.lit(0.0)),
        "net_disbur": millions(F.col("net_disbur")),
        "nums_day_in_month": F.coalesce("nums_day_in_month", F.dayofmonth("extract_date")),
    })
    facts = rows.columns
    lines, levels = card_lines(categorical, numeric)
    asked = _field_rows(rows, key).withColumn("level", F.explode_outer(levels[F.col("field")]))
    asked = asked.withColumn("place", F.coalesce("listed", _binned(F.col("level"), cell_of(F.col("value"), F.col("level")))))
    meets = [F.col(f"line_{c}") == F.col(c) for c in ("field", "scope", "package", "place")]
    meets.append(F.col("low").isNull() | ((F.col("value") >= F.col("low")) & (F.col("value") < F.col("high"))))
    # The rows of a contract meet again where they were made, before the shuffle.
    scored = asked.join(lines, reduce(lambda a, b: a & b, meets), "left").groupBy("key").agg(
        F.first("facts", ignorenulls=True).alias("facts"), F.count("low").alias("bins"),
        *[F.max(F.when(F.col("field") == f, F.col("score"))).alias(f"{f}_score") for f in FIELDS],
    )
    rows = scored.where(F.col("bins") == len(NUMERIC_FIELDS)).select("facts.*", *[f"{f}_score" for f in FIELDS])
    # Focus packages are attached to motorbike titles only.
    packages = focus_packages.drop("package_name")
    titled = F.when(name == fv.BIKE_TITLE, blank_to_null(F.col("packagecode")))
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"{f}_score"), F.lit(0.0)) for f in FIELDS])
    return rows.join(packages, titled == F.col("package_code"), "left").select(
        *facts,
        *[F.col(f"{f}_score").alias(f"{f}_risk_score") for f in FIELDS],
        *packages.columns,
        total.alias("total_score"),
    )
