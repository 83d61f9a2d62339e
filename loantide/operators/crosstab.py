"""Cross-tabs with grand totals.

Cells are aggregated once; the margins are then computed from the cells by
GROUPING SETS, so the fact rows are neither scanned again nor multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"
SEPARATOR = "|"


def key_text(columns: list[str], margins: bool = True) -> Column:
    """The key of several columns as one text, different for different values.

    A backslash stands before a bar or backslash of a value where several values are joined, and before a value that reads
    like the name of the totals; all other values are their own text.
    """
    parts = [F.col(c).cast("string") for c in columns]
    if len(parts) > 1:
        parts = [F.regexp_replace(p, r"([|\\])", r"\\$1") for p in parts]
    joined = F.concat_ws(SEPARATOR, *parts)
    return F.when(joined == ALL, F.lit("\\" + ALL)).otherwise(joined) if margins else joined


def _cells(df: DataFrame, index: list[str], columns: list[str], count: str | None, total: str | None, margins: bool) -> DataFrame:
    measures = []
    if count:
        measures.append(F.count(count).alias("n"))
    if total:
        measures.append(F.sum(total).alias("amount"))
    return (
        df.dropna(subset=[*index, *columns])
        .groupBy(
            *[key_text([c], margins).alias(f"__i{k}") for k, c in enumerate(index)],
            key_text(columns, margins).alias("col_key"),
        )
        .agg(*measures)
    )


def crosstab_long(
    df: DataFrame,
    index: list[str],
    columns: list[str],
    count: str | None = "pawnid",
    total: str | None = None,
    margins: bool = True,
) -> DataFrame:
    """One row per non-empty cell: index columns, ``col_key`` and the measures ``n`` / ``amount``.

    Rows with a null index or column key count neither in cells nor in totals.
    Total rows carry ``All`` in the first index column and blanks in the others;
    see ``key_text`` for values that would read like a total.
    """
    cells = _cells(df, index, columns, count, total, margins)
    measures = [c for c in ("n", "amount") if c in cells.columns]
    rows = [f"__i{k}" for k in range(len(index))]
    if margins:
        sums = [F.sum(m).alias(m) for m in measures]
        flags = [F.grouping(rows[0]).alias("__row_total"), F.grouping("col_key").alias("__col_total")]
        cells = cells.groupingSets(
            [[*rows, "col_key"], rows, ["col_key"], []], *rows, "col_key"
        ).agg(*sums, *flags)
        is_row_total = F.col("__row_total") == 1
        keys = [F.when(is_row_total, F.lit(ALL if k == 0 else "")).otherwise(F.col(r)) for k, r in enumerate(rows)]
        col_key = F.when(F.col("__col_total") == 1, F.lit(ALL)).otherwise(F.col("col_key"))
    else:
        keys = [F.col(r) for r in rows]
        col_key = F.col("col_key")
    return cells.select(*[k.alias(c) for k, c in zip(keys, index)], col_key.alias("col_key"), *measures)


#: Measures whose state of a cell is one number that merges with those of other cells.
_MERGED = {"count": (F.count, F.sum), "sum": (F.sum, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}


def crosstab_measures(
    df: DataFrame, index: list[str], columns: list[str], measures: dict[str, tuple[str, str]], margins: bool = True
) -> DataFrame:
    """One row per non-empty cell with any measures, and totals of them.

    ``measures`` maps an output name to (count, sum, mean, min, max or nunique, column); nulls of the column count in none.
    Cells are aggregated once into states that can be merged: a number, the parts of a mean, or the distinct values of a cell,
    a row each. The totals merge the states of cells, so the mean of a total is that of its rows, a value in several cells
    counts once in their total, and the rows are neither scanned again nor multiplied. Keys and totals are laid out as in
    ``crosstab_long``.
    """
    kinds = {kind for kind, _ in measures.values()}
    if not measures or not kinds <= {*_MERGED, "mean", "nunique"}:
        raise ValueError(f"measures are count, sum, mean, min, max and nunique: {sorted(kinds)}")
    rows = [f"__i{k}" for k in range(len(index))]
    given = df.dropna(subset=[*index, *columns]).select(
        *[key_text([c], margins).alias(r) for c, r in zip(index, rows)], key_text(columns, margins).alias("col_key"),
        *[F.col(column).alias(f"__m{n}") for n, (_, column) in enumerate(measures.values())],
    )
    keys = [*rows, "col_key"]
    sets = [keys, rows, ["col_key"], []] if margins else [keys]
    totals = [F.grouping(rows[0]).cast("int").alias("__row_total"), F.grouping("col_key").cast("int").alias("__col_total")]
    states, merges, distinct = [], [], {}
    for n, (name, (kind, _)) in enumerate(measures.items()):
        value = F.col(f"__m{n}")
        if kind in _MERGED:
            first, again = _MERGED[kind]
            states.append(first(value).alias(f"__s{n}"))
            merges.append(again(f"__s{n}").alias(name))
        elif kind == "mean":
            states += [F.sum(value).alias(f"__s{n}"), F.count(value).alias(f"__c{n}")]
            merges.append(F.try_divide(F.sum(f"__s{n}"), F.sum(f"__c{n}")).alias(name))
        else:
            distinct[name] = given.select(*keys, value.alias("__v")).distinct()
    # At least the keys of all cells, so that a cell of nulls has its row in every part.
    cells = given.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), *states)
    merged = cells.groupingSets(sets, *keys).agg(*totals, F.sum("__rows").alias("__rows"), *merges)
    for name, values in distinct.items():
        counted = values.groupingSets(sets, *keys).agg(*totals, F.count_distinct("__v").alias(name))
        on = [merged[c].eqNullSafe(counted[c]) for c in (*keys, "__row_total", "__col_total")]
        merged = merged.join(counted, on, "left").select(*[merged[c] for c in merged.columns], counted[name])
    row_total, col_total = F.col("__row_total") == 1, F.col("__col_total") == 1
    out = [F.when(row_total, F.lit(ALL if k == 0 else "")).otherwise(F.col(r)).alias(c) for k, (r, c) in enumerate(zip(rows, index))]
    # The grand total of no rows is no cell.
    return merged.where("__rows > 0").select(*out, F.when(col_total, F.lit(ALL)).otherwise(F.col("col_key")).alias("col_key"), *measures)


def crosstab_wide(long: DataFrame, index: list[str], col_keys: list[str], measure: str = "n", fill: float | None = 0) -> DataFrame:
    """Spread ``col_key`` over columns; empty cells are ``fill``."""
    wide = long.groupBy(*index).pivot("col_key", col_keys).agg(F.first(measure))
    if fill is None:
        return wide.select(*index, *[F.col(f"`{k}`") for k in col_keys])
    return wide.select(*index, *[F.coalesce(F.col(f"`{k}`"), F.lit(fill)).alias(k) for k in col_keys])
