"""First, latest and previous rows per key.

First/latest rows are aggregates rather than ranked windows: each map task sorts
its own rows by key and sends one candidate per key, so a key holding a third of
all rows sends one row per task through the shuffle. Previous-row access slices long groups and carries
the last rows on by levels, so no task has to hold or sort the whole history of one key, nor all of its
slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1


def extreme_rows(df: DataFrame, keys: list[str], picks: dict[str, tuple[str, list[Column], list[str]]]) -> DataFrame:
    """One row per key with a struct column per pick, all from one aggregation.

    ``picks`` maps an output name to (``"max"`` or ``"min"``, ranking columns,
    payload columns). End the ranking with a unique column to settle ties.
    Nulls rank lowest.
    """
    functions = {"max": F.max_by, "min": F.min_by}
    return df.groupBy(*keys).agg(
        *[functions[kind](F.struct(*payload), F.struct(*ranking)).alias(name)
          for name, (kind, ranking, payload) in picks.items()]
    )


def latest_with_ties(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """All rows of a key that share its greatest ``order`` value."""
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    return df.join(newest, [*keys, order], "left_semi")


def descending_nulls_last(value: Column) -> Column:
    """Ranking term that makes the largest value come first inside a ``"min"`` pick."""
    return F.coalesce(-value.cast("long"), F.lit(LONG_MAX))


ID_BLOCK = 1_000_000


def dated_slice(date: str, unique_id: str, block: int = ID_BLOCK) -> Column:
    """Slice for rows ordered by (date, id): one day and one block of ids, so at most ``block`` rows of a key."""
    return F.struct(F.col(date), F.floor(F.col(unique_id) / block))


def dated_slices(date: str, unique_id: str, block: int = ID_BLOCK) -> list[Column]:
    """Slices for rows ordered by (date, id), finest first: a day and a block of ids, a day and a block of such blocks.

    However sparse the ids are, a key has at most ``block`` rows in the first and ``block`` of the first in a second; of those it
    has one a day, as long as ids lie within ``block`` squared (10^12) of each other.
    """
    blocks = F.call_function("div", F.col(unique_id), F.lit(block).cast("long"))
    wider = F.call_function("div", blocks, F.lit(block).cast("long"))
    return [F.struct(F.col(date), blocks), F.struct(F.col(date), wider)]


def _carried(tails: DataFrame, slices: list[str]) -> DataFrame:
    """(__key, finest slice, __carried): what the last row before each slice carries on, for slices that have one.

    A parallel prefix: inside a coarser slice the tail before is that of the slice before; the first slice of a coarser one
    takes what is carried over to that, found in the same way from the tails of coarser slices.
    """
    own, *coarser = slices
    last = lambda *within: F.lag("__tail").over(W.partitionBy("__key", *within).orderBy(own))
    if not coarser:
        return tails.select("__key", own, last().alias("__carried")).where(F.col("__carried").isNotNull())
    inside = tails.select("__key", own, coarser[0], last(coarser[0]).alias("__before"))
    tops = tails.groupBy("__key", *coarser).agg(F.max_by("__tail", own).alias("__tail"))
    carried = F.coalesce("__before", "__carried").alias("__carried")
    return inside.join(_carried(tops, coarser), ["__key", coarser[0]], "left").select("__key", own, carried).where(F.col("__carried").isNotNull())


def previous_row(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    output: str,
    slice_by: Column | list[Column] | None = None,
    tails_of: DataFrame | None = None,
) -> DataFrame:
    """Add struct ``output`` holding ``payload`` of the preceding row of the key.

    ``order`` must be unique inside a key. ``slice_by`` is a non-decreasing function of the order, or several of them from fine
    to coarse, each a function of the one before (see ``dated_slices``): rows are ranked inside (key, slice), and only the last
    row of each slice is carried on, from slice to slice within the next coarser one. So no task orders more than the rows of
    a slice, or the slices of a coarser one. Without it this is a plain lag. Rows whose key is null form one group, as in a
    window. ``tails_of`` names a leaner frame with the same rows to take the last rows from.
    """
    packed = F.struct(*payload)
    if slice_by is None:
        return df.withColumn(output, F.lag(packed).over(W.partitionBy(*keys).orderBy(*order)))
    levels = slice_by if isinstance(slice_by, list) else [slice_by]
    slices = [f"__slice{k}" for k in range(len(levels))]

    # As a struct the key is never null, so window, aggregate and join share one partitioning.
    def sliced(frame: DataFrame) -> DataFrame:
        return frame.withColumns({"__key": F.struct(*keys), **dict(zip(slices, levels))})

    ranked = sliced(df).withColumn("__previous", F.lag(packed).over(W.partitionBy("__key", slices[0]).orderBy(*order)))
    tails = sliced(df if tails_of is None else tails_of).groupBy("__key", *slices).agg(F.max_by(packed, F.struct(*order)).alias("__tail"))
    return (
        ranked.join(_carried(tails, slices), ["__key", slices[0]], "left")
        .withColumn(output, F.coalesce("__previous", "__carried"))
        .drop("__key", *slices, "__previous", "__carried")
    )


def last_value_per_key(df: DataFrame, keys: list[str], order: list[Column], value: str, output: str) -> DataFrame:
    """The value on the last row of each key, as one row per key."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*order)).alias(output))


def previous_since(
    rows: DataFrame,
    older: DataFrame,
    keys: list[str],
    order: list[str],
    payload: list[str],
    output: str,
    slice_by: Column | list[Column] | None = None,
    tails_of: DataFrame | None = None,
) -> DataFrame:
    """``previous_row`` for ``rows`` that continue an ``older`` history.

    All older rows precede all rows. They enter as one aggregated row per key,
    and only for keys that occur in ``rows``, so a daily run neither sorts nor
    shuffles the full history.
    """
    from .lookups import keep_matching

    # As a struct a key with nulls is a key like any other, as in a window.
    keyed = lambda frame: frame.withColumn("__old_key", F.struct(*keys))
    slim = keyed(older.select(*dict.fromkeys([*keys, *order, *payload])))
    wanted = keyed((rows if tails_of is None else tails_of).select(*keys))
    carried = keep_matching(slim, wanted, ["__old_key"]).groupBy("__old_key").agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("__older")
    )
    ranked = keyed(previous_row(rows, keys, order, payload, output, slice_by, tails_of))
    return ranked.join(carried, "__old_key", "left").withColumn(output, F.coalesce(output, "__older")).drop("__older", "__old_key")
