"""Unions, schema alignment and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def union_all(*parts: DataFrame) -> DataFrame:
    """Append by column name; a column missing in one part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(*parts: DataFrame) -> DataFrame:
    return union_all(*parts).dropDuplicates()


def reindex(df: DataFrame, columns: list[str], types: dict[str, DataType] | None = None) -> DataFrame:
    """Project to a target column list; a column the frame lacks is null."""
    types = types or {}
    return df.select(
        [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(types.get(c, StringType())).alias(c) for c in columns]
    )


def with_costly_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    The optimizer copies a plain projected expression into every filter that
    reads it; a generated column is left where it is.
    """
    return df.withColumn(name, F.explode(F.array(value)))
