"""Column types that compare the same way in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates and times as text, decimals as doubles, whole numbers as bigint, doubles rounded."""
    columns = []
    for field in df.schema:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(kind, T.DecimalType):
            col = F.round(col.cast("double"), digits)
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("long")
        elif isinstance(kind, T.DoubleType):
            col = F.round(col, digits)
        elif isinstance(kind, T.ArrayType):
            col = F.concat_ws(";", col)
        columns.append(col.alias(field.name))
    return df.select(columns)
