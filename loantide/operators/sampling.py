"""Top-n and stratified quota samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def quota_sample(df: DataFrame, stratum: Column, quotas: dict[str, int] | DataFrame, *order: Column,
                 per: list[str] | None = None) -> DataFrame:
    """The best ``quotas[s]`` rows of each stratum (and of each value of the ``per`` columns).

    ``quotas`` may also be a table with a row for each stratum, columns ``stratum`` and ``quota``; of a stratum with several
    rows the greatest quota holds, and one of 0 or null takes nothing. A literal bound on the rank lets Spark cut every map
    partition to the largest quota before the shuffle, so a stratum with most of the rows costs no more than a small one; for a
    table, that bound is looked up in it first. Rows of strata without a quota are left out before, those without a stratum
    too. End ``order`` with a unique column.
    """
    rows = df.withColumn("stratum", stratum)
    if isinstance(quotas, DataFrame):
        wanted = quotas.groupBy("stratum").agg(F.max(F.col("quota").cast("long")).alias("__quota")).where(F.col("__quota") > 0)
        bound = wanted.agg(F.max("__quota")).first()[0] or 0
        rows, quota = rows.join(wanted, "stratum"), F.col("__quota")
    else:
        bound = max(quotas.values(), default=0)
        rows = rows.where(F.col("stratum").isin(list(quotas)))
        quota = F.coalesce(*[F.when(F.col("stratum") == name, F.lit(size)) for name, size in quotas.items()], F.lit(0))
    ranking = W.partitionBy(*(per or []), "stratum").orderBy(*order)
    ranked = rows.withColumn("sample_rank", F.row_number().over(ranking)).where(F.col("sample_rank") <= bound)
    return ranked.where(F.col("sample_rank") <= quota).select(*df.columns, *[c for c in ("stratum", "sample_rank") if c not in df.columns])
