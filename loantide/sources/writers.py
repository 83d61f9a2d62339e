"""Writers: overwritten tables, the append-only log, dated snapshots, long reports."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, display_date
from ..operators.sets import reindex
from . import versions

LOG_KEYS = ["extrac_date", "risk_type"]


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a whole output. Readers (``readers.read_output``) see the old rows until all new ones are written and recorded;
    a job that fails before that leaves the output as it was (see ``versions``)."""
    versions.publish(df, path, fmt)


def write_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table by name.

    The rows become a new version of an output below ``path`` (the warehouse folder by default), and the name a view of that
    version, which is one change in the catalogue. Until then the name shows the old rows, also if the job fails; the new
    rows may have other columns.
    """
    spark = df.sparkSession
    path = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
    folder = versions.publish(df, path)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")


def append_log(df: DataFrame, path: str, columns: list[str], run_id: str, keys: list[str] | None = None) -> None:
    """Add one run to the log, its columns aligned by name.

    ``run_id`` names the product and its day. Every run is a part of its own, partitioned by run date and risk type:
    another product of the same day and type stays, and repeating a run replaces exactly what it wrote before, also where it
    now finds less or nothing. A run that fails, at first or when repeated, changes nothing for the readers
    (``readers.read_log``).
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id consists of letters, digits, _, . and -: {run_id!r}")
    keys = keys or LOG_KEYS
    versions.publish(reindex(df, columns).hint("rebalance", *keys), path, partition_by=keys, part=run_id)


def append_rows(df: DataFrame, path: str, columns: list[str]) -> None:
    """Plain append with the columns aligned by name."""
    reindex(df, columns).write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Add days to the snapshot table, partitioned by day.

    Rebalancing packs small days into few files and splits large ones over many tasks.
    """
    (
        df.hint("rebalance", "created")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("created")
        .parquet(path)
    )


def write_snapshot_table(df: DataFrame, name: str, buckets: int) -> None:
    """Add days to a snapshot table bucketed by contract: joins of two days on ``pawnid`` need no shuffle.

    The first call creates the table. Later ones replace the days they bring and leave all others as they are; the number of
    buckets stays that of the first.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        (
            df.repartition(buckets, "pawnid")
            .write.partitionBy("created")
            .bucketBy(buckets, "pawnid")
            .sortBy("pawnid")
            .saveAsTable(name)
        )
        return
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).repartition(buckets, "pawnid").write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def write_report(report: DataFrame, path: str) -> None:
    """A long report, one directory per section."""
    (
        report.hint("rebalance", "section_no")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("section_no")
        .parquet(path)
    )


def as_of_title(title: str, as_of: dt.date | str) -> Column:
    """Report title ending in the as-of date."""
    return F.concat(F.lit(f"{title} "), display_date(F.lit(as_date(as_of))))


def newest_day_title(df: DataFrame, title: str, created: str = "created") -> DataFrame:
    """One row with the title, dated by the newest ``created`` in the data."""
    return df.agg(F.concat(F.lit(f"{title} "), display_date(F.max(created))).alias("as_of_title"))


def back_up(df: DataFrame, columns: list[str], path: str) -> None:
    """Append a copy of selected columns."""
    append_rows(df, path, columns)
