"""Outputs that survive a failed job.

An output is a folder that holds versions and commit records. A job writes a new version beside the ones that are there; when all
of it is written, one record, a single small file, is added that names it. Readers look the last record up and read that
version, so they see the old rows until the record is in place and all new ones from then on, also if the job or the driver
dies at any point. What a failed job left behind has no record and is never read.

One output can hold several parts with a name each, such as the runs of a log; each part has versions of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMMITS, VERSIONS = "_commits", "versions"
#: Folders of versions are partitions by this column, so that several parts, partitioned themselves, can be read at once.
COLUMN = "output_version"
RECORD = "part string, version long, folder string"


def _records(spark: SparkSession, path: str) -> DataFrame | None:
    """part, version and folder of every version that was written whole; None if the output does not exist."""
    try:
        return spark.read.schema(RECORD).json(f"{path}/{COMMITS}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _newest(records: DataFrame) -> DataFrame:
    """The last version of each part; of two jobs that wrote the same number, the one whose folder sorts last."""
    last = F.max(F.struct("version", "folder"))
    return records.groupBy("part").agg(last.alias("last")).select("part", "last.version", "last.folder")


def publish(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), part: str = "") -> str:
    """Write ``df`` as the next version of the output (or of one part of it) and make it the current one.

    The record is written only after the version is complete. A plan that reads the output's present version may be
    published to the same output, since that version stays.
    """
    spark = df.sparkSession
    records = _records(spark, path)
    before = None if records is None else _newest(records).where(F.col("part") == part).select("version").first()
    version = 1 + (before["version"] if before else 0)
    folder = f"{VERSIONS}/{COLUMN}={version:010d}-{uuid.uuid4().hex}"
    df.write.format(fmt).partitionBy(*partition_by).mode("error").save(f"{path}/{folder}")
    record = spark.range(1).select(F.lit(part).alias("part"), F.lit(version).cast("long").alias("version"), F.lit(folder).alias("folder"))
    record.coalesce(1).write.mode("append").json(f"{path}/{COMMITS}")
    return f"{path}/{folder}"


def current(spark: SparkSession, path: str) -> list[str]:
    """Folders of the last versions of all parts, in order of the parts; none if nothing was published there.

    One entry a part comes to the driver: the runs of a log, one each product and day.
    """
    records = _records(spark, path)
    if records is None:
        return []
    return [f"{path}/{r['folder']}" for r in _newest(records).orderBy("part").collect()]


def read_current(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The last version of every part. With a ``schema`` an output without any version is an empty frame."""
    folders = current(spark, path)
    if not folders:
        if schema is None:
            raise FileNotFoundError(f"nothing was published in {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.format(fmt).option("basePath", f"{path}/{VERSIONS}")
    return (reader.schema(schema) if schema else reader).load(folders).drop(COLUMN)


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete versions that ``keep`` or more newer ones of their part replaced, and give their number.

    Folders without a record are left alone, since a job may be writing them. Readers that started on a version keep it as
    long as fewer than ``keep`` newer ones exist.
    """
    records = _records(spark, path)
    if records is None:
        return 0
    newer = F.sort_array(F.collect_list(F.struct("version", "folder")), asc=False)
    old = records.groupBy("part").agg(newer.alias("all")).select(F.explode(F.slice("all", keep + 1, F.greatest(F.size("all") - keep, F.lit(0)))).alias("v"))
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [system.delete(files.Path(f"{path}/{r['folder']}"), True) for r in old.select("v.folder").collect()]
    return sum(gone)
