"""Queries over what the writers stored: the driver's tables are written to a scratch folder and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loantide.functions import fixed_values as fv
from loantide.operators import crosstab, sampling
from loantide.sources import readers, schemas, writers

from . import params as P
from . import views as V
from .duck_views import query


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that all machines share; a local session may have one of its own."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="loantide-stored-")
    return f"{shared}/stored-{uuid.uuid4().hex}"


def overwritten_output(spark, sf):
    """An output that was written twice, the second time from itself."""
    path = scratch(spark)
    writers.write_overwrite(V.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), path)
    writers.write_overwrite(readers.read_output(spark, path).where("o_orderstatus <> 'P'"), path)
    return readers.read_output(spark, path)


def replaced_table(spark, sf):
    """A table whose second version has other columns."""
    name, path = f"stored_{uuid.uuid4().hex}", scratch(spark)
    customers = V.table(spark, sf, "customer")
    writers.write_table(customers.select("c_custkey"), name, path)
    writers.write_table(customers.groupBy("c_nationkey").agg(F.count("c_custkey").alias("n")), name, path)
    return spark.table(name)


def log_runs(spark, sf):
    """A log of one run a risk type; one run is repeated after it had written something else."""
    path, log = scratch(spark), V.checking_log(spark, sf)
    fraud, other = log.where(F.col("risk_type") == fv.FRAUD), log.where(F.col("risk_type") != fv.FRAUD)
    writers.append_log(fraud.limit(100), path, fv.CHECKING_COLUMNS, "fraud", ["risk_type"])
    writers.append_log(other.drop("reason_check"), path, fv.CHECKING_COLUMNS, "other", ["risk_type"])
    writers.append_log(fraud, path, fv.CHECKING_COLUMNS, "fraud", ["risk_type"])
    return readers.read_checking_log(spark, path)


def backed_up_columns(spark, sf):
    path = scratch(spark)
    for half in (0, 1):
        writers.back_up(V.contract_core(spark, sf).where(F.col("pawnid") % 2 == half), ["codeno", "categoryname", "remark"], path)
    return readers.read_parquet(spark, path)


def as_of_titles(spark, sf):
    panel = V.snapshot(spark, sf, P.AS_OF, with_shop=False)
    return writers.newest_day_title(panel, "Report").select("as_of_title", writers.as_of_title("Daily", P.AS_OF).alias("fixed_title"))


def _staged(df: DataFrame, path: str) -> str:
    """A sheet of several files, each with its header, all cells quoted."""
    df.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return path


def text_sheet(spark, sf):
    """Whole texts with breaks, quotes and commas, as cells of a sheet."""
    texts = V.table(spark, sf, "documents").select("doc_id", "lang", F.regexp_replace("text", "e", '",\n"').alias("said"))
    path = _staged(texts, scratch(spark))
    return readers.read_text_sheet(spark, path, ["said", "doc_id"]).select("doc_id", F.md5("said").alias("said"), F.length("said").alias("n"))


def typed_sheet(spark, sf):
    lines = V.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderkey") % 7 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(" ").alias("day"),
    )
    schema = spark.createDataFrame([], "day date, price decimal(18,2), o_orderkey long").schema
    return readers.read_typed_sheet(spark, _staged(lines, scratch(spark)), schema)


def sheet_range(spark, sf):
    """Columns B and C of rows 1 to 16 of a sheet of all nations in order."""
    nations = V.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey", "n_nationkey").toDF("no", "n_name", "n_regionkey", "again")
    path = _staged(nations.orderBy("no").coalesce(1), scratch(spark))
    return readers.read_text_sheet(spark, path, ["n_regionkey", "n_name"], start="B1", end="C16")


def quotas_from_a_table(spark, sf):
    """The richest customers of each nation, as many as a table of quotas says."""
    quotas = V.table(spark, sf, "nation").select(F.col("n_nationkey").alias("stratum"), (F.col("n_nationkey") % 6).alias("quota"))
    found = sampling.quota_sample(V.table(spark, sf, "customer"), F.col("c_nationkey"), quotas, F.desc("c_acctbal"), F.col("c_custkey"))
    return found.select("c_nationkey", "c_custkey", "sample_rank")


def margins_of_measures(spark, sf):
    """Line items by flag, status and quarter: different suppliers, mean and greatest price, with totals."""
    lines = V.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.quarter("l_shipdate").alias("quarter"), "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    asked = {"n": ("count", "price"), "suppliers": ("nunique", "l_suppkey"), "mean_price": ("mean", "price"), "most": ("max", "price"), "least": ("min", "price")}
    return crosstab.crosstab_measures(lines, ["l_returnflag", "l_linestatus"], ["quarter"], asked)


QUERIES = {
    "overwritten_output": overwritten_output,
    "replaced_table": replaced_table,
    "log_runs": log_runs,
    "backed_up_columns": backed_up_columns,
    "as_of_titles": as_of_titles,
    "text_sheet": text_sheet,
    "typed_sheet": typed_sheet,
    "sheet_range": sheet_range,
    "quotas_from_a_table": quotas_from_a_table,
    "margins_of_measures": margins_of_measures,
}

SQL = {
    "overwritten_output": "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderstatus <> 'P'",
    "replaced_table": "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey",
    "log_runs": query("SELECT * FROM checking_log"),
    "backed_up_columns": query("SELECT codeno, categoryname, CAST(NULL AS VARCHAR) AS remark FROM contract_core"),
    "as_of_titles": f"SELECT 'Report ' || strftime(DATE '{P.AS_OF}', '%d-%m-%Y') AS as_of_title, 'Daily ' || strftime(DATE '{P.AS_OF}', '%d-%m-%Y') AS fixed_title",
    "text_sheet": """
        SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(said) AS said, length(said) AS n
        FROM (SELECT doc_id, replace(text, 'e', '",' || chr(10) || '"') AS said FROM documents)""",
    "typed_sheet": """
        SELECT CASE WHEN o_orderkey % 7 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
               CASE WHEN o_orderkey % 5 > 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS price, o_orderkey
        FROM orders""",
    "sheet_range": "SELECT CAST(n_regionkey AS VARCHAR) AS n_regionkey, n_name FROM nation WHERE n_nationkey < 15",
    "quotas_from_a_table": """
        SELECT c_nationkey, c_custkey, sample_rank
        FROM (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS sample_rank FROM customer)
             JOIN nation ON n_nationkey = c_nationkey AND sample_rank <= n_nationkey % 6""",
    "margins_of_measures": """
        SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'All' ELSE l_returnflag END AS l_returnflag,
               CASE WHEN grouping(l_linestatus) = 1 THEN '' ELSE l_linestatus END AS l_linestatus,
               CASE WHEN grouping(quarter) = 1 THEN 'All' ELSE CAST(quarter AS VARCHAR) END AS col_key,
               count(price) AS n, count(DISTINCT l_suppkey) AS suppliers, round(avg(price), 6) AS mean_price,
               max(price) AS most, min(price) AS least
        FROM (SELECT *, quarter(l_shipdate) AS quarter, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM lineitem)
        GROUP BY GROUPING SETS ((l_returnflag, l_linestatus, quarter), (l_returnflag, l_linestatus), (quarter), ())""",
}
