"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next one.

Toxic documents go; one document of each near-duplicate group stays; passages that repeat in what is left are taken out of the
texts; contaminated documents go; the rest is encoded. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loantide.llm import bpe, decontamination, neardup, queries, substrings, toxicity
from loantide.llm.common import WORD_PATTERN, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean_speech(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity reaches the threshold. Texts without words stay; all rows are scored on their own."""
    model = toxicity.train(queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, ["doc_id", "lang", "source", "n_chars"], model, name="toxicity")
    return scored.filter(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class: that of least id (nulls last), then of least text hash, once.

    Documents without words link with nothing, so all of them stay.
    """
    found = neardup.classes(docs)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    chosen = found.filter("worded").groupBy("part").agg(F.min(order).alias("first"))
    chosen = chosen.select(F.col("first.doc_id").alias("id"), F.col("first.node").alias("chosen"))
    worded = F.coalesce(F.rlike("text", F.lit(WORD_PATTERN)), F.lit(False)).alias("worded")
    keyed = neardup.numbered(docs).select(*COLUMNS, "node", worded)
    same = keyed["doc_id"].eqNullSafe(chosen["id"]) & (keyed["node"] == chosen["chosen"])
    kept = keyed.filter("worded").join(chosen, same, "left_semi")
    # Repeated rows of one id and text: the first stays; Spark cuts each part to its first row before the shuffle.
    once = Window.partitionBy("doc_id", "node").orderBy("source", "lang", "n_chars")
    ranked = kept.withColumn("rank", F.row_number().over(once)).filter("rank = 1")
    return ranked.select(*COLUMNS).unionByName(keyed.filter("NOT worded").select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages from the texts; every document stays, those without any unchanged, null texts too."""
    left = substrings.remove_repeats(docs, ["doc_id", "lang", "source", "n_chars"])
    length = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("kept").cast("long"))
    return left.select("doc_id", F.col("kept").alias("text"), "lang", "source", length.alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least a twentieth of the words are in benchmark windows. Null and empty texts, having none,
    stay, and so do all where the benchmark is empty."""
    found = decontamination.contamination(docs, queries.table(spark, sf_dir, "benchmark"), ["doc_id", "lang", "source", "n_chars"])
    hit = decontamination.n_hit()
    return found.filter((hit == 0) | (20 * hit < F.col("n_words"))).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to. Null and empty texts have no ids; an empty
    table gives no rows."""
    return queries.bpe_digest(docs, queries.rank_file())


STAGES = [
    ("toxicity", clean_speech),
    ("minhash", one_of_each),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

#: The learned filter and the signatures have no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_folder(spark)}/corpus-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
