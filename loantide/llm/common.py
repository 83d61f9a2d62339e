"""What the operators share: the folder for tables between jobs, and word normalisation."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()
_KEPT: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What a reused Python worker holds between tasks: one value, that of the operator it last worked for."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def release(key: str | None) -> None:
    """Drops what the worker holds, but for ``key``."""
    for other in [k for k in _KEPT if k != key]:
        del _KEPT[other]


def ship(spark: SparkSession) -> None:
    """Sends this subpackage to the executors' Python workers, once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="loantide-code-")) / "loantide_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        out.write(here.parent / "__init__.py", f"{here.parent.name}/__init__.py")
        for file in sorted(here.glob("*.py")):
            out.write(file, f"{here.parent.name}/{here.name}/{file.name}")
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema, holds: str | None = None) -> DataFrame:
    """``mapInArrow`` on workers that have this subpackage and hold nothing of other operators (``holds``: the own key)."""
    ship(df.sparkSession)

    def alone(batches):
        release(holds)
        yield from run(batches)

    return df.mapInArrow(alone, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; its own one only for a local session."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if sc.applicationId not in _OWN:
        _OWN[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="loantide-shared-")
        sc.setCheckpointDir(_OWN[sc.applicationId])
    return _OWN[sc.applicationId]


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Parts that a side with one row a key is dealt into again.
DEALS = 1_024


def joined_anew(rows: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``few``, which an aggregate left with one row for each key (never null).

    Such rows are dealt by the key already, and Spark would take them as they are. A number made from the key as second join
    column makes it deal them anew, so that adaptive execution finds two shuffles and can split the rows of a hot key.
    """
    deal = F.pmod(F.xxhash64(key), F.lit(DEALS)).alias("deal")
    return rows.select("*", deal).join(few.select("*", deal), [key, "deal"], how).drop("deal")


def text_ids(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """``docs`` with a long number for each text: equal texts have the same, and unlike ones different numbers.

    The number is a 64-bit hash. A second, independent hash tells where texts share the first, and all of those but one get
    another number, so only texts that agree in 128 bits are taken for one. Such cases are few (some hundreds in 10^11 texts).
    """
    number, second = F.xxhash64(text), F.xxhash64(F.lit("second"), text)
    pairs = docs.select(number.alias("clash"), second.alias("second"))
    ends = pairs.groupBy("clash").agg(F.min("second").alias("least"), F.max("second").alias("most"))
    clashes = written(ends.filter("least < most").select("clash", "least"), "clashes")
    if clashes.isEmpty():
        return docs.withColumn(name, number)
    other = F.when(second != F.col("least"), F.xxhash64(F.lit("clash"), number, second)).otherwise(number)
    return docs.join(clashes, number == clashes["clash"], "left").withColumn(name, F.coalesce(other, number)).drop("clash", "least")


#: A-Z to a-z; every other ASCII byte but 0-9 and a-z to a space. Bytes from 0x80 belong to words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: The same words as a pattern, for offsets in the original text.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[bytes]:
    """The normalised words of a text as UTF-8; none for null."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_line(text: Column, gap: str) -> Column:
    """The normalised words joined by ``gap`` (without leading or trailing gap), as a column; null counts as empty."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.trim(F.regexp_replace(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", gap))
