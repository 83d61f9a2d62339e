"""Readers: warehouse over JDBC, dated snapshot tables, and staged sheet exports."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.dates import as_date
from ..functions.text import blank_to_null
from . import versions
from .schemas import CHECKING_LOG


def read_warehouse(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    fetch_size: int = 50_000,
) -> DataFrame:
    """A warehouse table (or parenthesised query) over JDBC.

    ``options`` carries the url, driver and credentials of the caller. With a
    partition column the read is split into parallel range queries; filters and
    projections on the result are sent to the database.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column is not None:
        lower, upper = bounds
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_output(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """What ``writers.write_overwrite`` last wrote whole."""
    return versions.read_current(spark, path, schema, fmt)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def snapshot_at(panel: DataFrame, created: dt.date | str) -> DataFrame:
    """One day of a snapshot table; on a table partitioned by ``created`` only that partition is read."""
    return panel.where(F.col("created") == F.lit(as_date(created)))


def run_sql(spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None, **parameters) -> DataFrame:
    """SQL over ``{named}`` frames with ``:named`` parameters; values are bound, never pasted into the text."""
    return spark.sql(query, args=parameters, **(tables or {}))


def _lines_in_splits() -> Callable:
    """A function that walks batches of lines, each line with its split's columns before it and its break at its end.

    It gives each run of lines of one split: the columns, the bytes, where breaks (\\n, \\r\\n or \\r) end, and for every byte whether
    the quotes up to it are odd in number. Functions made inside others travel with their tasks, so executors need no package.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, np.ndarray, np.ndarray]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            file, split, text = batch.column(0), batch.column(1).to_numpy(), batch.column(batch.num_columns - 1)
            wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
            offsets = np.frombuffer(text.buffers()[1], wide)[text.offset : text.offset + len(text) + 1]
            data = np.frombuffer(text.buffers()[2], np.uint8)
            new = (split[1:] != split[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(split)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = data[offsets[a] : offsets[b]]
                odd = np.bitwise_xor.accumulate((part == 34).view(np.uint8))
                breaks = (part == 10) | ((part == 13) & (np.append(part[1:], 10) != 10))
                yield tuple(c[a].as_py() for c in batch.columns[:-1]), part, np.flatnonzero(breaks) + 1, odd

    return runs


def _splits(lines: DataFrame) -> DataFrame:
    """file, split, first (the number of the record in which the split starts), open (1 inside quotes, else 0) and odd."""
    runs = _lines_in_splits()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits: dict[tuple, list[int]] = {}
        for key, _, ends, odd in runs(batches):
            held = splits.setdefault(key, [0, 0, 0])
            after_odd = int(np.count_nonzero(odd[ends - 1] ^ held[0]))
            held[1] += len(ends) - after_odd
            held[2] += after_odd
            held[0] ^= int(odd[-1])
        columns = list(zip(*(key + tuple(held) for key, held in splits.items()), strict=True))
        if columns:
            kinds = [pa.string(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "split", "quotes", "even", "odd"])

    splits = lines.mapInArrow(count, "file string, split long, quotes long, even long, odd long")
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    open_, whole = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2, F.sum("quotes").over(W.partitionBy("file"))
    unclosed = F.raise_error(F.concat(F.lit("a quote is never closed in "), F.col("file"))).cast("long")
    splits = splits.select("file", "split", F.when(whole % 2 == 1, unclosed).otherwise(open_).alias("open"), "quotes", "even", "odd")
    ended = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("odd"))
    return splits.select("file", "split", F.coalesce(F.sum(ended).over(before), F.lit(0)).alias("first"), "open", F.col("quotes").alias("odd"))


def _pieces(lines: DataFrame, splits: DataFrame, low: int, high: int | None, whole: bool | None = None) -> DataFrame:
    """file, number, split and text of the records from ``low`` to below ``high`` in the given splits: those that lie in one split
    (``whole``), the pieces of those that do not (``whole=False``), or both.

    The splits, a short row for a hundred megabytes of a file or for a small file, go to every task: lines stay where they are read.
    """
    runs, limit = _lines_in_splits(), float("inf") if high is None else high

    def rows(file: str, split: int, numbers: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(numbers)
        columns = [pa.array([file] * n, pa.string()), pa.array(numbers, pa.int64()), pa.array(np.full(n, split), pa.int64()), texts]
        return pa.RecordBatch.from_arrays(columns, names=["file", "number", "split", "text"])

    def wanted(numbers: np.ndarray, inside: np.ndarray) -> np.ndarray:
        return (numbers >= low) & (numbers < limit) & (True if whole is None else inside == whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rest = None, []

        def close() -> Iterator[pa.RecordBatch]:
            text = b"".join(rest)
            rest.clear()
            if text and wanted(np.array([number]), np.array([False]))[0]:
                yield rows(*key, np.array([number]), pa.array([text], pa.binary()).view(pa.string()))

        for (file, split, first, open_), part, ends, odd in runs(batches):
            if key != (file, split):
                yield from close()
                key, number, inside, quoted = (file, split), first, open_ == 0, open_
            if number >= limit:
                continue
            stops = ends[(odd[ends - 1] ^ quoted) == 0]
            quoted ^= int(odd[-1])
            last = int(stops[-1]) if len(stops) else 0
            if last:
                numbers, insides = number + np.arange(len(stops)), np.ones(len(stops), bool)
                insides[0] = inside
                some = wanted(numbers, insides)
                if some.any():
                    held = sum(map(len, rest))
                    offsets = np.concatenate([[0], stops + held]).astype(np.int32)
                    text = pa.py_buffer(b"".join([*rest, part[:last]]))
                    texts = pa.Array.from_buffers(pa.string(), len(stops), [None, pa.py_buffer(offsets), text])
                    yield rows(file, split, numbers[some], texts.filter(pa.array(some)))
                rest.clear()
                number, inside = number + len(stops), True
            if last < len(part):
                rest.append(part[last:].tobytes())
        yield from close()

    near = splits if high is None else splits.where(F.col("first") < high)
    placed = lines.join(F.broadcast(near.drop("odd")), ["file", "split"])
    return placed.select("file", "split", "first", "open", "text").mapInArrow(cut, "file string, number long, split long, text string")


def _records(spark: SparkSession, path: str, low: int, high: int | None) -> tuple[DataFrame, DataFrame]:
    """Frames of file, number and record of staged sheets, blank rows counted, from files that are read in splits: the rows from
    ``low`` to below ``high`` and, of each file, the row before ``low``.

    A line break ends a record where the quotes before it are even in number. A first pass counts for each split its quotes and
    the breaks that would end a record after an even and after an odd number of earlier quotes; a running sum over the splits of
    a file, a row each, tells which count holds, and with it the numbers of a split's records. The next pass cuts the lines into
    records in the task that reads them. Only the pieces of a record that reaches over splits, and headers, are shuffled, to be
    put together by their number. A file whose quotes are odd in number is an error.
    """
    source = spark.read.option("lineSep", "\n").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    lines = source.select(*place, F.concat("value", F.lit("\n")).alias("text"))
    splits = _splits(lines)
    parts = F.array_sort(F.collect_list(F.struct("split", "text")))
    glue = lambda pieces: pieces.groupBy("file", "number").agg(F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"))
    text, mark = F.col("text"), F.col("text").startswith("\ufeff").cast("int")
    ended = F.when(text.endswith("\r\n"), 2).when(text.endswith("\n") | text.endswith("\r"), 1).otherwise(0)
    record = text.substr(mark + 1, F.length(text) - mark - ended).alias("record")
    across = splits.where((F.col("open") == 1) | (F.col("odd") == 1))
    rows = _pieces(lines, splits, low, high, whole=True).select("file", "number", "text").unionByName(glue(_pieces(lines, across, low, high, whole=False)))
    headers = glue(_pieces(lines, splits, low - 1, low))
    return rows.select("file", "number", record), headers.select("file", "number", record)


def _cell_at(reference: str) -> tuple[int, int]:
    """Row and column, from 1, of a cell such as B7."""
    letters, row = re.fullmatch(r"([A-Z]+)([1-9][0-9]*)", reference).groups()
    return int(row), reduce(lambda n, letter: n * 26 + ord(letter) - 64, letters, 0)


def _csv_rows(spark: SparkSession, path: str, columns: list[str], skip_rows: int, start: str | None = None, end: str | None = None) -> DataFrame:
    """The cells below the header as text, one column for each name in ``columns``.

    The header is the last of the ``skip_rows`` rows of each file, blank rows counted; its names say which column is which,
    and a name that a file lacks is an error. Without a header (``skip_rows`` 0) columns go by position. ``start`` and ``end``
    are the corners of a rectangle instead, as in B1 and C60: the header stands in its first row, and cells outside count
    neither as names nor as values. Files are independent of each other, and a large one is read by many tasks.
    """
    last, left, right = None, 1, None
    if start:
        skip_rows, left = _cell_at(start)
    if end:
        last, right = _cell_at(end)
    cell = r',((?:"[^"]*+")++|[^,]*+)'
    # A cell that starts with a quote ends with one: quotes of a record are even in number.
    unquoted = lambda c: F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    plain = lambda c: F.when(c.startswith('"'), unquoted(c)).otherwise(c)
    cells = F.transform(F.regexp_extract_all(F.concat(F.lit(","), F.col("record")), F.lit(cell), 1), plain)
    width = F.size("cells") if right is None else F.lit(right)
    cut = F.slice("cells", left, F.greatest(width - (left - 1), F.lit(0)))
    rows, headers = _records(spark, path, skip_rows, last)
    rows = rows.where("record != ''").select("file", cells.alias("cells")).withColumn("cells", cut)
    if not skip_rows:
        return rows.select([F.coalesce(F.get("cells", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(columns)])
    # Of a header only the places of the names go on, a short row for each file to every task.
    names = headers.select("file", cells.alias("cells")).select("file", F.transform(cut, F.trim).alias("names"))
    places = names.select("file", *[F.array_position("names", name).alias(f"__at{k}") for k, name in enumerate(columns)])
    rows = rows.join(F.broadcast(places), "file")

    def named(k: int, name: str) -> Column:
        at = F.col(f"__at{k}")
        missing = F.raise_error(F.concat(F.lit(f"no column {name} in "), "file"))
        return F.when(F.coalesce(at, F.lit(0)) == 0, missing.cast("string")).otherwise(F.coalesce(F.get("cells", (at - 1).cast("int")), F.lit("")))

    return rows.select([named(k, c).alias(c) for k, c in enumerate(columns)])


def read_text_sheet(
    spark: SparkSession, path: str, columns: list[str], skip_rows: int = 1, start: str | None = None, end: str | None = None
) -> DataFrame:
    """A staged sheet with every cell as text, header and title rows skipped; blanks stay blanks.

    ``start`` and ``end`` give a rectangle with the header in its first row instead of ``skip_rows``.
    """
    return _csv_rows(spark, path, columns, skip_rows, start, end).na.fill("")


def read_typed_sheet(
    spark: SparkSession,
    path: str,
    schema: StructType,
    skip_rows: int = 1,
    columns: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A staged sheet with declared types: blank cells and cells that do not parse are null.

    ``skip_rows`` is the number of rows up to and including the header, ``columns`` an optional subset; ``start`` and ``end``
    give a rectangle with the header in its first row instead.
    """
    rows = _csv_rows(spark, path, schema.fieldNames(), skip_rows, start, end)
    typed = rows.select([blank_to_null(F.trim(F.col(f"`{f.name}`"))).try_cast(f.dataType).alias(f.name) for f in schema])
    return typed.select(*[f"`{c}`" for c in columns]) if columns else typed


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All runs of a log, each as its last whole writing left it; an empty frame where there is none yet."""
    return versions.read_current(spark, path, schema).select(*schema.fieldNames())


def read_checking_log(spark: SparkSession, path: str) -> DataFrame:
    """The log earlier runs wrote, with the declared types; partition folders alone would turn day texts into dates."""
    return read_log(spark, path, CHECKING_LOG)
