"""Audit of sources: how far each source's use of terms is from every other source of its language, and from the language.

A language keeps the terms that stand in enough of its documents. A group (language and source) gives each kept term the share
p = 1 + floor(SCALE * (count + 1) / (N + V)), N being its counts of kept terms and V their number, and two groups differ by the
sum over kept terms of floor((p - q)^2 / q).

That sum is taken over segment trees. The kept terms of a language are dealt into blocks; in a block each group's counts are the
leaves of a tree whose nodes are hash-consed, so equal ranges of counts are one node, in a tree and across trees. Two trees
are walked down together; a pair of nodes met several times is priced once and counted as often as it was met. Terms stand
in the order of their counts, so rare terms that are counted alike form equal subtrees. Sources are dealt into chunks too, and a
task holds one block of terms and one pair of chunks; what it sends on is one sum for each pair of groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_arrow, ship, written

SCALE = 1_000_000_000
DOCUMENTS = 3
TOP = 200
#: Terms in a block, sources in a chunk, leaf pairs walked at once, and counts held by a task before they are sent on.
BLOCK, CHUNK, PAIRS, HELD = 4_096, 48, 1_000_000, 300_000

#: A-Z to a-z; every other ASCII byte that is no letter to a space. Bytes from 0x80 belong to terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text as UTF-8: runs of letters and of anything beyond ASCII, only A-Z in lower case."""
    return text.encode().translate(_TERM_BYTES).split() if text else []


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, source, term, count and docs of a few batches at a time, from columns lang, source, text."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            names = [t.decode() for t in counts]
            columns = [pa.array([x] * len(names), pa.string()) for x in (lang, source)]
            columns += [pa.array(names, pa.string()), pa.array(counts.values(), pa.int64()), pa.array(map(docs.__getitem__, counts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "count", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        for row in range(batch.num_rows):
            lang, source, text = (batch.column(k)[row].as_py() for k in range(3))
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            found, before = terms(text), len(counts)
            counts.update(found)
            docs.update(set(found))
            size += len(counts) - before
            if size > HELD:
                yield from out()
                size = 0
    yield from out()


def kept_terms(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """lang, source, term, count, total (in the language) and first (on one row a language and term), of kept terms."""
    given = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = map_arrow(given, _counted, "lang string, source string, term string, count long, docs long")
    # Dealt by (lang, term) once: sums of a source and those of the language need no other shuffle.
    each = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    each = each.select(
        "lang", "source", "term", "count", F.sum("docs").over(term).alias("docs"), F.sum("count").over(term).alias("total"),
        (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
    )
    return each.filter(F.col("docs") >= documents).drop("docs")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n, v, lang_n and sources for every group that occurs, also those without kept terms."""
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    langs = kept.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("v"), F.sum("count").alias("lang_n"))
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    sized = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").join(sources, "lang")
    return sized.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n")), "sources")


def _share(count: Column, n: Column, v: Column) -> Column:
    """p of a count, exact beyond the range of long."""
    top = (count + 1).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (n + v).cast("decimal(20,0)")) + 1


def prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q) of shares, which are at most SCALE + 1, so squares fit."""
    return (p - q) * (p - q) // q


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    return np.array([1 + SCALE * (c + 1) // (n + v) for c in counts.tolist()], np.int64)


class Trees:
    """Hash-consed segment trees over the same places, one for each row of ``counts`` (groups x places).

    ``roots`` holds the top node of each group, ``children[k]`` the two children of each node of level k, counted from the top.
    A leaf is a place in ``counts``, the distinct counts; places beyond the last column are empty leaves, which cost nothing.
    """

    def __init__(self, counts: np.ndarray):
        size = 1 << max(0, counts.shape[1] - 1).bit_length()
        self.counts, leaves = np.unique(counts, return_inverse=True)
        self.empty = len(self.counts)
        nodes = np.full((len(counts), size), self.empty, np.int64)
        nodes[:, : counts.shape[1]] = leaves.reshape(counts.shape)
        self.children: list[np.ndarray] = []
        while nodes.shape[1] > 1:
            pairs = nodes[:, 0::2] << 32 | nodes[:, 1::2]
            held, at = np.unique(pairs, return_inverse=True)
            self.children.append(np.column_stack([held >> 32, held & 0xFFFFFFFF]))
            nodes = at.reshape(pairs.shape)
        self.children.reverse()
        self.roots = nodes[:, 0]

    def walk(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
        """Walks the trees ``left[k]`` and ``right[k]`` down together, for all k at once.

        Gives k, the leaf on the left, the leaf on the right and how often they meet: once for each different pair of leaves.
        """
        pair, a, b, times = np.arange(len(left)), self.roots[left], self.roots[right], np.ones(len(left), np.int64)
        for children in self.children:
            pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
            a, b = children[a].T.ravel(), children[b].T.ravel()
            wide = int(max(a.max(), b.max())) + 1
            order = np.argsort((pair * wide + a) * wide + b, kind="stable")
            pair, a, b, times = pair[order], a[order], b[order], times[order]
            first = np.ones(len(pair), bool)
            first[1:] = (pair[1:] != pair[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            at = np.flatnonzero(first)
            pair, a, b, times = pair[at], a[at], b[at], np.add.reduceat(times, at)
        return pair, a, b, times


def divergences(counts: np.ndarray, sizes: list[tuple[int, int]], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of prices of groups ``left[k]`` against ``right[k]``, and the other way round, over the columns of ``counts``.

    ``sizes`` are (N, V) of each group.
    """
    order = np.lexsort(counts[::-1])  # terms that are counted alike stand side by side
    trees = Trees(counts[:, order])
    p = np.vstack([shares(trees.counts, n, v) for n, v in sizes])
    there, back = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
    step = max(1, PAIRS // max(1, counts.shape[1]))
    for k in range(0, len(left), step):
        x, y = left[k : k + step], right[k : k + step]
        pair, a, b, times = trees.walk(x, y)
        real = a != trees.empty
        pair, a, b, times = pair[real], a[real], b[real], times[real]
        own, other = p[x[pair], a], p[y[pair], b]
        at = np.flatnonzero(np.diff(pair, prepend=-1))
        there[k + pair[at]] = np.add.reduceat(prices(own, other) * times, at)
        back[k + pair[at]] = np.add.reduceat(prices(other, own) * times, at)
    return there, back


def _block_sums(table: pa.Table) -> pa.Table:
    """Partial sums (lang, source, item, value) of one block of terms and one pair of chunks.

    Rows without a term are the groups, with their sizes and the number of terms of the block; the others are counts.
    """
    columns = {name: table.column(name) for name in table.column_names}
    named = np.array(columns["term"].is_valid())
    sources, chunks = columns["source"].to_pylist(), columns["chunk"].to_pylist()
    groups = sorted({(chunks[k], sources[k], columns["n"][int(k)].as_py(), columns["v"][int(k)].as_py()) for k in np.flatnonzero(~named)})
    row = {g[:2]: k for k, g in enumerate(groups)}
    words = columns["term"].filter(pa.array(named)).combine_chunks().dictionary_encode()
    size = columns["size"].filter(pa.array(~named))[0].as_py()
    counts = np.zeros((len(groups), size), np.int64)
    at = np.array([row[chunks[k], sources[k]] for k in np.flatnonzero(named)], np.int64)
    if len(at):
        counts[at, words.indices.to_numpy()] = columns["count"].filter(pa.array(named)).to_numpy()
    x, y = columns["x"][0].as_py(), columns["y"][0].as_py()
    chunk = np.array([g[0] for g in groups])
    left, right = np.triu_indices(len(groups), 1)
    wanted = (chunk[left] == x) & (chunk[right] == y)
    left, right = left[wanted], right[wanted]
    there, back = divergences(counts, [g[2:] for g in groups], left, right)
    names = np.array([g[1] for g in groups], object)
    lang = pa.array([columns["lang"][0].as_py()] * (2 * len(left)), pa.string())
    ends = [pa.array(np.concatenate([names[i], names[j]]), pa.string()) for i, j in ((left, right), (right, left))]
    return pa.table([lang, *ends, pa.array(np.concatenate([there, back]))], names=["lang", "source", "item", "value"])


def source_pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item and value: every other source of the language and how far the source is from it."""
    ship(kept.sparkSession)
    blocks = F.ceil(F.col("v") / BLOCK).cast("int")
    chunks = F.ceil(F.col("sources") / CHUNK).cast("int")
    dealt = groups.select("lang", "source", "n", "v", blocks.alias("blocks"), F.pmod(F.xxhash64("source"), chunks).cast("int").alias("chunk"), chunks.alias("chunks"))
    dealt = dealt.filter("blocks > 0")
    counts = kept.join(dealt, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    counts = written(counts.select("lang", "source", "term", "count", "first", "block", "chunk", "chunks"), "counts")
    sizes = counts.filter(F.col("first")).groupBy("lang", "block").agg(F.count(F.lit(1)).cast("int").alias("size"))
    heads = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sizes, ["lang", "block"])
    nothing = F.lit(None)
    both = heads.select("lang", "block", "source", nothing.cast("string").alias("term"), nothing.cast("long").alias("count"), "n", "v", "size", "chunk", "chunks")
    both = both.unionByName(counts.select("lang", "block", "source", "term", "count", *(nothing.cast("long").alias(c) for c in ("n", "v")), nothing.cast("int").alias("size"), "chunk", "chunks"))
    # Each chunk meets every chunk once, itself included.
    both = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    both = both.withColumn("x", F.least("chunk", "other")).withColumn("y", F.greatest("chunk", "other")).drop("other", "chunks")
    parts = both.groupBy("lang", "block", "x", "y").applyInArrow(_block_sums, "lang string, source string, item string, value long")
    sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # A language without kept terms: its sources are all alike.
    bare = groups.filter("v = 0").select("lang", "source")
    alike = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source <> item").withColumn("value", F.lit(0).cast("long"))
    return sums.unionByName(alike)


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value and rank: the terms that a source uses more than its language, by their price, to ``top``."""
    found = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("count"), F.col("n"), F.col("v")))
    found = found.withColumn("q", _share(F.col("total"), F.col("lang_n"), F.col("v"))).filter("p > q")
    price = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("q"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = found.select("lang", "source", F.col("term").alias("item"), price.alias("value"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank, from columns lang, source and text of ``docs``.

    Nulls count as empty texts, so they form a language or source of their own. Repeated rows are documents of their own; ties
    are ranked by item; a group without kept terms is compared like any other, with all counts 0; an empty table gives no
    rows; other columns are not read. Tasks hold one block of terms for one pair of chunks of sources, never a whole group.
    """
    kept = written(kept_terms(docs, documents), "kept")
    groups = written(group_sizes(docs, kept), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(kept, groups).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    told = telling_terms(kept, groups, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(told.select(*columns))
