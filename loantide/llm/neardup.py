"""Near-duplicate documents by BagMinHash over bags of word shingles.

A document is a multiset of five-word shingles. Each shingle has a Poisson process over (signature slot, weight level): weights
are cut into dyadic intervals, every interval has a process of its own in proportion to its width, and a point counts for a
document if its level is within the shingle's weight there. A slot keeps the first point of all processes, so two documents
agree in a slot with exactly their weighted Jaccard similarity. Points are made only up to a bound that fills all slots.

Signatures are cut into bands. Documents of a bucket are not paired with each other: each is verified, by the exact overlap of
the bags, against its best representative. Buckets whose members are then still in different components are compared in
blocks, exactly as well. So no link is lost that a band finds, a large group of copies costs one verification a document, and
no pairs are sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, joined_anew, map_arrow, ship, text_ids, words_of, written
from .components import components
from .substrings import Text, _mixed, _texts
from .vectors import spanning

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
SLOTS = BANDS * ROWS
#: Nodes verified against one copy of their representative, members of a block of a bucket, and columns compared at once.
SHARE, BLOCK, COLUMNS = 32, 300, 4_096
#: Bags that get signatures at once: by documents, since each needs some 1,450 points however short it is, and by shingles.
BAGS, SHINGLES = 256, 100_000


def bag(text: str | None, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of normalised words, and their counts; a shorter text is one shingle, no words none."""
    words = Text(b" ".join(words_of(text)).decode())
    if not words.n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(words.hashes(min(shingle, words.n)), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - common
    return common / total if total else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` point identities for each (not empty) bag."""
    sizes = np.array([len(b[0]) for b in bags])
    doc = np.repeat(np.arange(len(bags)), sizes)
    element, weight = np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])
    # Dyadic intervals (0,1], (1,2], (2,4], ... up to each weight.
    parts = [(0, 1, np.arange(len(weight)))]
    low, high = 1, 2
    while (weight > low).any():
        parts.append((low, high, np.flatnonzero(weight > low)))
        low, high = high, 2 * high
    rows = np.concatenate([p[2] for p in parts])
    floor = np.repeat([p[0] for p in parts], [len(p[2]) for p in parts])
    width = np.repeat([p[1] - p[0] for p in parts], [len(p[2]) for p in parts])
    seed = _mixed(element[rows] + floor.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    doc, weight = doc[rows], weight[rows]
    total = np.bincount(doc, np.minimum(weight - floor, width), len(bags))
    out = np.zeros((len(bags), slots), np.uint64)
    open_, bound = np.ones(len(bags), bool), (np.log(slots) + 4) / total
    while open_.any():
        live = np.flatnonzero(open_[doc])
        first = np.full(len(bags) * slots, np.inf)
        time, step = np.zeros(len(live)), 0
        keys, times, marks = [], [], []
        while len(live):
            step += 1
            point = _mixed(seed[live] + np.uint64(step * 0xC2B2AE3D27D4EB4F & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((point >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / (slots * width[live])
            on = time <= bound[doc[live]]
            live, time, point = live[on], time[on], point[on]
            other = _mixed(point + np.uint64(0x165667B19E3779F9))
            level = floor[live] + 1 + ((other >> np.uint64(40)).astype(np.int64) * width[live] >> 24)
            counts = level <= weight[live]
            keys.append(doc[live][counts] * slots + ((other & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)[counts])
            times.append(time[counts])
            marks.append(point[counts])
        key, when, mark = np.concatenate(keys), np.concatenate(times), np.concatenate(marks)
        order = np.argsort(-when, kind="stable")  # the earliest point of a slot is written last
        first[key[order]] = when[order]
        flat = out.reshape(-1)
        flat[key[order]] = mark[order]
        empty = np.isinf(first.reshape(len(bags), slots)).any(1)
        open_ &= empty
        bound = np.where(open_, bound * 2, bound)
    return out


def banded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and bands of each distinct text with words (columns node, text); a text met often is sent once."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column(0).to_pylist()
        bags, own, held = [], [], 0
        for row, text in _texts(batch, 1):
            if nodes[row] in seen:
                continue
            if len(seen) < 1_000_000:  # beyond that, copies are only sent more often
                seen.add(nodes[row])
            b = bag(text)
            if len(b[0]):
                bags.append(b)
                own.append(nodes[row])
                held += len(b[0])
            if len(bags) >= BAGS or held > SHINGLES:
                yield _band_rows(own, bags)
                bags, own, held = [], [], 0
        if bags:
            yield _band_rows(own, bags)


def _band_rows(own: list[int], bags: list) -> pa.RecordBatch:
    out = signatures(bags)
    bands = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :], len(out), 0)
    for k in range(ROWS):
        bands = _mixed(bands * np.uint64(0xFF51AFD7ED558CCD) + out[:, k::ROWS])
    offsets = pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32))
    lists = pa.ListArray.from_arrays(offsets, pa.array(bands.view(np.int64).ravel()))
    return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), lists], names=["node", "bands"])


def _verified_stars(best: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (node, rep) of ``best`` whose bags reach the threshold.

    Texts are sent to their representative, whose own text comes first; a representative of many nodes is sent to several
    shares of them.
    """
    shares = best.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
    members = joined_anew(best, shares, "rep").select("node", "rep", F.pmod(F.xxhash64("node"), F.col("shares")).cast("int").alias("share"), F.lit(1).alias("place"))
    heads = shares.select(F.col("rep").alias("node"), "rep", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(0).alias("place"))
    sent = texts.join(members.unionByName(heads), "node").select("rep", "share", "place", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None
        for batch in batches:
            rep, place, nodes = (batch.column(k).to_pylist() for k in (0, 2, 3))
            out = []
            for row, text in _texts(batch, 4):
                if place[row] == 0:
                    head, own = rep[row], bag(text)
                elif rep[row] == head and similarity(own, bag(text)) >= SIMILARITY:
                    out.append((nodes[row], head))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    dealt = sent.repartition("rep", "share").sortWithinPartitions("rep", "share", "place")
    return map_arrow(dealt, run, "a long, b long")


def _elements(text: str | None) -> np.ndarray:
    """A bag as a set: the n-th copy of a shingle is an element of its own, so overlaps of bags are overlaps of sets."""
    hashes, counts = bag(text)
    copies = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(np.repeat(hashes, counts) + copies.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Similarity of each bag on the left with each on the right, exactly; elements on one side only need no column."""
    sizes = [np.array([len(x) for x in side], float) for side in (left, right)]
    flat = [np.concatenate([*side, np.empty(0, np.uint64)]) for side in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    common = np.zeros((len(left), len(right)))
    for k in range(0, len(shared), COLUMNS):
        part, held = shared[k : k + COLUMNS], []
        for side, values in zip((left, right), flat, strict=True):
            row = np.repeat(np.arange(len(side)), [len(x) for x in side])
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            on = part[at] == values
            matrix = np.zeros((len(side), len(part)), np.float32)
            matrix[row[on], at[on]] = 1
            held.append(matrix)
        common += held[0] @ held[1].T
    return common / (sizes[0][:, None] + sizes[1][None, :] - common)


def _links_in_blocks(members: DataFrame) -> DataFrame:
    """Links (a, b) among members of one bucket (bucket, node, component, elements) in different components.

    A bucket is cut into blocks; each pair of its blocks is one piece of work, which compares exactly and sends on a spanning
    forest of the links it finds, never the pairs.
    """
    ship(members.sparkSession)
    sizes = members.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = joined_anew(members, sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    both = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "node", "component", "elements"
    )

    def compare(work: pd.DataFrame) -> pd.DataFrame:
        x, y = work["x"].iloc[0], work["y"].iloc[0]
        sides = [work[work["own"] == z] for z in (x, y)]
        sets = [[np.frombuffer(e, "<u8") for e in s["elements"]] for s in sides]
        ids, parts = [s["node"].to_numpy(np.int64) for s in sides], [s["component"].to_numpy(np.int64) for s in sides]
        link = (parts[0][:, None] != parts[1][None, :]) & (overlaps(*sets) >= SIMILARITY)
        to = spanning(link, *ids)
        out = pd.DataFrame({"a": np.concatenate(ids), "b": np.concatenate(to)})
        return out[out["a"] != out["b"]]

    return both.groupBy("bucket", "x", "y").applyInPandas(compare, "a long, b long")


def _texts_of(given: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and text of the wanted ``nodes``; the copies of a hot text are split over tasks, and each sends on one of them."""
    held = joined_anew(given, nodes, "node", "left_semi")
    return held.groupBy("node").agg(F.first("text").alias("text"))


def numbered(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with node, the number of its text; null counts as empty."""
    return text_ids(docs, F.coalesce(F.col(text), F.lit("")), "node")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, node (number of the text), worded, part (one number a class) and class_id (least key in it) for every row.

    Equal texts are one node, and links of nodes make classes. Rows that aren't worded (null, empty, or no words) link with
    nothing: class_id is their own key. Rows with a null key belong to the class of their text; class_id is null if all its
    keys are. Repeated rows come back as they are; other columns are not read.
    """
    given = numbered(docs.select(F.col(key).alias("id"), F.col(text).alias("text")))
    buckets = written(map_arrow(given.select("node", "text"), banded, "node long, bands array<long>"), "bands").select("node", F.explode("bands").alias("bucket"))
    named = buckets.groupBy("bucket").agg(F.min("node").alias("rep"), F.max("node").alias("last")).filter("rep < last").select("bucket", "rep")
    near = written(joined_anew(buckets, named, "bucket"), "candidates")
    # Texts of all nodes that share a bucket with another one.
    nodes = near.select("node").distinct()
    texts = written(_texts_of(given, nodes), "texts")
    shared = near.filter("node <> rep").groupBy("node", "rep").agg(F.count(F.lit(1)).alias("shared"))
    best = shared.groupBy("node").agg(F.max_by("rep", F.struct("shared", F.col("rep").alias("r"))).alias("rep"))
    links = written(_verified_stars(written(best, "stars"), texts), "links")
    parts = components(links)

    def part_of(df: DataFrame, column: str, name: str) -> DataFrame:
        own = parts.select(F.col("node").alias(column), F.col("component").alias(name))
        return df.join(own, column, "left").withColumn(name, F.coalesce(name, column))

    member = part_of(near.select("bucket", "node").distinct(), "node", "component")
    split = member.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("bucket")
    open_ = written(joined_anew(member, split, "bucket", "left_semi"), "open")
    if not open_.isEmpty():
        ids = open_.select("node").distinct()

        def as_elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, batch.num_rows, 200):
                    part = batch.slice(k, 200)
                    sets = pa.array([_elements(t).astype("<u8").tobytes() for t in part.column(1).to_pylist()], pa.binary())
                    yield pa.RecordBatch.from_arrays([part.column(0), sets], names=["node", "elements"])

        sets = map_arrow(texts.join(ids, "node", "left_semi"), as_elements, "node long, elements binary")
        more = written(_links_in_blocks(open_.join(sets, "node")), "links")
        if not more.isEmpty():
            parts = components(links.unionByName(more))
    worded = F.coalesce(F.rlike("text", F.lit(WORD_PATTERN)), F.lit(False))
    rows = part_of(given.select("id", "node", worded.alias("worded")), "node", "part")
    names = rows.filter("worded").groupBy("part").agg(F.min("id").alias("least"))
    found = joined_anew(rows, names, "part", "left")
    return found.select(F.col("id").alias(key), "node", "worded", "part", F.when(F.col("worded"), F.col("least")).otherwise(F.col("id")).alias("class_id"))
