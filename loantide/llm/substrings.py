"""Repeated passages by groups of windows with an equal minimiser.

A word is repeated text if a window of ``WINDOW`` words that covers it also starts anywhere else. No suffix tree is built: at a
fixed depth the only question is which windows are equal. Of the ``PREFIX``-word runs in each window, wherever they stand in it,
the one with the least hash (the minimiser) is the window's key: equal windows share it, at the same place, so all windows that
can be equal fall into one group, and a run of neighbouring windows travels as one segment of text. Groups whose key stands once
hold no repeat and are never sent. The windows of a group of up to ``GROUP`` runs are sorted in memory, and equal neighbours are
repeats. Of a larger group, Spark counts a 128-bit digest of each whole window, and those counted more than once are repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks_of
from .common import joined_anew, map_arrow, text_ids, written

WINDOW = 35
PREFIX = 12
GROUP = 2_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to ``n``; kept for the longest text so far."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            _POWERS[name] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
    return _POWERS["up"], _POWERS["down"]


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xFF51AFD7ED558CCD)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


class Text:
    """The words of a text in one line, with hashes of any run of words in constant time."""

    def __init__(self, text: str | None):
        words = (text or "").encode().split()  # exactly white space of ASCII
        self.n = len(words)
        if self.n:
            self.line = b" ".join(words) + b" "
            data = np.frombuffer(self.line, np.uint8)
            self.ends = np.flatnonzero(data == 32)
            self.starts = np.concatenate([[0], self.ends[:-1] + 1])

    def hashes(self, length: int) -> np.ndarray:
        """Hash of the run of ``length`` words at each place."""
        data = np.frombuffer(self.line, np.uint8)
        up, down = _powers(len(data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
        first, last = self.starts[: self.n - length + 1], self.ends[length - 1 :]
        return _mixed((sums[last] - sums[first]) * down[first])

    def keys(self, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray]:
        """For each window the place of its prefix key, and the hash of the run at each place."""
        hashes = self.hashes(prefix)
        span = window - prefix + 1
        return np.lib.stride_tricks.sliding_window_view(hashes, span).argmin(1) + np.arange(self.n - window + 1), hashes

    def words(self, first: int, last: int) -> bytes:
        return self.line[self.starts[first] : self.ends[last - 1]]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, str | None]]:
    """Rows and texts, a block of texts at a time as Python objects."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for a, b in blocks_of(sizes):
        yield from enumerate(batch.column(column).slice(a, b - a).to_pylist(), a)


def _key_places(docs: DataFrame, window: int, prefix: int) -> DataFrame:
    """key, class, place and copies: each prefix key of each distinct text; a task sends a text that it holds often once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            classes = batch.column(0).to_pylist()
            own, held, size = [], [], 0
            for row, text in _texts(batch, 1):
                seen[classes[row]] = seen.get(classes[row], 0) + 1
                if seen[classes[row]] > 2:  # whether there is one copy or several is all that counts
                    continue
                words = Text(text)
                if words.n < window:
                    continue
                places, hashes = words.keys(window, prefix)
                places = np.unique(places)
                own.append((np.full(len(places), classes[row]), places))
                held.append(hashes[places])
                size += len(places)
                if size > 200_000:
                    yield rows(own, held)
                    own, held, size = [], [], 0
            if own:
                yield rows(own, held)

    def rows(own, held) -> pa.RecordBatch:
        columns = [np.concatenate(held).view(np.int64), np.concatenate([c for c, _ in own]), np.concatenate([p for _, p in own]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "class", "place"])

    return map_arrow(docs.select("class", "text"), run, "key long, class long, place int")


def _segments(docs: DataFrame, window: int, prefix: int, group: int) -> DataFrame:
    """Runs of suffixes that can be repeats. Of a small group: its key and the text of the run. Of a large one: no text, but a
    128-bit digest of the suffix's whole window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            classes, alive = batch.column(1).to_pylist(), batch.column(3)
            out: list[tuple[int | None, int, int, bytes | None, bytes | None]] = []
            for row, text in _texts(batch, 2):
                seen[classes[row]] = seen.get(classes[row], 0) + 1
                if seen[classes[row]] > 2:
                    continue
                words = Text(text)
                if words.n < window:
                    continue
                marks = alive[row].values  # places of repeated keys, twice the place and one more if the group is large
                marked = marks.to_numpy(zero_copy_only=False)
                places, hashes = words.keys(window, prefix)
                state = np.zeros(words.n, np.int8)
                state[marked >> 1] = 1 + (marked & 1)
                own, line = classes[row], words.line
                big = np.flatnonzero(state[places] == 2)
                if len(big):
                    bounds = zip(big.tolist(), words.starts[big].tolist(), words.ends[big + (window - 1)].tolist(), strict=True)
                    out += [(None, own, f, None, hashlib.md5(line[a:b], usedforsecurity=False).digest()) for f, a, b in bounds]
                small = np.flatnonzero(state[places] == 1)
                if len(small):
                    cut = np.flatnonzero((np.diff(small) > 1) | (np.diff(places[small]) != 0)) + 1
                    first, last = small[np.concatenate([[0], cut])], small[np.concatenate([cut - 1, [-1]])]
                    columns = hashes[places[first]].view(np.int64), first, words.starts[first], words.ends[last + (window - 1)]
                    out += [(k, own, f, line[a:b], None) for k, f, a, b in zip(*(c.tolist() for c in columns), strict=True)]
                if len(out) > 20_000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)

    def rows(out) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "class", "start", "words", "digest"])

    return map_arrow(docs, run, "key long, class long, start int, words binary, digest binary")


def deep_nodes(segments: list[bytes], window: int = WINDOW) -> list[list[int]]:
    """For each segment the places of its windows that also stand elsewhere; windows are sorted and neighbours compared.

    All windows of a segment that occurs twice are repeats; it is sorted once, and not at all where no others are in the group.
    """
    copies: dict[bytes, list[int]] = {}
    for s, segment in enumerate(segments):
        copies.setdefault(segment, []).append(s)
    found: list[list[int]] = [[] for _ in segments]
    single = False
    for segment, own in copies.items():
        if len(own) > 1:
            for s in own:
                found[s] = list(range(segment.count(b" ") + 2 - window))
        else:
            single = True
    if not single:
        return found
    suffixes: list[bytes] = []
    places: list[tuple[int, int]] = []
    for segment, own in copies.items():
        ends = [k for k, b in enumerate(segment) if b == 32] if len(segment) < 64 else np.flatnonzero(np.frombuffer(segment, np.uint8) == 32).tolist()
        starts, ends = [0, *(e + 1 for e in ends)], [*ends, len(segment)]
        n = len(starts) - window + 1
        suffixes += [segment[a:b] for a, b in zip(starts[: max(n, 0)], ends[window - 1 :], strict=True)]
        places += [(own[0] if len(own) == 1 else -1, k) for k in range(n)]
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    last = False
    for k, at in enumerate(order):
        again = k + 1 < len(order) and suffixes[order[k + 1]] == suffixes[at]
        s, place = places[at]
        if (last or again) and s >= 0:
            found[s].append(place)
        last = again
    return [sorted(own) for own in found]


def _repeats_in_groups(segments: DataFrame, window: int) -> DataFrame:
    """class, start, stop: runs of words covered by repeats, from the sorted windows of all small groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def close() -> None:
            if len(held) > 1 or held and len(held[0][2]) > 0:
                for (own, start, _), places in zip(held, deep_nodes([h[2] for h in held], window), strict=True):
                    first = None
                    for k, place in enumerate(places):
                        first = place if first is None else first
                        if k + 1 == len(places) or places[k + 1] > place + window:
                            out.append((own, start + first, start + place + window))
                            first = None
            held.clear()

        for batch in batches:
            for k, own, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    close()
                    key = k
                held.append((own, start, text))
            if len(out) > 10_000:
                yield rows(out)
                out = []
        close()
        if out:
            yield rows(out)

    def rows(out) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["class", "start", "stop"])

    dealt = segments.repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt.select("key", "class", "start", "words"), run, "class long, start int, stop int")


def _classed(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    given = docs.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], F.col(text).alias("text"))
    return text_ids(given, F.coalesce(F.col("text"), F.lit("")), "class").select(*[f"k{n}" for n in range(len(keys))], "class", "text")


def _texts_joined(rows: DataFrame, aggregated: DataFrame, how: str) -> DataFrame:
    """As ``joined_anew`` for whole texts by class, so a hot text is split; both joins of the texts use one exchange."""
    part = F.col("class").bitwiseAND(F.lit(1_023)).alias("part")
    return rows.select("*", part).join(aggregated.select("*", part), ["class", "part"], how).drop("part")


def remove_repeats(
    docs: DataFrame, keys: list[str], text: str = "text", window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP
) -> DataFrame:
    """``keys``, n_words, n_removed and kept (the text left) for each row.

    A text that loses nothing comes back as it is, null included; of others the words left are joined by one space. Null and
    empty texts, and texts of fewer words than the window, lose nothing. Repeated rows are copies of each other and
    lose every word if they reach the window; null keys come back as they are; other columns are not read. Windows are judged
    on the input. Rows of equal text are one class: a task sends them on at most twice.
    """
    given = _classed(docs, keys, text)
    # Written, as they are counted and then joined with their counts; else each use would read and hash all texts again.
    places = written(_key_places(given, window, prefix), "key-places")
    counts = places.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    mark = F.col("place") * 2 + (F.col("n") > group).cast("int")
    alive = joined_anew(places, counts, "key").groupBy("class").agg(F.collect_set(mark).alias("marks"))
    # The same columns on both uses of the rows, so that Spark moves them once and uses the exchange again.
    n = len(keys)
    sent = _texts_joined(given, alive, "inner").select(F.struct(*[f"k{m}" for m in range(n)]).alias("row"), "class", "text", "marks")
    segments = _segments(sent, window, prefix, group)
    small = _repeats_in_groups(segments.filter("words IS NOT NULL"), window)
    suffixes = segments.filter("words IS NULL").select(F.col("digest").alias("key"), "class", "start")
    nodes = suffixes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    large = joined_anew(suffixes, nodes, "key").select("class", "start", (F.col("start") + window).cast("int").alias("stop"))
    spans = small.unionByName(large).groupBy("class").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = _texts_joined(given, spans, "left").select(*[f"k{m}" for m in range(n)], "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(n)), 0).to_pylist()
            for a, b in blocks_of(sizes):
                part = batch.slice(a, b - a)
                counts, removed, kept = [], [], []
                for value, own in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True):
                    words = (value or "").encode().split()
                    counts.append(len(words))
                    left, at = [], 0
                    for start, stop in sorted((s["start"], s["stop"]) for s in own or ()):
                        left += words[at:start] if start > at else []
                        at = max(at, stop)
                    left += words[at:]
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode() if own else value)
                columns = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *columns], names=[*keys, "n_words", "n_removed", "kept"])

    schema = T.StructType([*(T.StructField(k, docs.schema[k].dataType) for k in keys), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    return map_arrow(rows, run, schema)
