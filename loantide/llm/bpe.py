"""Byte-level BPE: encoding and decoding by a rank file.

The distinct pre-tokens of a block of texts are sorted into buckets by length and laid out as padded matrices of ids. In each
round every row merges its leftmost pair of least rank; ranks come from a hashed pair table, rows are compacted after the
merge, and finished rows leave the matrix. Pre-tokens beyond the widest bucket merge by the same rule on a heap, since a
matrix would take quadratic time there. A bounded cache keeps the ids of pre-tokens seen before.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import kept, map_arrow

CACHE_ENTRIES = 120_000
WIDEST = 128
BLOCK_CHARS = 1_000_000
NO_RANK = np.int32(2**31 - 1)

#: Character classes of the pattern below U+0100, where the standard module gives the same matches and is faster.
_LETTER, _NUMBER, _SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class Vocabulary:
    """Tokens by rank and the hashed table from a pair of ids to the merged id, which is its rank."""

    def __init__(self, rank_file: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[t[:k]], ranks[t[k:]], r)
            for t, r in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        left, right, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        self._bits = max(4, int(len(pairs) * 4).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._merged = np.full(1 << self._bits, NO_RANK, np.int32)
        keys = left << 32 | right
        slot, waiting = self._slot(keys), np.arange(len(keys))
        while len(waiting):  # open addressing: one key wins each free slot, the others move on
            free = self._keys[slot[waiting]] == -1
            winners = waiting[free][np.unique(slot[waiting[free]], return_index=True)[1]]
            self._keys[slot[winners]], self._merged[slot[winners]] = keys[winners], merged[winners]
            waiting = waiting[self._keys[slot[waiting]] != keys[waiting]]
            slot[waiting] = (slot[waiting] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair; ``NO_RANK`` where there is none or one side is padding (negative)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(len(keys), NO_RANK, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        slot = self._slot(keys[open_])
        while len(open_):
            found = self._keys[slot]
            hit = found == keys[open_]
            out[open_[hit]] = self._merged[slot[hit]]
            on = ~hit & (found != -1)
            open_, slot = open_[on], (slot[on] + 1) & ((1 << self._bits) - 1)
        return out

    def merge_matrix(self, rows: Sequence[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of pre-tokens of one bucket."""
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ids = np.full((len(rows), int(lengths.max())), -1, np.int32)
        ids[np.arange(ids.shape[1]) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        out: list[bytes] = [b""] * len(rows)
        at = np.arange(len(rows))
        rank = self.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), -1)
        while len(at):
            width = ids.shape[1]
            best = rank.argmin(1) if width > 1 else np.zeros(len(at), np.int64)  # the first of equal ranks
            merged = rank[np.arange(len(at)), best] if width > 1 else np.full(len(at), NO_RANK)
            done = merged == NO_RANK
            if done.any():
                for where, row in zip(at[done].tolist(), ids[done], strict=True):
                    out[where] = row[row >= 0].astype("<u4").tobytes()
                keep = ~done
                at, ids, rank, best, merged = at[keep], ids[keep], rank[keep], best[keep], merged[keep]
                if not len(at):
                    break
            n = np.arange(len(at))
            ids[n, best] = merged
            stay = np.ones(ids.shape, bool)
            stay[n, best + 1] = False
            ids = ids[stay].reshape(len(at), width - 1)
            stay = np.ones(rank.shape, bool)
            stay[n, best] = False
            rank = rank[stay].reshape(len(at), width - 2)
            for shift in (-1, 0):  # pairs on both sides of the new token
                n = np.flatnonzero((best + shift >= 0) & (best + shift < width - 2))
                if len(n):
                    left = best[n] + shift
                    rank[n, left] = self.rank(ids[n, left], ids[n, left + 1])
        return out

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for one long pre-token, in O(n log n)."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        first = self.rank(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(first.tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        own, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pair = dict(enumerate(first.tolist()))
        while heap:
            r, i = heapq.heappop(heap)
            if pair.get(i) != r:  # an outdated entry
                continue
            j = after[i]
            own[i], own[j], after[i] = r, -1, after[j]
            pair.pop(j, None)
            if after[j] < len(own):
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(own):
                    new = int(self.rank(np.array([own[k]], np.int32), np.array([own[after[k]]], np.int32))[0])
                    pair[k] = new
                    if new != NO_RANK:
                        heapq.heappush(heap, (new, k))
                elif k >= 0:
                    pair.pop(k, None)
        return np.array([x for x in own if x >= 0], "<u4").tobytes()


class Encoder:
    def __init__(self, rank_file: bytes, pattern: str):
        self.vocabulary = Vocabulary(rank_file)
        self._general = regex.compile(pattern)
        self._latin = _LATIN if pattern == GPT_PATTERN else None
        self._cache: dict[str, bytes] = {}

    def pretokens(self, text: str) -> list[str]:
        if self._latin and (text.isascii() or max(text) < "Ā"):
            return self._latin.findall(text)
        return self._general.findall(text)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        cut = [self.pretokens(t) if t else [] for t in texts]
        cache = self._cache
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        new = set().union(*cut).difference(cache)
        buckets: dict[int, list[str]] = {}
        for word in new:
            n = len(word.encode())
            buckets.setdefault(1 << (n - 1).bit_length() if n <= WIDEST else 0, []).append(word)
        for width, words in buckets.items():
            if not width:
                cache.update((w, self.vocabulary.merge_long(w.encode())) for w in words)
                continue
            for k in range(0, len(words), 4_000):
                part = words[k : k + 4_000]
                cache.update(zip(part, self.vocabulary.merge_matrix([w.encode() for w in part]), strict=True))
        return [b"".join(map(cache.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes | None) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))


#: Fixed value: the pattern that public byte-level vocabularies of this family split by.
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""



def _key(rank_file: bytes, pattern: str) -> str:
    """One encoder for each worker process and vocabulary."""
    return f"bpe {hashlib.sha256(rank_file + pattern.encode()).hexdigest()}"


def blocks_of(sizes: Sequence[int], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes in all, or of one longer row."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, k
            start, held = k, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(df: DataFrame, keys: list[str], text: str, vocabulary: str, pattern: str = GPT_PATTERN, decoded: bool = False) -> DataFrame:
    """``keys`` and ``ids``: the ids of each text as little-endian unsigned 32-bit integers in one binary value.

    With ``decoded`` also the bytes that the ids stand for, as ``decode`` gives them, by the same worker.

    ``vocabulary`` is the path of a rank file on the driver; its contents (about 1 MB, whatever the data) are broadcast.
    Null and empty texts give empty ids. Rows are independent, so repeated rows and null keys come back as they are; columns
    other than ``keys`` and ``text`` are not read.
    """
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(ranks), _key(ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(key, lambda: Encoder(shared.value, pattern))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(keys))), 0).to_pylist()
            for a, b in blocks_of(sizes):  # a block at a time becomes Python objects
                part = batch.slice(a, b - a)
                ids = encoder.encode([t or "" for t in part.column(len(keys)).to_pylist()])
                made = [pa.array(ids, pa.binary())]
                if decoded:
                    made.append(pa.array(map(encoder.decode, ids), pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *made], names=names)

    names = [*keys, "ids", *(["decoded"] if decoded else [])]
    schema = T.StructType([*(df.schema[k] for k in keys), *(T.StructField(x, T.BinaryType()) for x in names[len(keys) :])])
    return map_arrow(df.select(*keys, text), run, schema, key)


def decode(df: DataFrame, keys: list[str], vocabulary: str, ids: str = "ids") -> DataFrame:
    """``keys``, the ids and ``decoded``: the bytes that the ids stand for. Null ids give no bytes."""
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(ranks), _key(ranks, GPT_PATTERN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(key, lambda: Encoder(shared.value, GPT_PATTERN))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(keys))), 0).to_pylist()
            for a, b in blocks_of(sizes):
                part = batch.slice(a, b - a)
                decoded = pa.array([encoder.decode(x) for x in part.column(len(keys)).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*keys, ids, "decoded"])

    schema = T.StructType([*(df.schema[k] for k in keys), T.StructField(ids, T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    return map_arrow(df.select(*keys, ids), run, schema, key)
