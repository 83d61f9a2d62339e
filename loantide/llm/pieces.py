"""SentencePiece encoding and decoding for merge-type vocabularies, by a score-ordered agenda of adjacent symbol pairs.

A text is one line of symbols, a character each at first, with spaces as marks and one mark more before it. The agenda holds every adjacent pair that is a
piece, best score first, leftmost of equal scores; a popped pair whose sides have changed since is stale, any other is merged
and its new neighbours join the agenda. What is no piece at the end is spelled in bytes.

Where no piece of the vocabulary goes on over a mark after another character, no merge can cross that place, so lines are cut
there and each distinct cut is encoded once; a bounded cache keeps their ids. Every cut that is new to the cache is checked
against the sentencepiece library, an Arrow batch at a time.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator, Sequence
from itertools import repeat
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import blocks_of
from .common import kept, map_arrow

#: Cuts in each of the two halves of the cache.
CACHE_ENTRIES = 450_000
#: Longest line whose agenda is a list.
SHORT = 48
MARK = "▁"
_CUT = re.compile(" *[^ ]+| +")
#: Kinds of pieces and of models in a model file (fixed values of its format).
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Numbers and values of the fields of one message of a model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            size = number() if size is None else size
            at += size
            yield tag >> 3, data[at - size : at]


class Pieces:
    """A model file's pieces; encoding and decoding of single lines. Other kinds of models are refused."""

    def __init__(self, model: bytes):
        trainer, rules, self.texts = {}, {}, []
        self.rank: dict[str, float] = {}  # scores, then their places
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.silent: set[int] = set()
        self.unknown = 0
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                text, kind = piece[1].decode(), piece.get(3, NORMAL)
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self._add(len(self.texts), text, kind, score)
                self.texts.append(text)
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        plain = trainer.get(3) == MERGES and not trainer.get(24) and not rules.get(2)
        if not plain or not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only merge-type models that put a mark first and leave the text as it is are known")
        self.spell = bool(trainer.get(35))
        self.of_byte = {b: i for i, b in self.bytes.items()}
        self.surface = trainer.get(44, b" \xe2\x81\x87 ").decode()
        # Places of scores, best first; equal scores share one.
        places = {score: k for k, score in enumerate(sorted(set(self.rank.values()), reverse=True))}
        self.rank = {text: places[score] for text, score in self.rank.items()}
        self.whole = any(re.search(f"[^{MARK}]{MARK}", t) for t in self.rank)
        self._said = [t.replace(MARK, " ").encode() for t in self.texts]
        for number in self.silent:
            self._said[number] = b""
        for number, byte in self.bytes.items():
            self._said[number] = bytes([byte])

    def _add(self, number: int, text: str, kind: int, score: float) -> None:
        if kind == NORMAL:
            self.rank[text], self.ids[text] = score, number
        elif kind == BYTE:
            self.bytes[number] = int(text[3:5], 16)
        elif kind == CONTROL:
            self.silent.add(number)
        elif kind == UNKNOWN:
            self.unknown = number
        else:
            raise ValueError("pieces defined by the user, and unused ones, are not known")

    def cuts(self, text: str) -> list[str]:
        """The pieces of text that merges cannot leave, each without the mark that begins it."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if self.whole:
            return [text]
        if text[0] != " " and "  " not in text:
            return text.split(" ")
        return [x[1:] for x in _CUT.findall(f" {text}")]

    def encode(self, cut: str) -> list[int]:
        """Ids of a mark and ``cut`` after all merges."""
        line = MARK + cut.replace(" ", MARK)
        symbols = self._merged(line) if len(line) <= SHORT else self._merged_long(line)
        try:
            return list(map(self.ids.__getitem__, symbols))
        except KeyError:
            if not self.spell:
                return [self.ids.get(x, self.unknown) for x in symbols]
            return [i for x in symbols for i in ([self.ids[x]] if x in self.ids else map(self.of_byte.__getitem__, x.encode()))]

    def _merged(self, line: str) -> list[str]:
        """The symbols of a short line: its agenda is a list in the order of places, searched for the first best score."""
        symbols, get, none = list(line), self.rank.get, len(self.rank)
        agenda = list(map(get, map(add, line, line[1:]), repeat(none)))
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            symbols[i] = now = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbols[i - 1] + now, none)
            if i < len(agenda):
                agenda[i] = get(now + symbols[i + 1], none)
        return symbols

    def _merged_long(self, line: str) -> list[str]:
        """The same for a line of any length: its agenda is a heap, in O(n log n)."""
        rank, push, n = self.rank, heapq.heappush, len(line)
        size = n + 1
        # end[i]: where the symbol that starts at i ends, or n if none does; before[i]: where the symbol left of it starts.
        end, before = [*range(1, size), -1], [*range(-1, n)]
        # A pair is one number: place of its score, start, end; so the least number is the best score, then the leftmost.
        agenda = [(r * size + i) * size + i + 2 for i, r in enumerate(map(rank.get, map(add, line, line[1:]))) if r is not None]
        heapq.heapify(agenda)
        while agenda:
            rest, stop = divmod(heapq.heappop(agenda), size)
            start = rest % size
            middle = end[start]
            if middle >= n or end[middle] != stop:  # stale
                continue
            end[start], end[middle] = stop, n
            if stop < n:
                before[stop] = start
                r = rank.get(line[start : end[stop]])
                if r is not None:
                    push(agenda, (r * size + start) * size + end[stop])
            if start:
                left = before[start]
                r = rank.get(line[left:stop])
                if r is not None:
                    push(agenda, (r * size + left) * size + stop)
        out, at = [], 0
        while at < n:
            out.append(line[at : end[at]])
            at = end[at]
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids: marks are spaces, the one that was put first goes, bytes that are no UTF-8 are U+FFFD each."""
        first = next((i for i in ids if i not in self.silent), None)
        if first is None:
            return ""
        cut = int(self.texts[first].startswith(MARK))
        if self.unknown not in ids and self.silent.isdisjoint(ids):
            try:  # pieces are whole characters, so all of it is UTF-8 if each run of bytes is
                return b"".join(map(self._said.__getitem__, ids)).decode()[cut:]
            except UnicodeDecodeError:
                pass
        out, held = [], bytearray()
        for number in ids:
            if number in self.bytes:
                held.append(self.bytes[number])
                continue
            out.append(_spelled(bytes(held)))
            held.clear()
            out.append(self.surface if number == self.unknown else self._said[number].decode())
        return ("".join(out) + _spelled(bytes(held)))[cut:]


def _spelled(data: bytes) -> str:
    """Bytes as text; each byte that belongs to no valid character is one U+FFFD."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as wrong:
            out.append(data[at : at + wrong.start].decode() + "\ufffd")
            at += wrong.start + 1
    return "".join(out)


class Encoder:
    """Encodes blocks of texts with a cache of cuts, each checked by the library when it is new."""

    def __init__(self, model: bytes, check: bool = True):
        self.pieces = Pieces(model)
        self._cache: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._library = None
        if check:
            import sentencepiece

            self._library = sentencepiece.SentencePieceProcessor(model_proto=model)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian signed 32-bit integers."""
        pieces, cache, old = self.pieces, self._cache, self._old
        cuts = [pieces.cuts(t) for t in texts]
        missing = set().union(*cuts).difference(cache)
        again = missing.intersection(old)
        new = list(missing.difference(again))
        found = [pieces.encode(x) for x in new]
        if self._library:
            for cut, own, want in zip(new, found, self._library.encode(new, num_threads=1), strict=True):
                if own != want and cut:  # an empty cut is a mark alone, which the library never gets to see
                    raise ValueError(f"the library encodes {cut!r} in another way")
        cache.update((cut, old[cut]) for cut in again)
        cache.update((cut, array("i", own).tobytes()) for cut, own in zip(new, found, strict=True))
        out = [b"".join(map(cache.__getitem__, own)) for own in cuts]
        if len(cache) > CACHE_ENTRIES:  # the older half goes; what of the newer one is used again comes back
            self._old, self._cache = cache, {}
        return out

    def decode(self, ids: bytes) -> str:
        return self.pieces.decode(np.frombuffer(ids, "<i4").tolist())


def _lists(ids: Sequence[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int64)
    flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def encode(
    df: DataFrame, keys: list[str], text: str, model: str, decoded: bool = False, check: bool = True
) -> DataFrame:
    """``keys`` and ``ids``: the ids of each whole text, without begin or end ids; with ``decoded`` also the text they stand for.

    ``model`` is the path of a model file on the driver; its contents (some 0.5 MB, whatever the data) are broadcast. Null and
    empty texts give no ids. Rows are independent, so repeated rows and null keys come back as they are; columns other than
    ``keys`` and ``text`` are not read. With ``check`` the job fails where the library disagrees.
    """
    with open(model, "rb") as file:
        data = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(data), f"pieces {hashlib.sha256(data).hexdigest()} {check}"
    names = [*keys, "ids", *(["decoded"] if decoded else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(key, lambda: Encoder(shared.value, check))
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(len(keys))), 0).to_pylist()
            for a, b in blocks_of(sizes):
                part = batch.slice(a, b - a)
                ids = encoder.encode([t or "" for t in part.column(len(keys)).to_pylist()])
                made = [_lists(ids)]
                if decoded:
                    made.append(pa.array(map(encoder.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *made], names=names)

    kinds = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*(df.schema[k] for k in keys), *kinds[: len(names) - len(keys)]])
    return map_arrow(df.select(*keys, text), run, schema, key)


def decode(df: DataFrame, keys: list[str], model: str, ids: str = "ids") -> DataFrame:
    """``keys``, the ids (array of int) and ``decoded``, the text that they stand for. Null ids give an empty text."""
    with open(model, "rb") as file:
        data = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(data), f"pieces {hashlib.sha256(data).hexdigest()} False"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = kept(key, lambda: Encoder(shared.value, False)).pieces
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [pieces.decode(x or []) for x in part.column(len(keys)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*keys, ids, "decoded"])

    schema = T.StructType([*(df.schema[k] for k in [*keys, ids]), T.StructField("decoded", T.StringType())])
    return map_arrow(df.select(*keys, ids), run, schema, key)
