"""Benchmark decontamination: word windows of test items, found by one Aho-Corasick automaton in one scan of the texts.

The automaton reads normalised words, not characters: a node is a prefix of a window of some item, numbered level by level, and
all its tables are plain arrays (some 25 bytes a node, of which an item has at most as many as words times the window). A block of
texts is one line of word numbers with gaps between texts, cut into lanes that go through the automaton side by side. A lane
starts a window's length early, since a state depends on no more words than that; so long texts are scanned by many lanes.
Matches are mapped to words and to offsets in the original text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import blocks_of
from .common import WORD_PATTERN, kept, map_arrow, words_of

WINDOW = 13
#: Bytes of texts scanned at once, and lanes that they are cut into.
BLOCK_CHARS, LANES = 2_000_000, 2_048

_WORD = re.compile(WORD_PATTERN)

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("words_hit", T.ArrayType(_SPAN)),
    T.StructField("spans", T.ArrayType(_SPAN)),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
]
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Automaton:
    """Aho-Corasick over numbers of words. Node 0 is the root; node k + 1 is reached by edge k.

    ``edges`` are (node, word) as one number and stand in order, since nodes are numbered as their edges are found. ``fail`` leads
    to the longest other prefix that ends a node's words, ``longest`` is the length of the longest window that does, ``out``
    the first node on the way down ``fail`` that ends a window, and ``more`` that after it.
    """

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.window = window
        self.words: dict[bytes, int] = {}
        own = [[self.words.setdefault(w, len(self.words)) for w in words_of(text)] for _, text in items]
        self.items = sorted({str(item) for item, _ in items if item is not None})
        numbers = {name: k for k, name in enumerate(self.items)}
        rows, names = [], []
        for (item, _), line in zip(items, own, strict=True):
            if line:
                padded = np.array(line + [-1] * (window - len(line)), np.int64)
                cut = np.lib.stride_tricks.sliding_window_view(padded, window)
                rows.append(cut)
                names.append(np.full(len(cut), -1 if item is None else numbers[str(item)]))
        windows = np.vstack(rows) if rows else np.empty((0, window), np.int64)
        at = self._add(windows)
        self._link()
        name = np.concatenate(names) if names else np.empty(0, np.int64)
        ends = np.unique(np.column_stack([at, name])[name >= 0], axis=0) if len(at) else np.empty((0, 2), np.int64)
        # Items of the windows that end at each node: a slice of ``told`` for each.
        self.told = ends[:, 1].astype(np.int32)
        self.told_from = np.searchsorted(ends[:, 0], np.arange(len(self.fail) + 1)).astype(np.int32)

    def _add(self, windows: np.ndarray) -> np.ndarray:
        """Nodes for all windows (padded by -1), a level at a time; gives the last node of each."""
        at, edges, self.levels, nodes = np.zeros(len(windows), np.int64), [], [0], 1
        for k in range(self.window):
            live = np.flatnonzero(windows[:, k] >= 0)
            if not len(live):
                break
            new, which = np.unique(at[live] << 32 | windows[live, k], return_inverse=True)
            edges.append(new)
            at[live] = nodes + which
            self.levels.append(nodes)
            nodes += len(new)
        self.levels.append(nodes)
        self.edges = np.concatenate(edges) if edges else np.empty(0, np.int64)
        self.ends = np.zeros(nodes, bool)
        self.ends[at] = True
        self.ends[0] = False
        self.first = np.zeros(len(self.words), np.int32)
        if edges:
            self.first[edges[0]] = np.arange(1, len(edges[0]) + 1)
        return at

    def _link(self) -> None:
        nodes = len(self.ends)
        self.fail, self.longest, self.out = np.zeros(nodes, np.int32), np.zeros(nodes, np.int16), np.zeros(nodes, np.int32)
        self.more = np.zeros(nodes, np.int32)
        for depth in range(1, len(self.levels) - 1):
            own = np.arange(self.levels[depth], self.levels[depth + 1])
            if depth > 1:
                parent, word = self.edges[own - 1] >> 32, self.edges[own - 1] & 0xFFFFFFFF
                self.fail[own] = self.step(self.fail[parent], word)
            below = self.fail[own]
            self.longest[own] = np.where(self.ends[own], depth, self.longest[below])
            self.out[own] = np.where(self.ends[own], own, self.out[below])
            self.more[own] = self.out[below]

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states after one more word, which is one of the items' words."""
        out = self.first[word]  # from the root
        open_ = np.flatnonzero(state)
        state, word = state[open_].astype(np.int64), word[open_]
        while len(open_):
            edge = state << 32 | word
            at = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            found = self.edges[at] == edge
            out[open_[found]] = at[found] + 1
            state = self.fail[state[~found]].astype(np.int64)
            open_, word = open_[~found], word[~found]
            left = state > 0  # those at the root have their state
            open_, word, state = open_[left], word[left], state[left]
        return out

    def scan(self, line: np.ndarray, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
        """Places of a line of word numbers (-1 for others) at which windows end, and the states there."""
        if not len(line) or not len(self.edges):
            return np.empty(0, np.int64), np.empty(0, np.int32)
        width, early = -(-len(line) // lanes), self.window - 1
        starts = np.arange(0, len(line), width)
        padded = np.concatenate([np.full(early, -1), line, np.full(width, -1)])
        state, places, states = np.zeros(len(starts), np.int32), [], []
        for k in range(width + early):
            word = padded[starts + k]
            known = np.flatnonzero(word >= 0)
            now = np.zeros(len(starts), np.int32)
            if len(known):
                now[known] = self.step(state[known], word[known])
            state = now
            if k >= early:
                hit = np.flatnonzero(self.longest[state])
                if len(hit):
                    places.append(starts[hit] + k - early)
                    states.append(state[hit])
        if not places:
            return np.empty(0, np.int64), np.empty(0, np.int32)
        return np.concatenate(places), np.concatenate(states)

    def items_at(self, state: int) -> set[str]:
        """Ids of the items of all windows that end in a state."""
        found: set[str] = set()
        node = int(self.out[state])
        while node:
            found.update(self.items[k] for k in self.told[self.told_from[node] : self.told_from[node + 1]].tolist())
            node = int(self.more[node])
        return found


def scan_texts(automaton: Automaton, texts: list[str | None], lanes: int = LANES) -> list[tuple[int, list, list, list[str]]]:
    """For each text: number of words, ranges of hit words, the same ranges as offsets in the text, ids of the items found."""
    words = [words_of(t) for t in texts]
    starts = np.cumsum([0, *(len(w) + 1 for w in words)])  # a gap after each text
    line = np.full(starts[-1], -1, np.int64)
    get = automaton.words.get
    for own, start in zip(words, starts.tolist(), strict=False):
        line[start : start + len(own)] = [get(w, -1) for w in own]
    places, states = automaton.scan(line, lanes)
    out: list[tuple] = [(len(w), [], [], []) for w in words]
    edge = np.zeros(len(line) + 1, np.int64)
    np.add.at(edge, places - automaton.longest[states] + 1, 1)
    np.add.at(edge, places + 1, -1)
    covered = np.cumsum(edge) > 0
    turns = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
    for a, b in zip(turns[0::2].tolist(), turns[1::2].tolist(), strict=True):
        row = int(np.searchsorted(starts, a, "right")) - 1
        out[row][1].append((a - int(starts[row]), b - int(starts[row])))
    rows = np.searchsorted(starts, places, "right") - 1
    for row, state in np.unique(np.column_stack([rows, states]), axis=0).tolist():
        out[row][3].extend(automaton.items_at(state))
    for row in np.unique(rows).tolist():
        at = [m.span() for m in _WORD.finditer(texts[row])]
        out[row][2].extend((at[a][0], at[b - 1][1]) for a, b in out[row][1])
        out[row] = (*out[row][:3], sorted(set(out[row][3])))
    return out


def contamination(
    docs: DataFrame, items: DataFrame, keys: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``keys``, ``text`` and per text: n_words, words_hit (ranges of words), spans (the same in the original), item_ids.

    An item of fewer words than the window, but not none, is one window. Null and empty texts have no words and no hits; an
    item without an id still marks words but adds no id; repeated rows stay rows; other columns are not read. The items are
    test questions and answers; all of them go to the driver and into one automaton, which is broadcast (some 25 bytes for each
    word and place in the window: 300 MB for 5 MB of items). Texts are scanned once, ``block_chars`` at a time.
    """
    held = [tuple(r) for r in items.select(F.col(item_id).cast("string"), F.col(item_text)).collect()]
    shared, token = docs.sparkSession.sparkContext.broadcast(Automaton(held, window)), uuid.uuid4().hex
    n, names = len(keys), [f.name for f in _FOUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = kept(token, lambda: shared.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(n)), 0).to_pylist()
            for a, b in blocks_of(sizes, block_chars):
                part = batch.slice(a, b - a)
                found = scan_texts(automaton, part.column(n).to_pylist())
                spans = [[[{"start": x, "end": y} for x, y in f[k]] for f in found] for k in (1, 2)]
                arrays = [
                    pa.array([f[0] for f in found], pa.int64()), *(pa.array(x, _ARROW_SPANS) for x in spans),
                    pa.array([f[3] for f in found], pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*keys, text, *names])

    schema = T.StructType([*(docs.schema[k] for k in [*keys, text]), *_FOUND])
    return map_arrow(docs.select(*keys, text), run, schema, token)


def n_hit(words_hit: str = "words_hit"):
    """Number of hit words, from disjoint ranges."""
    return F.aggregate(words_hit, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
