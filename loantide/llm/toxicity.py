"""Toxicity scores by a support vector machine over a gapped-subsequence string kernel.

The kernel of two words is the sum over all subsequences of ``ORDER`` characters within ``SPAN`` places, each weighted by
``DECAY`` for every place it spans, normalised by both words' own kernels. Words with inserted or replaced characters still
share most subsequences. Landmark words give Nyström features; a linear machine on them collapses to one weight for each
subsequence, so a word costs a few table look-ups. Labels mark whole documents, so training works on bags: of the
sentences of a toxic document, the words that score highest have to be toxic; no word of a clean one may be.

The model is fitted on a bounded sample of labelled rows; all documents are scored, by their whole texts.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, map_arrow

ORDER, SPAN, DECAY = 4, 7, 0.6
#: Bounds of the training sample, in documents: taken in order of a hash, so the sample is the same in every run.
TOXIC_ROWS, CLEAN_ROWS = 1_000, 1_500
#: Parameters of the fit on that sample: landmarks; words for each telling run among them; clean words that the machine learns
#: from, those closest to a landmark; and the commonest words of toxic documents that are learned with foreign characters too.
LANDMARKS, WORDS_A_RUN, CLEAN_WORDS, DISTURBED = 160, 4, 12_000, 60
#: Highest word margins that a text's score is made of.
TOP = 6
THRESHOLD = 0.7
CACHE_ENTRIES = 200_000
LONGEST = 64

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MARKS = bytes(b for b in range(0x21, 0x7F) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_SPELLED = re.compile(rb"(?<!\S)[^\s](?:[ \t][^\s]){2,}(?!\S)")
_OFFSETS = [(0, *rest) for rest in combinations(range(1, SPAN), ORDER - 1)]
_BITS = 20


def tokens(text: str | None) -> set[bytes]:
    """Distinct words: ASCII marks inside words are taken out, and letters spelled one by one are joined."""
    if not text:
        return set()
    line = text.encode().translate(_LOWER, _MARKS)
    words = set(line.split())
    if any(len(w) == 1 for w in words):
        words.update(b"".join(m[0].split()) for m in _SPELLED.finditer(line))
    return words


def _pieces(word: bytes) -> list[str]:
    """A word as text between marks of its ends; a long one as overlapping pieces that hold all its subsequences."""
    text = f"^{word.decode(errors='replace').lower()}$"
    if len(text) <= LONGEST:
        return [text]
    return [text[k : k + LONGEST] for k in range(0, len(text) - SPAN + 1, LONGEST - SPAN + 1)]


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed subsequences of words of one length and the exponent of each column: (words x places) and (places)."""
    length = len(words[0])
    chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length).astype(np.uint64)
    mixed = [chars * np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
    columns, spans = [], []
    for offsets in _OFFSETS:
        places = length - offsets[-1]
        if places > 0:
            code = mixed[0][:, :places].copy()
            for m, o in zip(mixed[1:], offsets[1:], strict=True):
                code ^= m[:, o : o + places]
                code *= np.uint64(0xFF51AFD7ED558CCD)
                code ^= code >> np.uint64(29)
            columns.append(code)
            spans += [offsets[-1] + 1] * places
    if not columns:
        return np.empty((len(words), 0), np.uint64), np.empty(0)
    return np.hstack(columns), DECAY ** np.array(spans, float)


def _by_length(words: Iterable[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        if len(w) >= ORDER:
            groups.setdefault(len(w), []).append(w)
    for group in groups.values():
        for k in range(0, len(group), 1_000):
            yield group[k : k + 1_000]


def _norms(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Square root of each word's kernel with itself; equal subsequences of a word add up first."""
    order = np.argsort(codes, axis=1, kind="stable")
    own, w = np.take_along_axis(codes, order, 1), weight[order]
    first = np.ones(own.shape, bool)
    first[:, 1:] = own[:, 1:] != own[:, :-1]
    sums = np.add.reduceat(w.ravel(), np.flatnonzero(first.ravel()))
    rows = np.repeat(np.arange(len(own)), own.shape[1])[first.ravel()]
    return np.sqrt(np.bincount(rows, sums**2, len(own)))


class Features:
    """Normalised kernels of words with a list of words, through a table of the latter's subsequences."""

    def __init__(self, landmarks: list[str]):
        own: dict[int, list[tuple[int, float]]] = {}
        for j, word in enumerate(landmarks):
            codes, weight = _codes([word])
            norm, sums = _norms(codes, weight)[0], Counter()
            for c, w in zip(codes[0].tolist(), weight.tolist(), strict=True):
                sums[c] += w
            for c, w in sums.items():
                own.setdefault(c, []).append((j, w / norm))
        self.codes = np.array(sorted(own), np.uint64)
        self.table = np.zeros((len(own), len(landmarks)))
        for row, c in enumerate(self.codes.tolist()):
            for j, w in own[c]:
                self.table[row, j] = w
        self._set_filter()

    def _set_filter(self) -> None:
        self.filter = np.zeros(1 << _BITS, bool)
        self.filter[self.codes >> np.uint64(64 - _BITS)] = True

    def collapsed(self, beta: np.ndarray) -> Features:
        """With one column: the sum over landmarks weighted by ``beta``."""
        out = object.__new__(Features)
        out.codes, out.table = self.codes, (self.table @ beta)[:, None]
        out._set_filter()
        return out

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length: positions of those that share a subsequence, and their kernels."""
        codes, weight = _codes(words)
        at, place = np.nonzero(self.filter[codes >> np.uint64(64 - _BITS)])
        found = codes[at, place]
        row = np.searchsorted(self.codes, found)
        row[row == len(self.codes)] = 0
        real = self.codes[row] == found if len(self.codes) else np.zeros(len(found), bool)
        at, place, row = at[real], place[real], row[real]
        if not len(at):
            return np.empty(0, np.int64), np.empty((0, self.table.shape[1]))
        first = np.flatnonzero(np.diff(at, prepend=-1))  # hits come word by word
        which = at[first]
        kernel = np.add.reduceat(self.table[row] * weight[place][:, None], first, axis=0)
        return which, kernel / _norms(codes[which], weight)[:, None]


class Model:
    """Margins of words and scores of texts; without both classes in training, every score is 0.

    A text's score is a logistic function of the length of its ``TOP`` highest margins, measured from the clean side's edge:
    one clear insult is enough, and several words that are each doubtful add up.
    """

    def __init__(self, features: Features | None, bias: float = 0.0):
        self.features, self.bias = features, bias
        self.slope, self.shift = 1.0, 0.0

    def margins(self, words: set[bytes], cache: dict[bytes, float]) -> None:
        """Puts the margins of new words into the cache; a word without shared subsequence has the bias."""
        if len(cache) > CACHE_ENTRIES:
            cache.clear()
        parts = {w: _pieces(w) for w in words.difference(cache)}
        margin = self.of_pieces({p for own in parts.values() for p in own})
        for w, own in parts.items():
            cache[w] = max((margin.get(p, 0.0) for p in own), default=0.0) + self.bias

    def of_pieces(self, pieces: set[str]) -> dict[str, float]:
        """Weighted kernels of the pieces that share a subsequence with a landmark."""
        out: dict[str, float] = {}
        for group in _by_length(pieces):
            which, kernel = self.features.of(group)
            out.update((group[k], v) for k, v in zip(which.tolist(), kernel[:, 0].tolist(), strict=True))
        return out

    def scores(self, texts: list[str | None], cache: dict[bytes, float] | None = None) -> list[float]:
        cache = {} if cache is None else cache
        if self.features is None:
            return [0.0] * len(texts)
        own = [tokens(t) for t in texts]
        self.margins(set().union(*own), cache)
        best = np.array([_evidence(map(cache.__getitem__, words)) for words in own])
        return _logistic(self.slope * best + self.shift).tolist()


def _evidence(margins: Iterable[float]) -> float:
    """Length of the highest margins above -1, the clean side's edge."""
    return math.sqrt(sum(max(0.0, m + 1.0) ** 2 for m in heapq.nlargest(TOP, margins)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.clip(-x, -50, 50)))


def _grams(word: str) -> set[str]:
    return {word[k : k + ORDER] for k in range(len(word) - ORDER + 1)}


def _disturbed(word: str) -> list[str]:
    """The word with a foreign character inserted at, or put in place of, each inner position."""
    inner = range(2, len(word) - 1)  # within the marks of its ends
    return [*(f"{word[:k]}*{word[k:]}" for k in inner), *(f"{word[:k]}*{word[k + 1:]}" for k in inner if k < len(word) - 2)]


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        near = y * (x @ w) < 1
        xs, c = x[near], cost * weight[near]
        step = np.linalg.solve(ridge + (xs * c[:, None]).T @ xs, (xs * c[:, None]).T @ y[near])
        if np.abs(step - w).max() < 1e-6:
            break
        w = step
    return w[:-1], float(w[-1])


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic function, both classes weighted equally, with smoothed targets."""
    n1, n0 = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y == 1, 0.5 / n1, 0.5 / n0)
    x, at, pull = np.column_stack([x, np.ones(len(x))]), np.array([1.0, 0.0]), np.array([1e-3, 1e-5])
    for _ in range(80):
        p = _logistic(x @ at)
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + np.diag(pull)
        at = at + np.clip(np.linalg.solve(bend, x.T @ (weight * (target - p)) - pull * at), -1, 1)
    return float(at[0]), float(at[1])


def fit(toxic: list[set[str]], clean: list[set[str]], landmarks: int = LANDMARKS) -> Model:
    """The model from distinct words (pieces) of toxic and clean documents."""
    if not toxic or not clean:
        return Model(None)
    # Landmarks: words of toxic documents whose contiguous runs are commoner there, by documents, and clean words like them.
    df = [Counter(), Counter()]
    for k, docs in enumerate((clean, toxic)):
        for words in docs:
            df[k].update(set().union(*map(_grams, words)) if words else ())
    n1, n0 = len(toxic), len(clean)
    odds = {g: np.log((a + 0.2) / (n1 + 1)) - np.log((df[0][g] + 0.5) / (n0 + 1)) for g, a in df[1].items() if a >= min(2, n1)}
    telling = {g: v * np.log1p(df[1][g]) for g, v in odds.items() if v > 1}
    value = {w: max((telling.get(g, 0.0) for g in _grams(w)), default=0.0) for words in toxic for w in words}
    # To begin with, the words of a toxic document that come near its most telling one.
    top = [max((value[w] for w in words), default=0.0) for words in toxic]
    picks = [[w for w in sorted(words) if value[w] > 0 and value[w] >= 0.6 * best] for words, best in zip(toxic, top, strict=True)]
    often = Counter(w for words in toxic for w in words if value.get(w, 0.0) > 0)
    chosen = sorted({w for w in often if len(w) >= ORDER}, key=lambda w: (-value[w] * np.log1p(often[w]), w))
    held: Counter = Counter()
    positive = []
    for w in chosen:  # a few words for each telling run, so that all kinds of insult have landmarks
        best = max(_grams(w), key=lambda g: (telling.get(g, 0.0), g))
        if held[best] < WORDS_A_RUN and len(positive) < landmarks * 3 // 4:
            held[best] += 1
            positive.append(w)
    if not positive:
        return Model(None)
    common = Counter(w for words in clean for w in words if len(w) >= ORDER)
    probe = Features(positive)
    close: dict[str, float] = {}
    for group in _by_length(common):
        which, kernel = probe.of(group)
        close.update((group[k], v) for k, v in zip(which.tolist(), kernel.max(1).tolist(), strict=True))
    negative = sorted(close, key=lambda w: (-close[w], w))[: landmarks - len(positive)]
    features = Features([*positive, *negative])

    def vectors(words: Iterable[str], least: float = 0.0) -> tuple[list[str], np.ndarray]:
        """Kernels of the words that have ``least`` with some positive landmark; below it they count as words without any."""
        names, rows = [], []
        for group in _by_length(sorted(words)):
            which, kernel = features.of(group)
            near = kernel[:, : len(positive)].max(1, initial=0.0) >= least
            names += [group[k] for k in which[near].tolist()]
            rows.append(kernel[near])
        return names, np.vstack(rows) if rows else np.empty((0, features.table.shape[1]))

    own_names, own = vectors([*positive, *negative])
    gram = own[[own_names.index(w) for w in [*positive, *negative]]]
    values, basis = np.linalg.eigh((gram + gram.T) / 2)
    root = basis @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ basis.T  # inverse square root: Nyström features
    # The closest clean words decide the margin.
    least = max(0.05, sorted(close.values(), reverse=True)[:CLEAN_WORDS][-1]) if close else 0.05
    clean_names, clean_x = vectors(common, least)  # with all that are as close as the last of them
    usualness = np.sqrt([common[w] for w in clean_names])
    toxic_names, toxic_x = vectors({w for words in toxic for w in words}, least)
    at = {w: k for k, w in enumerate(toxic_names)}
    z0, z1 = clean_x @ root, toxic_x @ root
    zero = np.zeros((1, z0.shape[1]))
    known = [[at[w] for w in words if w in at] for words in toxic]
    chosen_rows = [at[p] for own in picks for p in own if p in at]
    w, bias = np.zeros(z0.shape[1]), 0.0
    for _ in range(4):
        rows = sorted(set(chosen_rows))
        if not rows:
            return Model(None)
        times = Counter(chosen_rows)
        usual = [toxic_names[r] for r, _ in times.most_common(DISTURBED)]
        z2 = vectors({d for word in usual for d in _disturbed(word)})[1] @ root
        x = np.vstack([z1[rows], z2, z0, zero])
        y = np.r_[np.ones(len(rows) + len(z2)), -np.ones(len(z0) + 1)]
        heavy = np.array([times[r] for r in rows], float)
        weight = np.r_[heavy / heavy.sum() * 300, np.full(len(z2), 100 / max(1, len(z2))), usualness, 300.0]
        w, bias = _machine(x, y, weight)
        margin = z1 @ w
        best = [max(ks, key=lambda k: margin[k]) for ks in known if ks]
        more = [k for ks in known for k in ks if margin[k] + bias > 0]
        likely = {r for r in {*best, *more} if margin[r] + bias > -0.5}
        chosen_rows = [k for ks in known for k in ks if k in likely] or rows
    model = Model(features.collapsed(root @ w), bias)
    margin = model.of_pieces({w for words in [*toxic, *clean] for w in words})
    x = [_evidence(margin.get(w, 0.0) + bias for w in words) for words in [*toxic, *clean]]
    x, y = np.array(x), np.r_[np.ones(len(toxic)), np.zeros(len(clean))]
    model.slope, model.shift = _curve(x, y)
    # Where the classes are far apart, the threshold moves half the way to the clean ones, so that one weak insult is enough;
    # where they overlap, it moves to where all but two clean ones in a thousand stay below it.
    edge, middle = np.quantile(x[y == 0], 0.998), (math.log(THRESHOLD / (1 - THRESHOLD)) - model.shift) / model.slope
    model.shift += model.slope * (middle - max(edge, (edge + middle) / 2))
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that training never reads: crc32 of the id's text leaves 1 modulo 3. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """Fits on at most ``toxic_rows`` and ``clean_rows`` labelled documents outside the held-out part.

    A document with several labels counts as toxic if one says so; null labels are not used. Rows with the same id are one
    document with the words of all of them, and only its distinct words come to the driver. The bounds are on documents: the
    distinct words of one very long document have none.
    """
    marked = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("train"))
    parts = [marked.filter(F.col("toxic") == k).orderBy(order, "doc_id").limit(n) for k, n in ((1, toxic_rows), (0, clean_rows))]
    sample = parts[0].unionByName(parts[1])  # bounded by its two limits, so it may be broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted({p for w in tokens(t) for p in _pieces(w)}) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string())), *batch.columns[1:]], names=["words", "doc_id", "toxic"])

    schema = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), chosen.schema["doc_id"], T.StructField("toxic", T.LongType())])
    found = map_arrow(chosen.select("text", "doc_id", F.col("toxic").cast("long").alias("toxic")), words, schema)
    # Distinct first, so that an id of many rows is not gathered in one task before its words are few.
    each = found.select("doc_id", "toxic", F.explode_outer("words").alias("word")).distinct()
    rows = sorted(each.groupBy("doc_id", "toxic").agg(F.collect_list("word")).collect(), key=lambda r: r[0])
    return fit([set(r[2]) for r in rows if r[1] == 1], [set(r[2]) for r in rows if r[1] == 0])


def score(docs: DataFrame, keys: list[str], model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``keys``, ``text`` and the score of each text, 0 to 1. Only the text is an input of it.

    Null and empty texts get the score of a text without words; repeated rows and null keys come back as they are; other
    columns are not read. The broadcast model has a fixed size.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = kept(token, dict)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                values = pa.array(shared.value.scores(part.column(len(keys)).to_pylist(), cache), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, values], names=[*keys, text, name])

    schema = T.StructType([*(docs.schema[k] for k in [*keys, text]), T.StructField(name, T.DoubleType())])
    return map_arrow(docs.select(*keys, text), run, schema, token)
