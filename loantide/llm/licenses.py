"""License scan with built-in functions only.

Words are normalised once a text. A rule runs only on texts that hold its keyword; its matches become ranges of words, and a
range inside another of the same or a higher priority is dropped. Everything is an expression over the row: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import word_line
from .license_rules import BASE_PHRASES, rules

#: Confidence of a finding by its rule's priority.
CONFIDENCE = {1: 0.95, 2: 0.8, 3: 0.4}

#: Findings of a text that are folded at once.
PIECE = 256

_FINDING = "struct<start:bigint,stop:bigint,priority:int,rule:int,label:string>"


def on_padded(pattern: str) -> str:
    """A rule's pattern for text in which every word has a space of its own on both sides."""
    return f" (?:{pattern.replace(' ', '  ')}) "


def base_rules() -> list[tuple[int, int, str, str, str]]:
    """The base phrases as rules of priority 2, numbered after the others."""
    first = len(rules())
    return [(first + k, 2, label, phrase.split()[0], phrase) for k, (phrase, label) in enumerate(BASE_PHRASES.items())]


def _n_words(padded: Column) -> Column:
    return ((F.length(padded) - F.length(F.replace(padded, F.lit(" "), F.lit("")))) / 2).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pieces_of(items: Column) -> Column:
    """An array in pieces of ``PIECE``: folds append to the arrays of a piece, so they stay linear in long texts."""
    many = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / PIECE).cast("int"))
    return F.when(F.size(items) > 0, F.transform(many, lambda k: F.slice(items, k * PIECE + 1, PIECE))).otherwise(F.slice(F.array(items), 1, 0))


def _findings(padded: Column, rule: Column) -> Column:
    """All places of one rule as findings, in text order: pieces between matches give the places."""
    nothing = F.array().cast(f"array<{_FINDING}>")

    def step(so_far: Column, pair: Column) -> Column:
        start = so_far["at"] + _n_words(pair["piece"])
        stop = start + _n_words(pair["match"])
        own = F.struct(start.alias("start"), stop.alias("stop"), rule["priority"].alias("priority"), rule["rule"].alias("rule"), rule["label"].alias("label"))
        return F.struct(stop.alias("at"), F.array_append(so_far["found"], own).alias("found"))

    def moved(so_far: Column, piece: Column) -> Column:
        """The findings of a piece, counted from its own first word, and where they have to go."""
        own = F.struct(so_far["at"].alias("by"), piece["found"].alias("found"))
        return F.struct((so_far["at"] + piece["at"]).alias("at"), F.array_append(so_far["parts"], own).alias("parts"))

    def placed(part: Column) -> Column:
        return F.transform(part["found"], lambda f: F.struct(
            (f["start"] + part["by"]).alias("start"), (f["stop"] + part["by"]).alias("stop"), f["priority"].alias("priority"), f["rule"].alias("rule"), f["label"].alias("label")
        ))

    def of(matches: Column) -> Column:
        pieces = F.slice(F.split(padded, rule["pattern"]), 1, F.size(matches))
        pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
        zero = F.struct(F.lit(0).cast("long").alias("at"), nothing.alias("found"))
        parts = _let(pairs, lambda given: F.transform(_pieces_of(given), lambda piece: F.aggregate(piece, zero, step)))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<struct<by:bigint,found:array<{_FINDING}>>>").alias("parts"))
        whole = F.aggregate(parts, start, moved, lambda x: x["parts"])
        return F.when(F.size(matches) > 0, F.flatten(F.transform(whole, placed))).otherwise(nothing)

    return _let(F.regexp_extract_all(padded, rule["pattern"], F.lit(0)), of)


def _outermost(findings: Column) -> Column:
    """Findings not inside one of the same or a higher priority; of equal ranges the higher priority, then the first rule."""
    order = F.transform(
        findings,
        lambda x: F.struct(x["start"].alias("start"), (-x["stop"]).alias("less"), x["priority"].alias("priority"), x["rule"].alias("rule"), x["label"].alias("label")),
    )
    names = [f"end{p}" for p in CONFIDENCE]

    def reach(so_far: Column, x: Column) -> list[Column]:
        """The farthest end of each priority after one more finding."""
        return [F.when(x["priority"] == p, F.greatest(so_far[n], -x["less"])).otherwise(so_far[n]).alias(n) for p, n in zip(CONFIDENCE, names, strict=True)]

    def step(so_far: Column, x: Column) -> Column:
        stop, priority = -x["less"], x["priority"]
        inside = F.greatest(*[F.when(priority >= p, so_far[n]).otherwise(F.lit(-1)) for p, n in zip(CONFIDENCE, names, strict=True)])
        own = F.struct(x["start"].alias("start"), stop.alias("stop"), priority.alias("priority"), x["rule"].alias("rule"), x["label"].alias("label"))
        kept = F.when(inside >= stop, so_far["kept"]).otherwise(F.array_append(so_far["kept"], own))
        return F.struct(kept.alias("kept"), *reach(so_far, x))

    none = [F.lit(-1).cast("long").alias(n) for n in names]
    ends = f"struct<{','.join(f'{n}:bigint' for n in names)}>"

    def before(so_far: Column, piece: Column) -> Column:
        """The ends that each piece begins with."""
        now = F.aggregate(piece, so_far["now"], lambda e, x: F.struct(*reach(e, x)))
        return F.struct(F.array_append(so_far["all"], so_far["now"]).alias("all"), now.alias("now"))

    def of(pieces: Column) -> Column:
        begun = F.aggregate(pieces, F.struct(F.array().cast(f"array<{ends}>").alias("all"), F.struct(*none).alias("now")), before, lambda x: x["all"])
        zero = lambda e: F.struct(F.array().cast(f"array<{_FINDING}>").alias("kept"), *[e[n].alias(n) for n in names])
        return F.flatten(F.zip_with(pieces, begun, lambda piece, e: F.aggregate(piece, zero(e), step, lambda x: x["kept"])))

    return _let(F.array_sort(order), lambda ordered: _let(_pieces_of(ordered), of))


def scan(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and per text: n_words, base (places of base phrases) and findings (kept findings of all rules).

    A finding is a range of words [start, stop) with priority, rule and label. Null and empty texts have no words and no
    findings; a base phrase is listed at every place whatever else covers it. Rows are independent: repeated rows and null
    keys come back as they are, and other columns are not read.
    """
    table = [*rules(), *base_rules()]
    as_rules = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(word).alias("keyword"), F.lit(on_padded(pattern)).alias("pattern"))
        for n, p, label, word, pattern in table
    ])
    keywords = F.array(*[F.lit(k) for k in sorted({r[3] for r in table})])
    first_base = len(table) - len(BASE_PHRASES)
    empty = F.array().cast(f"array<{_FINDING}>")
    lined = df.select(*keys, word_line(F.col(text), "  ").alias("__line"))
    gated = lined.select(
        *keys, "__line",
        F.when(F.col("__line") == "", 0).otherwise(F.size(F.split("__line", "  "))).cast("long").alias("n_words"),
        F.array_intersect(F.split("__line", "  "), keywords).alias("__hits"),
    )
    padded = F.concat(F.lit(" "), F.col("__line"), F.lit(" "))
    chosen = F.filter(as_rules, lambda r: F.array_contains(F.col("__hits"), r["keyword"]))
    found = F.when(F.size("__hits") > 0, F.flatten(F.transform(chosen, lambda r: _findings(padded, r)))).otherwise(empty)
    steps = gated.select(*keys, "n_words", found.alias("__found"))
    return steps.select(
        *keys, "n_words",
        F.filter("__found", lambda x: x["rule"] >= first_base).alias("base"),
        F.when(F.size("__found") > 0, _outermost(F.col("__found"))).otherwise(empty).alias("findings"),
    )


def digest(scanned: DataFrame, keys: list[str]) -> DataFrame:
    """The report of a scan: counts, first and last place, labels and score."""
    starts = F.transform("base", lambda x: x["start"])
    base = F.array_distinct(F.transform("base", lambda x: x["label"]))
    labels = F.array_union(base, F.transform("findings", lambda x: x["label"]))
    best = F.array_min(F.transform("findings", lambda x: x["priority"]))
    score = F.lit(0.0)
    for priority, confidence in CONFIDENCE.items():
        score = F.when(best == priority, F.lit(confidence)).otherwise(score)
    return scanned.select(
        *keys, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"), score.alias("score"),
    )
