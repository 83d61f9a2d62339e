"""Text expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything but letters, numbers, underscore and white space, over all of Unicode.
PUNCTUATION = r"[^\p{L}\p{N}_\s\p{Z}]+"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def after_prefix(code: Column, prefix_length: int) -> Column:
    """The code without its first ``prefix_length`` characters."""
    return F.substring(code, prefix_length + 1, 2147483647)


def joined_lower(first: Column, second: Column) -> Column:
    """Both parts with one blank between them, null as empty, in lower case."""
    empty = F.lit("")
    return F.lower(F.concat(F.coalesce(first, empty), F.lit(" "), F.coalesce(second, empty)))


def strip_punctuation(value: Column) -> Column:
    return F.regexp_replace(value, PUNCTUATION, "")


def word_count(value: Column) -> Column:
    """Parts between single blanks; two blanks in a row count an empty word."""
    return F.length(value) - F.length(F.replace(value, F.lit(" "))) + 1


def matches_any(value: Column, patterns: list[str]) -> Column:
    """True when one of the regular expressions is found."""
    return value.rlike("|".join(patterns))


def has_any(value: Column, marks: list[str]) -> Column:
    """True when one of the plain texts occurs; a byte search, much cheaper than an alternation."""
    return reduce(lambda left, right: left | right, [value.contains(mark) for mark in marks])


def has_all_of(value: Column, marks: list[str]) -> Column:
    return reduce(lambda left, right: left & right, [value.contains(mark) for mark in marks])


def has_none_of(value: Column, marks: list[str]) -> Column:
    """True when none of the marks occurs; null stays null, so a filter drops it."""
    return reduce(lambda left, right: left & right, [~value.contains(mark) for mark in marks])
