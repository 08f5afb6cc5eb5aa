"""Native word and line columns shared by the operators on text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of anything but these; the same class in a Java and in a SQL pattern.
SPACES = "\\x20\\x09-\\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text in order; a NULL text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{SPACES}]+")
    return F.filter(parts, lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    """Lines (split at newlines) that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda x: x.rlike(f"[^{SPACES}]"))


def without(text: Column, characters: str) -> Column:
    """A text without the given characters."""
    return F.translate(text, characters, "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    A column that a function over an array's elements refers to may be replaced by
    its expression when the optimizer moves a filter, and would then be computed
    anew for every element. A bound value is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def windows(words: Column, size: int) -> Column:
    """64-bit hash of each run of ``size`` words, none if there are fewer."""
    none = F.array().cast("array<bigint>")
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= size,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (size - 1)),
                lambda i: F.xxhash64(F.slice(w, i, size)),
            ),
        ).otherwise(none),
    )


def shingles(words: Column, size: int) -> Column:
    """As :func:`windows`, but fewer words count as one shingle; no word, none."""
    few = F.size(words) < size
    return F.when(few & (F.size(words) > 0), F.array(F.xxhash64(words))).otherwise(
        windows(words, size)
    )


def unused(columns: Sequence[str], stem: str) -> str:
    """A column name starting with ``stem`` that is not among ``columns``."""
    name = stem
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
