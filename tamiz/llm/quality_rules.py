"""Heuristic quality rules, compiled from a table into one projection.

Every rule bounds a ratio of two counted features of a text. The counts are
columns of one projection and the verdict is a second one above it: built-in
functions only, no shuffle, no user function, whatever the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import SPACE_CHARS, let, lines_with_words, unused, windows, without, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "on",
    "be", "by", "are", "this", "not", "or", "from", "but",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist",
    "im", "dem", "nicht", "ein", "eine", "als",
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "est", "pour", "qui",
    "dans", "par", "plus", "pas", "au", "sur", "ne", "se",
    "el", "y", "los", "del", "las", "por", "con", "no", "una", "su", "para", "es", "al", "lo",
    "como",
]


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; judged from ``min_words`` words on."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None
    min_words: int = 0


# The base rules are the contract's; the others are the method's table of thresholds.
BASE_RULES = [
    Rule("few_words", "n_words", low=10),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.2),
]
RULES = [
    Rule("word_length", "word_chars", "n_words", low=2.5, high=12.0),
    Rule("symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop_words", "n_stop_words", "n_words", low=0.05, min_words=20),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=0.3, min_words=20),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=0.9, min_words=20),
    Rule("adjacent_repeats", "n_adjacent_repeats", "n_words", high=0.3),
]


def _covered(hashes: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more.

    Windows are sorted by hash; equal neighbours name repeated positions, and
    each position covers the words up to the next one, at most a whole window.
    """
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(p: Column) -> Column:
        twins = F.zip_with(
            F.slice(p, F.lit(1), F.size(p) - 1),
            F.slice(p, F.lit(2), F.size(p) - 1),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        return F.array_distinct(F.flatten(F.filter(twins, lambda t: t.isNotNull())))

    def span(p: Column) -> Column:
        steps = F.zip_with(
            F.slice(p, F.lit(1), F.size(p) - 1),
            F.slice(p, F.lit(2), F.size(p) - 1),
            lambda a, b: F.least(F.lit(WINDOW), b - a),
        )
        return F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)

    return let(F.array_sort(let(placed, repeated)), span)


def _fails(rule: Rule, count: dict[str, str]) -> Column:
    """True where the rule is broken. Ratios are compared as products, so 0/0 breaks nothing."""
    top = F.col(count[rule.numerator]).cast("double")
    base = F.col(count[rule.denominator]).cast("double") if rule.denominator else F.lit(1.0)
    tests = []
    if rule.low is not None:
        tests.append(top < base * F.lit(float(rule.low)))
    if rule.high is not None:
        tests.append(top > base * F.lit(float(rule.high)))
    broken = reduce(lambda a, b: a | b, tests)
    if rule.min_words:
        broken = (F.col(count["n_words"]) >= rule.min_words) & broken
    return broken


COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_stop_words", "n_ellipsis_lines", "n_bullet_lines", "n_adjacent_repeats",
]


def quality_rules(
    documents: DataFrame,
    text: str = "text",
    base: Sequence[Rule] = tuple(BASE_RULES),
    rules: Sequence[Rule] = tuple(RULES),
    keep_columns: bool = True,
) -> DataFrame:
    """Add the counts of :data:`COUNTS`, ``base_failed``, ``failed_rules`` and ``kept``.

    * NULL text: no words, all counts 0, ``base_failed``.
    * Empty text: the same. A text without lines breaks no line rule.
    * Very long texts are counted whole; a repeated window is found by its
      64-bit hash among the windows of its own document.
    * Repeated rows and ties: every row is judged by itself, the order is free.
    * Columns that are named like an output column are replaced by it, other
      columns stay (``keep_columns=False`` leaves only the results).
    * Empty table: empty result.
    """
    taken = documents.columns
    names = {}
    for c in ["words", "lines", "windows", "row", *COUNTS]:
        names[c] = unused([*taken, *names.values()], f"__{c}")
    w, lines, hashes, row = (names[c] for c in ("words", "lines", "windows", "row"))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def number(c: Column) -> Column:
        return c.cast("long")

    split = documents.withColumns({w: words(body), lines: lines_with_words(body)})
    hashed = split.withColumn(hashes, windows(F.col(w), WINDOW))
    # Most documents repeat no window: only the others are sorted.
    some = F.size(F.array_distinct(F.col(hashes))) < F.size(F.col(hashes))
    stops = F.filter(F.col(w), lambda x: F.lower(x).isin(STOP_WORDS))
    n = F.size(F.col(w))
    twins = F.zip_with(
        F.slice(F.col(w), F.lit(1), F.greatest(n - 1, F.lit(0))),
        F.slice(F.col(w), F.lit(2), F.greatest(n - 1, F.lit(0))),
        lambda a, b: a == b,
    )
    counted = hashed.withColumns(
        {
            # Numbered rows keep a filter on the verdict above the counts, which would
            # else be computed once for the filter and again for the result.
            row: F.monotonically_increasing_id(),
            names["n_words"]: number(n),
            names["word_chars"]: number(F.length(without(body, SPACE_CHARS))),
            names["n_symbols"]: number(F.length(body) - F.length(without(body, SYMBOLS))),
            names["n_lines"]: number(F.size(F.col(lines))),
            names["n_dup_lines"]: number(
                F.size(F.col(lines)) - F.size(F.array_distinct(F.col(lines)))
            ),
            names["n_repeat_words"]: number(
                F.when(some, _covered(F.col(hashes))).otherwise(F.lit(0))
            ),
            names["n_stop_words"]: number(F.size(stops)),
            names["n_ellipsis_lines"]: number(
                F.size(F.filter(F.col(lines), lambda x: x.rlike(r"(\.\.\.|…)\s*$")))
            ),
            names["n_bullet_lines"]: number(
                F.size(F.filter(F.col(lines), lambda x: x.rlike(r"^\s*[•\-\*]\s")))
            ),
            names["n_adjacent_repeats"]: number(F.size(F.filter(twins, lambda t: t))),
        }
    )
    broken = {r.name: _fails(r, names) for r in [*base, *rules]}
    base_failed = reduce(lambda a, b: a | b, [broken[r.name] for r in base], F.lit(False))
    rejected = reduce(lambda a, b: a | b, broken.values(), F.lit(False))
    failed = F.filter(
        F.array(*[F.when(c, F.lit(name)) for name, c in broken.items()]), lambda x: x.isNotNull()
    )
    results = {
        **{c: F.col(names[c]) for c in COUNTS},
        "base_failed": base_failed, "failed_rules": failed, "kept": ~rejected & (F.col(row) >= 0),
    }
    lower = {c.lower() for c in results}
    rest = [c for c in taken if c.lower() not in lower] if keep_columns else []
    return counted.select(
        *[F.col(f"`{c}`") for c in rest], *[c.alias(name) for name, c in results.items()]
    )


def passing(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """Rows that break no rule, with the columns they came with."""
    mark = unused(documents.columns, "__row")
    packed = documents.select(F.struct("*").alias(mark), F.col(f"`{text}`").alias("text"))
    judged = quality_rules(packed, "text", **options)
    return judged.filter("kept").select(f"{mark}.*")
