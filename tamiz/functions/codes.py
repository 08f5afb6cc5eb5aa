"""Code and category normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import letters_only

# A literal map is scanned linearly per row; past this size use a lookup join.
MAX_LITERAL_ENTRIES = 200


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A constant ``map`` column built from a small dictionary."""
    if len(mapping) > MAX_LITERAL_ENTRIES:
        raise ValueError(
            f"{len(mapping)} entries are too many for a literal map; "
            "put them in a table and use operators.enrich"
        )
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_value(c: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped value, NULL for a key that is not in the map."""
    return F.try_element_at(literal_map(mapping), c)


def map_code(c: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped code where the trimmed text is a key, else the text upper-cased."""
    text = F.trim(c.cast("string"))
    return F.coalesce(map_value(text, mapping), F.upper(text))


def categorize(
    c: Column, rules: Sequence[tuple[str, str, str]], empty: str
) -> Column:
    """Category of the first rule that holds.

    A rule is ``(kind, pattern, category)`` with kind ``regex``, ``equals`` or
    ``contains``; it is tested on the letters of the text only. Text without
    letters becomes ``empty``; text no rule takes is trimmed and upper-cased.
    """
    base = letters_only(c)
    tests = {
        "regex": lambda p: base.rlike(p),
        "equals": lambda p: base == p,
        "contains": lambda p: base.contains(p),
    }
    out = F.when(base.isNull() | (base == ""), F.lit(empty))
    for kind, pattern, category in rules:
        out = out.when(tests[kind](pattern), F.lit(category))
    return out.otherwise(F.upper(F.trim(c)))
