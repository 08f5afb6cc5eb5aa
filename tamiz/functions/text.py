"""Text cleaning expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators Java's \s leaves out.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def clean(c: Column, upper: bool = False) -> Column:
    """Strip blanks on both ends, optionally folding to upper case."""
    return F.upper(F.trim(c)) if upper else F.trim(c)


def strip_whitespace(c: Column) -> Column:
    """Strip every kind of white space (tab, NBSP, ...), not only blanks."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def strip_quotes(c: Column) -> Column:
    """Drop one double quote at either end; the ends are independent."""
    return F.trim(F.regexp_replace(F.trim(c), '^"|"$', ""))


def strip_markers(c: Column, marker: str = "*", at_most: int | None = None) -> Column:
    """Drop leading ``marker`` characters, all of them or ``at_most`` many."""
    times = "+" if at_most is None else "{1,%d}" % at_most
    return F.trim(F.regexp_replace(c, rf"^\Q{marker}\E{times}", ""))


def letters_only(c: Column) -> Column:
    """Upper-case and keep A-Z only: the comparison base for categories."""
    return F.regexp_replace(F.upper(F.trim(c)), "[^A-Z]", "")


def is_blank(c: Column) -> Column:
    """True for NULL and for text that is empty once trimmed."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def not_blank(c: Column) -> Column:
    """True for text with content; NULL input gives NULL, so a filter drops it."""
    return F.trim(c) != ""


def default_if_blank(c: Column, default: str) -> Column:
    """Trimmed text, or ``default`` where there is none."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(default))


def concat_skip_nulls(*parts: Column) -> Column:
    """Concatenate treating NULL as empty text (never NULL itself)."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def zero_pad(c: Column, width: int) -> Column:
    """Left-pad with zeros; text that is already longer is left alone."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)
