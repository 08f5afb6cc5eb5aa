"""Date parsing and calendar naming. Bad input gives NULL, never an error."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .codes import map_value


def pattern_shape(pattern: str) -> str | None:
    """Regular expression of the texts that a date pattern can read.

    It may let through what does not parse (a month 13), never the other way round. None
    for patterns with letters other than numbers of a date or time.
    """
    out, i = ["^"], 0
    while i < len(pattern):
        letter = pattern[i]
        n = len(pattern[i:]) - len(pattern[i:].lstrip(letter))
        if letter in "yu" and n == 4:
            # Four letters take more digits with a sign.
            out.append("[+-]?[0-9]{4,}")
        elif letter in "yu" and n == 2 or letter in "MdHms" and n == 2:
            out.append("[0-9]{2}")
        elif letter in "MdHms" and n == 1:
            out.append("[0-9]{1,2}")
        elif letter.isalpha() or letter in "'[]#{}":
            return None
        else:
            out.append(re.escape(letter) * n)
        i += n
    return "".join(out) + "$"


def _parsed(c: Column, pattern: str) -> Column:
    shape = pattern_shape(pattern)
    parsed = F.try_to_date(c, pattern)
    # A value that does not fit costs an exception, so only likely ones are tried.
    return parsed if shape is None else F.when(c.rlike(shape), parsed)


def parse_date(c: Column, *patterns: str) -> Column:
    """First pattern that parses wins; NULL where none does."""
    tries = [_parsed(c, p) for p in patterns]
    return tries[0] if len(tries) == 1 else F.coalesce(*tries)


def iso_date(c: Column) -> Column:
    """Date from the ISO prefix of a date or timestamp text."""
    return parse_date(F.substring(F.trim(c.cast("string")), 1, 10), "yyyy-MM-dd")


def iso_date_or(c: Column, default: str, only_if_null: bool = False) -> Column:
    """ISO prefix of ``c`` as a date, or ``default``.

    ``only_if_null`` keeps the default for input that is NULL; input that is
    present but unreadable then stays NULL.
    """
    fallback = F.lit(default).cast("date")
    if only_if_null:
        raw = parse_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")
        return F.when(c.isNull(), fallback).otherwise(raw)
    return F.coalesce(iso_date(c), fallback)


def nth_name(n: Column, names: Sequence[str]) -> Column:
    """The 1-based ``n``-th of a short list of names."""
    return F.try_element_at(F.array(*[F.lit(x) for x in names]), n)


def date_key(d: Column) -> Column:
    """Integer key ``yyyymmdd``."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def half_year(d: Column) -> Column:
    """1 for January to June, 2 for July to December."""
    return F.when(F.month(d) <= 6, F.lit(1)).otherwise(F.lit(2))


def iso_weekday(d: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(d) + 1


def period_label(
    code: Column,
    start: Column,
    end: Column,
    months: Mapping[str, str],
    special_prefix: str,
    special_label: str,
) -> Column:
    """Readable label of a period.

    ``MONTH yyyy - MONTH yyyy`` in general; codes starting with
    ``special_prefix`` become ``special_label yyyy``.
    """

    def month_and_year(d: Column) -> Column:
        return F.concat(
            map_value(F.date_format(d, "MM"), months), F.lit(" "), F.date_format(d, "yyyy")
        )

    return F.when(
        code.startswith(special_prefix),
        F.concat(F.lit(special_label + " "), F.date_format(start, "yyyy")),
    ).otherwise(F.concat(month_and_year(start), F.lit(" - "), month_and_year(end)))
