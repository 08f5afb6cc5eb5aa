"""Tables hidden in a narrative spreadsheet.

Input rows carry an array of cells. A row is read by its shape: two cells are a
level-1 heading, three a level-2 heading, four or more hold level-3 entries in
groups of four. Everything else on the sheet is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_markers, strip_whitespace, zero_pad

_TWO_DIGITS = "^[0-9]{2}$"
_ONE_OR_TWO_DIGITS = "^[0-9]{1,2}$"


@dataclass(frozen=True)
class Narrative:
    """The words that mark each level.

    ``level1_prefix`` is a regular expression removed from level-1 names without
    regard to case; ``level2_word`` is removed from level-2 names as written
    (with its blank), ``skip_word`` disqualifies a level-3 group.
    """

    level1_word: str
    level1_prefix: str
    level2_word: str
    skip_word: str
    marker: str = "*"


def clean_cells(cells: Column) -> Column:
    """Stripped cells without the empty ones (and without the text ``nan``)."""
    stripped = F.transform(cells, strip_whitespace)
    return F.filter(stripped, lambda x: x.isNotNull() & ~x.isin("", "nan"))


def clean_rows(rows: DataFrame, cells: str) -> DataFrame:
    """Clean the cell array and drop rows that have nothing left."""
    return rows.withColumn(cells, clean_cells(F.col(cells))).filter(F.size(cells) > 0)


def level1(rows: DataFrame, cells: str, words: Narrative) -> DataFrame:
    """``(code, name)`` of the two-cell headings."""
    code, name = F.get(cells, 0), F.get(cells, 1)
    return rows.filter(
        (F.size(cells) == 2)
        & code.rlike(_TWO_DIGITS)
        & F.upper(name).contains(words.level1_word)
    ).select(
        code.alias("code"),
        F.upper(
            strip_whitespace(F.regexp_replace(name, f"(?iU){words.level1_prefix}", ""))
        ).alias("name"),
    )


def level2(rows: DataFrame, cells: str, words: Narrative) -> DataFrame:
    """``(parent_code, code, name)`` of the three-cell headings."""
    parent, own, name = (F.get(cells, i) for i in range(3))
    bare = F.upper(strip_whitespace(F.replace(name, F.lit(f"{words.level2_word} "))))
    return rows.filter(
        (F.size(cells) == 3)
        & parent.rlike(_TWO_DIGITS)
        & own.rlike(_TWO_DIGITS)
        & F.upper(name).contains(words.level2_word)
    ).select(
        parent.alias("parent_code"),
        F.concat(parent, own).alias("code"),
        strip_whitespace(strip_markers(bare, words.marker)).alias("name"),
    )


def level3(rows: DataFrame, cells: str, words: Narrative) -> DataFrame:
    """``(root_code, parent_code, code, name)`` of every full group of four."""
    c = F.col(cells)
    # sequence() raises when it would run backwards, so short rows get none.
    starts = F.when(F.size(c) >= 4, F.sequence(F.lit(1), F.size(c) - 3, F.lit(4)))
    groups = rows.select(
        F.explode(F.transform(starts, lambda i: F.slice(c, i, 4))).alias("g")
    ).select(*[F.get("g", i).alias(n) for i, n in enumerate(["root", "mid", "leaf", "name"])])
    name = F.upper(strip_whitespace(strip_markers(F.col("name"), words.marker)))
    return groups.filter(
        F.col("root").rlike(_TWO_DIGITS)
        & F.col("mid").rlike(_TWO_DIGITS)
        & F.col("leaf").rlike(_ONE_OR_TWO_DIGITS)
        & (F.length("name") > 2)
        & ~F.upper(F.col("name")).contains(words.skip_word)
    ).select(
        F.col("root").alias("root_code"),
        F.concat("root", "mid").alias("parent_code"),
        F.concat(F.col("root"), F.col("mid"), zero_pad(F.col("leaf"), 2)).alias("code"),
        name.alias("name"),
    )


def parse_narrative(
    rows: DataFrame, cells: str, words: Narrative
) -> Sequence[DataFrame]:
    """The three levels of a narrative sheet."""
    cleaned = clean_rows(rows, cells)
    return tuple(f(cleaned, cells, words) for f in (level1, level2, level3))
