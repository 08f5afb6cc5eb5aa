"""Column profiles, samples and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from .dedup import tie_break


def missing(name: str, data_type: T.DataType) -> Column:
    """Whether a column is NULL, or blank where it is text."""
    c = F.col(f"`{name}`")
    # Only text can be blank; casting anything else to text would be wasted work.
    textual = isinstance(data_type, (T.StringType, T.BinaryType))
    return is_blank(c) if textual else c.isNull()


def profile(df: DataFrame, table: str) -> DataFrame:
    """``(table, position, column, type, rows, null_or_blank)`` in one scan."""
    fields = df.schema.fields
    one_row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(missing(f.name, f.dataType)).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    return one_row.select(
        F.lit(table).alias("table"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("position"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("type"),
                        F.col("n").alias("rows"),
                        F.col(f"c{i}").alias("null_or_blank"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        ),
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Profiles of several tables, one below the other."""
    return reduce(DataFrame.unionByName, [profile(df, n) for n, df in tables.items()])


def sample_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first ``n`` rows by ``order``: the same rows on every run."""
    first = [F.col(o) if isinstance(o, str) else o for o in order]
    return df.orderBy(*first, *tie_break(df)).limit(n)


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.col(column))
    )
