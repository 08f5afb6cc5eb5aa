"""Row counts before and after cleaning."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.delimited import CORRUPT


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` of several tables in one frame."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
            for n, df in tables.items()
        ],
    )


def malformed_lines(tables: Mapping[str, DataFrame], corrupt: str = CORRUPT) -> DataFrame:
    """``(source, malformed)``: rows with a ``corrupt`` line, one aggregate per table.

    The other columns are read as well: a reader that is asked for the line alone
    refuses, and one that skips columns may not see what is wrong with them.
    """
    def bad(df: DataFrame) -> Column:
        others = F.concat_ws("", *[F.col(c).cast("string") for c in df.columns if c != corrupt])
        return F.count_if(F.col(corrupt).isNotNull() & (F.length(others) >= 0))

    return reduce(
        DataFrame.unionByName,
        [
            df.agg(bad(df).alias("malformed")).select(F.lit(n).alias("source"), "malformed")
            for n, df in tables.items()
        ],
    )


def quality_report(
    sources: Mapping[str, tuple[DataFrame | None, DataFrame]],
) -> DataFrame:
    """``(source, original, clean, removed)``.

    A source without a raw side is reported with its clean count only. Give the
    staged tables as clean side, so that counting reads files, not the plan
    that made them.
    """
    raw = {n: o for n, (o, _) in sources.items() if o is not None}
    sides = [row_counts({n: c for n, (_, c) in sources.items()}).withColumn("side", F.lit("c"))]
    if raw:
        sides.append(row_counts(raw).withColumn("side", F.lit("o")))
    both = reduce(DataFrame.unionByName, sides)
    return (
        both.groupBy(F.col("table").alias("source"))
        .agg(
            F.max(F.when(F.col("side") == "o", F.col("rows"))).alias("original"),
            F.max(F.when(F.col("side") == "c", F.col("rows"))).alias("clean"),
        )
        .withColumn("removed", F.col("original") - F.col("clean"))
    )
