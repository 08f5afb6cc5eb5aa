"""Row counts of staged tables from the footers of their files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of its own in which a count of Parquet files is taken from footers.

    Aggregates are pushed down by the version-2 file source only, so it is chosen
    there; the caller's session keeps its settings.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_count_frame(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(table, rows)`` of Parquet tables; no page of theirs is read."""
    own = footer_session(spark)
    counts = [
        own.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table"), "rows")
        for name, path in paths.items()
    ]
    # Pushed down, the count of a table without row groups comes back as NULL, although
    # a count never is; a maximum may be.
    return reduce(DataFrame.unionByName, counts).groupBy("table").agg(
        F.coalesce(F.max("rows"), F.lit(0).cast("long")).alias("rows")
    )


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, int]:
    """Rows of every table, all in one job."""
    if not paths:
        return {}
    return {r["table"]: r["rows"] for r in footer_count_frame(spark, paths).collect()}
