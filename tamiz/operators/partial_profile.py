"""Profiles of a partitioned table that read only what is new.

The counts of every partition are stored with a fingerprint of its files. A profile sums
the stored counts; partitions without counts, or whose files changed since, are scanned
first. Counts are only ever appended, those of files that are gone are left out when the
table's files are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staged import read_staged
from .dedup import dedup
from .profile import missing

STATE = (
    "part string, fingerprint string, position int, column string, type string, "
    "rows long, null_or_blank long"
)


def partition_files(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """``(part, fingerprint)`` of every partition, from the listing of its files alone.

    A partition folder is named ``<partition>=<value>``; a NULL value is the folder that
    Spark gives it. Nothing is read from the files.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(path)
        .select("path", "modificationTime", "length")
    )
    part = F.regexp_extract("path", rf"/{partition}=([^/]*)/", 1)
    name = F.regexp_extract("path", "([^/]*)$", 1)
    # A sum of hashes does not depend on the order of files, and merges before the shuffle.
    one = F.xxhash64(name, "modificationTime", "length").cast("decimal(38,0)")
    return files.groupBy(part.alias("part")).agg(
        F.concat_ws("-", F.count(F.lit(1)), F.sum(one)).alias("fingerprint")
    )


def profile_by_partition(df: DataFrame, partition: str, part: Column) -> DataFrame:
    """Counts of every partition and column in one scan; the partition column is one too."""
    fields = df.schema.fields
    counted = df.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(missing(f.name, f.dataType)).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    return counted.select(
        "part",
        F.inline(F.array(*[
            F.struct(
                F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"), F.col("n").alias("rows"),
                F.col(f"c{i}").alias("null_or_blank"),
            )
            for i, f in enumerate(fields)
        ])),
    )


@dataclass(frozen=True)
class StoredProfile:
    """Profile of the table at ``path``, with its counts stored at ``states``."""

    spark: SparkSession
    path: str
    states: str
    partition: str

    def stored(self) -> DataFrame:
        """Counts stored so far, none before the first refresh."""
        try:
            return self.spark.read.schema(STATE).parquet(self.states)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], STATE)

    def outdated(self) -> DataFrame:
        """``(part, fingerprint)`` of partitions that have no counts of their present files."""
        files = partition_files(self.spark, self.path, self.partition)
        known = self.stored().select("part", "fingerprint").distinct()
        return files.join(known, ["part", "fingerprint"], "left_anti")

    def to_scan(self, outdated: list[str]) -> DataFrame:
        """The rows of partitions, read by a filter that prunes all others."""
        null = "__HIVE_DEFAULT_PARTITION__"
        column = F.col(f"`{self.partition}`")
        wanted = column.cast("string").isin([p for p in outdated if p != null])
        if null in outdated:
            wanted = wanted | column.isNull()
        return read_staged(self.spark, self.path).filter(wanted)

    def refresh(self) -> list[str]:
        """Scan and store what is outdated; returns those partitions.

        Run again after a failure it stores what is still missing. One refresh at a time.
        """
        # A row per outdated partition.
        found = self.outdated().collect()
        if not found:
            return []
        rows = self.to_scan([r["part"] for r in found])
        part = F.coalesce(
            F.col(f"`{self.partition}`").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")
        )
        prints = self.spark.createDataFrame(
            [(r["part"], r["fingerprint"]) for r in found], "part string, fingerprint string"
        )
        counts = profile_by_partition(rows, self.partition, part).join(prints, "part")
        counts.select("part", "fingerprint", "position", "column", "type", "rows", "null_or_blank") \
            .coalesce(1).write.mode("append").parquet(self.states)
        return sorted(r["part"] for r in found)

    def profile(self, table: str) -> DataFrame:
        """``(table, position, column, type, rows, null_or_blank)`` of the whole table."""
        files = partition_files(self.spark, self.path, self.partition)
        current = self.stored().join(files, ["part", "fingerprint"], "left_semi")
        return (
            dedup(current, ["part", "column"]).groupBy("position", "column", "type")
            .agg(F.sum("rows").alias("rows"), F.sum("null_or_blank").alias("null_or_blank"))
            .select(F.lit(table).alias("table"), "position", "column", "type", "rows", "null_or_blank")
        )
