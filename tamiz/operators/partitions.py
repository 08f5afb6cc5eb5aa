"""Tables kept in hash buckets of their key, so that an upsert rewrites only some.

A bucket is a partition folder, ``bucket_of_<n>=<i>``: the layout tells the number of
buckets, and a reader sees an ordinary partitioned table with one more column.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staged import read_staged, shared_folder, stage
from .dedup import dedup
from .dims import upsert

PREFIX = "bucket_of_"


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    """Bucket of a key; it depends on the key's text alone, so types may differ."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in key]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: Sequence[str], buckets: int) -> DataFrame:
    """Write a table in buckets of its key and return it re-read."""
    column = f"{PREFIX}{buckets}"
    return stage(df.withColumn(column, key_bucket(key, buckets)), path, partition_by=[column])


def bucket_column(df: DataFrame) -> tuple[str, int]:
    """The bucket column of a table and its number of buckets."""
    for c in df.columns:
        found = re.fullmatch(PREFIX + r"(\d+)", c)
        if found:
            return c, int(found[1])
    raise ValueError("not a table in buckets")


def upsert_buckets(
    spark: SparkSession, path: str, updates: DataFrame, key: Sequence[str],
    order: Sequence[Column | str] = (), **limits: int,
) -> DataFrame:
    """Updates win over rows of the same key; only buckets with updates are rewritten.

    Other buckets are neither read nor written. Several updates of one key are reduced
    to the first by ``order``. Columns are taken by name and cast to the table's types.
    The new buckets are staged before they replace the old ones, so nothing is read
    from where it is written; a write that fails half way is mended by running it again,
    as the same updates give the same rows. Writers must follow one another, and frames
    of the table from before an upsert may miss files.
    """
    target = read_staged(spark, path)
    column, buckets = bucket_column(target)
    fields = [f for f in target.schema.fields if f.name != column]
    typed = updates.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    folder = shared_folder(spark, "upsert")
    latest = stage(
        dedup(typed, key, order).withColumn(column, key_bucket(key, buckets)), f"{folder}/latest"
    )
    # At most one number per bucket.
    touched = [r[0] for r in latest.select(column).distinct().collect()]
    if not touched:
        return target
    old = target.filter(F.col(column).isin(touched)).select(*latest.columns)
    merged = stage(upsert(old, latest, key, **limits), f"{folder}/merged")
    (
        merged.hint("rebalance", column).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    )
    spark.catalog.refreshByPath(path)
    return read_staged(spark, path)
