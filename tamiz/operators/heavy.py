"""Keys with very many rows, found in one pass without moving a row.

Every task fills a frequent-items sketch of a bounded number of counters; sketches
are merged in two steps, so what is exchanged is a few sketches, whatever the rows and
however many distinct keys they have. A sketch of ``m`` counters over ``n`` rows
overestimates a key by at most ``3.5 n / m`` and reports every key with more than twice
that. The sketch is made large enough for the limit asked for; see ``heavy_keys``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staged import shared_folder, stage

# Items that a sketch tracks at first, and at most (a limit of the SQL functions).
TRACKED, MOST_TRACKED = 16_384, 1_000_000
# Sketches that the tasks' sketches are merged into before the last step.
MERGES = 64

# More heavy keys than this are staged rather than kept in the plan.
LOCAL_KEYS = 10_000

HASH, ROWS = "__hash", "__rows"


def counters(tracked: int) -> int:
    """Counters of a sketch that tracks so many items: filled to three quarters."""
    return 1 << max(3, (-(-4 * tracked // 3) - 1).bit_length())


def reach(rows: int, tracked: int) -> int:
    """Every key with more rows than this is reported."""
    return -(-7 * rows // counters(tracked))


def tracked_for(rows: int, limit: int) -> int:
    """Items to track so that every key with more than ``limit`` rows is reported."""
    tracked = TRACKED
    while reach(rows, tracked) > limit and tracked < MOST_TRACKED:
        tracked = min(2 * tracked, MOST_TRACKED)
    return tracked


def sketch(df: DataFrame, item: Column, tracked: int = TRACKED) -> DataFrame:
    """One row ``(rows, state)`` that counts the non-NULL values of ``item``.

    Rows are only read; what is exchanged are ``MERGES`` sketches at most per task of
    the first step and one for each of them after it.
    """
    items = df.select(item.alias("i")).filter(F.col("i").isNotNull())
    merged = items.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("m")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.expr(f"approx_top_k_accumulate(i, {tracked})").alias("state"),
    )
    return merge_sketches(merged, tracked)


def merge_sketches(sketches: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """Rows of :func:`sketch`, from any loads or partitions, as one; none of none."""
    # A group of its own: without any sketch there is nothing to combine.
    return sketches.groupBy(F.lit(0).alias("all")).agg(
        F.sum("rows").alias("rows"),
        F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"),
    ).drop("all")


def estimates(sketched: DataFrame, tracked: int = TRACKED) -> DataFrame:
    """``(rows, item, count)`` of the items that a sketch reports, counts never too small.

    One more row has the rows alone.
    """
    found = F.expr(f"approx_top_k_estimate(state, {tracked})")
    none = F.array(F.struct(F.lit(None).cast("long").alias("item"), F.lit(None).cast("long").alias("count")))
    return sketched.select("rows", F.inline(F.concat(found, none)))


@dataclass(frozen=True)
class HeavyKeys:
    """``(__hash, __rows)`` of heavy keys, how many there are, and the limit kept."""

    frame: DataFrame
    keys: int
    limit: int


def heavy_keys(df: DataFrame, item: Column, limit: int) -> HeavyKeys:
    """Every value of ``item``, a long, with more than ``limit`` rows.

    The limit is raised to the reach of the largest sketch where that is more (a table
    of more than 290,000 times ``limit`` rows). Values with fewer rows may be reported
    with somewhat too many, never the other way round. One pass, and a second with a
    larger sketch where the number of rows asks for it. There are at most rows / limit
    such values and never more than a sketch tracks, so they pass through the driver;
    many are staged.
    """
    spark, tracked = df.sparkSession, TRACKED
    while True:
        top = estimates(sketch(df, item, tracked), tracked)
        # One row without an item tells the rows where no item is heavy.
        found = top.filter((F.col("count") > limit) | F.col("item").isNull()).toArrow()
        rows = found.column("rows")[0].as_py() if found.num_rows else 0
        needed = tracked_for(rows, limit)
        if needed <= tracked:
            break
        tracked = needed
    limit = max(limit, reach(rows, tracked))
    heavy = found.filter(pc.greater(found.column("count"), limit)).select(["item", "count"])
    frame = spark.createDataFrame(heavy.rename_columns([HASH, ROWS]))
    if heavy.num_rows > LOCAL_KEYS:
        frame = stage(frame, shared_folder(spark, "heavy-keys"))
    return HeavyKeys(frame, heavy.num_rows, limit)


def key_hashes(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]
) -> tuple[Column, Column] | None:
    """Hashes of the keys that agree wherever a join finds the keys equal.

    Both sides are cast to the type in which the join compares them. None where a
    comparison is not that of the bytes (collations), so a hash would part equal keys.
    """
    sides: tuple[list[Column], list[Column]] = ([], [])
    for l, r in pairs:
        kinds = left.schema[l].dataType, right.schema[r].dataType
        both = left.sparkSession.range(0).select(
            F.coalesce(*[F.lit(None).cast(k) for k in kinds]).alias("c")
        ).schema["c"].dataType
        if not _hashable(both):
            return None
        for side, name in zip(sides, (l, r)):
            side.append(F.col(name).cast(both))
    return F.xxhash64(*sides[0]), F.xxhash64(*sides[1])


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StringType):
        return kind == T.StringType()
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType,
                             T.BooleanType, T.BinaryType))


def without_nulls(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
