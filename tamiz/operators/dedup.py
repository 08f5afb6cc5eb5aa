"""Deterministic deduplication.

``row_number() == 1`` plans a partial group limit in front of the shuffle, so a
key that holds a large share of all rows leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tie_break(df: DataFrame, used: Sequence[str] = ()) -> list[Column]:
    """Order by every column that is left, so that the survivor is unique."""
    out = []
    for f in df.schema.fields:
        if f.name in used:
            continue
        c = F.col(f"`{f.name}`")
        out.append(
            F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c
        )
    return out


def dedup(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    Rows whose key is NULL form a group like any other. The result does not
    depend on partitioning or on the order of the input.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [F.col(o) if isinstance(o, str) else o for o in order]
    order_by = [*first, *tie_break(df, keys)]
    if not order_by:
        return df.distinct()
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        df.withColumn("__rn", F.row_number().over(window))
        .filter(F.col("__rn") == 1)
        .drop("__rn")
    )


def distinct_on(
    df: DataFrame, key: str | Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """``DISTINCT ON (key)`` with the order that the statement should have had."""
    if not order:
        raise ValueError("distinct_on needs an order; use dedup to accept any row")
    return dedup(df, key, order)
