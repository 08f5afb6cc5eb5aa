"""Members with versions: what changed, from when to when.

A history has a row per key and version with the half-open interval ``date_from``,
``date_to``; the open one ends at ``forever``. Intervals of a key follow each other
without overlap. A load is compared by a hash of the tracked columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup
from .joins import lookup_join

FOREVER = "2999-12-31 00:00:00"
_STAMP = "timestamp_ntz"


def row_hash(columns: Sequence[str]) -> Column:
    """128-bit hash of columns; a NULL differs from every text, borders count."""
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.concat(F.coalesce(F.length(text).cast("string"), F.lit("n")), F.lit(":"),
                        F.coalesce(text, F.lit("")))

    return F.md5(F.concat_ws("|", *[part(c) for c in columns]))


def open_history(
    load: DataFrame, key: Sequence[str], since: str, forever: str = FOREVER
) -> DataFrame:
    """First version of every member; the first row of a repeated key counts."""
    tracked = [c for c in load.columns if c not in key]
    return dedup(load, key).select(
        *key, *tracked, F.lit(1).alias("version"),
        F.lit(since).cast(_STAMP).alias("date_from"), F.lit(forever).cast(_STAMP).alias("date_to"),
        row_hash(tracked).alias("row_hash"),
    )


def apply_load(
    history: DataFrame, load: DataFrame, key: Sequence[str], at: str,
    close_missing: bool = False, forever: str = FOREVER, **limits: int,
) -> DataFrame:
    """The history after a load that became valid at ``at``.

    A member whose tracked columns differ has its open version closed at ``at`` and a
    next one opened; a new member gets version 1 from ``at``; one that came back after
    it was closed gets its next version. With ``close_missing`` open members that the
    load does not have are closed. Applying a load again changes nothing. A change that
    is not later than the version it would close makes the result fail.
    Stage the result, to a new path, for the next load.
    """
    names, moment, end = list(key), F.lit(at).cast(_STAMP), F.lit(forever).cast(_STAMP)
    tracked = [c for c in load.columns if c not in names]
    rows = dedup(load, names).withColumn("row_hash", row_hash(tracked))
    is_open = F.col("date_to") == end
    # A key has few versions, and the last of each is found before the shuffle.
    last = dedup(history.select(*names, "version", "date_from", "date_to", "row_hash"), names,
                 [F.desc("version")])
    last = last.select(
        *names, F.col("version").alias("__v"), F.col("row_hash").alias("__h"),
        F.col("date_from").alias("__from"), F.col("date_to").alias("__to"),
    )
    met = lookup_join(rows, last, names, null_safe=True, **limits)
    same = F.coalesce((F.col("__to") == end) & (F.col("row_hash") == F.col("__h")), F.lit(False))
    since = F.when(F.col("__to") == end, F.col("__from")).otherwise(F.col("__to"))
    early = F.raise_error(F.concat_ws(" ", F.lit("the load is not later than"), since)).cast(_STAMP)
    # A closed member may come back at the moment it was closed, not before.
    # Rows that stay are let through here as well: filters may be evaluated in any order.
    fits = (
        F.col("__v").isNull() | same | (moment > since)
        | ((F.col("__to") != end) & (moment == since))
    )
    opened = met.filter(~same).select(
        *names, *tracked, (F.coalesce("__v", F.lit(0)) + 1).alias("version"),
        F.when(fits, moment).otherwise(early).alias("date_from"), end.alias("date_to"), "row_hash",
    )
    # Open versions are closed if their key has another hash now.
    now = rows.select(*names, F.col("row_hash").alias("__now"), F.lit(True).alias("__met"))
    compared = lookup_join(history, now, names, null_safe=True, **limits)
    gone = F.col("__met").isNull() if close_missing else F.lit(False)
    changed = is_open & (F.coalesce(F.col("__now") != F.col("row_hash"), F.lit(False)) | gone)
    kept = compared.select(
        *[
            F.when(changed, moment).otherwise(F.col(c)).alias(c) if c == "date_to" else F.col(c)
            for c in history.columns
        ]
    )
    return kept.unionByName(opened)


def valid_at(history: DataFrame, at: Column) -> DataFrame:
    """The versions that are valid at a moment."""
    return history.filter((F.col("date_from") <= at) & (at < F.col("date_to")))
