"""Star and snowflake enrichment with a guard against row multiplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staged import shared_folder, stage
from .joins import (
    BROADCAST_BYTES, BROADCAST_ROWS, bucketed_join, key_counts, key_pairs, lookup_join, measure,
)


class FanOutError(ValueError):
    """A lookup that was declared unique is not."""


@dataclass(frozen=True)
class Lookup:
    """One step of an enrichment chain.

    ``on`` pairs a column of the rows built so far with a column of ``frame``.
    ``columns`` maps lookup columns to output names (a sequence keeps names).
    ``expect="one"`` refuses a lookup whose key repeats; ``"many"`` lets the rows
    multiply; ``"trusted"`` skips the check, for large lookups whose key is unique
    by construction. ``fold_case`` compares keys trimmed and in upper case.
    ``placed`` says that rows and lookup are staged in the same buckets of the keys, so
    they are joined where they are.
    """

    frame: DataFrame
    on: str | Sequence[str | tuple[str, str]]
    columns: Mapping[str, str] | Sequence[str]
    expect: str = "one"
    how: str = "left"
    fold_case: bool = False
    name: str = "lookup"
    placed: bool = False

    def prepared(self) -> tuple[DataFrame, list[tuple[str, str]]]:
        """Lookup columns under their output names, keys under private ones."""
        names = (
            dict(self.columns)
            if isinstance(self.columns, Mapping)
            else {c: c for c in self.columns}
        )
        pairs = key_pairs(self.on)
        keys = [F.col(r) for _, r in pairs]
        if self.fold_case:
            keys = [F.upper(F.trim(k)) for k in keys]
        frame = self.frame.select(
            *[k.alias(f"__k{i}") for i, k in enumerate(keys)],
            *[F.col(c).alias(o) for c, o in names.items()],
        )
        return frame, [(l, f"__k{i}") for i, (l, _) in enumerate(pairs)]


def enrich(rows: DataFrame, *lookups: Lookup, **limits: int) -> DataFrame:
    """Join the lookups one after the other.

    One job up front measures all lookups: it enforces ``expect="one"`` and
    decides between broadcast and salted shuffle per lookup. A later lookup may
    join on a column that an earlier one added. Rows between two shuffled lookups are
    staged, so that the count in front of the second does not join anew.
    """
    limit = (
        limits.get("broadcast_rows", BROADCAST_ROWS), limits.get("broadcast_bytes", BROADCAST_BYTES)
    )
    steps = [lk.prepared() for lk in lookups]
    sizes = measure(
        [
            (frame, [] if lk.expect == "trusted" else [k for _, k in pairs])
            for lk, (frame, pairs) in zip(lookups, steps)
        ]
    )
    for lk, size in zip(lookups, sizes):
        if lk.expect == "one" and size.max_per_key > 1:
            raise FanOutError(
                f"{lk.name}: up to {size.max_per_key} rows per key {lk.on!r}; "
                "join on the full key or pass expect='many'"
            )
    shuffled = False
    for lk, (frame, pairs), size in zip(lookups, steps, sizes):
        if lk.placed and not lk.fold_case:
            rows = bucketed_join(rows, frame, pairs, lk.how, **limits)
            continue
        if not size.fits(*limit):
            if shuffled:
                rows = stage(rows, shared_folder(rows.sparkSession, "enriched"))
            shuffled = True
        if lk.fold_case:
            for i, (l, _) in enumerate(pairs):
                rows = rows.withColumn(f"__l{i}", F.upper(F.trim(F.col(l))))
            pairs = [(f"__l{i}", r) for i, (_, r) in enumerate(pairs)]
        rows = lookup_join(rows, frame, pairs, lk.how, size=size, **limits)
        if lk.fold_case:
            rows = rows.drop(*[l for l, _ in pairs])
    return rows


def duplicate_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return key_counts(lookup, keys).withColumnRenamed("__n", "rows").filter(F.col("rows") > 1)


def join_audit(
    rows: DataFrame, lookup: DataFrame, on: str | Sequence[str | tuple[str, str]], name: str
) -> DataFrame:
    """What a left join would do, without doing it.

    One row ``(lookup, rows, matched, unmatched, joined_rows)``. Both sides are
    counted per key first, so neither hot keys nor fan-out materialise.
    """
    pairs = key_pairs(on)
    left = rows.groupBy(*[F.col(l).alias(f"__l{i}") for i, (l, _) in enumerate(pairs)]).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    right = lookup.groupBy(*[F.col(r).alias(f"__k{i}") for i, (_, r) in enumerate(pairs)]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    joined = left.join(
        right, [left[f"__l{i}"] == right[f"__k{i}"] for i in range(len(pairs))], "left"
    )
    n, copies = F.col("__rows"), F.col("__copies")
    matched = F.coalesce(F.sum(F.when(copies.isNotNull(), n)), F.lit(0))
    total = F.coalesce(F.sum(n), F.lit(0))
    return joined.agg(
        F.lit(name).alias("lookup"),
        total.alias("rows"),
        matched.alias("matched"),
        (total - matched).alias("unmatched"),
        F.coalesce(F.sum(n * F.coalesce(copies, F.lit(1))), F.lit(0)).alias("joined_rows"),
    )
