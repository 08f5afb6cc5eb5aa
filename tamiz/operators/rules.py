"""Declarative validation rules: a status per row, or rows per status.

Statuses never remove rows; cleaning does. ``apply_rules`` adds one column per
rule, ``summarize_rules`` counts statuses with one pass over the table for all
row rules together plus one aggregation per uniqueness rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import (
    BROADCAST_BYTES, BROADCAST_ROWS, ROWS_PER_TASK, key_counts, lookup_join, measure, row_spread,
    split_keys,
)
from ..sources.staged import shared_folder, stage
from .refint import On, flag_reference

NULL_KEY = "NULL_KEY"


@dataclass(frozen=True)
class RowRule:
    """A condition on the columns of one row; NULL counts as a failure."""

    name: str
    condition: Column
    ok: str = "OK"
    bad: str = "INV"

    def status(self) -> Column:
        return F.when(self.condition, F.lit(self.ok)).otherwise(F.lit(self.bad))


@dataclass(frozen=True)
class UniqueRule:
    """The key occurs once.

    ``nulls`` says what a key with a NULL part is: ``"flag"`` its own status
    ``NULL_KEY``; ``"dup"`` a duplicate; ``"group"`` an ordinary value.
    """

    name: str
    key: Sequence[str]
    nulls: str = "flag"
    ok: str = "OK"
    bad: str = "DUP"

    def status_of(self, copies: Column) -> Column:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in self.key])
        status = F.when(copies > 1, F.lit(self.bad)).otherwise(F.lit(self.ok))
        if self.nulls == "group":
            return status
        on_null = NULL_KEY if self.nulls == "flag" else self.bad
        return F.when(any_null, F.lit(on_null)).otherwise(status)


@dataclass(frozen=True)
class ForeignKeyRule:
    """The reference exists, or the row is exempt."""

    name: str
    reference: DataFrame
    on: On
    exempt: Column | None = None
    ok: str = "OK"
    bad: str = "FK_INV"


Rule = RowRule | UniqueRule | ForeignKeyRule


def in_domain(name: str, c: Column, values: Sequence[object], **status: str) -> RowRule:
    """Value is in a short constant list."""
    return RowRule(name, c.isin(list(values)), **status)


def nonzero(name: str, c: Column, **status: str) -> RowRule:
    """Identifier is present and not zero."""
    return RowRule(name, c.isNotNull() & (c != 0), **status)


def date_range(name: str, start: Column, end: Column, **status: str) -> RowRule:
    """Start before end; a date that is missing fails."""
    return RowRule(name, start < end, **status)


def min_date(name: str, d: Column, earliest: str, **status: str) -> RowRule:
    """Date present and not before ``earliest``."""
    return RowRule(name, d >= F.lit(earliest).cast("date"), **status)


def _with_foreign_keys(df: DataFrame, rules: Sequence[Rule], **limits: int) -> DataFrame:
    for r in rules:
        if isinstance(r, ForeignKeyRule):
            df = flag_reference(
                df, r.reference, r.on, r.name, r.exempt, r.ok, r.bad, **limits
            )
    return df


def _count_copies(
    df: DataFrame,
    rule: UniqueRule,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``__copies``: rows with the same key, or any number above 1 if more.

    Keys are counted first, with a map-side combine on the key columns alone, and
    those that repeat are staged. Where few repeat they are broadcast and no row moves. Otherwise rows are
    counted in windows; keys too large for one task are known to repeat, so
    their rows need no count and are spread over salts instead, like rows whose
    NULL key decides the status.
    """
    keys, null_safe = list(rule.key), rule.nulls == "group"
    repeated = stage(
        key_counts(df, keys).filter(F.col("__n") > 1),
        shared_folder(df.sparkSession, "repeated-keys"),
    )
    size = measure([(repeated, [])], largest="__n")[0]
    if size.fits(broadcast_rows, broadcast_bytes):
        found = lookup_join(df, repeated, keys, "left", size=size, null_safe=null_safe)
        return found.withColumnRenamed("__n", "__copies")

    salt, hot = F.lit(0), F.lit(False)
    rows, spread = df, row_spread(df)
    if size.max_per_key > rows_per_task:
        split = split_keys(repeated, keys, rows_per_task)
        rows = lookup_join(df, split.frame, keys, "left", size=split.size, null_safe=null_safe)
        hot = F.col("__salts").isNotNull()
        salt = F.when(hot, F.pmod(spread, F.col("__salts"))).otherwise(salt)
    if not null_safe:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        salt = F.when(any_null, spread).otherwise(salt)
    rows = rows.select(*df.columns, hot.alias("__hot"), salt.alias("__salt"))
    in_window = F.count(F.lit(1)).over(Window.partitionBy(*keys, "__salt"))
    copies = F.when(F.col("__hot"), F.lit(2)).otherwise(in_window)
    return rows.withColumn("__copies", copies).drop("__hot", "__salt")


def apply_rules(df: DataFrame, rules: Sequence[Rule], **limits: int) -> DataFrame:
    """Add one status column per rule, keeping every row."""
    out = df
    for r in rules:
        if isinstance(r, UniqueRule):
            out = _count_copies(out, r, **limits)
            out = out.withColumn(r.name, r.status_of(F.col("__copies"))).drop("__copies")
    out = _with_foreign_keys(out, rules, **limits)
    row_rules = {r.name: r.status() for r in rules if isinstance(r, RowRule)}
    out = out.withColumns(row_rules) if row_rules else out
    return out.select(*df.columns, *[r.name for r in rules])


def summarize_rules(df: DataFrame, rules: Sequence[Rule], **limits: int) -> DataFrame:
    """``(rule, status, rows)`` for every status that occurs."""
    flagged = _with_foreign_keys(df, rules, **limits)
    counters = []
    for r in rules:
        if isinstance(r, RowRule):
            holds = F.coalesce(r.condition, F.lit(False))
        elif isinstance(r, ForeignKeyRule):
            holds = F.col(r.name) == r.ok
        else:
            continue
        counters += [(r.name, r.ok, F.count_if(holds)), (r.name, r.bad, F.count_if(~holds))]
    parts = []
    if counters:
        one_row = flagged.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(counters)])
        parts.append(
            one_row.select(
                F.inline(
                    F.array(
                        *[
                            F.struct(
                                F.lit(n).alias("rule"),
                                F.lit(s).alias("status"),
                                F.col(f"c{i}").alias("rows"),
                            )
                            for i, (n, s, _) in enumerate(counters)
                        ]
                    )
                )
            )
        )
    for r in rules:
        if isinstance(r, UniqueRule):
            parts.append(
                key_counts(df, r.key)
                .groupBy(r.status_of(F.col("__n")).alias("status"))
                .agg(F.sum("__n").alias("rows"))
                .select(F.lit(r.name).alias("rule"), "status", "rows")
            )
    return reduce(DataFrame.unionByName, parts).filter(F.col("rows") > 0)
