"""Declarative cleaning of one table: normalise, filter, deduplicate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup
from .refint import flag_reference, keep_valid


@dataclass(frozen=True)
class Reference:
    """A parent table the rows must point into."""

    parent: DataFrame
    on: str | Sequence[str | tuple[str, str]]
    exempt: Column | None = None
    name: str = "reference"


@dataclass(frozen=True)
class CleanSpec:
    """What makes a raw table clean.

    ``normalise`` replaces columns in one projection, ``keep`` are conditions
    that must all hold (name them by a mapping for :func:`funnel`), ``key`` is what
    must be unique afterwards. Filters run
    before deduplication so that an invalid copy cannot displace a valid one;
    ``dedup_first`` turns the two around.
    """

    key: Sequence[str]
    normalise: Mapping[str, Column] = field(default_factory=dict)
    keep: Sequence[Column] | Mapping[str, Column] = ()
    references: Sequence[Reference] = ()
    order: Sequence[Column | str] = ()
    dedup_first: bool = False

    def conditions(self) -> dict[str, Column]:
        if isinstance(self.keep, Mapping):
            return dict(self.keep)
        return {f"condition {i}": c for i, c in enumerate(self.keep, 1)}


def clean_table(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Apply a ``CleanSpec``."""
    out = df.withColumns(dict(spec.normalise)) if spec.normalise else df

    def restrict(frame: DataFrame) -> DataFrame:
        for condition in spec.conditions().values():
            frame = frame.filter(condition)
        for ref in spec.references:
            frame = keep_valid(frame, ref.parent, ref.on, ref.exempt)
        return frame

    def unique(frame: DataFrame) -> DataFrame:
        return dedup(frame, spec.key, spec.order)

    return restrict(unique(out)) if spec.dedup_first else unique(restrict(out))


def funnel(df: DataFrame, spec: CleanSpec) -> DataFrame:
    """Where :func:`clean_table` would lose rows: ``(position, step, rows)``.

    A row counts under the first step it fails: conditions in their order, then
    references, then being a copy of a key (before all others with ``dedup_first``);
    the last step, ``kept``, has what is left. The step is one expression, so the table
    is read once whatever the number of steps, and rows are counted per key before they
    are shuffled.
    """
    out = df.withColumns(dict(spec.normalise)) if spec.normalise else df
    tests = list(spec.conditions().items())
    for i, ref in enumerate(spec.references):
        out = flag_reference(out, ref.parent, ref.on, f"__ref{i}", ref.exempt, True, False)
        tests.append((ref.name, F.col(f"__ref{i}")))
    failed = [
        F.when(~F.coalesce(test, F.lit(False)), F.lit(i)) for i, (_, test) in enumerate(tests)
    ]
    step = F.coalesce(*failed, F.lit(None).cast("int"))
    names = [name for name, _ in tests]
    n = F.col("__n")

    def summed(condition: Column, value: Column = n) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("long")

    if spec.dedup_first:
        survivors = dedup(out, spec.key, spec.order).groupBy(step.alias("__s"))
        counted = survivors.agg(F.count(F.lit(1)).alias("__n"))
        copies = out.groupBy(*spec.key).agg((F.count(F.lit(1)) - 1).alias("__n"))
        counted = counted.unionByName(
            copies.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("__n")).withColumn("__s", F.lit(-1))
        )
        rows = [("duplicate", summed(F.col("__s") == -1))]
        rows += [(name, summed(F.col("__s") == i)) for i, name in enumerate(names)]
        rows.append(("kept", summed(F.col("__s").isNull())))
    else:
        passed = out.withColumn("__s", step)
        keys = [F.when(F.col("__s").isNull(), F.col(k)).alias(f"__k{i}") for i, k in enumerate(spec.key)]
        counted = passed.groupBy("__s", *keys).agg(F.count(F.lit(1)).alias("__n"))
        rows = [(name, summed(F.col("__s") == i)) for i, name in enumerate(names)]
        rows.append(("duplicate", summed(F.col("__s").isNull(), n - 1)))
        rows.append(("kept", summed(F.col("__s").isNull(), F.lit(1))))
    one = counted.agg(*[value.alias(f"c{i}") for i, (_, value) in enumerate(rows)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("position"), F.lit(name).alias("step"), F.col(f"c{i}").alias("rows"))
        for i, (name, _) in enumerate(rows)
    ])))


def date_window(start: Column, end: Column) -> Column:
    """Both dates present and in order; a missing one fails the comparison."""
    return start < end


def present(*names: str) -> Column:
    """All named columns are non-null."""
    out = F.lit(True)
    for n in names:
        out = out & F.col(n).isNotNull()
    return out
