"""Referential integrity: keep, list, flag or default references."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, default_if_blank
from ..sources.staged import shared_folder, stage
from .joins import KeyPairs, key_pairs, lookup_join, measure

On = str | Sequence[str | tuple[str, str]]


def reference_keys(reference: DataFrame, pairs: KeyPairs) -> DataFrame:
    """Distinct non-null keys of the reference side, staged: they are measured and joined."""
    keys = [r for _, r in pairs]
    # Plain null tests reach the file scan; dropna() would not be pushed down.
    for k in keys:
        reference = reference.filter(F.col(k).isNotNull())
    found = reference.select(*keys).distinct()
    return stage(found, shared_folder(reference.sparkSession, "reference-keys"))


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def flag_reference(
    df: DataFrame,
    reference: DataFrame,
    on: On,
    into: str,
    exempt: Column | None = None,
    ok: object = "OK",
    bad: object = "FK_INV",
    **limits: int,
) -> DataFrame:
    """Every row, with ``into`` telling whether its reference exists.

    A NULL reference is ``bad``; rows for which ``exempt`` holds are ``ok``.
    """
    pairs = key_pairs(on)
    keys = reference_keys(reference, pairs).withColumn("__found", F.lit(True))
    found = F.col("__found").isNotNull()
    if exempt is not None:
        found = found | _holds(exempt)
    size = measure([(keys, [])])[0]
    joined = lookup_join(df, keys, pairs, "left", size=size, **limits)
    kept = [c for c in df.columns if c != into]
    return joined.select(*kept, F.when(found, F.lit(ok)).otherwise(F.lit(bad)).alias(into))


def keep_valid(
    df: DataFrame, reference: DataFrame, on: On, exempt: Column | None = None, **limits: int
) -> DataFrame:
    """Rows whose reference exists, or for which ``exempt`` holds."""
    if exempt is None:
        pairs = key_pairs(on)
        return lookup_join(df, reference_keys(reference, pairs), pairs, "left_semi", **limits)
    flagged = flag_reference(df, reference, on, "__ref", exempt, True, False, **limits)
    return flagged.filter("__ref").drop("__ref")


def violators(
    df: DataFrame, reference: DataFrame, on: On, exempt: Column | None = None, **limits: int
) -> DataFrame:
    """Rows whose reference is missing (or NULL) and that are not exempt."""
    pairs = key_pairs(on)
    rows = df if exempt is None else df.filter(~_holds(exempt))
    return lookup_join(rows, reference_keys(reference, pairs), pairs, "left_anti", **limits)


def lookup_or_default(
    df: DataFrame,
    reference: DataFrame,
    column: str,
    key: str,
    default: str,
    trim_first: bool = True,
    **limits: int,
) -> DataFrame:
    """Replace blank or unknown codes of ``column`` by ``default``.

    The code is trimmed before it is looked up. ``trim_first=False`` looks up
    the raw text and trims on output only, so padded codes become the default.
    """
    probe = default_if_blank(F.col(column), default) if trim_first else F.col(column)
    flagged = flag_reference(
        df.withColumn("__code", probe),
        reference, [("__code", key)], "__known", None, True, False, **limits,
    )
    code = F.when(F.col("__known"), clean(F.col("__code"))).otherwise(F.lit(default))
    return flagged.withColumn(column, code).drop("__code", "__known")
