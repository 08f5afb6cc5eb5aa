"""Lookup joins that stay even at scale.

A lookup is broadcast only after its size has been measured. Past the limit the
join shuffles, and keys that fill more than one task on the left side are spread
over salts. Such keys are found by a sketch of their hashes, which exchanges no rows,
and staged, so the rows in front of a join are read twice however many joins follow
each other. Both sides take the salts from the same staged table, so the result does
not depend on what the sketch finds. The salt depends on the row
and its partition, never on the order of rows, so a task that is run again after a
lost executor sends every row to the same place.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.staged import shared_folder, stage
from .heavy import HASH, ROWS, heavy_keys, key_hashes, without_nulls

KeyPairs = Sequence[tuple[str, str]]

# Broadcast bound: a lookup within both limits fits in every executor.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that one task may take before the key is split.
ROWS_PER_TASK = 2_000_000


@dataclass(frozen=True)
class LookupSize:
    """Measured size of a lookup and its largest group of equal keys."""

    rows: int
    bytes: int
    max_per_key: int

    def fits(self, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
        return self.rows <= rows and self.bytes <= size


def key_pairs(on: str | Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    """``"k"``, ``["a", "b"]`` or ``[("a", "b")]`` as (left, right) pairs."""
    names = [on] if isinstance(on, str) else list(on)
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in names]


def _row_bytes(df: DataFrame) -> Column:
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts).cast("long")


def measure(
    lookups: Sequence[tuple[DataFrame, Sequence[str]]], largest: str | None = None
) -> list[LookupSize]:
    """Rows, bytes and largest key group of each lookup, all in one job.

    Without keys a lookup is only summed up, which needs no shuffle; its
    ``max_per_key`` is then the maximum of column ``largest``, or 1.
    """

    def one(i: int, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        n, b = F.count(F.lit(1)), F.sum(_row_bytes(df))
        if not keys:
            return df.agg(
                F.lit(i).alias("i"), n.alias("rows"),
                F.coalesce(b, F.lit(0)).alias("bytes"),
                F.coalesce(F.max(largest) if largest else F.lit(1), F.lit(0))
                .cast("long").alias("m"),
            )
        can_match = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
        return (
            df.groupBy(*keys).agg(n.alias("__n"), b.alias("__b")).agg(
                F.lit(i).alias("i"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum("__b"), F.lit(0)).alias("bytes"),
                F.coalesce(F.max(F.when(can_match, F.col("__n"))), F.lit(0)).alias("m"),
            )
        )

    frames = [one(i, df, keys) for i, (df, keys) in enumerate(lookups)]
    if not frames:
        return []
    rows = sorted(reduce(DataFrame.unionByName, frames).collect(), key=lambda r: r["i"])
    return [LookupSize(r["rows"], r["bytes"], r["m"]) for r in rows]


def row_spread(df: DataFrame) -> Column:
    """Hash that spreads rows; the partition id also parts identical copies.

    Maps are left out, they cannot be hashed.
    """
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{n}`") for n in names])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, column ``__n``: a map-side combine on the key columns alone."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))


@dataclass(frozen=True)
class SplitKeys:
    """Staged keys that would overload one task, with column ``__salts``."""

    frame: DataFrame
    size: LookupSize


def split_keys(counts: DataFrame, keys: Sequence[str], rows_per_task: int) -> SplitKeys:
    """Count once which keys need more than one task, and into how many each is split.

    The table has at most rows / ``rows_per_task`` keys. It is staged and measured, as
    both sides of a join need it.
    """
    needed = counts.filter(F.col("__n") > rows_per_task).select(
        *keys, F.ceil(F.col("__n") / rows_per_task).cast("int").alias("__salts")
    )
    frame = stage(needed, shared_folder(counts.sparkSession, "split-keys"))
    return SplitKeys(frame, measure([(frame, [])])[0])


def heavy_split(
    df: DataFrame, key_hash: Column, needed: Sequence[str], rows_per_task: int
) -> SplitKeys:
    """Hashes of keys that need more than one task, with their salts.

    Rows with a NULL in one of the columns ``needed`` are left out. Keys are sketched,
    so no row is exchanged, see :func:`tamiz.operators.heavy.heavy_keys`.
    """
    item = F.when(without_nulls(needed), key_hash) if needed else key_hash
    heavy = heavy_keys(df, item, rows_per_task)
    salts = F.ceil(F.col(ROWS) / heavy.limit).cast("int").alias("__salts")
    return SplitKeys(heavy.frame.select(HASH, salts), LookupSize(heavy.keys, 24 * heavy.keys, 1))


def _mark_hashed(df: DataFrame, split: SplitKeys, key_hash: Column) -> DataFrame:
    """Add the salt counts of split keys by the hash of the key."""
    if not split.size.rows:
        return df.withColumn("__salts", F.lit(None).cast("int"))
    hot = F.broadcast(split.frame) if split.size.fits() else split.frame
    return df.withColumn("__h", key_hash).join(hot, F.col("__h") == F.col(HASH), "left").drop(
        "__h", HASH
    )


def _condition(pairs: KeyPairs, null_safe: bool) -> Column:
    tests = [
        F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r)
        for l, r in pairs
    ]
    return reduce(lambda a, b: a & b, tests)


def _hide_keys(
    left: DataFrame, right: DataFrame, pairs: KeyPairs
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Right side with its keys under names the left side does not have."""
    prefix = "__rk"
    while any(c.startswith(prefix) for c in left.columns):
        prefix += "_"
    keys = [r for _, r in pairs]
    hidden = [f"{prefix}{i}" for i in range(len(keys))]
    rest = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(h) for k, h in zip(keys, hidden)], *rest)
    return renamed, [(l, h) for (l, _), h in zip(pairs, hidden)]


def _mark_split(
    df: DataFrame, split: SplitKeys, keys: Sequence[str], null_safe: bool, names: Sequence[str]
) -> DataFrame:
    """Add the salt counts of split keys.

    The table of split keys is broadcast if it was measured to fit. If not it is
    joined by a shuffle, in which adaptive execution splits large keys.
    """
    if not split.size.rows:
        return df.withColumns({n: F.lit(None).cast("int") for n in names})
    marks = [f"__hk{i}" for i in range(len(keys))]
    own = split.frame.columns[: len(keys)]
    hot = split.frame.select(*[F.col(k).alias(m) for k, m in zip(own, marks)], *names)
    if split.size.fits():
        hot = F.broadcast(hot)
    return df.join(hot, _condition(list(zip(keys, marks)), null_safe), "left").drop(*marks)


def _salts(count: str) -> Column:
    return F.sequence(F.lit(0), F.coalesce(F.col(count), F.lit(1)) - 1)


def _grid_join(
    left: DataFrame, right: DataFrame, pairs: KeyPairs, how: str, null_safe: bool,
    rows_per_task: int,
) -> DataFrame:
    """Left or inner join where some keys are large on the right, and maybe on the left.

    Each such key is a grid of tasks: a left row has one row of the grid and is
    repeated over its columns, a right row the other way round, so every pair of
    rows meets once. All other keys have a grid of one cell. There is one join and no
    union behind it, so what is summed up over the pairs is summed up where they meet.
    """
    left_keys, right_keys = [l for l, _ in pairs], [r for _, r in pairs]
    splits = [
        (split_keys(key_counts(df, keys), keys, rows_per_task), name)
        for df, keys, name in ((left, left_keys, "__left"), (right, right_keys, "__right"))
    ]

    def marked(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        for split, name in splits:
            own = SplitKeys(split.frame.withColumnRenamed("__salts", name), split.size)
            df = _mark_split(df, own, keys, null_safe, [name])
        return df

    row = row_spread(left)
    cell = F.coalesce(F.pmod(row, F.col("__left")), F.lit(0))
    if not null_safe:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in left_keys])
        # They match nothing, so any place will do.
        cell = F.when(any_null, F.pmod(row, F.lit(1 << 30))).otherwise(cell)
    left_cells = marked(left, left_keys).select(
        *left.columns, "__right", cell.cast("int").alias("__i"),
        F.explode(_salts("__right")).alias("__j"),
    )
    cell = F.coalesce(F.pmod(row_spread(right), F.col("__right")), F.lit(0)).cast("int")
    right_cells = marked(right, right_keys).select(
        *right.columns, cell.alias("__y"), F.explode(_salts("__left")).alias("__x")
    )
    on = _condition([*pairs, ("__i", "__x"), ("__j", "__y")], null_safe)
    joined = left_cells.join(right_cells, on, how)
    if how != "inner":
        # A key that is split on the right has a match in some cell, if not in all.
        joined = joined.filter(F.col("__y").isNotNull() | F.col("__right").isNull())
    return joined.drop("__right", "__i", "__j", "__x", "__y", *right_keys)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str | tuple[str, str]],
    how: str = "left",
    null_safe: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    largest_group: int = 1,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle join in which large left keys are spread over several tasks.

    Finds large left keys in a job of its own, which reads the left rows and moves none.
    Right rows of a split key are repeated once per salt, at most
    ``left rows / rows_per_task`` extra copies over all keys of a unique lookup.
    ``largest_group`` is the most right rows one key has; if that is too many
    for one task as well, those keys are joined over a grid. ``spread`` names the
    columns that part the rows of a split key, all by default.
    """
    right, pairs = _hide_keys(left, right, key_pairs(on))
    left_keys, right_keys = [l for l, _ in pairs], [r for _, r in pairs]
    if how in ("left_semi", "left_anti"):
        right = right.select(*right_keys).distinct()
    elif largest_group > rows_per_task:
        return _grid_join(left, right, pairs, how, null_safe, rows_per_task)

    hashes = key_hashes(left, right, pairs)
    if hashes is None:
        # Keys that are equal without being the same are counted as the join compares them.
        split = split_keys(key_counts(left, left_keys), left_keys, rows_per_task)
        marked = _mark_split(left, split, left_keys, null_safe, ["__salts"])
        copied = _mark_split(right, split, right_keys, null_safe, ["__salts"])
    else:
        split = heavy_split(left, hashes[0], [] if null_safe else left_keys, rows_per_task)
        marked, copied = _mark_hashed(left, split, hashes[0]), _mark_hashed(right, split, hashes[1])
    row = row_spread(left if spread is None else left.select(*spread))
    salt = F.coalesce(F.pmod(row, F.col("__salts")), F.lit(0))
    if not null_safe:
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in left_keys])
        # They match nothing, so any place will do.
        salt = F.when(any_null, row).otherwise(salt)
    salted = marked.select(*left.columns, salt.cast("long").alias("__salt"))
    numbers = F.transform(_salts("__salts"), lambda n: n.cast("long"))
    each = F.explode(numbers) if split.size.rows else F.lit(0).cast("long")
    copies = copied.select(*right.columns, each.alias("__copy"))
    joined = salted.join(copies, _condition([*pairs, ("__salt", "__copy")], null_safe), how)
    return joined.drop("__salt", "__copy", *right_keys)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str | tuple[str, str]],
    how: str = "left",
    size: LookupSize | None = None,
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join with a lookup: broadcast if it was measured to fit, salted if not.

    The right key columns do not appear in the result. ``how`` is ``left``,
    ``inner``, ``left_semi`` or ``left_anti``. Pass ``size`` where the lookup has
    been measured already.
    """
    pairs = key_pairs(on)
    if size is None:
        keys = [] if how in ("left_semi", "left_anti") else [r for _, r in pairs]
        size = measure([(right, keys)])[0]
    if not size.fits(broadcast_rows, broadcast_bytes):
        return salted_join(left, right, pairs, how, null_safe, rows_per_task, size.max_per_key)
    small, hidden = _hide_keys(left, right, pairs)
    return left.join(
        F.broadcast(small), _condition(hidden, null_safe), how
    ).drop(*[h for _, h in hidden])


def bucketed_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str | tuple[str, str]],
    how: str = "left",
    rows_per_task: int = ROWS_PER_TASK,
    **limits: int,
) -> DataFrame:
    """Join of tables that are staged in buckets of the join keys: no row is exchanged.

    A bucket is joined by one task. Keys with more than ``rows_per_task`` left rows are
    taken out and joined as :func:`lookup_join` does, with the few right rows they have;
    the others stay where they are. On frames without such buckets the result is the
    same, with the exchanges of any merge join.
    """
    pairs = key_pairs(on)
    hidden, shown = _hide_keys(left, right, pairs)
    keys = [l for l, _ in pairs]
    hashes = key_hashes(left, hidden, shown)
    heavy = None if hashes is None else heavy_split(left, hashes[0], keys, rows_per_task)
    drop = [h for _, h in shown]
    if heavy is None or not heavy.size.rows:
        joined = left.join(hidden.hint("merge"), _condition(shown, False), how)
        return joined.drop(*drop)
    hot = F.broadcast(heavy.frame.select(HASH)) if heavy.size.fits() else heavy.frame.select(HASH)

    def part(df: DataFrame, key_hash: Column, kind: str) -> DataFrame:
        hashed = df.withColumn("__h", F.coalesce(key_hash, F.lit(0)))
        return hashed.join(hot, F.col("__h") == F.col(HASH), kind).drop("__h")

    cold = part(left, hashes[0], "left_anti").join(
        hidden.hint("merge"), _condition(shown, False), how
    ).drop(*drop)
    # The same rows by hash on both sides, so every right row that matches is there.
    few = part(hidden, hashes[1], "left_semi")
    apart = lookup_join(
        part(left, hashes[0], "left_semi"), few, shown, how, rows_per_task=rows_per_task, **limits
    )
    return cold.unionByName(apart)
