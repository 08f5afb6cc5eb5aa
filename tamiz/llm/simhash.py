"""Near duplicates by SimHash, found with a multi-index over fingerprint halves.

Two fingerprints of 64 bits that differ in at most 3 bits agree in one half up to
one bit. Each distinct fingerprint is put into a table under both halves, and is
looked up there under every half within that distance (the half itself and its 32
neighbours). What a lookup finds is verified on all 64 bits. Exact copies share a
fingerprint and take part once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.joins import salted_join
from ..shipping import ship_package
from ..sources.staged import shared_folder, stage
from .components import components
from .words import unused

SHINGLE_WORDS = 3
MAX_BITS = 3
BITS = 64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# Shingle hashes summed up at once, which bounds the memory that a long text takes.
_AT_ONCE = 65_536


def simhash(text: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a UTF-8 text; without words it is zero."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1 :][:n] - 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    begin, stop = starts[:n].tolist(), last.tolist()
    for k in range(0, n, _AT_ONCE):
        part = zip(begin[k : k + _AT_ONCE], stop[k : k + _AT_ONCE])
        hashes = np.array([digest(joined[i:j], 42) for i, j in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > n).tolist())


def _fingerprints(
    batches: Iterator[pa.RecordBatch], size: int, name: str
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        prints = np.array([simhash(t.as_py(), size) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_pydict(
            {**{c: batch.column(c) for c in batch.schema.names if c != "text"}, name: prints}
        )


def fingerprints(
    documents: DataFrame, carried: dict[str, Column], text: str = "text",
    size: int = SHINGLE_WORDS,
) -> DataFrame:
    """The ``carried`` columns and ``fingerprint`` (64 bits as a long) of each row."""
    ship_package(documents.sparkSession)
    picked = documents.select(
        *[c.alias(n) for n, c in carried.items()], F.col(f"`{text}`").alias("text")
    )
    fields = [f for f in picked.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("fingerprint", T.LongType())])
    return picked.mapInArrow(partial(_fingerprints, size=size, name="fingerprint"), schema)


def near_fingerprints(
    prints: DataFrame, column: str = "fingerprint", max_bits: int = MAX_BITS
) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``max_bits`` bits apart.

    With two segments one of them differs in at most ``max_bits // 2`` bits, so balls
    of that radius around a segment miss no pair. ``max_bits`` up to 3 keeps the
    balls at 33 keys.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("the balls are enumerated for up to 3 bits")
    half = BITS // 2
    prints = prints.select(F.col(column).alias("p")).filter("p IS NOT NULL").distinct()
    masks = [0] + [1 << i for i in range(half)] if max_bits >= 2 else [0]
    ball = F.array(*[F.lit(m).cast("long") for m in masks])
    low, high = F.col("p").bitwiseAND((1 << half) - 1), F.shiftrightunsigned("p", half)
    segments = prints.select(
        "p", F.posexplode(F.array(low, high)).alias("segment", "part")
    ).select("p", "segment", "part")
    table = segments.select(
        F.col("p").alias("b"), F.col("segment").alias("s"), F.col("part").alias("key")
    )
    probes = segments.select(
        F.col("p").alias("a"), "segment", F.explode(ball).alias("mask"), "part"
    ).select("a", "segment", F.col("part").bitwiseXOR(F.col("mask")).alias("probe"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    # Both sides grow with the fingerprints, and the size of the exploded one would be
    # underestimated: neither is ever broadcast.
    return (
        probes.join(
            table.hint("merge"),
            (F.col("segment") == F.col("s")) & (F.col("probe") == F.col("key"))
            & (F.col("a") < F.col("b")) & close,
        )
        .select("a", "b")
        .distinct()
    )


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Each document with its fingerprint and the smallest key of its component.

    Columns: the key, ``text_hash`` (64-bit hash of the text), ``fingerprint`` (long),
    ``group`` (smallest fingerprint of the component) and ``component_id`` (smallest
    key reachable, itself included).

    * Words are runs of anything but ASCII white space, ASCII letters fold case;
      shingles count as often as they occur; fewer words than a shingle are one
      shingle; a NULL, empty or blank text has fingerprint 0 and is linked like any.
    * NULL keys get the component's smallest key, NULL if all of its keys are NULL.
    * Repeated rows and equal keys stay rows of their own; an empty table gives none.
    * Texts are read whole; columns of any other name are not looked at.
    """
    folder = shared_folder(documents.sparkSession, "simhash")
    carried = {
        "key": F.col(f"`{key}`"),
        "text_hash": F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))),
    }
    rows = stage(fingerprints(documents, carried, text, size), f"{folder}/fingerprints")
    classes = stage(
        rows.groupBy("fingerprint").agg(F.min("key").alias("least")), f"{folder}/classes"
    )
    links = stage(near_fingerprints(classes, max_bits=max_bits), f"{folder}/links")
    rooted = classes.join(
        components(links), F.col("fingerprint") == F.col("node"), "left"
    ).select("fingerprint", F.coalesce("root", "fingerprint").alias("group"), "least")
    least = rooted.groupBy("group").agg(F.min("least").alias("component_id"))
    named = stage(
        rooted.select("fingerprint", "group").join(least, "group"), f"{folder}/components"
    )
    # A fingerprint that a third of all rows share is a hot key and is split.
    return salted_join(rows, named, "fingerprint", "inner").select(
        F.col("key").alias(key), "text_hash", "fingerprint", "group", "component_id"
    )


def one_of_each(
    documents: DataFrame, key: str = "doc_id", text: str = "text",
    size: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
) -> DataFrame:
    """The row with the smallest key of every component, with all its columns.

    Of rows that share that key the one with the smallest text hash stays, and of
    equal rows one. A component whose keys are all NULL keeps a row too.
    """
    found = near_duplicates(documents, key, text, size, max_bits)
    order = [F.asc_nulls_last(key), F.asc("text_hash")]
    first = Window.partitionBy("group").orderBy(*order)
    chosen = (
        found.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
        .select(F.col(key).alias("__key"), F.col("text_hash").alias("__hash"))
    )
    chosen = stage(chosen, shared_folder(documents.sparkSession, "simhash-kept"))
    names = [unused(documents.columns, f"__{n}") for n in ("key", "null", "hash", "number")]
    name, null, hash_, number = names
    rows = documents.withColumns(
        {**_named(key, name, null), hash_: F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))}
    )
    chosen = chosen.select(
        *[c.alias(n) for n, c in _named("__key", "__k", "__z").items()], F.col("__hash").alias("__h")
    )
    # As many rows as components: never broadcast, and dealt out once for join and window.
    kept = rows.join(
        chosen.hint("merge"),
        (F.col(name) == F.col("__k")) & (F.col(null) == F.col("__z"))
        & (F.col(hash_) == F.col("__h")),
        "left_semi",
    )
    same = Window.partitionBy(name, null, hash_).orderBy(
        *[F.col(f"`{c}`") for c in documents.columns if c not in (key, text)], F.lit(0)
    )
    return kept.withColumn(number, F.row_number().over(same)).filter(
        F.col(number) == 1
    ).drop(*names)


def _named(key: str, name: str, null: str) -> dict[str, Column]:
    """A key as two columns that are never NULL."""
    k = F.col(f"`{key}`")
    return {name: F.coalesce(k.cast("string"), F.lit("")), null: k.isNull()}
