"""Threshold-scaled sketches of documents, built-in functions only.

A sketch keeps every shingle hash below a fixed fraction of all hash values, so
its size follows the document's and the overlap of two sketches estimates how
much of the smaller document the larger one contains, however unequal they are.
Sketches of parts merge into the sketch of the whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.staged import shared_folder, stage
from .words import shingles, unused, words

SHINGLE_WORDS = 5
FRACTION = 0.25


def _cut(fraction: float) -> int:
    """Signed value below which the given fraction of 64-bit hashes lies."""
    if not 0 < fraction <= 1:
        raise ValueError("the fraction is above 0 and at most 1")
    return min(-(1 << 63) + int(fraction * (1 << 64)), (1 << 63) - 1)


def _scaled(hashes: Column, fraction: float) -> Column:
    """Sorted distinct hashes below the cut; the least hash if there is none."""
    kept = F.filter(hashes, lambda h: h < F.lit(_cut(fraction)).cast("long"))
    least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)
    return F.array_sort(F.array_distinct(F.when(F.size(kept) > 0, kept).otherwise(least)))


def with_sketch(
    rows: DataFrame,
    text: str,
    name: str,
    size: int = SHINGLE_WORDS,
    fraction: float = FRACTION,
) -> DataFrame:
    """Add the sketch of column ``text`` as ``name``, a sorted array of hashes.

    NULL, empty and blank texts have the empty sketch; fewer words than a shingle
    are one shingle. A text with words but no hash below the cut keeps its least
    hash, so no document with words has an empty sketch. Whole texts are read;
    equal texts have equal sketches; other columns stay.
    """
    w, hashes = unused(rows.columns, "__words"), unused(rows.columns, "__hashes")
    split = rows.withColumn(w, words(F.col(f"`{text}`")))
    hashed = split.withColumn(hashes, shingles(F.col(w), size))
    return hashed.withColumn(name, _scaled(F.col(hashes), fraction)).drop(w, hashes)


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Sketch of two parts together."""
    return _scaled(F.array_union(a, b), fraction)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller shingle set that the other one holds, 0 to 1.

    Two empty sketches are alike (1), an empty and a filled one are not (0).
    """
    least = F.least(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(F.greatest(F.size(a), F.size(b)) == 0, F.lit(1.0))
        .when(least == 0, F.lit(0.0))
        .otherwise(shared / least)
    )


def digest(sketch: Column) -> Column:
    """A sketch as 32 hex digits: 128 bits of hash over its values."""
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(i), sketch)), 16, "0") for i in (1, 2)]
    return F.lower(F.concat(*parts))


def neighbours(keys: DataFrame, columns: list[str], partitions: int = 0) -> DataFrame:
    """Distinct rows of ``keys`` with the row before and after them, in a ring.

    Rows are ordered by ``columns`` (NULL first). Results: the rows and the structs
    ``before`` and ``after``; the first row follows the last. Rows are dealt by range
    and looked at within a range; only the ends of the ranges, one row each, meet in
    one task. A single row is its own neighbour; an empty table gives an empty result.
    """
    spark = keys.sparkSession
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.struct(*keys.columns)
    dealt = stage(
        keys.distinct().repartitionByRange(ranges, *columns)
        .withColumn("__range", F.spark_partition_id()),
        shared_folder(spark, "ranges"),
    )
    inside = Window.partitionBy("__range").orderBy(*columns)
    rows = dealt.withColumns(
        {"__before": F.lag(whole).over(inside), "__after": F.lead(whole).over(inside)}
    )
    ends = dealt.groupBy("__range").agg(
        F.min_by(whole, F.struct(*columns)).alias("__first"),
        F.max_by(whole, F.struct(*columns)).alias("__last"),
    )
    # One row per range.
    ring = Window.orderBy("__range")
    all_ranges = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        F.col("__range").alias("__at"),
        F.coalesce(
            F.lag("__last").over(ring), F.last("__last").over(all_ranges)
        ).alias("__previous"),
        F.coalesce(
            F.lead("__first").over(ring), F.first("__first").over(all_ranges)
        ).alias("__next"),
    )
    return rows.join(F.broadcast(ends), F.col("__range") == F.col("__at")).select(
        *keys.columns,
        F.coalesce("__before", "__previous").alias("before"),
        F.coalesce("__after", "__next").alias("after"),
    )


def edited_fingerprints(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    fraction: float = FRACTION,
) -> DataFrame:
    """Sketches of documents, of their edited texts and of the document that follows.

    In the edited text the last quarter of the code points (rounded down) gives way
    to the first as many, or all, of the next document by ascending key; the first
    follows the last. Columns: the key, ``n_chars``, ``text``, ``edited``, and the
    sketches ``own_sketch``, ``edited_sketch`` and ``next_sketch``.

    * NULL text counts as empty.
    * Documents are the distinct pairs of key and text, ordered by key (NULL first)
      and then by a hash of the text: repeated rows share one result each, and equal
      keys with different texts follow each other.
    * Columns of any other name are not looked at; an empty table gives none.
    """
    docs = documents.select(
        F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t")
    ).withColumn("h", F.xxhash64("t"))
    order = neighbours(docs.select("k", "h", F.length("t").alias("n")), ["k", "h"])

    # Joins are on plain columns, NULL keys included, so that rows dealt out once
    # by a document's name can be aggregated and joined where they are.
    def name(key: str, hash_: str, prefix: str) -> list[Column]:
        return [
            F.coalesce(F.col(key).cast("string"), F.lit("")).alias(f"{prefix}_key"),
            F.col(key).isNull().alias(f"{prefix}_null"), F.col(hash_).alias(f"{prefix}_hash"),
        ]

    def same(a: str, b: str) -> Column:
        return reduce(
            lambda x, y: x & y,
            [F.col(f"{a}_{c}") == F.col(f"{b}_{c}") for c in ("key", "null", "hash")],
        )

    # Without the key itself both uses of the documents are alike and share one exchange.
    docs = docs.select("t", *name("k", "h", "own"))
    before = order.select(
        *name("k", "h", "is"), *name("before.k", "before.h", "to"),
        F.floor(F.col("before.n") / 4).cast("int").alias("q"),
    )
    sent = with_sketch(
        docs.join(before, same("own", "is")), "t", "next_sketch", size, fraction
    ).select(
        "to_key", "to_null", "to_hash", F.expr("substring(t, 1, q)").alias("head"), "next_sketch"
    )
    # Rows that repeat send the same twice.
    sent = sent.dropDuplicates(["to_key", "to_null", "to_hash"])
    kind = documents.schema[key].dataType
    pairs = docs.join(sent, same("own", "to")).select(
        F.when(~F.col("own_null"), F.col("own_key").cast(kind)).alias("k"), "t", F.length("t").alias("n"), "next_sketch",
        F.expr("concat(substring(t, 1, length(t) - cast(floor(length(t) / 4) AS INT)), head)")
        .alias("e"),
    )
    both = with_sketch(
        with_sketch(pairs, "t", "own_sketch", size, fraction), "e", "edited_sketch",
        size, fraction,
    )
    return both.select(
        F.col("k").alias(key), F.col("n").cast("long").alias("n_chars"), F.col("t").alias("text"),
        F.col("e").alias("edited"), "own_sketch", "edited_sketch", "next_sketch",
    )
