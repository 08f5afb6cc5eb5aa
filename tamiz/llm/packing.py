"""Best-fit packing of documents into sequences, from local bins up a tree.

Every partition packs its own items by best fit, longest first. Bins that are
nearly full are done; the others are handed up as items of the size they hold.
A round packs the bins of several partitions together, until one task holds all
that are left or a round saves none. What a round fills is emitted with the bins that were
done before. Nothing is shuffled: a round reads the open
bins of neighbouring partitions, a bounded number per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from ..sources.staged import shared_folder, stage
from .tokens import encoder, gather, rounds
from .words import unused

# Items (pieces, later bins) that one task packs at a time.
ITEMS_PER_TASK = 200_000
# A bin this full is done.
NEARLY_FULL = 0.99


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin per item, offset per item, filled per bin), longest items first.

    Bins are found by the room they have left: one bit per possible room, so an
    item costs the same however many bins there are. Items of no size get bin -1.
    """
    place = np.full(len(sizes), -1, np.int64)
    offset = np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        if size <= 0:
            continue
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            bins = by_room[room]
            b = bins.pop()
            if not bins:
                rooms &= ~(1 << room)
        else:
            b, room = len(filled), capacity
            filled.append(0)
        place[i], offset[i] = b, filled[b]
        filled[b] += size
        left = room - size
        if left:
            by_room.setdefault(left, []).append(b)
            rooms |= 1 << left
    return place, offset, filled


def token_pieces(
    documents: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as token ids with an end id, cut where longer than ``capacity``.

    One row per piece: the key, ``piece``, ``start``, ``length``, ``ids_crc32`` (of
    the ids as little-endian 32-bit integers) and, if asked for, ``ids``. A NULL or
    empty text is the end id alone; rows with a NULL or repeated key are documents
    like any other; an empty table has no pieces.
    """
    ship_package(documents.sparkSession)
    picked = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    schema = T.StructType(
        [T.StructField(key, documents.schema[key].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )
    cut = partial(
        _cut, path=tokenizer, capacity=capacity, end_id=end_id, key=key, with_ids=with_ids
    )
    return picked.mapInArrow(cut, schema).withColumn("piece", F.col("piece").cast("int"))


def _cut(
    batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, key: str,
    with_ids: bool,
) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for batch in batches:
        for part in rounds(batch, "text"):
            flat, sizes = enc.encode(part.column("text"))
            ends = np.cumsum(sizes)
            # The end id goes behind each document's own ids.
            ids = np.insert(flat, ends, end_id).astype("<u4")
            sizes = sizes + 1
            begin = np.cumsum(sizes) - sizes
            counts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            at = begin[doc] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), length.tolist())]
            columns = {
                key: part.column("key").take(pa.array(doc)),
                "piece": pa.array(piece, pa.int64()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.append(at, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))
                )
            yield pa.RecordBatch.from_pydict(columns)


def _task_ids(level: int) -> int:
    """First bin number of this task in a round, so that no two tasks share one."""
    return (level << 56) + (TaskContext.get().partitionId() << 28)


def _pack_items(
    batches: Iterator[pa.RecordBatch], capacity: int, size: str, bin_: str, offset: str,
    open_: str, nearly_full: float,
) -> Iterator[pa.RecordBatch]:
    """First round: each row gets its bin, its offset and whether the bin is open."""
    number = _task_ids(0)
    held: list[pa.RecordBatch] = []
    rows = 0

    def pack() -> Iterator[pa.RecordBatch]:
        nonlocal number
        table = pa.Table.from_batches(held).combine_chunks()
        sizes = table.column(size).to_numpy(zero_copy_only=False).astype(np.int64)
        place, at, filled = best_fit(sizes, capacity)
        still = np.array([f < nearly_full * capacity for f in filled] + [False])[place]
        for name, values in (
            (bin_, pa.array(number + place)), (offset, pa.array(at)), (open_, pa.array(still)),
        ):
            table = table.append_column(name, values)
        number += len(filled)
        yield from table.to_batches()

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ITEMS_PER_TASK:
            yield from pack()
            held, rows = [], 0
    if rows:
        yield from pack()


def _merge_bins(
    batches: Iterator[pa.RecordBatch], capacity: int, level: int, items: int
) -> Iterator[pa.RecordBatch]:
    """A later round: open bins are items, their first-round bins move along."""
    number = _task_ids(level)
    held: list[pa.RecordBatch] = []
    rows = 0

    def merged() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        used = table.column("used").to_numpy(zero_copy_only=False)
        place, at, filled = best_fit(used, capacity)
        members = pc.list_value_length(table.column("roots")).to_numpy(zero_copy_only=False)
        order = np.argsort(place, kind="stable")

        def moved(name: str, by: np.ndarray) -> np.ndarray:
            flat = pc.list_flatten(table.column(name)).to_numpy(zero_copy_only=False)
            return gather(flat + np.repeat(by, members), members, order)

        per_bin = np.bincount(place, weights=members, minlength=len(filled)).astype(np.int32)
        ends = pa.array(np.concatenate([[0], np.cumsum(per_bin)]).astype(np.int32))
        return pa.RecordBatch.from_pydict(
            {
                "bin": pa.array(number + np.arange(len(filled), dtype=np.int64)),
                "used": pa.array(np.array(filled, np.int64)),
                "roots": pa.ListArray.from_arrays(ends, moved("roots", np.zeros_like(at))),
                "shifts": pa.ListArray.from_arrays(ends, moved("shifts", at)),
            }
        )

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= items:
            yield (out := merged())
            number, held, rows = number + out.num_rows, [], 0
    if rows:
        yield merged()


def pack(
    items: DataFrame,
    capacity: int,
    size: str = "length",
    nearly_full: float = NEARLY_FULL,
    items_per_task: int = ITEMS_PER_TASK,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items of ``size`` 1 to ``capacity``.

    Items of one sequence lie one behind the other without a gap, and no sequence
    holds more than ``capacity``.

    * NULL or non-positive sizes take no room: both columns are NULL.
    * An item larger than the capacity is an error (cut it first).
    * Ties and repeated rows: every row is an item of its own; equal items may
      swap places.
    * Empty table: empty result. Other columns stay; columns named like the two
      new ones are replaced.
    """
    spark = items.sparkSession
    ship_package(spark)
    folder = shared_folder(spark, "packing")
    mine = {"sequence_id", "offset"}
    items = items.select(*[c for c in items.columns if c.lower() not in mine])
    bin_, offset, open_ = (unused(items.columns, f"__{n}") for n in ("bin", "offset", "open"))
    valid = items.filter(F.coalesce(F.col(size), F.lit(0)) > 0)
    fits = F.when(F.col(size) <= capacity, F.col(size)).otherwise(
        F.raise_error(F.lit(f"an item is larger than the capacity of {capacity}"))
    )
    schema = T.StructType(
        [*items.schema.fields]
        + [T.StructField(bin_, T.LongType()), T.StructField(offset, T.LongType())]
        + [T.StructField(open_, T.BooleanType())]
    )
    local = partial(
        _pack_items, capacity=capacity, size=size, bin_=bin_, offset=offset, open_=open_,
        nearly_full=nearly_full,
    )
    first = stage(
        valid.withColumn(size, fits.cast(items.schema[size].dataType)).mapInArrow(local, schema),
        f"{folder}/round-0",
    )
    opened = (
        first.filter(F.col(open_))
        .groupBy(F.col(bin_).alias("bin"))
        .agg(F.sum(size).cast("long").alias("used"))
        .select(
            "bin", "used", F.array("bin").alias("roots"),
            F.array(F.lit(0).cast("long")).alias("shifts"),
        )
    )
    opened = stage(opened, f"{folder}/open-0")
    n_bins, level = opened.count(), 0
    # Bins that a round fills are emitted and take no part in the next.
    emitted, full = [], F.col("used") >= nearly_full * capacity
    while n_bins > 1:
        level += 1
        tasks = max(1, -(-n_bins // items_per_task))
        merge = partial(_merge_bins, capacity=capacity, level=level, items=items_per_task)
        merged = stage(
            opened.coalesce(tasks).mapInArrow(merge, opened.schema), f"{folder}/open-{level}"
        )
        emitted.append(merged.filter(full))
        opened = merged.filter(~full)
        left = opened.count()
        if tasks == 1 or left == n_bins:
            break
        n_bins = left
    moved = reduce(DataFrame.unionByName, emitted, opened).select(
        F.col("bin").alias("__to"), F.explode(F.arrays_zip("roots", "shifts")).alias("__m")
    ).select("__to", F.col("__m.roots").alias("__root"), F.col("__m.shifts").alias("__by"))
    placed = first.join(moved, F.col(bin_) == F.col("__root"), "left").select(
        *[F.col(f"`{c}`") for c in items.columns],
        F.coalesce("__to", bin_).alias("sequence_id"),
        (F.col(offset) + F.coalesce("__by", F.lit(0))).alias("offset"),
    )
    unplaced = items.filter(F.coalesce(F.col(size), F.lit(0)) <= 0).withColumns(
        {"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")}
    )
    return placed.unionByName(unplaced)


def pack_documents(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Whole documents in sequences: pieces with their place, see the two steps.

    The token pieces are staged once; packing reads their lengths from the files.
    """
    pieces = token_pieces(documents, tokenizer, capacity, end_id, key, text, with_ids)
    folder = shared_folder(documents.sparkSession, "pieces")
    return pack(stage(pieces, folder), capacity)
