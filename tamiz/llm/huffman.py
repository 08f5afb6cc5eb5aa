"""Token ids in files of Huffman-coded blocks.

A store is a folder with two Parquet tables: ``codes`` (id, length: the canonical
code, from the counts of all ids) and ``blocks`` (one row per block, in key order
within and across files). A block's ``data`` is decoded with the code table alone:

    magic 'HTB1' | documents, checkpoints, payload bytes (3 x uint32)
    | keys (int64 each) | key is present (uint8 each) | ids per document (uint32 each)
    | bit offset of every checkpoint (uint32 each) | payload

A document starts at a byte, and its stream has a checkpoint every ``SPAN`` ids.
Decoding walks all checkpoints of a block side by side, one table look-up an id.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from ..sources.staged import shared_folder
from .tokens import encoder, rounds

MAGIC = b"HTB1"
LONGEST = 20
SPAN = 256
# Text that a worker encodes at once: the more, the more often a chunk is looked up once
# for all its places.
ROUND = 8_000_000
# Bytes of ids that a worker codes at once.
SHARE = 300_000
# Payload bytes after which a block is closed; a longer document is a block by itself.
BLOCK = 1 << 20


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Bits per symbol of a best code with at most ``longest`` bits (package-merge).

    Symbols that do not occur have length 0; a single symbol has length 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << longest:
        raise ValueError(f"{n} symbols need codes longer than {longest} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    merged, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(longest - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        merged = both[by]
        is_leaf.append(by < n)
    take = 2 * n - 2
    sorted_lengths = np.zeros(n, np.int64)
    for level in reversed(is_leaf):
        own = int(level[:take].sum())
        sorted_lengths[:own] += 1
        take = 2 * (take - own)
    lengths[order] = sorted_lengths
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length and then by symbol, as canonical Huffman codes go."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    # One step per distinct length; codes of one length are consecutive.
    for bits in np.unique(lengths[order]).tolist():
        own = order[lengths[order] == bits]
        code <<= bits - last
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code, last = code + len(own), bits
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(symbol, bits) for every prefix of the longest code's width, and that width."""
    width = int(lengths.max()) if len(lengths) else 0
    symbols, bits = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    fill = 1 << (width - lengths[used].astype(np.int64))
    if len(used):
        start = int(codes[used[0]]) << (width - int(lengths[used[0]]))
        stop = start + int(fill.sum())
        symbols[start:stop] = np.repeat(used, fill)
        bits[start:stop] = np.repeat(lengths[used], fill)
    return symbols, bits, width


def write_bits(codes: np.ndarray, sizes: np.ndarray, at: np.ndarray, total: int) -> np.ndarray:
    """Bytes with each code (at most 32 bits) at its bit offset; offsets ascend."""
    words = np.zeros(total // 32 + 2, np.uint64)
    if len(codes):
        first = at >> 5
        # Left-aligned in a window of 64 bits that starts at the word of its first bit.
        window = codes << (64 - sizes - (at & 31)).astype(np.uint64)
        runs = np.flatnonzero(np.diff(first, prepend=-1))
        words[first[runs]] |= np.bitwise_or.reduceat(window >> np.uint64(32), runs)
        spill = np.bitwise_or.reduceat(window & np.uint64(0xFFFFFFFF), runs)
        words[first[runs] + 1] |= spill
    return words.astype(">u4").view(np.uint8)[: (total + 7) // 8]


def encode_documents(
    ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(payload, bytes per document, checkpoint bits, checkpoints per document).

    Checkpoints are relative to their document's first byte.
    """
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    doc_end = np.cumsum(sizes)
    doc_begin = doc_end - sizes
    before = ends - bits  # bits before each id, without padding
    base = np.concatenate([before, ends[-1:] if len(ends) else [0]])[doc_begin]
    doc_bits = np.concatenate([[0], ends])[doc_end] - base
    doc_bytes = (doc_bits + 7) // 8
    doc_at = (np.cumsum(doc_bytes) - doc_bytes) * 8
    inside = before - np.repeat(base, sizes)
    at = inside + np.repeat(doc_at, sizes)
    payload = write_bits(codes[ids], bits, at, int(doc_bytes.sum()) * 8)
    marks = -(-sizes // SPAN)
    doc = np.repeat(np.arange(len(sizes)), marks)
    place = doc_begin[doc] + SPAN * (
        np.arange(len(doc)) - np.repeat(np.cumsum(marks) - marks, marks)
    )
    return payload, doc_bytes, inside[place] if len(place) else place, marks


def decode_block(
    data: bytes, table: tuple[np.ndarray, np.ndarray, int]
) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(keys, ids per document, ids of all documents) of one block."""
    if data[:4] != MAGIC:
        raise ValueError("not a block of token ids")
    n, marks, size = struct.unpack_from("<3I", data, 4)
    at = 16
    keys = np.frombuffer(data, "<i8", n, at)
    present = np.frombuffer(data, np.uint8, n, at + 8 * n)
    sizes = np.frombuffer(data, "<u4", n, at + 9 * n).astype(np.int64)
    bit = np.frombuffer(data, "<u4", marks, at + 13 * n).astype(np.int64)
    payload = np.frombuffer(data, np.uint8, size, at + 13 * n + 4 * marks)
    if at + 13 * n + 4 * marks + size != len(data):
        raise ValueError("a block of token ids is cut short")
    symbols, bits, width = table
    # The 32 bits from every byte on, so one look-up needs one gather.
    padded = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
    ahead = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    per_doc = -(-sizes // SPAN)
    rank = np.arange(marks) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    run = np.minimum(np.repeat(sizes, per_doc) - rank * SPAN, SPAN)
    start = np.cumsum(run) - run
    out = np.empty(int(run.sum()), np.uint32)
    order = np.argsort(-run, kind="stable")
    bit, run, start = bit[order], run[order], start[order]
    active = np.searchsorted(-run, -np.arange(1, (run[0] if marks else 0) + 1), side="right")
    down = 32 - width
    for t, k in enumerate(active):
        here = bit[:k]
        window = (ahead[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(down)
        out[start[:k] + t] = symbols[window]
        bit[:k] = here + bits[window]
    return [int(k) if p else None for k, p in zip(keys, present)], sizes, out


def _tokenised(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    wide = "<u2" if max(enc.size, end_id + 1) <= 1 << 16 else "<u4"
    row = TaskContext.get().partitionId() << 36
    for batch in batches:
        for part in rounds(batch, "text", ROUND):
            flat, sizes = enc.encode(part.column("text"))
            ids = np.insert(flat, np.cumsum(sizes), end_id).astype(wide)
            ends = np.concatenate([[0], np.cumsum(sizes + 1)]) * ids.itemsize
            data = ids.tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "key": part.column("key"),
                    "row": pa.array(row + np.arange(part.num_rows)),
                    "width": pa.array(np.full(part.num_rows, ids.itemsize, np.int32)),
                    "ids": pa.array(
                        [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())],
                        pa.binary(),
                    ),
                }
            )
            row += part.num_rows


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    width = int(batch.column("width")[0].as_py())
    parts = [x.as_py() for x in batch.column("ids")]
    ids = np.frombuffer(b"".join(parts), f"<u{width}").astype(np.int64)
    return ids, np.fromiter(map(len, parts), np.int64, len(parts)) // width


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            own = np.bincount(_ids(batch)[0], minlength=len(total))
            own[: len(total)] += total
            total = own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(used), "n": pa.array(total[used])})


def _order(key: int | None, row: int) -> tuple[bool, int, int]:
    return key is not None, key or 0, row


def _coded(
    batches: Iterator[pa.RecordBatch], lengths: np.ndarray, bounds: list[tuple]
) -> Iterator[pa.RecordBatch]:
    codes = canonical_codes(lengths)
    for whole in batches:
        # A share of the ids at a time, so that the arrays made of them stay in the CPU's cache.
        for batch in rounds(whole, "ids", SHARE):
            ids, sizes = _ids(batch)
            payload, doc_bytes, marks, per_doc = encode_documents(ids, sizes, lengths, codes)
            data = payload.tobytes()
            ends = np.cumsum(doc_bytes)
            mark_ends = np.concatenate([[0], np.cumsum(per_doc)])
            marks = marks.astype("<u4")
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch.column("key"),
                    "row": batch.column("row"),
                    "range": pa.array(
                        [
                            bisect_right(bounds, _order(k, r))
                            for k, r in zip(
                                batch.column("key").to_pylist(), batch.column("row").to_pylist()
                            )
                        ],
                        pa.int32(),
                    ),
                    "n": pa.array(sizes),
                    "marks": pa.array(
                        [marks[a:b].tobytes() for a, b in zip(mark_ends[:-1], mark_ends[1:])],
                        pa.binary(),
                    ),
                    "data": pa.array(
                        [data[a:b] for a, b in zip(ends - doc_bytes, ends)], pa.binary()
                    ),
                }
            )


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents as blocks; a block is of one range, whose counts start anew."""
    part, number, before = -1, 0, 0
    held: list[tuple] = []
    size = 0

    def block() -> pa.RecordBatch:
        keys, sizes, marks, data = zip(*held)
        payload = b"".join(data)
        starts = np.cumsum([0, *map(len, data)])[:-1] * 8
        mark = [np.frombuffer(m, "<u4") + s for m, s in zip(marks, starts.tolist())]
        mark = np.concatenate(mark).astype("<u4")
        head = MAGIC + struct.pack("<3I", len(keys), len(mark), len(payload))
        body = b"".join(
            [
                head, np.array([k or 0 for k in keys], "<i8").tobytes(),
                bytes(k is not None for k in keys), np.array(sizes, "<u4").tobytes(),
                mark.tobytes(), payload,
            ]
        )
        return pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()), "block": pa.array([number], pa.int64()),
                "first_key": pa.array([keys[0]], pa.int64()),
                "n_docs": pa.array([len(keys)], pa.int64()),
                "ids_before": pa.array([before], pa.int64()),
                "n_ids": pa.array([sum(sizes)], pa.int64()),
                "data": pa.array([body], pa.binary()),
            }
        )

    for batch in batches:
        ranges = batch.column("range").to_pylist()
        rows = zip(*(batch.column(c).to_pylist() for c in ("key", "n", "marks", "data")))
        for own, row in zip(ranges, rows):
            if held and (size >= BLOCK or own != part):
                yield (out := block())
                before, number = before + out.column("n_ids")[0].as_py(), number + 1
                held, size = [], 0
            if own != part:
                part, number, before = own, 0, 0
            held.append(row)
            size += len(row[3])
    if held:
        yield block()


def _bounds(ids: DataFrame, ranges: int) -> list[tuple]:
    """Where ranges of about equal numbers of rows begin, from a sample of their order.

    The driver takes about a hundred rows per range, whatever the size of the table.
    """
    share = min(1.0, 100.0 * ranges / max(ids.count(), 1))
    sample = ids.select("key", "row").sample(share, seed=0).collect()
    order = sorted(_order(r["key"], r["row"]) for r in sample)
    return sorted({order[len(order) * i // ranges] for i in range(1, ranges)}) if order else []


def write_store(
    documents: DataFrame, tokenizer: str, folder: str, end_id: int,
    key: str = "doc_id", text: str = "text", longest: int = LONGEST,
) -> str:
    """Encode whole texts and write their ids, in ascending key order, to ``folder``.

    Each document is its ids and the end id. NULL texts are empty; rows with a NULL
    key come first; rows with equal keys follow each other in any order, so repeated
    rows are kept. An empty table gives a store without blocks. Keys are integers.

    Ids are staged once, as they are counted before they can be coded. What is
    shuffled into order is coded already.
    """
    spark = documents.sparkSession
    ship_package(spark)
    picked = documents.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text")
    )
    schema = "key long, row long, width int, ids binary"
    made = picked.mapInArrow(partial(_tokenised, path=tokenizer, end_id=end_id), schema)
    path = shared_folder(spark, "token-ids")
    made.write.option("compression", "zstd").parquet(path)
    ids = spark.read.schema(made.schema).parquet(path)
    # At most one row per id of the vocabulary.
    counted = ids.select("width", "ids").mapInArrow(_counted, "id long, n long")
    counts = counted.groupBy("id").agg(F.sum("n").alias("n")).collect()
    table = np.zeros(max((r["id"] for r in counts), default=-1) + 1, np.int64)
    for r in counts:
        table[r["id"]] = r["n"]
    lengths = code_lengths(table, longest)
    used = np.flatnonzero(lengths).tolist()
    code = spark.createDataFrame(
        [(i, int(lengths[i])) for i in used], "id long, length int"
    )
    code.coalesce(1).write.parquet(f"{folder}/codes")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    coded = ids.mapInArrow(
        partial(_coded, lengths=lengths, bounds=_bounds(ids, ranges)),
        "key long, row long, range int, n long, marks binary, data binary",
    )
    in_order = coded.repartitionById(ranges, F.col("range"))
    in_order = in_order.sortWithinPartitions("range", "key", "row")
    layout = (
        "part int, block long, first_key long, n_docs long, ids_before long, n_ids long, data binary"
    )
    in_order.mapInArrow(_blocked, layout).write.option("compression", "none").parquet(
        f"{folder}/blocks"
    )
    return folder


def _decoded(batches: Iterator[pa.RecordBatch], lengths: np.ndarray, with_ids: bool):
    table = decode_table(lengths)
    for batch in batches:
        for data, start in zip(batch.column("data"), batch.column("start").to_pylist()):
            keys, sizes, ids = decode_block(data.as_py(), table)
            ids = ids.astype("<u4")
            ends = np.cumsum(sizes)
            begin = ends - sizes
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), ends.tolist())]
            columns = {
                "key": pa.array(keys, pa.int64()), "start": pa.array(begin + start),
                "n_tokens": pa.array(sizes), "ids_crc32": pa.array(crc, pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.view(np.int32))
                )
            yield pa.RecordBatch.from_pydict(columns)


def read_store(
    spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """Documents of a store: key, ``start`` (ids before it), ``n_tokens``, ``ids_crc32``.

    Blocks are decoded independently. The ids before a range of blocks are summed
    over one row per range; within a range every block knows its own.
    """
    ship_package(spark)
    layout = (
        "part int, block long, first_key long, n_docs long, ids_before long, n_ids long, data binary"
    )
    blocks = spark.read.schema(layout).parquet(f"{folder}/blocks")
    # At most one row per id of the vocabulary, and one per range.
    code = spark.read.schema("id long, length int").parquet(f"{folder}/codes").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=-1) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    parts = sorted(
        (r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    )
    starts, total = [], 0
    for p, n in parts:
        starts.append((p, total))
        total += n
    bases = spark.createDataFrame(starts, "at int, base long")
    placed = blocks.join(F.broadcast(bases), F.col("part") == F.col("at")).select(
        "data", (F.col("base") + F.col("ids_before")).alias("start")
    )
    schema = T.StructType(
        [T.StructField(n, T.LongType()) for n in ("key", "start", "n_tokens", "ids_crc32")]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )
    found = placed.mapInArrow(partial(_decoded, lengths=lengths, with_ids=with_ids), schema)
    return found.withColumnRenamed("key", key)
