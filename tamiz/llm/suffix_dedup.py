"""Repeated byte strings of a corpus, found in a range-partitioned suffix array.

A string of ``length`` bytes that also starts earlier is removed. Not every suffix has
to be sorted for that. Among the ``length - K + 1`` runs of K bytes in a string the one
with the least hash is its anchor, so equal strings have their anchors at the same
place, and only the suffixes that start at an anchor matter. Steps:

1. Texts are packed into blocks, staged in buckets so that later joins move no text.
2. Blocks list the hashes of their anchors; those in two blocks come back as bits.
   A suffix whose first K bytes do not repeat cannot match and is left out.
3. The others go to buckets with the text around them. Sampled splitters cut the
   range of suffixes by their leading K bytes. Matching suffixes share these, so no
   match lies across a boundary of buckets.
4. A bucket sorts its suffixes by multikey quicksort, and the texts to the left of the
   anchors the same way. A string is a class of suffixes that share enough to the
   right and to the left, as told by common prefixes of neighbours; all but the
   earliest of a class are repeats.
5. What is found goes back to the blocks, whose texts are cut.

Runs of K bytes that a sample shows to be very frequent become anchors only where a
string holds nothing else, so a common line does not bring all texts around it into
one bucket; equal surroundings count once per block.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..shipping import ship_package
from ..sources.staged import shared_folder, stage

LENGTH = 100
K = 32
# Bytes of text in a block, window starts looked at together, bytes per bucket of blocks.
BLOCK_BYTES, SLICE, PART_BYTES = 4 << 20, 1 << 18, 16 << 20
# Suffixes that a bucket should hold.
BUCKET_ROWS = 40_000
# Blocks in the sample, and leading words that each gives.
SAMPLE_BLOCKS, SAMPLE_WORDS = 32, 4096
# A run of K bytes is frequent from this share of all anchors.
FREQUENT = 400

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_PLACE = np.uint64(20)
_PLACES = np.uint64((1 << 20) - 1)
_TOP = np.uint64(1 << 63)
_FILTER = 1 << 20
_LEAD = f"S{K}"

BLOCKS = "block long, n int, bytes long, data binary, lens binary, known binary, ids binary"
HASHES = "slice int, block long, hashes binary"
BITS = "slice int, block long, bits binary, repeated long"
PACKETS = "bucket int, block long, n int, data binary"
SPANS = "block long, spans binary"


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
    )


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _ddl(text: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in text.split(", ")])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _pack(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of texts in the order of ids (NULL first) and text hashes."""
    held: list[tuple] = []
    size, number, task = 0, 0, TaskContext.get().partitionId() << 32
    press = zstandard.ZstdCompressor(level=3)

    def block() -> pa.RecordBatch:
        nonlocal held, size, number
        held.sort(key=lambda h: h[:3])
        data = press.compress(b"".join(h[3] for h in held))
        row = (
            task | number, len(held), size, data,
            np.array([len(h[3]) for h in held], "<i8").tobytes(),
            np.array([h[0] for h in held], "u1").tobytes(),
            np.array([h[1] for h in held], "<i8").tobytes(),
        )
        held, size, number = [], 0, number + 1
        return _batch(schema, [row])

    for batch in batches:
        texts = batch.column("text")
        for i, key in enumerate(batch.column("key").to_pylist()):
            text = texts[i].as_py() or b""
            held.append((key is not None, key or 0, xxhash.xxh64_intdigest(text), text))
            size += len(text)
            if size >= BLOCK_BYTES or len(held) >= BLOCK_BYTES // 16:
                yield block()
    if held:
        yield block()


class Block:
    """Texts of a block side by side."""

    def __init__(self, row: dict) -> None:
        self.number = row["block"]
        raw = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=row["bytes"] or 1)
        self.bytes = np.frombuffer(raw, np.uint8)
        self.lens = np.frombuffer(row["lens"], "<i8")
        self.stops = np.cumsum(self.lens)
        self.starts = self.stops - self.lens
        self.known = np.frombuffer(row["known"], "u1")
        self.ids = np.frombuffer(row["ids"], "<i8")


def run_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from every place on."""
    n = len(data) - K + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    h = np.ndarray((len(data) - 7,), "<u8", data.data, 0, (1,)) * _A
    h ^= h >> np.uint64(29)
    h = h[:-8] * _B + h[8:]
    h ^= h >> np.uint64(31)
    h = h[:-16] * _C + h[16:]
    h ^= h >> np.uint64(28)
    h *= _A
    h ^= h >> np.uint64(32)
    return h[:n]


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the ``width`` values from every place on."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


class Frequent:
    """Set of hashes with a fast test."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.table = np.zeros(_FILTER, bool)
        self.table[(self.hashes % np.uint64(_FILTER)).astype(np.int64)] = True

    def places(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.table[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
        at = np.searchsorted(self.hashes, h[maybe])
        return maybe[self.hashes[np.minimum(at, len(self.hashes) - 1)] == h[maybe]]


def anchors(block: Block, length: int, frequent: Frequent) -> Iterator[tuple[np.ndarray, ...]]:
    """(hash, place, least offset, largest offset) of anchors, by slices of the block.

    The strings that an anchor stands for start at the place minus an offset from the
    least to the largest. Every string has one anchor, of equal hashes the first.
    """
    data, n = block.bytes, len(block.bytes)
    outside = np.zeros(n + 1, np.int32)
    np.add.at(outside, np.maximum(block.starts, block.stops - length + 1), 1)
    np.add.at(outside, block.stops, -1)
    carried = 0
    for s in range(0, n - length + 1, SLICE):
        e = min(s + SLICE, n - length + 1)
        out = np.cumsum(outside[s:e]) + carried
        carried = int(out[-1])
        h = run_hashes(data[s : e + length - 1])
        ranked = (h >> np.uint64(1)) & ~_PLACES | np.arange(len(h), dtype=np.uint64)
        ranked[frequent.places(h)] |= _TOP
        at = (least_of(ranked, length - K + 1) & _PLACES).astype(np.int64)
        inside = np.flatnonzero(out == 0)
        if not len(inside):
            continue
        at = at[inside]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], len(at)] - 1
        place = at[first]
        yield h[place], place + s, place - inside[last], place - inside[first]


def all_anchors(block: Block, length: int, frequent: Frequent) -> list[np.ndarray]:
    found = list(anchors(block, length, frequent))
    if not found:
        return [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3]
    return [np.concatenate(c) for c in zip(*found)]


def leading(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The K bytes from places on, in the order of the bytes."""
    if not len(places):
        return np.zeros(0, _LEAD)
    runs = np.lib.stride_tricks.sliding_window_view(data, K)[places]
    return np.ascontiguousarray(runs).view(_LEAD).ravel()


def _sampled(
    batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Of a block: leading words of some anchors, runs that are frequent, anchors in all."""
    for row in _rows(batches):
        block = Block(row)
        h, places, *_ = all_anchors(block, length, Frequent(np.zeros(0, np.uint64)))
        picked = places[np.argsort(h, kind="stable")[:SAMPLE_WORDS]]
        need = max(16, len(h) // (2 * FREQUENT))
        runs = run_hashes(block.bytes)
        low = (runs & np.uint64((1 << 22) - 1)).astype(np.int64)
        many = runs[np.bincount(low, minlength=1 << 22)[low] >= need]
        runs, counts = np.unique(many, return_counts=True)
        yield _batch(schema, [(
            leading(block.bytes, picked).tobytes(),
            runs[counts >= need].astype("<u8").tobytes(),
            counts[counts >= need].astype("<i8").tobytes(), len(h),
        )])


def _slices(h: np.ndarray, slices: int) -> np.ndarray:
    return ((h >> np.uint64(24)) % np.uint64(slices)).astype(np.int64)


def _by_slice(h: np.ndarray, slices: int) -> Iterator[tuple[int, np.ndarray]]:
    """Sorted distinct hashes of every slice that has some."""
    h = np.unique(h)
    of = _slices(h, slices)
    order = np.argsort(of, kind="stable")
    h, of = h[order], of[order]
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else []
    for a, b in zip(first, [*first[1:], len(of)]):
        yield int(of[a]), h[a:b]


def _listed(
    batches: Iterator[pa.RecordBatch], length: int, frequent: Frequent, slices: int,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        block = Block(row)
        h, *_ = all_anchors(block, length, frequent)
        yield _batch(schema, [(s, block.number, x.tobytes()) for s, x in _by_slice(h, slices)])


def _repeated(group: pa.Table) -> pa.Table:
    """Which hashes of a slice are in more than one block, as bits for each."""
    parts = [np.frombuffer(x.as_py(), "<u8") for x in group.column("hashes")]
    every, counts = np.unique(np.concatenate(parts), return_counts=True)
    again = every[counts > 1]
    out = []
    for block, x in zip(group.column("block").to_pylist(), parts):
        bits = np.isin(x, again, assume_unique=True)
        out.append((group.column("slice")[0].as_py(), block, np.packbits(bits).tobytes(), int(bits.sum())))
    return pa.Table.from_batches([_batch(_ddl(BITS), out)])


def surroundings(block: Block, places: np.ndarray, length: int) -> np.ndarray:
    """``length - K`` bytes before and ``length`` from each place on, zero outside its text."""
    before = length - K
    width = before + length
    padded = np.concatenate([np.zeros(before, np.uint8), block.bytes, np.zeros(length, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, width)[places].copy()
    text = np.searchsorted(block.stops, places, side="right")
    offset = np.arange(width) - before
    at = places[:, None] + offset
    around[(at < block.starts[text][:, None]) | (at >= block.stops[text][:, None])] = 0
    return around


def _mixed(around: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash per row, to find rows that may be equal."""
    wide = -(-around.shape[1] // 8) * 8
    rows = np.zeros((len(around), wide), np.uint8)
    rows[:, : around.shape[1]] = around
    h = (low * 256 + high).astype(np.uint64)
    for word in rows.view("<u8").T:
        h = (h ^ word) * _B
        h ^= h >> np.uint64(29)
    return h


def _suffixes(
    block: Block, length: int, frequent: Frequent, slices: int, bits: dict[int, bytes],
    splitters: np.ndarray, buckets: int,
) -> list[tuple]:
    """Packets of suffixes for the buckets, and what the block can tell by itself."""
    h, places, low, high = all_anchors(block, length, frequent)
    wanted = [
        x[np.unpackbits(np.frombuffer(bits[s], np.uint8), count=len(x)).astype(bool)]
        for s, x in _by_slice(h, slices) if s in bits
    ]
    distinct, counts = np.unique(h, return_counts=True)
    wanted.append(distinct[counts > 1])
    use = np.isin(h, np.concatenate(wanted))
    places, low, high = places[use], low[use], high[use]
    kept, copies = [], []
    for k in range(0, len(places), SLICE):
        kept.append(_mixed(surroundings(block, places[k : k + SLICE], length), low[k : k + SLICE], high[k : k + SLICE]))
    mixed = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
    # Places ascend in the order of ids: the first of equal hashes is the earliest.
    _, first, which = np.unique(mixed, return_index=True, return_inverse=True)
    single = np.zeros(len(places), bool)
    single[first] = True
    for k in range(0, len(places), SLICE):
        rest = np.flatnonzero(~single[k : k + SLICE]) + k
        if len(rest):
            head = first[which[rest]]
            same = (
                (surroundings(block, places[rest], length) == surroundings(block, places[head], length)).all(axis=1)
                & (low[rest] == low[head]) & (high[rest] == high[head])
            )
            single[rest[~same]] = True
            copies.append(rest[same])
    out = []
    text = np.searchsorted(block.stops, places, side="right")
    off = places - block.starts[text] if len(places) else places
    if copies:
        c = np.concatenate(copies)
        spans = _span_bytes(text[c], off[c] - high[c], off[c] - low[c] + length)
        out.append((block.number % buckets, block.number, -1, spans))
    s = np.flatnonzero(single)
    target = np.searchsorted(splitters, leading(block.bytes, places[s]), side="right")
    order = np.argsort(target, kind="stable")
    s, target = s[order], target[order]
    press = zstandard.ZstdCompressor(level=1)
    starts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(s) else []
    for a, b in zip(starts, [*starts[1:], len(s)]):
        r = s[a:b]
        data = b"".join([
            surroundings(block, places[r], length).tobytes(), low[r].astype("u1").tobytes(),
            high[r].astype("u1").tobytes(), text[r].astype("<i4").tobytes(),
            off[r].astype("<i8").tobytes(), block.known[text[r]].tobytes(),
            block.ids[text[r]].tobytes(),
            np.array([_text_hash(block, t) for t in text[r]], "<u8").tobytes(),
        ])
        out.append((int(target[a]), block.number, len(r), press.compress(data)))
    return out


def _text_hash(block: Block, text: int) -> int:
    cache = block.__dict__.setdefault("hashes", {})
    if text not in cache:
        cache[text] = xxhash.xxh64_intdigest(
            block.bytes[block.starts[text] : block.stops[text]].tobytes()
        )
    return cache[text]


def _span_bytes(text: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    return np.stack([text, start, stop]).astype("<i8").tobytes()


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of rows of words by multikey quicksort.

    Rows are parted in three by a pivot word; those equal to it go on with the next
    word. Small parts are sorted by all words that are left.
    """
    order = np.arange(len(words))
    depth = words.shape[1]
    parts = [(0, len(words), 0)]
    while parts:
        a, b, d = parts.pop()
        if b - a < 2 or d == depth:
            continue
        part = order[a:b]
        if b - a <= 4096:
            order[a:b] = part[np.lexsort(words[part, d:].T[::-1])]
            continue
        column = words[part, d]
        pivot = np.sort(column[:: max(1, (b - a) // 31)])[15]
        less, more = column < pivot, column > pivot
        equal = ~(less | more)
        order[a:b] = np.concatenate([part[less], part[equal], part[more]])
        m, n = a + int(less.sum()), b - int(more.sum())
        parts += [(a, m, d), (m, n, d + 1), (n, b, d)]
    return order


def _words(rows: np.ndarray) -> np.ndarray:
    wide = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), wide), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def _common(rows: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before it; none for the first."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        out[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def _reach(common: np.ndarray) -> np.ndarray:
    """The most that each row has in common with a neighbour."""
    return np.maximum(common, np.r_[common[1:], 0]) if len(common) else common


def repeats(
    around: np.ndarray, low: np.ndarray, high: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Which strings of suffixes, given from the earliest to the last, repeat.

    Returns suffixes that are copies of an earlier one as a whole, and a table of
    suffixes and offsets.
    """
    before, n = length - K, len(around)
    right, left = around[:, before:], around[:, :before][:, ::-1]
    rank = np.arange(n, dtype=np.uint64)
    marks = np.stack([low, high], axis=1).astype(np.uint64)
    right_words, left_words = _words(right), _words(left)
    full = multikey_order(np.concatenate([right_words, left_words, marks, rank[:, None]], axis=1))
    same = np.zeros(n, bool)
    same[1:] = (around[full[1:]] == around[full[:-1]]).all(axis=1) & (
        marks[full[1:]] == marks[full[:-1]]
    ).all(axis=1)
    copy = np.zeros(n, bool)
    copy[full[same]] = True
    found = np.zeros((n, before + 1), bool)
    keep = np.flatnonzero(~copy)
    # Suffixes in order, and the texts to the left within equal first K bytes.
    by_right = full[~same]
    right_common = _common(right[by_right])
    run = np.empty(n, np.uint64)
    run[by_right] = np.cumsum(right_common < K)
    by_left = keep[multikey_order(np.concatenate([run[keep][:, None], left_words[keep]], axis=1))]
    left_common = _common(left[by_left])
    if len(by_left):
        left_common[np.r_[True, run[by_left][1:] != run[by_left][:-1]]] = -1
    right_reach, left_reach = np.zeros(n, np.int64), np.zeros(n, np.int64)
    right_reach[by_right], left_reach[by_left] = _reach(right_common), _reach(left_common)
    least = np.maximum(low, length - right_reach)
    most = np.minimum(high, left_reach)
    hopeful = keep[least[keep] <= most[keep]]
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(before + 1):
        here = hopeful[(least[hopeful] <= o) & (o <= most[hopeful])]
        if len(here) < 2:
            continue
        right_class[by_right] = np.cumsum(right_common < length - o)
        left_class[by_left] = np.cumsum(left_common < o)
        key = right_class[here] * (n + 1) + left_class[here]
        again = np.ones(len(here), bool)
        again[np.unique(key, return_index=True)[1]] = False
        found[here[again], o] = True
    return copy, found


def _resolve(group: pa.Table, length: int) -> pa.Table:
    """Repeats among the suffixes of a bucket, by block."""
    width = 2 * length - K
    fields: list[list[np.ndarray]] = [[] for _ in range(9)]
    out: list[tuple] = []
    expand = zstandard.ZstdDecompressor()
    per_row = width + 2 + 4 + 8 + 1 + 8 + 8
    for number, n, data in zip(*[group.column(c).to_pylist() for c in ("block", "n", "data")]):
        if n < 0:
            out.append((number, data))
            continue
        raw, at = expand.decompress(data, max_output_size=n * per_row), 0
        for field, kind in zip(fields, ("u1", "u1", "u1", "<i4", "<i8", "u1", "<i8", "<u8")):
            size = n * (width if field is fields[0] else np.dtype(kind).itemsize)
            values = np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at)
            field.append(values.reshape(n, -1) if field is fields[0] else values)
            at += size
        fields[8].append(np.full(n, number, np.int64))
    schema = _ddl(SPANS)
    if not fields[0]:
        return pa.Table.from_batches([_batch(schema, out)])
    around, low, high, text, off, known, ids, hashes, number = [np.concatenate(f) for f in fields]
    order = np.lexsort((off, text, number, hashes, ids, known))
    around, text, off, number = around[order], text[order], off[order], number[order]
    low, high = low[order].astype(np.int64), high[order].astype(np.int64)
    copy, found = repeats(around, low, high, length)
    whole = np.flatnonzero(copy)
    edge = np.zeros((len(found), found.shape[1] + 2), np.int8)
    edge[:, 1:-1] = found
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    last = np.nonzero(step == -1)[1] - 1
    at = np.r_[whole, row]
    starts = np.r_[off[whole] - high[whole], off[row] - last]
    stops = np.r_[off[whole] - low[whole], off[row] - first] + length
    by_block = np.argsort(number[at], kind="stable")
    at, starts, stops = at[by_block], starts[by_block], stops[by_block]
    blocks = number[at]
    cut = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(at) else []
    for a, b in zip(cut, [*cut[1:], len(at)]):
        out.append((int(blocks[a]), _span_bytes(text[at[a:b]], starts[a:b], stops[a:b])))
    return pa.Table.from_batches([_batch(schema, out)])


def merge_spans(
    text: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans per text of spans that may overlap or touch."""
    order = np.lexsort((start, text))
    text, start, stop = text[order], start[order], stop[order]
    if not len(text):
        return text, start, stop
    # Texts are laid one after the other, so one running maximum does for all.
    far = int(stop.max()) + 2
    a, b = text * far + start, np.maximum.accumulate(text * far + stop)
    first = np.flatnonzero(np.r_[True, a[1:] > b[:-1]])
    last = np.r_[first[1:], len(a)] - 1
    return text[first], start[first], b[last] - text[first] * far


def _cut(blocks: pa.Table, spans: pa.Table, schema: pa.Schema) -> pa.Table:
    out = []
    found = [np.frombuffer(x.as_py(), "<i8").reshape(3, -1) for x in spans.column("spans")]
    text, start, stop = merge_spans(*(np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)))
    for i in range(blocks.num_rows):
        block = Block({n: blocks.column(n)[i].as_py() for n in blocks.column_names})
        first = np.searchsorted(text, np.arange(len(block.lens) + 1))
        raw = memoryview(block.bytes.tobytes())
        for t in range(len(block.lens)):
            mine = slice(first[t], first[t + 1])
            pieces, at, base = [], 0, int(block.starts[t])
            cuts = list(zip(start[mine].tolist(), stop[mine].tolist()))
            for a, b in [*cuts, (int(block.lens[t]), 0)]:
                pieces.append(raw[base + at : base + a])
                at = b
            out.append((
                int(block.ids[t]) if block.known[t] else None, int(block.lens[t]),
                [{"start": a, "stop": b} for a, b in cuts], b"".join(pieces),
            ))
    return pa.Table.from_batches([_batch(schema, out)])


RESULT = "n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"


def remove_repeats(
    documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Every text without the strings of ``length`` bytes that also start earlier.

    Result: the key as a long, ``n_bytes`` of the UTF-8 text, ``spans`` (maximal removed
    runs) and ``kept`` (the other bytes, joined). Earlier is a smaller key, or an
    earlier start in the same text. Overlapping repeats count; repeats are judged on
    the texts as they are, not on what is left of them; no match crosses texts.

    * A NULL text is empty; texts shorter than ``length`` stay whole.
    * A NULL key comes before all others. Texts of one key are ordered by a hash of
      the text; of texts equal in key and content one, whichever, is the earlier.
    * Texts of any length are read whole; an empty table gives none.
    * Columns of other names are not looked at.
    """
    spark = documents.sparkSession
    if length < K + 8:
        raise ValueError(f"strings of at least {K + 8} bytes")
    if length - K > 255:
        raise ValueError(f"strings of at most {K + 255} bytes")
    ship_package(spark)
    folder = shared_folder(spark, "suffixes")
    texts = documents.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_parts = max(8, -(-total // PART_BYTES))
    blocks = _bucketed(
        texts.mapInArrow(partial(_pack, schema=_ddl(BLOCKS)), BLOCKS), "block", n_parts,
        f"{folder}/blocks",
    )
    frequent, leads = _sample(blocks, length)

    listed = blocks.mapInArrow(
        partial(_listed, length=length, frequent=frequent, slices=n_parts, schema=_ddl(HASHES)),
        HASHES,
    )
    bits = stage(listed.groupBy("slice").applyInArrow(_repeated, BITS), f"{folder}/bits")
    shared = bits.agg(F.coalesce(F.sum("repeated"), F.lit(0))).first()[0]
    buckets = max(n_parts, -(-shared // BUCKET_ROWS))
    splitters = leads[np.linspace(0, len(leads), buckets + 1).astype(int)[1:-1]] if len(leads) else leads

    def suffixes(block: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        of = dict(zip(found.column("slice").to_pylist(), found.column("bits").to_pylist()))
        for row in _rows(block.to_batches()):
            rows += _suffixes(Block(row), length, frequent, n_parts, of, splitters, buckets)
        return pa.Table.from_batches([_batch(_ddl(PACKETS), rows)])

    def resolve(group: pa.Table) -> pa.Table:
        return _resolve(group, length)

    packets = blocks.groupBy("block").cogroup(bits.groupBy("block")).applyInArrow(suffixes, PACKETS)
    spans = stage(packets.groupBy("bucket").applyInArrow(resolve, SPANS), f"{folder}/spans")
    result = T.StructType([T.StructField(key, T.LongType()), *T.StructType.fromDDL(RESULT)])
    arrow = to_arrow_schema(result)

    def cut(block: pa.Table, found: pa.Table) -> pa.Table:
        return _cut(block, found, arrow)

    return blocks.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(cut, result)


def _bucketed(df: DataFrame, column: str, n: int, path: str) -> DataFrame:
    """Written in buckets, so that joins on the column do not move it again."""
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(n, column).option("path", path).option("compression", "none").saveAsTable(name)
    return df.sparkSession.table(name)


def _sample(blocks: DataFrame, length: int) -> tuple[Frequent, np.ndarray]:
    """Frequent runs and sorted leading words, from at most ``SAMPLE_BLOCKS`` blocks.

    Both only steer the work: another sample gives the same result.
    """
    picked = blocks.select("block").orderBy(F.xxhash64("block")).limit(SAMPLE_BLOCKS)
    picked = [r[0] for r in picked.collect()]
    ddl = "leads binary, runs binary, counts binary, n long"
    rows = blocks.filter(F.col("block").isin(picked)).mapInArrow(
        partial(_sampled, length=length, schema=_ddl(ddl)), ddl
    ).collect()
    none = [np.zeros(0, np.uint64)]
    leads = [np.frombuffer(r["leads"], _LEAD) for r in rows]
    leads = np.sort(np.concatenate([np.zeros(0, _LEAD), *leads]))
    runs = np.concatenate(none + [np.frombuffer(r["runs"], "<u8") for r in rows])
    counts = np.concatenate(
        [np.zeros(0, np.int64)] + [np.frombuffer(r["counts"], "<i8") for r in rows]
    )
    distinct, at = np.unique(runs, return_inverse=True)
    sums = np.bincount(at, counts, len(distinct))
    return Frequent(distinct[sums >= max(32, sum(r["n"] for r in rows) / FREQUENT)]), leads
