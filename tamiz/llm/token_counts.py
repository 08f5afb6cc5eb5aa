"""Token counts of whole texts, each distinct pre-token counted once.

A text's tokens are those of its pre-tokens. One pass lists, block by block, the
distinct pre-tokens and every document's pre-token frequencies in the block's own
numbering. Each distinct pre-token of the corpus is then met in one place, its
pieces are counted once, the counts go back to the blocks that have it, and a
document's tokens are the sum of frequency times pieces. Token ids are never made
for documents, and no step holds more than a block or one slice of pre-tokens.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from public_tokenizers import PATTERN
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from ..sources.staged import shared_folder, stage
from .tokens import _MARKS, Encoder, encoder, gather, rounds

# Bytes of text per block.
BLOCK = 16_000_000
_PRETOKENS = regex.compile(PATTERN)


def pack_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all values, bytes per value): 7 bits a byte, low bits first."""
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= (1 << bits)
    out = np.empty(int(sizes.sum()), np.uint8)
    at = np.cumsum(sizes) - sizes
    for k in range(5):
        some = sizes > k
        more = (sizes[some] > k + 1).astype(np.int64) << 7
        out[at[some] + k] = ((values[some] >> (7 * k)) & 127) | more
    return out, sizes


def unpack_numbers(data: np.ndarray) -> np.ndarray:
    """Values of :func:`pack_numbers`."""
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], data[:-1] < 128]))
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first)


class PreTokens:
    """Pre-tokens of chunks and the pieces of a pre-token, as the library has them."""

    def __init__(self, enc: Encoder):
        self.enc = enc
        added = enc.tokenizer.get_added_tokens_decoder().values()
        self.special = {t.content for t in added}
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None

    def of(self, chunk: str) -> list[str]:
        if not chunk:
            return []
        if not self.enc.spaced:
            # The pipeline changes such texts before it splits them; a chunk is the unit.
            return [chunk]
        body = chunk[1:] if chunk[0] == " " else chunk
        if not body:
            return [chunk]
        if body.isascii() or max(body) < "Ā":
            if body.isalpha():
                return [chunk]
            if body[-1:] in _MARKS and body[:-1].isalpha():
                return [chunk[:-1], chunk[-1]]
        parts = [chunk]
        if self.cut is not None and self.cut.search(chunk):
            parts = [x for x in self.cut.split(chunk) if x]
        found: list[str] = []
        for part in parts:
            if part in self.special:
                found.append(part)
            elif max(part) < "Ā":
                found += _PRETOKENS.findall(part)
            else:
                split = self.enc.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                found += [part[a:b] for _, (a, b) in split]
        return found

    def pieces(self, pretoken: str) -> int:
        if self.enc.spaced and pretoken not in self.special:
            spelled = pretoken.encode().decode("latin-1").translate(self.enc._letters)
            return len(self.enc.model.tokenize(spelled))
        return len(self.enc.tokenizer.encode(pretoken, add_special_tokens=False).ids)


def _blocks(
    batches: Iterator[pa.RecordBatch], path: str, slices: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """A row per document with its frequencies, and a row per slice of a block's pre-tokens."""
    enc = encoder(path)
    pre = PreTokens(enc)
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in rounds(batch, "text", BLOCK):
            flat, per_text = enc.chunks(part.column("text"))
            coded = flat.dictionary_encode()
            number: dict[str, int] = {}
            of_chunk = [
                [number.setdefault(p, len(number)) for p in pre.of(c)]
                for c in coded.dictionary.to_pylist()
            ]
            sizes = np.fromiter(map(len, of_chunk), np.int64, len(of_chunk))
            ids = np.fromiter((i for x in of_chunk for i in x), np.int64, int(sizes.sum()))
            which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(part.num_rows), per_text)
            # Local numbers follow slices, so the counts of a block come back in order.
            names = list(number)
            utf8 = [n.encode() for n in names]
            home = np.fromiter((zlib.crc32(u) % slices for u in utf8), np.int64, len(utf8))
            order = np.argsort(home, kind="stable")
            local = np.empty(len(names), np.int64)
            local[order] = np.arange(len(names))
            width = max(len(names), 1)
            pair = np.repeat(doc, sizes[which]) * width + local[gather(ids, sizes, which)]
            pair, counts = np.unique(pair, return_counts=True)
            owner, ids = pair // width, pair % width
            steps = np.diff(ids, prepend=0)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            steps[starts] = ids[starts]
            docs = np.arange(part.num_rows)
            ends = np.searchsorted(owner, np.concatenate([docs, [part.num_rows]]))
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(part.num_rows, block)),
                    "key": part.column("key"),
                    "n_bytes": pc.fill_null(pc.binary_length(part.column("text")), 0).cast("int64"),
                    "ids": _cut_up(*pack_numbers(steps), ends),
                    "counts": _cut_up(*pack_numbers(counts), ends),
                    "slice": pa.nulls(part.num_rows, pa.int32()),
                    "words": pa.nulls(part.num_rows, pa.binary()),
                    "sizes": pa.nulls(part.num_rows, pa.binary()),
                },
                schema,
            )
            lengths = np.fromiter(map(len, utf8), np.int32, len(utf8))[order]
            used, begin = np.unique(home[order], return_index=True)
            stop = np.append(begin[1:], len(order))
            n = len(used)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array(np.full(n, block)),
                    "key": pa.nulls(n, schema.field("key").type),
                    "n_bytes": pa.nulls(n, pa.int64()),
                    "ids": pa.nulls(n, pa.binary()),
                    "counts": pa.nulls(n, pa.binary()),
                    "slice": pa.array(used, pa.int32()),
                    "words": pa.array(
                        [b"".join(utf8[i] for i in order[a:b]) for a, b in zip(begin, stop)],
                        pa.binary(),
                    ),
                    "sizes": pa.array(
                        [lengths[a:b].tobytes() for a, b in zip(begin, stop)], pa.binary()
                    ),
                },
                schema,
            )
            block += 1


def _cut_up(data: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values: the bytes of the numbers from one end to the next."""
    at = np.concatenate([[0], np.cumsum(sizes)])[ends].astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer(at), pa.py_buffer(data.tobytes())]
    )


def _count_slice(table: pa.Table, path: str) -> pa.Table:
    """Pieces of the pre-tokens of one slice, each distinct one counted once."""
    pre = PreTokens(encoder(path))
    known: dict[bytes, int] = {}
    pieces = []
    for words, sizes in zip(table.column("words"), table.column("sizes")):
        data, at, own = words.as_py(), 0, []
        for size in np.frombuffer(sizes.as_py(), np.int32).tolist():
            word = data[at : at + size]
            at += size
            n = known.get(word)
            if n is None:
                n = known[word] = pre.pieces(word.decode())
            own.append(n)
        pieces.append(np.array(own, np.int32).tobytes())
    return pa.table(
        {
            "block": table.column("block"), "slice": table.column("slice"),
            "pieces": pa.array(pieces, pa.binary()),
        }
    )


def _sum_block(docs: pa.Table, pieces: pa.Table) -> pa.Table:
    """Tokens of the documents of one block."""
    order = np.argsort(pieces.column("slice").to_numpy(), kind="stable")
    rows = pieces.column("pieces").to_pylist()
    per_word = np.concatenate(
        [np.frombuffer(rows[i], np.int32) for i in order] or [np.zeros(0, np.int32)]
    ).astype(np.int64)
    tokens = []
    for ids, counts in zip(docs.column("ids"), docs.column("counts")):
        at = np.cumsum(unpack_numbers(np.frombuffer(ids.as_py(), np.uint8)))
        often = unpack_numbers(np.frombuffer(counts.as_py(), np.uint8))
        tokens.append(int(per_word[at] @ often) if len(at) else 0)
    return pa.table(
        {
            "key": docs.column("key"), "n_bytes": docs.column("n_bytes"),
            "n_tokens": pa.array(tokens, pa.int64()),
        }
    )


def token_counts(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The key, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row's whole text.

    Counts are those of the tokenizer file without added begin or end tokens, special
    strings inside a text being what the library takes them for.

    * NULL and empty texts have 0 bytes and 0 tokens; long texts are counted whole.
    * Repeated rows and NULL or equal keys: every row is counted by itself.
    * Columns of any other name are not looked at; an empty table gives none.
    """
    spark = documents.sparkSession
    ship_package(spark)
    folder = shared_folder(spark, "token-counts")
    picked = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = picked.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()), T.StructField("key", kind),
            T.StructField("n_bytes", T.LongType()), T.StructField("ids", T.BinaryType()),
            T.StructField("counts", T.BinaryType()), T.StructField("slice", T.IntegerType()),
            T.StructField("words", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    # As many slices as input tasks: a slice holds about as many words as a block.
    slices = max(1, picked.rdd.getNumPartitions())
    listed = partial(_blocks, path=tokenizer, slices=slices, schema=to_arrow_schema(schema))
    staged = stage(picked.mapInArrow(listed, schema), folder)
    docs = staged.filter("slice IS NULL").select("block", "key", "n_bytes", "ids", "counts")
    words = staged.filter("slice IS NOT NULL").select("block", "slice", "words", "sizes")

    def count(group: pa.Table) -> pa.Table:
        return _count_slice(group, tokenizer)

    pieces = words.groupBy("slice").applyInArrow(
        count, "block long, slice int, pieces binary"
    )
    result = T.StructType(
        [T.StructField("key", kind), T.StructField("n_bytes", T.LongType()),
         T.StructField("n_tokens", T.LongType())]
    )
    summed = docs.groupBy("block").cogroup(pieces.groupBy("block")).applyInArrow(
        _sum_block, result
    )
    return summed.select(F.col("key").alias(key), "n_bytes", "n_tokens")
