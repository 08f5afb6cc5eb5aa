"""Sampled segmentations into SentencePiece pieces, reproducible and lossless.

A segmentation of a text is a path through the lattice of all pieces that match it;
its weight is the exponential of ``alpha`` times the sum of its pieces' scores. A
path is drawn by forward filtering (the weight of all paths up to every position)
and backward sampling (from the end, one piece at a time). No piece reaches from a
word into the space behind it, so the lattice falls apart at word starts: words are
filtered once per batch and sampled for all their occurrences side by side.

Random numbers come from a hash of the row's seed, the word's place in the text and
the step, never from a generator's state: the same row gives the same pieces
wherever and however often it is computed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from .tokens import gather, rounds

SPACE = "\u2581"
ALPHA = 1e-4
# A cut before every space mark; a text's own space marks are segments of two of them.
_PARTS = re.compile(f"{SPACE}[^{SPACE}]*|[^{SPACE}]+")
_LITERAL = SPACE * 2
# Longer words are filtered one by one.
LONG_WORD = 40
# Substrings looked up together.
_AT_ONCE = 200_000
# Bytes of text that a worker samples at once, and edges of lattices that it keeps.
ROUND_BYTES = 1_500_000
KEPT_EDGES = 2_000_000
# Multipliers of the two hashes of a run of characters.
_FACTORS = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _codes(words: list[str], n: int) -> np.ndarray:
    """Characters of words of ``n`` characters, a row each.

    Counted from 1: a hash starts at 0, so a leading 0 would not tell in it.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n)
    return codes.astype(np.uint64) + np.uint64(1)


def _run_hashes(codes: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Hash of every row of characters."""
    h = np.zeros(len(codes), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(codes.shape[1]):
            h = h * factor + codes[:, k]
    return h


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class Pieces:
    """Matchable pieces of a model with their log weights, and byte pieces."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.text: list[bytes] = [b""] * n
        self.weight: dict[str, tuple[int, float]] = {}
        self.byte_id = [-1] * 256
        least = 0.0
        for i in range(n):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_id[value] = i
                self.text[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = name.replace(SPACE, " ").encode()
                # Pieces with a mark inside are runs of spaces without a score.
                if SPACE not in name[1:]:
                    self.weight[name] = (i, alpha * model.get_score(i))
                    least = min(least, alpha * model.get_score(i))
        if min(self.byte_id) < 0:
            raise ValueError("lossless pieces need a model with byte pieces")
        self._joined: tuple[np.ndarray, np.ndarray] | None = None
        self.longest = max(map(len, self.weight), default=1)
        self.byte_weight = least - 1.0
        # What a slice of a word can be: a piece, or an ASCII character spelled in a byte.
        spelled = {chr(b): (self.byte_id[b], self.byte_weight) for b in range(128)}
        known = {**{c: v for c, v in spelled.items() if c not in self.weight}, **self.weight}
        self._index(list(known))
        self.ids = np.array([v[0] for v in known.values()], np.int32)
        self.weights = np.array([v[1] for v in known.values()] + [-np.inf])

    def _index(self, names: list[str]) -> None:
        """Tables from the top bits of a hash to the piece; the second takes what collides."""
        self.hashes = np.zeros((2, len(names)), np.uint64)
        self.lengths = {len(w) for w in names}
        for n in self.lengths:
            own = np.array([k for k, w in enumerate(names) if len(w) == n])
            codes = _codes([names[k] for k in own], n)
            for h, f in zip(self.hashes, _FACTORS):
                h[own] = _run_hashes(codes, f)
        bits = 20
        while True:
            self.shift = np.uint64(64 - bits)
            self.tables = np.full((2, 1 << bits), -1, np.int32)
            rest = np.arange(len(names))
            for h, table in zip(self.hashes, self.tables):
                slot = (_mixed(h[rest]) >> self.shift).astype(np.int64)
                table[slot] = rest
                rest = rest[table[slot] != rest]
            if not len(rest):
                return
            bits += 1

    def look_up(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The piece of each pair of hashes, -1 for none."""
        out = self.tables[0][(_mixed(first) >> self.shift).astype(np.int64)]
        out[(self.hashes[0][out] != first) | (self.hashes[1][out] != second)] = -1
        other = self.tables[1][(_mixed(second) >> self.shift).astype(np.int64)]
        at = np.nonzero(other >= 0)
        if len(at[0]):
            k = other[at]
            out[at] = np.where(
                (self.hashes[0][k] == first[at]) & (self.hashes[1][k] == second[at]), k, out[at]
            )
        return out

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all pieces one after the other, and bytes per piece."""
        if self._joined is None:
            sizes = np.fromiter(map(len, self.text), np.int64, len(self.text))
            self._joined = np.frombuffer(b"".join(self.text), np.uint8), sizes
        return self._joined


_LOADED: dict[tuple[str, float], Pieces] = {}


def loaded(path: str, alpha: float) -> Pieces:
    """The worker's pieces of a model file."""
    if (path, alpha) not in _LOADED:
        _LOADED[path, alpha] = Pieces(path, alpha)
    return _LOADED[path, alpha]


def segments(text: str) -> list[str]:
    """A text as segments that no piece reaches across."""
    if not text:
        return []
    out: list[str] = []
    for k, part in enumerate(text.split(SPACE)):
        if k:
            out.append(_LITERAL)
        out += _PARTS.findall((SPACE if not k else "") + part.replace(" ", SPACE))
    return out


def all_segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(segments of all texts, segments per text); a NULL or empty text has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    odd = pc.or_(pc.match_substring(texts, SPACE), pc.match_substring(texts, "\x00"))
    odd = pc.or_(odd, pc.equal(texts, "")).to_numpy(zero_copy_only=False)
    mark, none = pa.scalar(SPACE, texts.type), pa.scalar("", texts.type)
    front = pc.binary_join_element_wise(mark, pc.if_else(pa.array(odd), none, texts), none)
    parts = pc.split_pattern(pc.replace_substring(front, " ", "\x00" + SPACE), "\x00")
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = parts.flatten()
    if not odd.any():
        return flat, sizes
    at = np.concatenate([[0], np.cumsum(sizes)])
    pieces, start = [], 0
    for i in np.flatnonzero(odd):
        own = pa.array(segments(texts[int(i)].as_py()), flat.type)
        pieces += [flat.slice(start, at[i] - start), own]
        start, sizes[i] = at[i + 1], len(own)
    pieces.append(flat.slice(start))
    return pa.concat_arrays(pieces), sizes


class Lattices:
    """Filtered lattices of distinct words as flat tables.

    A node is a position in a word. Its incoming edges are consecutive, each with
    the upper end of its probability in units of 2**-32 (above the node's number in
    the upper bits of the key), the piece and the node it comes from (-1: the start
    of the word). Words of equal length are filtered side by side.
    """

    def __init__(self, words: pa.Array, pieces: Pieces, first_node: int = 0):
        self.pieces = pieces
        self.nodes = first_node
        self._keys: list[np.ndarray] = []
        self._piece: list[np.ndarray] = []
        self._origin: list[np.ndarray] = []
        self.last = np.empty(len(words), np.int64)
        lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        by_length = np.argsort(lengths, kind="stable")
        rest: list[np.ndarray] = [by_length[lengths[by_length] > LONG_WORD]]
        for n in np.unique(lengths[lengths <= LONG_WORD]).tolist():
            own = by_length[np.searchsorted(lengths[by_length], n):]
            own = own[: np.searchsorted(lengths[own], n, side="right")]
            step = max(1, _AT_ONCE // (n * min(n, pieces.longest)))
            for k in range(0, len(own), step):
                some = own[k : k + step]
                rest.append(self._side_by_side(words, some, n))
        for w in np.concatenate(rest).tolist():
            self.last[w] = self._one(words[w].as_py())
        empty = np.zeros(0, np.int64)
        self.keys = np.concatenate([*self._keys, empty])
        self.piece = np.concatenate([*self._piece, empty.astype(np.int32)])
        self.origin = np.concatenate([*self._origin, empty])
        counts = np.bincount((self.keys >> 32) - first_node, minlength=self.nodes - first_node)
        # The first edge of every node.
        self.first = np.cumsum(counts) - counts

    def _side_by_side(self, words: pa.Array, which: np.ndarray, n: int) -> np.ndarray:
        """Filter words of ``n`` characters; returns those with a character to spell out."""
        longest, weights = self.pieces.longest, self.pieces.weights
        taken = words.take(pa.array(which))
        spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - longest), j)]
        at = {span: k for k, span in enumerate(spans)}
        found = self._found(_codes(taken.to_pylist(), n), at)
        whole = np.all([found[at[i, i + 1]] >= 0 for i in range(n)], axis=0)
        whole &= ~pc.equal(taken, _LITERAL).to_numpy(zero_copy_only=False)
        found, good = found[:, whole], which[whole]
        m = len(good)
        total = np.zeros((n + 1, m))
        row = np.arange(m)
        for j in range(1, n + 1):
            low = max(0, j - longest)
            ids = found[at[low, j] : at[low, j] + j - low]
            weight = total[low:j] + weights[ids]
            top = weight.max(axis=0)
            run = np.cumsum(np.exp(weight - top), axis=0)
            total[j] = top + np.log(run[-1])
            ends = (run / run[-1] * 4294967296.0).astype(np.int64)
            node = self.nodes + (j - 1) * m + row
            real = (ids >= 0).T
            before = self.nodes + (np.arange(low, j) - 1)[None, :] * m + row[:, None]
            if low == 0:
                before[:, 0] = -1
            self._keys.append(((node << 32)[:, None] + ends.T)[real])
            self._piece.append(self.pieces.ids[ids.T[real]])
            self._origin.append(before[real])
        self.last[good] = self.nodes + (n - 1) * m + row
        self.nodes += n * m
        return which[~whole]

    def _found(self, codes: np.ndarray, at: dict[tuple[int, int], int]) -> np.ndarray:
        """The piece that each span of each word is, -1 for none; spans are rows."""
        m, n = codes.shape
        found = np.full((len(at), m), -1, np.int32)
        hashes = [np.zeros((m, n), np.uint64) for _ in _FACTORS]
        for length in range(1, min(n, self.pieces.longest) + 1):
            starts = n - length + 1
            # One character more than the runs before.
            hashes = [
                h[:, :starts] * f + codes[:, length - 1 :] for h, f in zip(hashes, _FACTORS)
            ]
            if length in self.pieces.lengths:
                rows = [at[i, i + length] for i in range(starts)]
                found[rows] = self.pieces.look_up(*hashes).T
        return found

    def _one(self, word: str) -> int:
        """Filter one word; a character without a piece is spelled in bytes."""
        get, longest = self.pieces.weight.get, self.pieces.longest
        keys, piece, origin = [], [], []
        node = self.nodes
        chars = [SPACE] if word == _LITERAL else word
        if word == _LITERAL:
            get = {}.get
        n = len(chars)
        total, at = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            found = []
            for i in range(max(0, j - longest), j):
                hit = get(word[i:j])
                if hit is not None:
                    found.append((total[i] + hit[1], at[i], hit[0]))
            if get(chars[j - 1]) is None:
                code = chars[j - 1].encode()
                back = at[j - 1]
                for b in code[:-1]:
                    keys.append((node + 1) << 32)
                    piece.append(self.pieces.byte_id[b])
                    origin.append(back)
                    back, node = node, node + 1
                weight = total[j - 1] + self.pieces.byte_weight * len(code)
                found.append((weight, back, self.pieces.byte_id[code[-1]]))
            top = max(f[0] for f in found)
            parts = [math.exp(f[0] - top) for f in found]
            whole = sum(parts)
            total[j] = top + math.log(whole)
            run = 0.0
            for part, (_, back, number) in zip(parts, found):
                run += part
                keys.append((node << 32) + int(run / whole * 4294967296.0))
                piece.append(number)
                origin.append(back)
            keys[-1] = (node + 1) << 32
            at[j] = node
            node += 1
        self._keys.append(np.array(keys, np.int64))
        self._piece.append(np.array(piece, np.int32))
        self._origin.append(np.array(origin, np.int64))
        self.nodes = node
        return at[n]


class Kept:
    """Lattices of the words met so far, so that a worker filters a word once.

    They are dropped when they have more than ``KEPT_EDGES`` edges, which bounds the
    memory; a word that is filtered again gets the same lattice.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._drop()

    def _drop(self) -> None:
        self.number: dict[str, int] = {}
        none = np.zeros(0, np.int64)
        self.last, self.keys, self.piece, self.origin = none, none, none.astype(np.int32), none
        self.first, self.nodes = none, 0

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Numbers of distinct words in ``last``, new ones filtered."""
        if len(self.keys) > KEPT_EDGES:
            self._drop()
        texts = words.to_pylist()
        found = np.array([self.number.get(t, -1) for t in texts], np.int64)
        new = np.flatnonzero(found < 0)
        if len(new):
            more = Lattices(words.take(pa.array(new)), self.pieces, self.nodes)
            at = len(self.last)
            found[new] = np.arange(at, at + len(new))
            self.number.update(zip([texts[i] for i in new.tolist()], range(at, at + len(new))))
            # Nodes of later words are larger, so the keys stay in order.
            self.last = np.concatenate([self.last, more.last])
            self.first = np.concatenate([self.first, more.first + len(self.keys)])
            self.keys = np.concatenate([self.keys, more.keys])
            self.piece = np.concatenate([self.piece, more.piece])
            self.origin = np.concatenate([self.origin, more.origin])
            self.nodes = more.nodes
        return found


def sample(
    words: np.ndarray, seeds: np.ndarray, lattices: Lattices | Kept
) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all word occurrences in order, ids per occurrence).

    ``words``: the distinct word of each occurrence, ``seeds``: a number of its own
    for each occurrence.
    """
    node = lattices.last[words]
    where = np.arange(len(words))
    counts = np.zeros(len(words), np.int64)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    with np.errstate(over="ignore"):
        while len(where):
            k = np.uint64(len(steps) + 1)
            u = (_mixed(seeds[where] + k * _MIX[0]) >> np.uint64(32)).astype(np.int64)
            # The first edge of the node whose upper end is above the number drawn.
            edge, drawn = lattices.first[node], (node << 32) + u
            late = np.flatnonzero(lattices.keys[edge] <= drawn)
            while len(late):
                edge[late] += 1
                late = late[lattices.keys[edge[late]] <= drawn[late]]
            steps.append((where, lattices.piece[edge]))
            counts[where] += 1
            node = lattices.origin[edge]
            more = node >= 0
            where, node = where[more], node[more]
    ends = np.cumsum(counts)
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    # Drawn from the end of a word, so the first step fills its last place.
    for k, (at, drawn) in enumerate(steps):
        ids[ends[at] - 1 - k] = drawn
    return ids, counts


def _encoded(
    batches: Iterator[pa.RecordBatch], path: str, alpha: float, verify: str | None
) -> Iterator[pa.RecordBatch]:
    pieces = loaded(path, alpha)
    kept = Kept(pieces)
    for batch in batches:
        for part in rounds(batch, "__text", ROUND_BYTES):
            flat, sizes = all_segments(part.column("__text"))
            coded = flat.dictionary_encode()
            place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            row = part.column("__seed").to_numpy(zero_copy_only=False).view(np.uint64)
            with np.errstate(over="ignore"):
                seeds = _mixed(np.repeat(row, sizes) + (place.astype(np.uint64) + np.uint64(1))
                               * _MIX[2])
            words = kept.numbers(coded.dictionary)
            which = coded.indices.to_numpy(zero_copy_only=False)
            ids, counts = sample(words[which], seeds, kept)
            ends = np.concatenate([[0], np.cumsum(counts)])[
                np.concatenate([[0], np.cumsum(sizes)])
            ]
            values = ids.astype("<u4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            columns = {
                **{c: part.column(c) for c in part.schema.names if c not in ("__text", "__seed")},
                "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                "ids_crc32": pa.array(crc, pa.int64()),
            }
            if verify:
                texts = pc.fill_null(part.column("__text"), "")
                columns[verify] = pc.equal(_texts(ids, ends, pieces), texts.cast(pa.large_string()))
            yield pa.RecordBatch.from_pydict(columns)


def sample_pieces(
    documents: DataFrame, model: str, carried: dict[str, Column], seed_by: Column,
    text: str = "text", alpha: float = ALPHA, seed: int = 0, verify: str | None = None,
) -> DataFrame:
    """The ``carried`` columns, ``ids`` and ``ids_crc32`` of a sampled segmentation.

    With ``verify`` a column of that name tells whether the ids decode to the text; they
    are decoded where they are sampled, so whole texts are not sent once more.

    ``alpha`` near 0 draws among all segmentations alike, a large one takes the best.
    Rows with equal ``seed_by`` and text give equal ids; another ``seed`` gives others.

    * NULL and empty texts have no ids. Control and unknown pieces never occur; a
      character without a piece, and a space mark in the text itself, is spelled in
      byte pieces, so :func:`decode_pieces` returns every text unchanged.
    * Texts are read whole, however long; a NULL ``seed_by`` is a seed like any other;
      repeated rows give the same ids; an empty table gives an empty result.
    * Columns that are not ``carried`` are not looked at, whatever their names.
    """
    ship_package(documents.sparkSession)
    picked = documents.select(
        *[c.alias(n) for n, c in carried.items()], F.col(f"`{text}`").alias("__text"),
        F.xxhash64(F.lit(seed), seed_by.cast("string")).alias("__seed"),
    )
    fields = [f for f in picked.schema.fields if f.name not in ("__text", "__seed")]
    schema = T.StructType(
        [*fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
         T.StructField("ids_crc32", T.LongType()),
         *([T.StructField(verify, T.BooleanType())] if verify else [])]
    )
    return picked.mapInArrow(partial(_encoded, path=model, alpha=alpha, verify=verify), schema)


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    """The text of piece ids, without the space that encoding puts in front."""
    data = b"".join([pieces.text[i] for i in ids])
    return data[1:].decode()


def _texts(ids: np.ndarray, ends: np.ndarray, pieces: Pieces) -> pa.Array:
    """Texts of rows of piece ids, without the space that encoding puts in front.

    ``ends`` has the first id of every row and the end of the last.
    """
    data, sizes = pieces.joined()
    body = gather(data, sizes, ids.astype(np.int64))
    at = np.concatenate([[0], np.cumsum(sizes[ids])])[ends]
    # A row without ids has no space in front.
    lengths = np.maximum(np.diff(at) - 1, 0)
    front = np.ones(len(body), bool)
    front[at[:-1][at[:-1] < at[1:]]] = False
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    kept = body[front]
    return pa.Array.from_buffers(
        pa.large_string(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]
    )


def _decoded(batches: Iterator[pa.RecordBatch], path: str, ids: str) -> Iterator[pa.RecordBatch]:
    pieces = loaded(path, ALPHA)
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy()
        for start, stop in _runs(sizes, 500_000):
            part = batch.slice(start, stop - start)
            flat = part.column(ids).flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(sizes[start:stop])]).astype(np.int64)
            columns = {c: part.column(c) for c in part.schema.names if c != ids}
            texts = _texts(flat, ends, pieces)
            yield pa.RecordBatch.from_pydict({**columns, "decoded": texts.cast(pa.string())})


def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + limit, side="right")), start + 1)
        yield start, stop
        start = stop


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """Replace column ``ids`` by ``decoded``, the text; no ids give an empty text."""
    ship_package(rows.sparkSession)
    rest = [f for f in rows.schema.fields if f.name != ids]
    schema = T.StructType([*rest, T.StructField("decoded", T.StringType())])
    return rows.mapInArrow(partial(_decoded, path=model, ids=ids), schema)
