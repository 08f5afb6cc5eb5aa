"""Hard negatives by an inverted multi-index over the halves of vectors.

Two codebooks, one for each half of a vector, form cells. The index is kept in parts:
every part holds rows of all cells, sorted by cell, so a hot cell is spread over parts.
In each part an anchor visits cells by the sum of two half scores, bounded from above
by the score of the codeword plus the length of the anchor's half times the radius of
the codeword's rows (multi-sequence order, with a heap). A visit ends when no cell left
can change the result: the bound is below the last of the ranked positives, or below
what every window of scores still needs. Cells that lie above all windows are passed.

Vectors are whole numbers, so scores are exact: in single or double precision while no
sum can leave the whole numbers these hold, in Python's integers beyond.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shipping import ship_package
from ..sources.staged import shared_folder, stage

POSITIVES, NEGATIVES = 5, 10
SCALE = 256
# A part's rows, and the rows that a cell should hold.
PART_ROWS, CELL_ROWS = (4096, 65_536), 64
# Codebooks are fitted on at most so many rows, the first in hash order.
SAMPLE_ROWS = 8192
# Anchors that go to the parts together (bounds what is broadcast).
ROUND_ROWS = 24_576
# Rows that are scored together.
WAVE = 512
LONG = (1 << 63) - 1

PARTS = "zero int, n int, vectors binary, wide boolean, ids binary, labels binary, codes binary"
ROUNDS = "round int, n int, vectors binary, wide boolean, ids binary, labels binary"
FOUND = "round int, place int, anchor_id long, id long, score long"
WINDOWED = (
    "round int, place int, window int, anchor_id long, positive_id long, positive_score long, "
    "id long, score long"
)


def usable(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """Rows that take part: ``id``, ``label``, ``vector``; equal rows count once."""
    label = F.col("label") if label is None else label
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"),
        F.col("embedding").alias("vector"),
    )
    finite = F.forall(
        "vector",
        lambda v: v.isNotNull() & (F.abs(v.cast("double") * SCALE) < float("inf")),
    )
    return rows.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    )


def _whole(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows of whole numbers; shorter ones end in zeros."""
    lists = column.cast(pa.large_list(pa.float64()))
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(SCALE * lists.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = values
    return out


def _packed(vectors: np.ndarray) -> tuple[bytes, bool]:
    wide = bool(len(vectors)) and float(np.abs(vectors).max(initial=0)) >= 1 << 24
    return vectors.astype("<f8" if wide else "<f4").tobytes(), wide


def fit_codebook(rows: np.ndarray, size: int, rounds: int = 8) -> np.ndarray:
    """At most ``size`` codewords of the rows by Lloyd's rounds from spread rows."""
    book = np.unique(rows, axis=0)
    if not len(book):
        return np.zeros((1, rows.shape[1]))
    book = book[np.linspace(0, len(book) - 1, min(size, len(book))).astype(int)]
    for _ in range(rounds):
        near = nearest(rows, book)
        sums = np.zeros_like(book)
        np.add.at(sums, near, rows)
        counts = np.bincount(near, minlength=len(book))[:, None]
        book = np.where(counts > 0, sums / np.maximum(counts, 1), book)
    return book


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(axis=1) - 2 * rows @ book.T, axis=1)


def _record(values: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values[f.name], f.type) for f in schema], schema=schema
    )


def _pack_parts(
    batches: Iterator[pa.RecordBatch], books: list[np.ndarray], dim: int, most: int,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def pack() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        vectors = _whole(table.column("vector").combine_chunks(), dim)
        half = dim // 2
        codes = [nearest(v, b) for v, b in zip((vectors[:, :half], vectors[:, half:]), books)]
        data, wide = _packed(vectors)
        return _record({
            "zero": [0], "n": [len(vectors)], "vectors": [data], "wide": [wide],
            "ids": [table.column("id").to_numpy().astype("<i8").tobytes()],
            "labels": [table.column("label").to_numpy().astype("<i8").tobytes()],
            "codes": [np.array(codes, "<u2").tobytes()],
        }, schema)

    for batch in batches:
        for k in range(0, batch.num_rows, most):
            held.append(batch.slice(k, most))
            if sum(b.num_rows for b in held) >= most:
                yield pack()
                held.clear()
    if held and sum(b.num_rows for b in held):
        yield pack()


def _pack_round(table: pa.Table, dim: int, schema: pa.Schema) -> pa.Table:
    """Anchors of a round in one row, in order of id, label and vector."""
    vectors = _whole(table.column("vector").combine_chunks(), dim)
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    order = np.lexsort((*vectors.T[::-1], labels, ids))
    data, wide = _packed(vectors[order])
    return pa.Table.from_batches([_record({
        "round": [table.column("round")[0].as_py()], "n": [len(ids)], "vectors": [data],
        "wide": [wide], "ids": [ids[order].astype("<i8").tobytes()],
        "labels": [labels[order].astype("<i8").tobytes()],
    }, schema)])


def _vectors(row: dict) -> np.ndarray:
    kind = "<f8" if row["wide"] else "<f4"
    return np.frombuffer(row["vectors"], kind).reshape(row["n"], -1)


def _lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def scores(rows: np.ndarray, anchor: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products, held within a long; ``bound`` is at least their size."""
    if bound < 1 << 23:
        return (rows.astype(np.float32) @ anchor.astype(np.float32)).astype(np.int64)
    if bound < 1 << 52:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    a = [int(x) for x in anchor]
    exact = [sum(int(x) * y for x, y in zip(r, a)) for r in rows]
    return np.array([max(-LONG - 1, min(LONG, s)) for s in exact], np.int64)


class MultiIndex:
    """Rows of a part by cell, with what bounds the scores of a cell."""

    def __init__(self, vectors, ids, labels, codes, books) -> None:
        order = np.lexsort((codes[1], codes[0]))
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        first, second = codes[0][order], codes[1][order]
        half = vectors.shape[1] // 2
        self.half, self.halves = half, []
        for code, book, part in (
            (first, books[0], self.vectors[:, :half]), (second, books[1], self.vectors[:, half:])
        ):
            words, place = np.unique(code, return_inverse=True)
            radius = np.zeros(len(words))
            np.maximum.at(radius, place, _lengths(part - book[code]))
            self.halves.append((book[words], radius, place))
        places = [h[2] for h in self.halves]
        width = len(self.halves[1][0])
        cell = places[0] * width + places[1] if len(ids) else np.zeros(0, int)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(ids) else cell
        self.bounds = np.r_[starts, len(ids)].tolist()
        self.cells = {
            divmod(c, width): k for k, c in enumerate(cell[starts].tolist())
        } if len(ids) else {}
        self.longest = float(_lengths(self.vectors).max(initial=0))

    def walk(self, anchor: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """Cells from the highest bound down: bound above, bound below, rows from and to."""
        if not self.cells:
            return
        sides = []
        for (words, radius, _), q in zip(self.halves, (anchor[: self.half], anchor[self.half :])):
            middle, reach = words @ q, np.sqrt(float((q**2).sum())) * radius
            # Beyond what rounding may have taken.
            reach = reach + 1e-6 * (np.abs(middle) + reach) + 1e-3
            order = np.argsort(-(middle + reach), kind="stable")
            sides.append((
                order.tolist(), (middle + reach)[order].tolist(), (middle - reach)[order].tolist()
            ))
        (word_a, up_a, low_a), (word_b, up_b, low_b) = sides
        heap = [(-(up_a[0] + up_b[0]), 0, 0)]
        pop, push, cells, bounds = heapq.heappop, heapq.heappush, self.cells, self.bounds
        while heap:
            up, a, b = pop(heap)
            if b == 0 and a + 1 < len(up_a):
                push(heap, (-(up_a[a + 1] + up_b[0]), a + 1, 0))
            if b + 1 < len(up_b):
                push(heap, (-(up_a[a] + up_b[b + 1]), a, b + 1))
            k = cells.get((word_a[a], word_b[b]))
            if k is not None:
                yield -up, low_a[a] + low_b[b], bounds[k], bounds[k + 1]


def visit(
    index: MultiIndex, anchor: np.ndarray, needed: Callable[[], float], above: float,
    take: Callable[[np.ndarray, np.ndarray], None], counted: list[int] | None = None,
) -> None:
    """Score cells in order until none left can reach ``needed``; pass those over ``above``."""
    q = anchor.astype(np.float64)
    bound = index.longest * float(np.sqrt((q**2).sum())) * 1.001 + 1
    wave: list[np.ndarray] = []
    size, least = 0, needed()

    def score() -> None:
        at = np.concatenate(wave)
        take(at, scores(index.vectors[at], anchor, bound))
        if counted is not None:
            counted[0] += len(at)

    for up, low, start, stop in index.walk(q):
        if up < least:
            break
        if low > above:
            continue
        wave.append(np.arange(start, stop))
        size += stop - start
        if size >= WAVE:
            score()
            wave, size, least = [], 0, needed()
    if wave:
        score()


def best(scores_: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first by descending score, then ascending id."""
    order = np.lexsort((ids, ~scores_))[:most]
    return scores_[order], ids[order]


def window(positive: int) -> tuple[int, int]:
    """Least and largest score n with 30 p <= 100 n <= 90 p."""
    return -(-30 * positive // 100), 90 * positive // 100


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _add_positives(found, key, index, anchor_id, anchor, most) -> None:
    kept = found.get(key, _NONE)

    def needed() -> float:
        return float(kept[0][-1]) if len(kept[0]) == most else -np.inf

    def take(at: np.ndarray, s: np.ndarray) -> None:
        nonlocal kept
        ids = index.ids[at]
        fit = ids != anchor_id
        if len(kept[0]) == most:
            fit &= s >= kept[0][-1]
        kept = best(np.r_[kept[0], s[fit]], np.r_[kept[1], ids[fit]], most)

    visit(index, anchor, needed, np.inf, take)
    found[key] = kept


def _add_negatives(found, key, index, label, anchor, positives, most) -> None:
    windows = [window(p) for p in positives]
    kept = [found.get((*key, w), _NONE) for w in range(len(windows))]

    def needed() -> float:
        return min(
            float(max(low, k[0][-1])) if len(k[0]) == most else float(low)
            for (low, _), k in zip(windows, kept)
        )

    def take(at: np.ndarray, s: np.ndarray) -> None:
        other = (index.labels[at] != label) & (s >= needed())
        s, ids = s[other], index.ids[at][other]
        for w, (low, high) in enumerate(windows):
            k = kept[w]
            fit = (s >= max(low, k[0][-1]) if len(k[0]) == most else s >= low) & (s <= high)
            if fit.any():
                kept[w] = best(np.r_[k[0], s[fit]], np.r_[k[1], ids[fit]], most)

    visit(index, anchor, needed, float(max(h for _, h in windows)), take)
    found.update({(*key, w): k for w, k in enumerate(kept) if len(k[0])})


def _part(row: dict) -> tuple:
    codes = np.frombuffer(row["codes"], "<u2").reshape(2, -1)
    return (
        _vectors(row), np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), codes
    )


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _anchors(row: dict) -> tuple[np.ndarray, list[int], list[int]]:
    of = {"vectors": row["a_vectors"], "wide": row["a_wide"], "n": row["a_n"]}
    return (
        _vectors(of), np.frombuffer(row["a_ids"], "<i8").tolist(),
        np.frombuffer(row["a_labels"], "<i8").tolist(),
    )


def _positives(
    batches: Iterator[pa.RecordBatch], books: list[np.ndarray], most: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Best rows of the anchor's label in the parts of this task."""
    found: dict = {}
    names: dict = {}
    for row in _rows_of(batches):
        vectors, ids, labels, codes = _part(row)
        anchors, anchor_ids, anchor_labels = _anchors(row)
        indexes: dict = {}
        for place, (anchor_id, label) in enumerate(zip(anchor_ids, anchor_labels)):
            if label not in indexes:
                own = labels == label
                indexes[label] = MultiIndex(vectors[own], ids[own], labels[own], codes[:, own], books)
            key = (row["round"], place)
            names[key] = anchor_id
            _add_positives(found, key, indexes[label], anchor_id, anchors[place], most)
    out = [
        (*key, names[key], i, s)
        for key, (ss, ids) in found.items() for s, i in zip(ss.tolist(), ids.tolist())
    ]
    yield from _batches(out, schema)


def _negatives(
    batches: Iterator[pa.RecordBatch], books: list[np.ndarray], most: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Best rows of other labels within the windows in the parts of this task."""
    found: dict = {}
    names: dict = {}
    for row in _rows_of(batches):
        index = MultiIndex(*_part(row), books)
        anchors, anchor_ids, anchor_labels = _anchors(row)
        for at in row["windows"]:
            place, positives = at["place"], at["positives"]
            key = (row["round"], place)
            names[key] = (anchor_ids[place], positives)
            _add_negatives(
                found, key, index, anchor_labels[place], anchors[place],
                [p["score"] for p in positives], most,
            )
    out = []
    for (r, place, w), (ss, ids) in found.items():
        anchor_id, positives = names[r, place]
        p = positives[w]
        out += [
            (r, place, w, anchor_id, p["id"], p["score"], i, s)
            for s, i in zip(ss.tolist(), ids.tolist())
        ]
    yield from _batches(out, schema)


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(rows), 50_000):
        columns = zip(*rows[k : k + 50_000])
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema
        )


def hard_negatives(
    embeddings: DataFrame, anchor: Column, label: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """The best negatives in the window of every anchor and positive.

    Takes ``vec_id``, ``embedding`` and ``label`` (or the expression ``label``). Anchors
    are the rows whose ``anchor``, a condition on ``id``, holds. Result: ``anchor_id``,
    ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    * A row with a NULL id, label, vector or component, or one whose components (times
      256) are not finite, takes no part. Rows equal in id, label and vector count once;
      rows that share only the id are rows of their own, though never partners of an
      anchor with that id among the positives.
    * Vectors shorter than the longest count as ended by zeros.
    * Equal scores are ordered by id. Scores beyond a long are held at its bounds.
    * An anchor without positives, or a window without rows, gives none, so does an
      empty table. Columns of other names are not looked at.
    """
    spark = embeddings.sparkSession
    ship_package(spark)
    rows = usable(embeddings, label)
    size = F.size("vector")
    n, n_anchors, dim = rows.agg(
        F.count(F.lit(1)), F.count_if(anchor), F.coalesce(F.max(size), F.lit(2))
    ).first()
    dim = max(2, dim)
    folder = shared_folder(spark, "multi-index")
    part_rows = int(min(PART_ROWS[1], max(PART_ROWS[0], n // 32)))
    sample = rows.orderBy(F.xxhash64("id", "label")).limit(SAMPLE_ROWS).select("vector").toArrow()
    vectors = _whole(sample.column("vector").combine_chunks(), dim)
    words = max(1, round((part_rows / CELL_ROWS) ** 0.5))
    half = dim // 2
    books = [fit_codebook(v, words) for v in (vectors[:, :half], vectors[:, half:])]

    once = rows.distinct()
    parts = once.repartition(max(1, -(-n // part_rows)), "id", "label", "vector")
    parts = stage(
        parts.mapInArrow(
            partial(_pack_parts, books=books, dim=dim, most=PART_ROWS[1], schema=_schema(PARTS)),
            PARTS,
        ),
        f"{folder}/parts",
    )
    n_rounds = max(1, -(-n_anchors // ROUND_ROWS))
    number = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n_rounds)).cast("int")

    def pack_round(group: pa.Table) -> pa.Table:
        return _pack_round(group, dim, _schema(ROUNDS))

    rounds = stage(
        once.filter(anchor).withColumn("round", number).groupBy("round").applyInArrow(
            pack_round, ROUNDS
        ),
        f"{folder}/rounds",
    )
    carried = rounds.select(
        "round", *[F.col(c).alias(f"a_{c}") for c in ("n", "vectors", "wide", "ids", "labels")]
    )

    def each(name: str, function: Callable, schema: str, most: int, with_: DataFrame) -> DataFrame:
        found = partial(function, books=books, most=most, schema=_schema(schema))
        frames = []
        for r in range(n_rounds):
            # One row of at most about ROUND_ROWS anchors; every part meets it.
            one = F.broadcast(with_.filter(F.col("round") == r))
            met = parts.join(one, F.col("zero") + r == F.col("round"))
            frames.append(stage(met.mapInArrow(found, schema), f"{folder}/{name}/{r}"))
        return spark.read.schema(frames[0].schema).parquet(
            *[f"{folder}/{name}/{r}" for r in range(n_rounds)]
        )

    found = each("positives", _positives, FOUND, positives, carried)
    first = Window.partitionBy("round", "place").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(
        F.col("rank") <= positives
    )
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "score", "id"))),
        lambda p: F.struct(p["score"].alias("score"), p["id"].alias("id")),
    )
    windows = (
        ranked.groupBy("round", "place").agg(listed.alias("positives"))
        .groupBy("round").agg(F.collect_list(F.struct("place", "positives")).alias("windows"))
    )
    windows = stage(windows, f"{folder}/windows")
    both = carried.join(F.broadcast(windows), "round")
    found = each("negatives", _negatives, WINDOWED, negatives, both)
    first = Window.partitionBy("round", "place", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).filter(
        F.col("rank") <= negatives
    ).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])
