"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. Its features are its own counts and those
of the lines before and after it; neighbouring labels are tied by transition
weights. The field is fitted on the driver on a bounded sample of labelled
documents, whose lines all take the document's label. Scoring runs forward-backward
on every document and weighs the chance that a line is good by its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package
from .quality_rules import STOP_WORDS, SYMBOLS
from .words import lines_with_words

# Bounds of the training sample: documents, and lines over all of them.
MAX_DOCUMENTS = 3_000
MAX_LINES = 200_000
STEPS = 120
_STOPS = frozenset(STOP_WORDS)
_TERMINAL = frozenset(".!?\"'")
_BLANKS = " \t\n\x0b\x0c\r"
# Texts scored together, which bounds a worker's memory.
_CHARS_AT_ONCE = 8_000_000


def line_features(line: str) -> list[float]:
    """Counts of a line as ratios; a line without words has zeros."""
    words = line.split()
    n = len(words)
    if not n:
        return [0.0] * N_OWN
    size = len(line)
    lowered = line.lower().split()
    stops = sum(map(_STOPS.__contains__, lowered))
    symbols = sum(map(line.count, SYMBOLS))
    repeats = sum(map(str.__eq__, words, words[1:]))
    upper = sum(map(str.isupper, words))
    tail = line.rstrip()[-1]
    return [
        1.0,
        np.log1p(n),
        stops / n,
        min(symbols / n, 3.0),
        1.0 if symbols else 0.0,
        repeats / n,
        1.0 - len(set(lowered)) / n,
        upper / n,
        min(line.count("!") / n, 3.0),
        min(size / n, 20.0) / 10.0,
        min(line.count(".") / n, 3.0),
        1.0 if tail in _TERMINAL else 0.0,
        1.0 if line[0].isupper() else 0.0,
        sum(map(str.isdigit, words)) / n,
        1.0 if n < 5 else 0.0,
        1.0 if n >= 20 and stops * 20 < n else 0.0,
    ]


N_OWN = 16


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line with a word, their lengths); such lines are never absent:
    a text without any counts as one line without words."""
    lines = [x for x in (text or "").split("\n") if x.strip(_BLANKS)]
    if not lines:
        lines = [""]
    own = np.array([line_features(x) for x in lines])
    empty = np.zeros((1, N_OWN))
    before, after = np.vstack([empty, own[:-1]]), np.vstack([own[1:], empty])
    return np.hstack([own, before, after]), np.array([max(len(x), 1) for x in lines], float)


@dataclass(frozen=True)
class LineField:
    """Weights of a fitted field; a label is 0 (bad) or 1 (good)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # evidence for a good line
    bias: float
    transitions: np.ndarray  # [label before, label]

    def evidence(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.scale) @ self.weights + self.bias


def _logadd(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


class _Chains:
    """Chains of different lengths side by side, the longest first."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        longest = int(self.lengths[0]) if len(lengths) else 0
        # Number of chains that reach position t.
        self.active = np.searchsorted(-self.lengths, -np.arange(1, longest + 1), side="right")

    def passes(self, unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, ...]:
        """Forward and backward log messages per line and the log sum per chain.

        ``unary``: evidence of label 1 per line, label 0 has none.
        """
        total = len(unary)
        forward, backward = np.zeros((total, 2)), np.zeros((total, 2))
        for t, k in enumerate(self.active):
            at = self.starts[:k] + t
            if t:
                last = forward[at - 1]
                step = _logadd(last[:, :1] + trans[0], last[:, 1:] + trans[1])
            else:
                step = np.zeros((k, 2))
            step[:, 1] += unary[at]
            forward[at] = step
        for t in range(len(self.active) - 2, -1, -1):
            k = self.active[t + 1]
            at = self.starts[:k] + t
            ahead = backward[at + 1].copy()
            ahead[:, 1] += unary[at + 1]
            backward[at] = _logadd(trans[:, 0] + ahead[:, :1], trans[:, 1] + ahead[:, 1:])
        end = forward[self.starts + self.lengths - 1]
        return forward, backward, _logadd(end[:, 0], end[:, 1])

    def good(self, unary: np.ndarray, trans: np.ndarray) -> np.ndarray:
        """Chance that each line is good, given its whole document."""
        forward, backward, _ = self.passes(unary, trans)
        both = forward + backward
        return 1.0 / (1.0 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700)))


def fit_field(
    features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, steps: int = STEPS,
    ridge: float = 1e-3, rate: float = 0.15,
) -> LineField:
    """Penalised maximum likelihood of the label sequences, by Adam on all chains.

    ``labels`` holds one label per chain, that of all its lines. Without any chain,
    or with one label only, the field gives that label (good if there is none).
    """
    width = 3 * N_OWN
    if not len(labels) or labels.min() == labels.max():
        sure = 5.0 if not len(labels) or labels.max() else -5.0
        return LineField(np.zeros(width), np.ones(width), np.zeros(width), sure, np.zeros((2, 2)))
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = (features - mean) / scale
    chains = _Chains(lengths)
    y = np.repeat(labels, lengths).astype(float)
    begin = np.cumsum(lengths) - lengths
    inner = np.ones(len(x), bool)
    inner[begin] = False
    later = np.flatnonzero(inner)
    same = np.array([[np.sum(y[later] == 0), 0.0], [0.0, np.sum(y[later] == 1)]])
    theta = np.zeros(width + 5)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    per_chain = np.empty(len(lengths))
    for i in range(1, steps + 1):
        trans = theta[width + 1 :].reshape(2, 2)
        unary = x @ theta[:width] + theta[width]
        forward, backward, total = chains.passes(unary, trans)
        per_chain[chains.order] = total
        z = np.repeat(per_chain, lengths)
        p = np.exp(forward[:, 1] + backward[:, 1] - z)
        expected = np.empty((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                pair = forward[later - 1, a] + trans[a, b] + backward[later, b] - z[later]
                expected[a, b] = np.exp(pair + (unary[later] if b else 0.0)).sum()
        gap = p - y
        gradient = np.concatenate(
            [x.T @ gap, [gap.sum()], (expected - same).ravel()]
        ) / len(lengths) + ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return LineField(
        mean, scale, theta[:width], float(theta[width]), theta[width + 1 :].reshape(2, 2)
    )


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            features, _ = document_features(batch.column("text")[row].as_py())
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: batch.column(c).slice(row, 1) for c in ("at", "label", "tie", "n")},
                    "lines": pa.array([len(features)], pa.int64()),
                    "features": pa.array([features.ravel().tolist()]),
                }
            )


def train(
    labelled: DataFrame, label: str = "quality", text: str = "text", order: str = "doc_id",
    max_documents: int = MAX_DOCUMENTS, max_lines: int = MAX_LINES, steps: int = STEPS,
) -> LineField:
    """Fit on at most ``max_documents`` labelled rows, chosen by a hash of ``order``.

    The driver receives numbers of the sample's lines, never texts, and at most
    ``max_lines`` lines: rows are taken in the order of the hash, equal hashes by
    label and a hash of the text, and one that does not fit any more is passed over
    by itself. Rows with a NULL label or key are left out; a NULL text is an empty
    document. If rows of a label are among the chosen ones but none of them fits, a
    ValueError says so.
    """
    ship_package(labelled.sparkSession)
    usable = labelled.filter(
        F.col(f"`{label}`").isNotNull() & F.col(f"`{order}`").isNotNull()
    ).select(
        F.xxhash64(F.col(f"`{order}`").cast("string")).alias("at"),
        F.col(f"`{label}`").cast("int").alias("label"), F.col(f"`{text}`").alias("text"),
    )
    last = usable.select("at").orderBy("at").limit(max_documents).agg(F.max("at")).first()[0]
    # Rows with equal hashes may be more than documents asked for; they are cut below.
    sample = usable.filter(F.col("at") <= F.lit(last).cast("long")).withColumn(
        "tie", F.xxhash64("text")
    )
    # As document_features counts: lines with a character other than blanks, or one.
    n_lines = F.greatest(F.size(lines_with_words(F.col("text"))), F.lit(1)).cast("long")
    sizes = sample.select("at", "label", "tie", n_lines.alias("lines"))
    order_by = ["at", "label", "tie"]
    wanted: dict[tuple, int] = {}
    seen: set[int] = set()
    held = 0
    for row in sizes.orderBy(*order_by).limit(max_documents).collect():
        seen.add(row["label"])
        if held + row["lines"] <= max_lines:
            held += row["lines"]
            name = (row["at"], row["label"], row["tie"])
            wanted[name] = wanted.get(name, 0) + 1
    missing = seen - {name[1] for name in wanted}
    if missing:
        raise ValueError(
            f"no sampled row labelled {sorted(missing)} fits into {max_lines} lines"
        )
    if not wanted:
        return fit_field(np.zeros((0, 3 * N_OWN)), np.array([], int), np.array([], int), steps)
    # At most max_documents names.
    named = labelled.sparkSession.createDataFrame(
        [(*name, n) for name, n in wanted.items()], "at long, label int, tie long, n int"
    )
    chosen = sample.join(F.broadcast(named), order_by).select(*order_by, "n", "text")
    schema = "at long, label int, tie long, n int, lines long, features array<double>"
    taken: dict[tuple, tuple[np.ndarray, int]] = {}
    for row in chosen.dropDuplicates(order_by).mapInArrow(_featured, schema).toLocalIterator():
        taken[(row["at"], row["label"], row["tie"])] = (
            np.array(row["features"]).reshape(row["lines"], -1), row["n"]
        )
    features, labels = [], []
    for name in wanted:  # in hash order, whatever the files
        part, n = taken[name]
        features += [part] * n
        labels += [name[1]] * n
    lengths = np.array([len(x) for x in features], int)
    return fit_field(np.vstack(features), lengths, np.array(labels, int), steps)


def _score_texts(field: LineField, texts: Sequence[str | None]) -> list[float]:
    parts = [document_features(t) for t in texts]
    if not parts:
        return []
    lengths = np.array([len(f) for f, _ in parts])
    unary = field.evidence(np.vstack([f for f, _ in parts]))
    good = _Chains(lengths).good(unary, field.transitions)
    weight = np.concatenate([w for _, w in parts])
    begin = np.cumsum(lengths) - lengths
    return (np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin)).tolist()


def _scored(
    batches: Iterator[pa.RecordBatch], field: LineField, text: str, name: str
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores: list[float] = []
        group: list[str | None] = []
        held = 0
        for value in batch.column(text):
            group.append(value.as_py())
            held += len(group[-1] or "")
            if held >= _CHARS_AT_ONCE:
                scores += _score_texts(field, group)
                group, held = [], 0
        scores += _score_texts(field, group)
        keep = [i for i, c in enumerate(batch.schema.names) if c != text]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array(scores, pa.float64())],
            names=[*[batch.schema.names[i] for i in keep], name],
        )


def score(documents: DataFrame, field: LineField, carried: dict[str, Column],
          text: str = "text") -> DataFrame:
    """The ``carried`` columns and ``score``, 0 to 1, of every row.

    The score is the share of a document's characters in good lines, each line
    weighed by its chance. NULL, empty and blank texts score as one line without
    words; whole texts are read; repeated rows score alike, each by itself; an
    empty table gives an empty result.
    """
    ship_package(documents.sparkSession)
    picked = documents.select(
        *[c.alias(n) for n, c in carried.items()], F.col(f"`{text}`").alias("__text")
    )
    fields = [f for f in picked.schema.fields if f.name != "__text"]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    scored = partial(_scored, field=field, text="__text", name="score")
    return picked.mapInArrow(scored, schema)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: CRC-32 of its key as text, modulo the folds."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def passing(documents: DataFrame, field: LineField, threshold: float, text: str = "text"
            ) -> DataFrame:
    """Rows that score ``threshold`` or more, with the columns they came with."""
    whole = {"row": F.struct("*")}
    return score(documents, field, whole, text).filter(F.col("score") >= threshold).select("row.*")
