"""Hard negatives against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm.hard_negatives import MultiIndex, fit_codebook, hard_negatives, nearest, visit, window

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, score string"


def brute(rows, anchors=lambda i: i % 100 == 0):
    fit = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(256 * x) for x in v):
            continue
        fit[i, label, tuple(v)] = [int(np.floor(256 * x)) for x in v]
    out = set()
    for (i, label, _), a in fit.items():
        if not anchors(i):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(a, b)), j, m) for (j, m, _), b in fit.items()
        )
        positives = [(-s, j) for s, j, m in scored if m == label and j != i][:5]
        for ps, p in positives:
            hits = [(j, -s) for s, j, m in scored if m != label and 30 * ps <= -100 * s <= 90 * ps]
            out |= {(i, p, r, j, ps, s) for r, (j, s) in enumerate(hits[:10], 1)}
    return out


def found(frame, every=100):
    rows = hard_negatives(frame, F.col("id") % every == 0).collect()
    assert len(rows) == len(set(rows))
    return {tuple(r) for r in rows}


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(6, 9))
    rows = []
    for i in range(900):
        v = middle[i % 6] + rng.normal(size=9) * (0.05 if i % 3 else 0.6)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], int(i % 4), "r", "s"))
    return rows


def test_equals_all_scores(spark, table):
    frame = spark.createDataFrame(table, SCHEMA).repartition(5)
    expected = brute(table)
    assert found(frame) == expected and len(expected) > 200


def test_odd_rows(spark, table):
    rows = table[:160] + [
        (200, None, 1, "", ""), (300, [0.1, None], 1, "", ""), (None, [0.1] * 9, 1, "", ""),
        (400, [0.1] * 9, None, "", ""), (500, [float("nan")] * 9, 1, "", ""),
        (600, [float("inf")] * 9, 1, "", ""), (601, [1e307] * 9, 1, "", ""),
        (700, [0.25, 0.5], 2, "", ""), (701, [], 2, "", ""), (800, [], 3, "", ""),
        table[100], table[100], (100, table[7][1], 3, "", ""), (0, [0.0] * 9, 0, "", ""),
        (1000, table[5][1], 1, "", ""), (1001, table[5][1], 1, "", ""), (1002, table[5][1], 0, "", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(frame) == brute(rows)


def test_numbers_beyond_double_precision(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(1, 1 << 22, 4)], int(i % 2), "", "") for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(frame, 3) == brute(rows, lambda i: i % 3 == 0)


def test_no_rows(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == set()
    assert found(spark.createDataFrame([(0, [1.0], 1, "", "")], SCHEMA)) == set()


def test_visits_stop_once_certified():
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(40, 16)) * 300
    rows = np.floor(middle[rng.integers(0, 40, 20_000)] + rng.normal(size=(20_000, 16)) * 8)
    books = [fit_codebook(h, 18) for h in (rows[:4000, :8], rows[:4000, 8:])]
    codes = np.array([nearest(rows[:, :8], books[0]), nearest(rows[:, 8:], books[1])])
    index = MultiIndex(rows, np.arange(20_000), np.zeros(20_000, int), codes, books)
    scores, kept, counted = index.vectors @ rows[3], np.zeros(0), [0]

    def take(at, s):
        nonlocal kept
        assert (s == scores[at]).all()
        kept = np.sort(np.r_[kept, s])[::-1][:5]

    visit(index, rows[3], lambda: kept[-1] if len(kept) == 5 else -np.inf, np.inf, take, counted)
    assert (kept == np.sort(scores)[::-1][:5]).all() and counted[0] < 10_000


def test_windows():
    for p in (-7, 0, 1, 3, 10, 99, 12345):
        low, high = window(p)
        inside = [s for s in range(-20, 12346) if 30 * p <= 100 * s <= 90 * p]
        assert inside == list(range(max(low, -20), high + 1))


def test_query_equals_all_scores(spark):
    from tamiz.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = [
        (r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
        for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()
    ]
    assert {tuple(r) for r in QUERIES["op11_hard_negatives"](spark, path).collect()} == brute(rows)
