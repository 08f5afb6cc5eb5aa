import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm.line_crf import (
    _Chains, document_features, fit_field, held_out, passing, score, train,
)


def brute_good(unary, trans):
    """Marginals by summing over all labellings."""
    n = len(unary)
    total, good = 0.0, np.zeros(n)
    for labels in itertools.product((0, 1), repeat=n):
        w = sum(u for u, y in zip(unary, labels) if y)
        w += sum(trans[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(w)
        good += np.exp(w) * np.array(labels)
    return good / total


def test_marginals_of_chains_of_any_length():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 7, 2, 7])
    unary, trans = rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    got = _Chains(lengths).good(unary, trans)
    at = 0
    for n in lengths:
        assert np.allclose(got[at : at + n], brute_good(unary[at : at + n], trans))
        at += n


def test_gradient_leads_to_the_labels():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 9, 200)
    labels = rng.integers(0, 2, 200)
    x = rng.normal(size=(lengths.sum(), 48)) + 0.7 * np.repeat(labels, lengths)[:, None]
    field = fit_field(x, lengths, labels, steps=60)
    good = _Chains(lengths).good(field.evidence(x), field.transitions)
    means = np.add.reduceat(good, np.cumsum(lengths) - lengths) / lengths
    assert ((means > 0.5) == labels).mean() > 0.97
    assert field.transitions[0, 0] + field.transitions[1, 1] > field.transitions[0, 1]


def test_features_of_odd_texts(odd_documents):
    for r in odd_documents.collect():
        features, sizes = document_features(r["text"])
        assert features.shape == (len(sizes), 48) and np.isfinite(features).all()
        assert len(sizes) >= 1 and (sizes > 0).all()


def test_score_rows_and_tables(spark, odd_documents, no_documents):
    labelled = spark.createDataFrame(
        [(i, "The house of the man was on the hill." if i % 2 else "buy### now$$$ x%%%", i % 2)
         for i in range(60)], "doc_id long, text string, quality int")
    field = train(labelled)
    scored = score(odd_documents, field, {"doc_id": F.col("doc_id")})
    assert scored.count() == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    assert score(no_documents, field, {"doc_id": F.col("doc_id")}).count() == 0
    assert passing(odd_documents, field, 0.0).columns == odd_documents.columns
    assert {r["quality"] for r in passing(labelled, field, 0.3).collect()} == {1}


def test_fields_without_both_labels(spark, odd_documents):
    none = spark.createDataFrame([], "doc_id long, text string, quality int")
    one = spark.createDataFrame([(1, "a", 0), (None, "b", 1), (2, "c", None)], none.schema)
    for rows, verdict in ((none, True), (one, False)):
        scores = score(odd_documents, train(rows), {}).collect()
        assert all((r["score"] > 0.5) == verdict for r in scores)


def test_held_out_rows(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for r in rows.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect():
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["h"] == want


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    data = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{data}/labels.parquet")
    rows = entry.queries()["op10_quality_classifier"](spark, data).join(labels, "doc_id")
    held = rows.filter("held_out").collect()
    assert len(held) > 30
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95


def test_a_text_beyond_the_bound_is_passed_over(spark):
    """Whatever the order of rows, a long labelled text does not end the sample."""
    rows = [(i, "The house of the man was on the hill.\n" * 3 if i % 2 else "buy### now$$$ x%%%", i % 2)
            for i in range(60)]
    schema = "doc_id long, text string, quality int"
    long = [(1000 + i, "the line is here\n" * 400, i % 2) for i in range(2)]
    fields = [
        train(spark.createDataFrame(mixed, schema).coalesce(1), max_lines=200)
        for mixed in (long + rows, rows + long, rows[::-1] + long)
    ]
    for field in fields:
        assert np.abs(field.weights).sum() > 0
        assert np.allclose(field.weights, fields[0].weights)
    with pytest.raises(ValueError, match="fits"):
        train(spark.createDataFrame(long, schema), max_lines=200)
