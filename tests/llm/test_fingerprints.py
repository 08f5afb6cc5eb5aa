import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tamiz.llm.fingerprints import (
    FRACTION, containment, digest, edited_fingerprints, merge, neighbours, with_sketch,
)


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_edited_texts_follow_the_order(odd_documents):
    rows = [r.asDict() for r in edited_fingerprints(odd_documents).collect()]
    assert len(rows) == odd_documents.count()
    named = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
    single = [i for i in sorted(named) if i != 6]
    for a, b in zip(single, single[1:]):
        if 6 in (a, b) or b - a != 1:
            continue
        t, nxt = named[a], named[b]
        q = len(t) // 4
        r = next(r for r in rows if r["doc_id"] == a)
        assert r["n_chars"] == len(t) and r["edited"] == t[: len(t) - q] + nxt[:q]
    assert len({str(r["own_sketch"]) for r in rows if r["doc_id"] in (6, 7)}) == 1


def test_single_and_empty_tables(spark, no_documents):
    one = spark.createDataFrame([(1, "abcd efgh")], "doc_id long, text string")
    row = edited_fingerprints(one).first()
    assert row["edited"] == "abcd efab" and row["next_sketch"] == row["own_sketch"]
    assert edited_fingerprints(no_documents).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 20])
def test_neighbours_form_a_ring(spark, ranges):
    rows = spark.createDataFrame([(i * 7 % 50,) for i in range(50)] + [(3,), (None,)], "k long")
    got = neighbours(rows, ["k"], ranges).collect()
    order = [None, *range(50)]
    after = dict(zip(order, order[1:] + order[:1]))
    assert {r["k"]: r["after"]["k"] for r in got} == after
    assert {r["after"]["k"]: r["k"] for r in got} == {r["k"]: r["before"]["k"] for r in got}


def test_sketch_is_the_hashes_below_the_cut(spark):
    texts = [" ".join(f"w{i * k % 97}" for i in range(n)) for k, n in ((1, 400), (3, 4), (5, 40))]
    rows = spark.createDataFrame(list(enumerate([*texts, "", None])), "i int, text string")
    cut = -(1 << 63) + int(FRACTION * (1 << 64))
    for r in with_sketch(rows, "text", "s").collect():
        n = len(shingles(r["text"]))
        assert r["s"] == sorted(set(r["s"])) and bool(r["s"]) == bool(n)
        assert len(r["s"]) == 1 or all(h < cut for h in r["s"])
        if n > 100:
            assert 0.1 * n < len(r["s"]) < 0.45 * n


def test_containment_of_unequal_documents(spark):
    long = [f"v{i * i % 1009}x{i}" for i in range(4000)]
    parts = [(0, " ".join(long)), (1, " ".join(long[1000:1400])), (2, "none of it is in there at all")]
    s = with_sketch(spark.createDataFrame(parts, "i int, text string"), "text", "s")
    a, b, c = [s.filter(F.col("i") == k).select(F.col("s").alias(n)) for k, n in enumerate("abc")]
    row = a.crossJoin(b).crossJoin(c).select(
        containment(F.col("a"), F.col("b")).alias("in_it"),
        containment(F.col("a"), F.col("c")).alias("not_in_it"),
        (merge(F.col("a"), F.col("b")) == F.col("a")).alias("merged"),
        containment(F.array().cast("array<bigint>"), F.array().cast("array<bigint>")).alias("none"),
        digest(F.col("a")).alias("d"),
    ).first()
    assert row["in_it"] == 1.0 and row["not_in_it"] == 0.0 and row["merged"] and row["none"] == 1
    assert re.fullmatch("[0-9a-f]{32}", row["d"])


def test_registered_query_against_brute_force(spark):
    import __spark_entry__ as entry

    data = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"] or "") for r in
                  spark.read.parquet(f"{data}/documents.parquet").collect())
    got = {r["doc_id"]: r for r in entry.queries()["op7_document_fingerprints"](spark, data).collect()}
    off = 0.0
    for k, (i, t) in enumerate(docs):
        nxt = docs[(k + 1) % len(docs)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingles(t), shingles(edited)
        off += abs(got[i]["near_edited"] - (len(a & b) / min(len(a), len(b)) if a and b else a == b))
    assert off / len(docs) < 0.1
