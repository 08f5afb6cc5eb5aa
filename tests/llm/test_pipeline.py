"""The corpus pipeline, stage by stage and as a whole."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tamiz.llm.line_crf import score
from tamiz.llm.queries import QUALITY, QUERIES, table, tokenizer_path, train_quality
from tamiz.llm.simhash import simhash

DATA = "/root/testdata/sf0.001"
FILTERS = P.STAGES[:-1]


@pytest.mark.parametrize("name, stage", FILTERS)
def test_filtering_stages_keep_columns_and_take_odd_rows(spark, odd_documents, name, stage):
    kept = stage(spark, odd_documents, DATA)
    assert kept.columns == odd_documents.columns and kept.schema == odd_documents.schema
    rows, given = kept.collect(), [tuple(r) for r in odd_documents.collect()]
    for r in rows:
        given.remove(tuple(r))  # every row comes from the input, and no more often
    # Columns named like helpers or results of the stage.
    clash = odd_documents.withColumns(
        {c: F.lit(c) for c in ("score", "key", "group", "fingerprint", "n_words", "__n", "__hash")}
    )
    again = stage(spark, clash, DATA)
    assert again.columns == clash.columns and again.count() == len(rows)


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stages_of_no_documents(spark, no_documents, name, stage):
    assert stage(spark, no_documents, DATA).count() == 0


def test_packing_takes_odd_rows(spark, odd_documents):
    packed = P.best_fit_packing(spark, odd_documents, DATA)
    assert packed.columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    ]
    assert packed.filter("piece = 0").count() == odd_documents.count()


def _near(prints):
    """Smallest key of everything reachable over links of at most three bits."""
    keys = list(prints)
    least = {k: k for k in keys}
    while True:
        before = dict(least)
        for a in keys:
            for b in keys:
                if (prints[a] ^ prints[b]).bit_count() <= 3:
                    least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return least


def test_run_equals_plain_stages(spark):
    """Rules and scores from their operators, near copies and packing by hand."""
    documents = table(spark, DATA, "documents")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    good = {r["doc_id"] for r in QUERIES["op8_quality_rules"](spark, DATA).collect() if r["kept"]}
    field = train_quality(documents, table(spark, DATA, "labels"))
    scores = {
        r["doc_id"]: r["score"] for r in score(documents, field, {"doc_id": F.col("doc_id")}).collect()
    }
    good = {d for d in good if scores[d] >= QUALITY}
    least = _near({d: simhash((texts[d] or "").encode()) for d in good})
    expected = {d for d in good if least[d] == d}
    rows = P.run(spark, DATA).collect()
    assert {r["doc_id"] for r in rows} == expected and len(good) > len(expected) > 20
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    library.no_truncation()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, own in pieces.items():
        n = len(library.encode(texts[d] or "", add_special_tokens=False).ids) + 1
        starts = range(0, n, 2048)
        assert sorted(own) == [(i, s, min(2048, n - s)) for i, s in enumerate(starts)]
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("op")))
def test_registered_queries_run_over_their_whole_table(spark, name):
    """One row per row of the table where the contract says so, rows at all otherwise."""
    found = QUERIES[name](spark, DATA)
    per_document = {1, 4, 5, 7, 8, 10, 13, 2, 9}
    number = int(name[2:].split("_")[0])
    if number in per_document:
        ids = sorted(r["doc_id"] for r in found.select("doc_id").collect())
        assert ids == sorted(r["doc_id"] for r in table(spark, DATA, "documents").select("doc_id").collect())
    else:
        assert found.count() > 0
