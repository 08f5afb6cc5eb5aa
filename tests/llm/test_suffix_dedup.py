"""Removed repeats against every string of every text."""

import hashlib

import numpy as np
import pytest
import xxhash

from tamiz.llm import suffix_dedup
from tamiz.llm.suffix_dedup import LENGTH, merge_spans, multikey_order, remove_repeats

SCHEMA = "doc_id long, text string, spans string, kept int"


def brute(rows, length=LENGTH):
    """(id, bytes, spans, kept) by looking every string up."""
    texts = sorted(
        ((i is not None, i or 0, xxhash.xxh64_intdigest((t or "").encode()), (t or "").encode())
         for i, t, *_ in rows)
    )
    seen, out = set(), []
    for known, i, _, text in texts:
        cover = np.zeros(len(text) + 1, bool)
        for p in range(len(text) - length + 1):
            string = text[p : p + length]
            if string in seen:
                cover[p : p + length] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.r_[False, cover[:-1], False].astype(int)))
        spans = tuple(zip(edges[::2].tolist(), edges[1::2].tolist()))
        kept = bytes(np.frombuffer(text, np.uint8)[~cover[:-1]])
        out.append((i if known else None, len(text), spans, kept))
    return sorted(out, key=str)


def found(frame, length=LENGTH):
    rows = remove_repeats(frame, length=length).collect()
    return sorted(
        ((r["doc_id"], r["n_bytes"], tuple((s["start"], s["stop"]) for s in r["spans"]), bytes(r["kept"]))
         for r in rows), key=str,
    )


def corpus(seed, n=120):
    """Texts that share passages, with edits, periods and copies."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcd \n"))

    def text(size):
        return "".join(letters[rng.integers(0, 6, size)])

    passages = [text(k) for k in (40, 99, 100, 101, 130, 180, 260, 400)]
    line = text(80)
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.integers(0, 6)):
            kind = rng.integers(0, 7)
            parts.append(
                [text(int(rng.integers(0, 250))), passages[rng.integers(0, 8)], line + text(5),
                 "ab" * int(rng.integers(20, 120)), " " * int(rng.integers(90, 210)),
                 passages[7][: int(rng.integers(90, 400))], passages[6][int(rng.integers(0, 160)) :]][kind]
            )
        rows.append((i, "".join(parts), "s", i))
    rows += [(n + k, rows[k][1], "s", k) for k in range(0, n, 9)]
    return rows


@pytest.fixture
def small(monkeypatch):
    """Small blocks, slices and buckets, so that all borders are met."""
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 300)
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 8000)


@pytest.mark.parametrize("seed", range(3))
def test_equals_all_strings(spark, small, seed):
    rows = corpus(seed)
    expected = brute(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(7)) == expected
    assert sum(len(s) for _, _, s, _ in expected) > 100


def test_slices_and_frequent_runs(small, monkeypatch):
    """The steps of one machine, with slices of a few bytes and all runs frequent."""
    import zstandard

    rows = corpus(7, 60)
    texts = [t.encode() for _, t, *_ in rows]
    data = b"".join(texts)
    row = {
        "block": 5, "n": len(texts), "bytes": len(data),
        "data": zstandard.ZstdCompressor().compress(data),
        "lens": np.array([len(t) for t in texts], "<i8").tobytes(),
        "known": np.ones(len(texts), "u1").tobytes(),
        "ids": np.arange(len(texts), dtype="<i8").tobytes(),
    }
    expected = [s for _, _, s, _ in sorted(brute(rows), key=lambda r: r[0])]
    every = np.unique(suffix_dedup.run_hashes(np.frombuffer(data, np.uint8)))
    for size in (37, 1 << 18):
        monkeypatch.setattr(suffix_dedup, "SLICE", size)
        for frequent in (every[:0], every[::2], every):
            block = suffix_dedup.Block(row)
            packets = suffix_dedup._suffixes(
                block, 100, suffix_dedup.Frequent(frequent), 4, {}, np.array([b"b"], suffix_dedup._LEAD), 2
            )
            spans = []
            for bucket in (0, 1):
                mine = [p for p in packets if p[0] == bucket]
                if mine:
                    table = suffix_dedup._batch(suffix_dedup._ddl(suffix_dedup.PACKETS), mine)
                    done = suffix_dedup._resolve(suffix_dedup.pa.Table.from_batches([table]), 100)
                    spans += [np.frombuffer(s, "<i8").reshape(3, -1) for s in done.column("spans").to_pylist()]
            text, start, stop = merge_spans(*np.concatenate(spans, axis=1))
            got = [[] for _ in texts]
            for t, a, b in zip(text.tolist(), start.tolist(), stop.tolist()):
                got[t].append((a, b))
            assert [tuple(g) for g in got] == expected


def test_odd_documents(spark, odd_documents, small):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert found(odd_documents) == brute(rows)


def test_no_documents(spark, no_documents):
    assert found(no_documents) == []


def test_another_length(spark, small):
    rows = corpus(11, 60)
    assert found(spark.createDataFrame(rows, SCHEMA), 50) == brute(rows, 50)


def test_multikey_order():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 4, (20_000, 5)).astype(np.uint64)
    order = multikey_order(words)
    assert (words[order] == words[np.lexsort(words.T[::-1])]).all() and len(set(order)) == 20_000


def test_query_equals_all_strings(spark):
    from tamiz.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    expected = {
        (i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, n, spans, kept in brute([tuple(r) for r in source])
    }
    assert {tuple(r) for r in QUERIES["op13_suffix_dedup"](spark, path).collect()} == expected


def test_no_text_moves_again(spark, small, odd_documents, capsys):
    remove_repeats(odd_documents).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1, plan
