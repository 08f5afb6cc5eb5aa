import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tamiz.llm.huffman import (
    canonical_codes, code_lengths, decode_block, decode_table, encode_documents, read_store,
    write_store,
)
from tamiz.llm.license_scan import license_scan
from tamiz.llm.piece_sampling import (
    ALPHA, Lattices, all_segments, decode_ids, decode_pieces, loaded, sample, sample_pieces,
)
from tamiz.llm.warc import derivatives, plain_text, read_warc, responses, write_warc

FILE = path("byte_bpe_50k.json")
MODEL = path("piece_bpe_32k.model")


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    return cost


@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=60))
def test_codes_are_best_and_prefix_free(counts):
    counts = np.array(counts)
    lengths = code_lengths(counts, 40)
    if (counts > 0).sum() > 1:
        assert (lengths.astype(int) * counts).sum() == huffman_cost(counts.tolist())
    short = code_lengths(counts, 6) if (counts > 0).sum() <= 64 else lengths
    used = np.flatnonzero(short)
    assert short.max(initial=0) <= 40 and set(used) == set(np.flatnonzero(counts))
    codes = canonical_codes(short)
    words = [format(int(codes[i]), f"0{short[i]}b") for i in used]
    assert not any(a != b and b.startswith(a) for a in words for b in words)


@settings(deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=700), max_size=6))
def test_blocks_decode_to_their_ids(docs):
    import struct

    flat = np.array([i for d in docs for i in d], np.int64)
    sizes = np.array([len(d) for d in docs], np.int64)
    lengths = code_lengths(np.bincount(flat, minlength=301), 12)
    payload, per_doc, marks, _ = encode_documents(flat, sizes, lengths, canonical_codes(lengths))
    starts = (np.cumsum(per_doc) - per_doc) * 8
    marks = (marks + np.repeat(starts, -(-sizes // 256))).astype("<u4")
    data = b"HTB1" + struct.pack("<3I", len(docs), len(marks), len(payload))
    data += np.arange(len(docs), dtype="<i8").tobytes() + b"\1" * len(docs)
    data += sizes.astype("<u4").tobytes() + marks.tobytes() + payload.tobytes()
    keys, got_sizes, ids = decode_block(data, decode_table(lengths))
    assert keys == list(range(len(docs))) and got_sizes.tolist() == sizes.tolist()
    assert ids.tolist() == flat.tolist()
    with pytest.raises(ValueError):
        decode_block(b"HTB2" + data[4:], decode_table(lengths))


def test_store_round_trip(spark, odd_documents, no_documents, tmp_path):
    library = Tokenizer.from_file(FILE)
    folder = write_store(odd_documents, FILE, f"file://{tmp_path}/a", 2)
    rows = sorted(read_store(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert [r["start"] for r in rows] == [
        int(x) for x in np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1]]
    want = sorted(
        (str(r["doc_id"]), library.encode(r["text"] or "", add_special_tokens=False).ids + [2])
        for r in odd_documents.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in rows) == want
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    empty = write_store(no_documents, FILE, f"file://{tmp_path}/b", 2)
    assert read_store(spark, empty).count() == 0


def test_sampled_pieces_are_lossless_and_repeatable(spark, odd_documents, no_documents):
    def ids(frame, seed=0):
        made = sample_pieces(frame, MODEL, {"doc_id": F.col("doc_id"), "text": F.col("text")},
                             F.col("doc_id"), seed=seed)
        return sorted((str(r["doc_id"]), str(r["text"]), r["ids"]) for r in made.collect())

    first = ids(odd_documents)
    assert ids(odd_documents.repartition(1)) == first and ids(odd_documents, 1) != first
    carried = {"text": F.col("text")}
    made = sample_pieces(odd_documents, MODEL, carried, F.col("doc_id"))
    for r in decode_pieces(made, MODEL).collect():
        assert r["decoded"] == (r["text"] or "")
    assert sample_pieces(no_documents, MODEL, carried, F.col("doc_id")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aé \n▁\x00日🙂the", max_size=60), min_size=1, max_size=6))
def test_any_text_is_lossless(texts):
    import pyarrow as pa

    pieces = loaded(MODEL, ALPHA)
    flat, sizes = all_segments(pa.array(texts, pa.string()))
    coded = flat.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids, counts = sample(which, np.arange(len(which), dtype=np.uint64),
                         Lattices(coded.dictionary, pieces))
    ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes)])]
    got = [decode_ids(ids[a:b].tolist(), pieces) for a, b in zip(ends, ends[1:])]
    assert got == texts


def test_samples_follow_the_weights():
    import math

    import pyarrow as pa

    pieces = loaded(MODEL, 3e-4)
    word, n = "▁thenti", 20_000
    paths = {}

    def walk(i, ids, weight):
        if i == len(word):
            paths[tuple(ids)] = weight
        for j in range(i + 1, len(word) + 1):
            if word[i:j] in pieces.weight:
                number, w = pieces.weight[word[i:j]]
                walk(j, [*ids, number], weight + w)

    walk(0, [], 0.0)
    whole = sum(map(math.exp, paths.values()))
    ids, counts = sample(np.zeros(n, np.int64), np.arange(n, dtype=np.uint64) * np.uint64(7919),
                         Lattices(pa.array([word], pa.large_string()), pieces))
    seen = {}
    for part in np.split(ids, np.cumsum(counts)[:-1]):
        seen[tuple(part.tolist())] = seen.get(tuple(part.tolist()), 0) + 1
    off = sum(abs(seen.get(k, 0) / n - math.exp(w) / whole) for k, w in paths.items()) / 2
    assert set(seen) <= set(paths) and off < 0.02


PAGES = [
    (1, "http://a.example/x", "<html lang=en><title>T &amp; u</title><script>no</script>"
        "<!-- no --><p>One <b>two</b><br>three<a href='/y?a=1&amp;b'>link</a>"),
    (2, None, None), (2, None, None), (3, "http://b.example/", ""),
    (None, "http://c.example/", "<p>unclosed <!-- comment"), (4, "u", "a\r\n\r\nb < c <3"),
]


def test_warc_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    made = derivatives(responses(pages))
    rows = made.collect()
    assert len(rows) == 2 * len(PAGES)
    source = {r["page_id"]: r["record_id"] for r in responses(pages).collect()}
    for r in rows:
        head, block = r["record"].split("\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in head.split("\r\n")[1:])
        assert block == r["block"] and int(fields["Content-Length"]) == len(block.encode())
        assert fields["WARC-Refers-To"] == r["refers_to"] == source[r["page_id"]]
        assert re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"])
        if r["warc_type"] == "metadata":
            assert f"source-payload-digest: {r['source_payload_digest']}" in block
            assert "source-header-content-type: text/html; charset=utf-8" in block
    one = {r["warc_type"]: r["block"] for r in rows if r["page_id"] == 1}
    assert one["conversion"] == "T & u\nOne two\nthreelink"
    assert "title: T & u\r\n" in one["metadata"] and "outlink: /y?a=1&b\r\n" in one["metadata"]
    for how in ("gzip", "none"):
        back = read_warc(spark, write_warc(made, f"file://{tmp_path}/{how}", how))
        got = sorted(map(str, back.collect()))
        assert got == sorted(map(str, made.select(back.columns).collect()))
    none = spark.createDataFrame([], pages.schema)
    assert derivatives(responses(none)).count() == 0


def test_plain_text_tolerates_markup():
    assert plain_text("<style>x<p>kept? no") == ""
    assert plain_text("1 < 2 &lt;b&gt; <i>x</i>") == "1 < 2 <b> x"


FILES = [
    (1, "p/LICENSE", "Some words.\nReleased under the MIT License.\n"),
    (2, "p/a/x.py", "code = 1"), (3, "p/a/b/COPYING", "Licensed under CC BY-NC 4.0."),
    (4, "p/a/b/y.py", None), (5, "p/a/b/c/d/z.py", ""),
    (6, "p/q.py", "# Licensed under the Apache License, Version 2.0.\nx"), (7, "q/x", "nothing"),
    (8, None, "Released under the MIT License."), (9, "top.py", "the license of the house"),
    (2, "p/a/x.py", "code = 1"), (10, "p/a/README", "Licensed under CC BY-NC 4.0."),
    (11, "p/a/other", "plain"),
]


def test_licenses_come_from_the_nearest_directory(spark):
    files = spark.createDataFrame(FILES, "doc_id long, path string, text string")
    files = files.withColumn("score", F.lit("clash"))
    rows = license_scan(files).collect()
    got = {r["doc_id"]: (r["license"], r["license_from"], r["inherited"]) for r in rows}
    assert len(rows) == len(FILES)
    mit, nc = ("MIT", "p/LICENSE"), ("CC-BY-NC-4.0", "p/a/b/COPYING")
    assert got == {
        1: (*mit, False), 2: (*mit, True), 3: (*nc, False), 4: (*nc, True), 5: (*nc, True),
        6: ("Apache-2.0", "p/q.py", False), 7: (None, None, False), 8: (None, None, False),
        9: (None, None, False), 10: ("CC-BY-NC-4.0", "p/a/README", False), 11: (*mit, True),
    }
    none = spark.createDataFrame([], "doc_id long, path string, text string")
    assert license_scan(none).count() == 0


def test_lattices_that_are_kept_give_the_same_pieces(spark, odd_documents, monkeypatch):
    """Dropping kept lattices, or never keeping any, changes no segmentation."""
    from pyspark.sql import functions as F

    from tamiz.llm import piece_sampling as P

    pieces = loaded(MODEL, ALPHA)
    words = pa.array(["\u2581the", "\u2581cat", "x" * 50, "\u2581日本", "\u2581\u2581", "a"] * 1, pa.large_string())
    seeds = np.arange(600, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    which = np.arange(600) % len(words)
    fresh = Lattices(words, pieces)
    expected = sample(which, seeds, fresh)
    kept = P.Kept(pieces)
    kept.numbers(words.slice(3))
    kept.numbers(words.slice(0, 2))
    numbers = kept.numbers(words)
    for got, want in zip(sample(numbers[which], seeds, kept), expected):
        assert (got == want).all()
    before = len(kept.last)
    kept.numbers(words)
    assert len(kept.last) == before
    monkeypatch.setattr(P, "KEPT_EDGES", 0)
    for got, want in zip(sample(kept.numbers(words)[which], seeds, kept), expected):
        assert (got == want).all()


def test_sampled_pieces_tell_whether_they_are_lossless(spark, odd_documents):
    from pyspark.sql import functions as F

    carried = {"kept": F.col("kept"), "text": F.coalesce("text", F.lit(""))}
    made = sample_pieces(odd_documents, MODEL, carried, F.col("doc_id"), verify="ids_ok")
    assert made.columns == ["kept", "text", "ids", "ids_crc32", "ids_ok"]
    assert made.filter("NOT ids_ok OR ids_ok IS NULL").count() == 0
    back = decode_pieces(made.select("text", "ids"), MODEL)
    assert back.filter("NOT decoded <=> text").count() == 0
    plain = sample_pieces(odd_documents, MODEL, carried, F.col("doc_id"))
    assert plain.exceptAll(made.drop("ids_ok")).count() == 0
