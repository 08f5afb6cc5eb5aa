import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from tamiz.llm.token_counts import pack_numbers, token_counts, unpack_numbers
from tamiz.llm.tokens import Encoder, rounds

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
LETTERS = "aZé 日́\n\t  .,'st1<|>\x00\x1c"


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    return Encoder(path(request.param)), Tokenizer.from_file(path(request.param))


def same(pair, texts):
    enc, library = pair
    ids, sizes = enc.encode(pa.array(texts, pa.string()))
    ends = np.cumsum(sizes)
    for t, a, b in zip(texts, ends - sizes, ends):
        assert ids[a:b].tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def test_ids_are_the_librarys(pair, odd_documents):
    same(pair, [r["text"] for r in odd_documents.collect()])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=30), min_size=1, max_size=8))
def test_ids_are_the_librarys_on_any_text(pair, texts):
    same(pair, texts + ["<|endoftext|>".join(texts)])


def test_rounds_keep_rows():
    batch = pa.record_batch({"text": ["a" * n for n in (5, 0, 20, 3, 3)] + [None]})
    parts = list(rounds(batch, "text", 8))
    assert sum(p.num_rows for p in parts) == 6 and all(p.num_rows for p in parts)


@given(st.lists(st.integers(0, 2**34), max_size=50))
def test_packed_numbers(values):
    data, sizes = pack_numbers(np.array(values, np.int64))
    assert unpack_numbers(data).tolist() == values and sizes.sum() == len(data)


@pytest.mark.parametrize("file", FILES)
def test_counts_of_whole_texts(spark, odd_documents, no_documents, file):
    library = Tokenizer.from_file(path(file))
    want = sorted(
        (str(r["doc_id"]), len((r["text"] or "").encode()),
         len(library.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in odd_documents.collect()
    )
    got = token_counts(odd_documents, path(file)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert token_counts(no_documents, path(file)).count() == 0


def test_hard_chunks_that_are_kept_give_the_same_ids():
    """The second time a chunk comes from the cache; case and white space tell chunks apart."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    texts = ["Ünï 12,345 don't", "ünï 12,345 DON'T", " 日本 🙂", "日本 🙂 ", "x" * 300 + "1"] * 2
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        enc, library = Encoder(path(name)), Tokenizer.from_file(path(name))
        library.no_truncation()
        library.no_padding()
        for _ in range(3):
            ids, sizes = enc.encode(pa.array(texts))
            want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
            assert ids.tolist() == [i for w in want for i in w]
            assert sizes.tolist() == [len(w) for w in want]
        assert enc._hard


def test_words_and_marks_behind_them_are_encoded_once_each():
    """Runs of marks and line ends do not make chunks of their own out of known words."""
    enc, library = Encoder(path(FILES[0])), Tokenizer.from_file(path(FILES[0]))
    calls = []

    class Counted:
        def encode_batch(self, chunks, **kind):
            calls.extend(chunks)
            return library.encode_batch(chunks, **kind)

    enc.tokenizer = Counted()
    words = ["wey", "äthor", "MIN"]
    texts = [f"{a}{m}\n{b}{m} {a}" for a in words for b in words for m in ("$$$", ".", "?!", "***")]
    texts += ["can't.", "a\n\nb", "x<|endoftext|>y.", "a1.b", "\na.", "b.\n", "c. \nd"]
    ids, sizes = enc.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert not any(w in c for c in calls for w in words)


def test_pretokens_are_kept_when_a_half_of_the_cache_is_full(monkeypatch):
    from tamiz.llm import tokens

    monkeypatch.setattr(tokens, "CACHE", 20)
    enc, library = Encoder(path(FILES[0])), Tokenizer.from_file(path(FILES[0]))
    texts = [" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9)) for j in range(9)] * 3
    for t in texts:
        ids, _ = enc.encode(pa.array([t]))
        assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(enc._known) <= 10 and len(enc._older) <= 10


@given(st.lists(st.text(alphabet="ab\x00é", max_size=3), max_size=6))
def test_listed(values):
    from tamiz.llm.tokens import listed

    assert listed(pa.array(values, pa.string())) == values
    assert listed(pa.array(values, pa.large_string())) == values
