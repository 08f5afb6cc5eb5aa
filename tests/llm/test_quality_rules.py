import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tamiz.llm.quality_rules import COUNTS, STOP_WORDS, SYMBOLS, passing, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                covered.update(range(i, i + 5))
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_lines": len(lines), "n_stop_words": sum(w.lower() in STOP_WORDS for w in words),
        "n_adjacent_repeats": sum(a == b for a, b in zip(words, words[1:])),
        "base_failed": n < 10 or 100 * len(covered) > 20 * n,
    }


def check(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules(rows).collect():
        want = brute(texts[r["doc_id"]])
        assert {k: r[k] for k in want} == want, texts[r["doc_id"]]
        assert not (r["kept"] and r["base_failed"])


def test_counts_agree_with_brute_force(spark, odd_documents):
    texts = [r["text"] for r in odd_documents.collect()]
    repeats = ["a b c d e " * 3, "q " * 9, "p " * 5, "p p p p p p", "a b c d e f a b c d e"]
    check(spark, texts + repeats)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#.é", max_size=60), min_size=1, max_size=20))
def test_counts_agree_on_any_text(spark, texts):
    check(spark, texts)


def test_rows_columns_and_empty_tables(odd_documents, no_documents):
    judged = quality_rules(odd_documents)
    assert judged.count() == odd_documents.count()
    assert judged.schema["kept"].dataType.simpleString() == "boolean"
    assert {*COUNTS, "doc_id", "text", "length"} <= set(judged.columns)
    assert quality_rules(no_documents).count() == 0
    kept = passing(odd_documents)
    assert kept.columns == odd_documents.columns and {r["doc_id"] for r in kept.collect()} == {1, 8}
    assert passing(no_documents).count() == 0


def test_junk_goes_and_prose_stays(spark):
    prose = "the house of the king was on the hill and it was old but not small for him " * 2
    rows = [(1, prose + "he saw"), (2, "x### " * 3 + "The a$$$ b%%% of c&&& d*** e### the f$$$ g%%%"),
            (3, " | ".join(f"word{i}" for i in range(40))), (4, "buy now " * 30)]
    kept = passing(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["doc_id"] for r in kept.collect()] == []
    prose = " ".join(f"{w} thing{i} of the place{i}." for i, w in enumerate(["the"] * 20))
    kept = passing(spark.createDataFrame([(1, prose), *rows[1:]], "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == {1}


def test_no_python_in_the_plan(odd_documents):
    plan = passing(odd_documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)
