import pytest

LONG = "word " * 30_000 + "end\n" + "x" * 50_000
TEXTS = [
    (1, "The cat sat on the mat and the dog lay by the fire in the hall of the old house."),
    (2, None), (3, ""), (4, " \t\n\x0b "), (5, LONG),
    (6, "a b c"), (6, "a b c"), (None, "a b c"), (None, None), (7, "a b c"),
    (8, "Ünïcode – “quotes”  wide space 日本語 🙂 é ﬁ ▁ mark\x00nul"),
    (9, "one two three four five six one two three four five six\nline\nline\n\nline"),
    (10, "x <|endoftext|> y<|startoftext|>z  double  space\ttab's don't WE'LL 12,345"),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """NULLs, empty, blank and very long texts, repeated rows, clashing columns."""
    rows = [(i, t, f"n{k}", k) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, kept string, length int"
    ).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept string, length int")


@pytest.fixture(scope="session", autouse=True)
def scratch(spark, tmp_path_factory):
    """Staged tables go to a folder of the test run."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
