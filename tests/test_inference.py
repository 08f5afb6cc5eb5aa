"""Types of text columns."""

import pytest
from pyspark.sql import types as T

from tamiz.sources.inference import (
    count_types, infer_types, inferred_schema, merge_counts, read_inferred,
)

CASES = {
    "int": ["1", "-7", " 42 ", None, "", "0", "+3"],
    "bigint": ["1", "3000000000"],
    "decimal(21,0)": ["9223372036854775808", "123456789012345678901"],
    "decimal(5,2)": ["1.5", "123.45", "-2"],
    "double": ["1.5", "2e10", "-3E-4"],
    "date": ["2024-02-29", "1999-12-31"],
    "timestamp_ntz": ["2024-02-29", "2024-02-29 10:11", "2024-02-29T10:11:12.123456"],
    "boolean": ["true", "FALSE", " "],
    "string": ["007", "1"],
}
TEXTS = [["01"], ["1", "x"], ["2024-02-30"], ["1.", "2"], [".5"], ["1e"], ["--1"], [None, " "], ["1 2"], ["٣"], ["NaN"]]


@pytest.mark.parametrize("kind", CASES)
def test_narrowest_type(spark, kind):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(CASES[kind])], "a string, n int")
    schema = inferred_schema(count_types(df))
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [("a", kind)]


def test_texts(spark):
    width = max(map(len, TEXTS))
    rows = [tuple(t[i] if i < len(t) else None for t in TEXTS) for i in range(width)]
    names = [f"c{i}" for i in range(len(TEXTS))]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    assert {f.dataType for f in inferred_schema(count_types(df))} == {T.StringType()}


def test_share_that_may_be_lost(spark):
    df = spark.createDataFrame([(str(i) if i % 10 else "n/a",) for i in range(100)], "a string")
    counts = count_types(df)
    assert inferred_schema(counts)["a"].dataType == T.StringType()
    assert inferred_schema(counts, 0.1)["a"].dataType == T.IntegerType()
    report = {r["type"]: (r["lost"], r["lost_share"]) for r in infer_types(counts).collect()}
    assert report["int"] == (10, 0.1) and report["date"] == (100, 1.0) and report["string"] == (0, 0.0)


def test_counts_of_loads_add_up(spark, rows):
    texts = [("1", "x"), ("2.5", None), ("3000000000", "2024-01-01"), ("00", ""), ("-1", "2024-13-01")]
    whole = spark.createDataFrame(texts, "a string, b string")
    parts = [count_types(spark.createDataFrame([t], "a string, b string")) for t in texts]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.union(p)
    assert rows(merge_counts(merged)) == rows(count_types(whole))


def test_digits_must_fit_together(spark):
    wide = [("1" * 30,), ("0." + "1" * 30,)]
    assert inferred_schema(count_types(spark.createDataFrame(wide, "a string")))["a"].dataType == T.DoubleType()


def test_one_scan(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(20).selectExpr(*[f"cast(id as string) c{i}" for i in range(12)]).write.parquet(path)
    counts = count_types(spark.read.parquet(path))
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    empty = count_types(spark.read.parquet(path).limit(0))
    assert {f.dataType for f in inferred_schema(empty)} == {T.StringType()}


def test_file_with_a_mark_and_a_late_surprise(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id;code;day\n1;007;2024-01-31\n2;x;\n3000000000;08;2024-02-01\n")
    df = read_inferred(spark, f"file://{tmp_path}/a.csv", ";")
    assert [f.dataType.simpleString() for f in df.schema][:3] == ["bigint", "string", "date"]
    assert [r["code"] for r in df.orderBy("id").collect()] == ["007", "x", "08"]
