from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tamiz.operators.dims import (
    calendar_dim, merge_into, rename_and_stamp, surrogate_key, upsert, with_unknown_member,
)
from tamiz.operators.profile import distribution, profile, profile_tables, sample_rows
from tamiz.operators.report import quality_report, row_counts
from tamiz.plans import values as V


def test_profile_counts_null_and_blank(spark):
    df = spark.createDataFrame(
        [(1, "a", [1]), (None, " ", None), (3, None, [])], "i int, s string, a array<int>"
    )
    got = {r["column"]: (r["type"], r["rows"], r["null_or_blank"]) for r in profile(df, "t").collect()}
    assert got == {"i": ("int", 3, 1), "s": ("string", 3, 2), "a": ("array<int>", 3, 1)}


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "x int")
    assert [tuple(r) for r in profile_tables({"e": empty}).collect()] == [("e", 1, "x", "int", 0, 0)]


def test_samples_and_distribution(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1)], "k string, n int")
    assert [tuple(r) for r in sample_rows(df, 2, ["n"]).collect()] == [("a", 1), ("b", 1)]
    assert [tuple(r) for r in distribution(df, "k").collect()] == [("b", 2), ("a", 1)]


def test_quality_report(spark):
    df = spark.range(10)
    report = quality_report({"x": (df, df.filter("id < 7")), "only clean": (None, df)})
    assert sorted(tuple(r) for r in report.collect()) == [
        ("only clean", None, 10, None), ("x", 10, 7, 3),
    ]
    assert [tuple(r) for r in row_counts({"t": df}).collect()] == [("t", 10)]


def test_unknown_member_follows_types(spark):
    dim = rename_and_stamp(spark.range(1, 3), {"id": "key"}, "2024-01-01 00:00:00")
    out = with_unknown_member(dim, {"key": 0, "etl_fecha_carga": "1900-01-01 00:00:00"})
    assert out.schema.fieldNames() == dim.schema.fieldNames()
    assert out.filter("key = 0").first()["etl_fecha_carga"] == datetime(1900, 1, 1)
    assert out.count() == 3


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_surrogate_keys_are_dense_and_repeatable(spark, buckets):
    dim = spark.range(500).selectExpr("concat('k', id) AS a", "id % 3 AS b")
    first = surrogate_key(dim, ["a", "b"], "sk", buckets).collect()
    again = surrogate_key(dim.repartition(13), ["a", "b"], "sk", buckets).collect()
    assert sorted(r["sk"] for r in first) == list(range(1, 501))
    assert {r["a"]: r["sk"] for r in first} == {r["a"]: r["sk"] for r in again}


def test_calendar(spark):
    cal = calendar_dim(spark, "2000-01-01", "2030-12-31", V.MONTHS, V.WEEKDAYS, V.HALF_YEARS)
    assert cal.count() == 11_323 == cal.select("id_tiempo").distinct().count()
    day = cal.filter("id_tiempo = 20240229").first()
    assert tuple(day) == (20240229, 2024, 1, "PRIMER SEM.", 2, "FEBRERO", "JUEVES")


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "rows_per_task": 2}])
def test_upsert_twice_is_upsert_once(spark, rows, limits):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (2, "C"), (3, "c"), (None, "N")], "k int, v string")
    order = [F.desc("v")]
    once = upsert(target, updates, ["k"], order, **limits)
    assert rows(once) == [(None, "N"), (1, "a"), (2, "C"), (3, "c")]
    assert rows(upsert(once, updates, ["k"], order, **limits)) == rows(once)


def test_merge_needs_a_table_format_that_can(spark, tmp_path):
    spark.sql(f"CREATE TABLE merge_target (k INT, v STRING) USING parquet LOCATION '{tmp_path}/t'")
    try:
        with pytest.raises(Exception, match="(?i)merge"):
            merge_into(spark.createDataFrame([(1, "a")], "k int, v string"), "merge_target", ["k"])
    finally:
        spark.sql("DROP TABLE merge_target")


def test_calendar_of_one_day(spark):
    cal = calendar_dim(spark, "2024-12-31", "2024-12-31", V.MONTHS, V.WEEKDAYS, V.HALF_YEARS)
    assert [r["dia"] for r in cal.collect()] == [V.WEEKDAYS[date(2024, 12, 31).weekday()]]
