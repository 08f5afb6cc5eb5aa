import pytest
from pyspark.sql import functions as F

from tamiz.operators.refint import flag_reference, keep_valid, lookup_or_default, violators
from tamiz.operators.rules import (
    ForeignKeyRule, RowRule, UniqueRule, apply_rules, date_range, in_domain, min_date, nonzero,
    summarize_rules,
)

LIMITS = [{}, {"broadcast_rows": 0, "rows_per_task": 2}]


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(
        [("C1", "P1"), ("C2", "PX"), ("C3", None), ("DES", "PX"), (None, "P1")],
        "code string, province string",
    )


@pytest.fixture
def provinces(spark):
    return spark.createDataFrame([("P1",), ("P1",), (None,)], "code string")


@pytest.mark.parametrize("limits", LIMITS)
def test_references(rows, cities, provinces, limits):
    on = [("province", "code")]
    exempt = F.col("code") == "DES"
    assert rows(keep_valid(cities, provinces, on, **limits), "code") == [(None,), ("C1",)]
    assert rows(keep_valid(cities, provinces, on, exempt, **limits), "code") == [
        (None,), ("C1",), ("DES",),
    ]
    assert rows(violators(cities, provinces, on, exempt, **limits), "code") == [("C2",), ("C3",)]
    flagged = flag_reference(cities, provinces, on, "r", exempt, **limits)
    assert rows(flagged, "code", "r") == [
        (None, "OK"), ("C1", "OK"), ("C2", "FK_INV"), ("C3", "FK_INV"), ("DES", "OK"),
    ]


@pytest.mark.parametrize("limits", LIMITS)
def test_lookup_or_default(spark, rows, limits):
    codes = spark.createDataFrame([("LAGO",), ("DES",)], "code string")
    df = spark.createDataFrame([("LAGO",), ("LAGO ",), (" ",), (None,), ("ZZ",)], "c string")
    trimmed = lookup_or_default(df, codes, "c", "code", "DES", **limits)
    raw = lookup_or_default(df, codes, "c", "code", "DES", trim_first=False, **limits)
    assert [r[0] for r in rows(trimmed)] == ["DES"] * 3 + ["LAGO"] * 2
    assert [r[0] for r in rows(raw)] == ["DES"] * 4 + ["LAGO"]


def test_row_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, "A", "2020-01-01", "2020-02-01"), (0, "Z", "2020-02-01", "2020-01-01"),
         (None, None, None, "2020-01-01")],
        "id int, d string, a string, b string",
    ).withColumns({"a": F.col("a").cast("date"), "b": F.col("b").cast("date")})
    rules = [
        nonzero("r_id", F.col("id")),
        in_domain("r_dom", F.col("d"), ["A"], bad="OUT"),
        date_range("r_range", F.col("a"), F.col("b")),
        min_date("r_min", F.col("a"), "2020-01-15"),
        RowRule("r_any", F.col("id") == 1),
    ]
    assert rows(apply_rules(df, rules), *[r.name for r in rules]) == [
        ("INV", "OUT", "INV", "INV", "INV"),
        ("INV", "OUT", "INV", "OK", "INV"),
        ("OK", "OK", "OK", "INV", "OK"),
    ]
    summary = {(r["rule"], r["status"]): r["rows"] for r in summarize_rules(df, rules).collect()}
    assert summary[("r_dom", "OUT")] == 2 and summary[("r_min", "OK")] == 1
    assert sum(v for (rule, _), v in summary.items() if rule == "r_id") == 3


@pytest.mark.parametrize("limits", LIMITS)
@pytest.mark.parametrize(
    "nulls, lonely, twin",
    [("flag", "NULL_KEY", "NULL_KEY"), ("dup", "DUP", "DUP"), ("group", "OK", "DUP")],
)
def test_unique_rule_and_nulls(spark, rows, nulls, lonely, twin, limits):
    data = [("a", "1"), ("a", "1"), ("a", "1"), ("b", "1"), (None, "9"), (None, "1"), (None, "1")]
    df = spark.createDataFrame(data, "k string, j string")
    rule = UniqueRule("r", ["k", "j"], nulls=nulls)
    got = rows(apply_rules(df, [rule], **limits))
    assert got == [
        (None, "1", twin), (None, "1", twin), (None, "9", lonely),
        ("a", "1", "DUP"), ("a", "1", "DUP"), ("a", "1", "DUP"), ("b", "1", "OK"),
    ]
    counted = {}
    for *_, status in got:
        counted[status] = counted.get(status, 0) + 1
    summary = summarize_rules(df, [rule])
    assert {r["status"]: r["rows"] for r in summary.collect()} == counted


def test_all_kinds_together_agree_with_summary(spark, cities, provinces):
    rules = [
        RowRule("r_code", F.col("code").startswith("C")),
        UniqueRule("r_dup", ["province"]),
        ForeignKeyRule("r_fk", provinces, [("province", "code")]),
    ]
    flagged = apply_rules(cities, rules)
    assert flagged.columns == [*cities.columns, "r_code", "r_dup", "r_fk"]
    summary = {(r["rule"], r["status"]): r["rows"] for r in summarize_rules(cities, rules).collect()}
    for rule in ("r_code", "r_dup", "r_fk"):
        for r in flagged.groupBy(rule).count().collect():
            assert summary.pop((rule, r[0])) == r["count"]
    assert not summary
