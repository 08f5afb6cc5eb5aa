from datetime import date

import pytest
from pyspark.sql import functions as F

from tamiz.functions import codes, dates, text


def evaluate(spark, value, *exprs, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    row = df.select(*[e(F.col("v")).alias(f"c{i}") for i, e in enumerate(exprs)]).first()
    return row[0] if len(exprs) == 1 else tuple(row)


@pytest.mark.parametrize(
    "value, expected",
    [
        ('"TEMA"', "TEMA"), ('  "TEMA" ', "TEMA"), ('"TEMA', "TEMA"), ('TEMA"', "TEMA"),
        ('""TEMA""', '"TEMA"'), ('"', ""), ("TE\"MA", "TE\"MA"), ('" TEMA "', "TEMA"),
        (None, None),
    ],
)
def test_strip_quotes(spark, value, expected):
    assert evaluate(spark, value, text.strip_quotes) == expected


def test_clean_strips_blanks_only(spark):
    assert evaluate(spark, "  año\t ", lambda c: text.clean(c, upper=True)) == "AÑO\t"


def test_strip_whitespace_takes_every_kind(spark):
    assert evaluate(spark, "\t  a b  \n", text.strip_whitespace) == "a b"


@pytest.mark.parametrize(
    "value, every, two", [("***X", "X", "*X"), ("* X", "X", "X"), ("X*", "X*", "X*")]
)
def test_strip_markers(spark, value, every, two):
    got = evaluate(spark, value, text.strip_markers, lambda c: text.strip_markers(c, at_most=2))
    assert got == (every, two)


@pytest.mark.parametrize(
    "value, blank, default", [(None, True, "D"), ("", True, "D"), ("  ", True, "D"), (" x ", False, "x")]
)
def test_blank_and_default(spark, value, blank, default):
    got = evaluate(spark, value, text.is_blank, lambda c: text.default_if_blank(c, "D"))
    assert got == (blank, default)


def test_not_blank_is_null_for_null(spark):
    assert evaluate(spark, None, text.not_blank) is None


def test_concat_skip_nulls(spark):
    assert evaluate(spark, None, lambda c: text.concat_skip_nulls(F.lit("a"), c, F.lit("b"))) == "ab"


@pytest.mark.parametrize("value, expected", [("7", "07"), ("07", "07"), ("123", "123")])
def test_zero_pad_never_truncates(spark, value, expected):
    assert evaluate(spark, value, lambda c: text.zero_pad(c, 2)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("1", "P1"), (" 1 ", "P1"), ("900", "900"), ("p0011", "P0011"), (None, None)],
)
def test_map_code(spark, value, expected):
    assert evaluate(spark, value, lambda c: codes.map_code(c, {"1": "P1", "2": "P2"})) == expected


def test_map_code_takes_numbers(spark):
    assert evaluate(spark, 2, lambda c: codes.map_code(c, {"2": "P2"}), kind="int") == "P2"


def test_literal_map_refuses_large_maps(spark):
    with pytest.raises(ValueError, match="too many"):
        codes.literal_map({str(i): "x" for i in range(codes.MAX_LITERAL_ENTRIES + 1)})


RULES = [
    ("regex", "^ECU[A-Z]*$", "HOME"), ("equals", "TOWN", "HOME"), ("contains", "CHIN", "CN"),
]


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, "NONE"), (" ", "NONE"), ("..", "NONE"), ("Ecuatoriano.", "HOME"), ("e-c-u", "HOME"),
        ("town", "HOME"), ("town hall", "TOWN HALL"), ("la china", "CN"), (" Perú ", "PERÚ"),
        ("ecuchin", "HOME"),
    ],
)
def test_categorize_first_rule_wins(spark, value, expected):
    assert evaluate(spark, value, lambda c: codes.categorize(c, RULES, "NONE")) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1/03/04", date(2004, 3, 1)), ("31/08/99", date(2099, 8, 31)), ("1/3/04", None),
        ("31/02/04", None), ("xx", None), (None, None),
    ],
)
def test_parse_date_never_raises(spark, value, expected):
    assert evaluate(spark, value, lambda c: dates.parse_date(c, "d/MM/yy")) == expected


def test_parse_date_tries_patterns_in_order(spark):
    assert evaluate(
        spark, "2004-03-01", lambda c: dates.parse_date(c, "d/MM/yy", "yyyy-MM-dd")
    ) == date(2004, 3, 1)


@pytest.mark.parametrize(
    "value, total, if_null",
    [
        ("1990-05-06 10:00:00", date(1990, 5, 6), date(1990, 5, 6)),
        (None, date(1900, 1, 1), date(1900, 1, 1)),
        ("xx", date(1900, 1, 1), None),
    ],
)
def test_iso_date_or(spark, value, total, if_null):
    got = evaluate(
        spark, value,
        lambda c: dates.iso_date_or(c, "1900-01-01"),
        lambda c: dates.iso_date_or(c, "1900-01-01", only_if_null=True),
    )
    assert got == (total, if_null)


def test_calendar_parts(spark):
    got = evaluate(
        spark, date(2024, 7, 7), dates.date_key, dates.half_year, dates.iso_weekday,
        lambda c: dates.nth_name(dates.iso_weekday(c), list("abcdefg")), kind="date",
    )
    assert got == (20240707, 2, 7, "g")


@pytest.mark.parametrize(
    "code, expected", [("P1", "MARZO 2004 - AGOSTO 2004"), ("R1", "REMEDIAL 2004")]
)
def test_period_label(spark, code, expected):
    months = {"03": "MARZO", "08": "AGOSTO"}
    got = evaluate(
        spark, code,
        lambda c: dates.period_label(
            c, F.lit(date(2004, 3, 1)), F.lit(date(2004, 8, 31)), months, "R", "REMEDIAL"
        ),
    )
    assert got == expected


@pytest.mark.parametrize(
    "pattern", ["yyyy-MM-dd", "d/MM/yy", "dd.MM.yyyy", "d/M/yyyy", "yyyyMMdd", "yyyy-MM-dd HH:mm:ss"]
)
def test_shapes_let_every_date_through(spark, pattern):
    """With the shape in front the same texts parse as without."""
    texts = [
        "2024-02-29", "2024-2-29", "2023-02-29", "5/04/19", "05/04/19", "5/4/2019", "31.12.1999",
        "20240131", "2024-01-31 10:11:12", " 2024-01-31", "2024-01-31 ", "12024-01-31", "+12024-01-31",
        "-2024-01-31", "", "x", "1/1/1", "99/99/99", "٢٠٢٤-٠١-٣١", "2024-01-31\n", "0000-00-00", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", dates.parse_date(F.col("t"), pattern).alias("a"), F.try_to_date("t", pattern).alias("b"))
    assert [tuple(r) for r in rows.filter("NOT a <=> b").collect()] == []


def test_patterns_without_a_shape():
    assert dates.pattern_shape("dd MMM yyyy") is None and dates.pattern_shape("yyyy-MM-dd'T'HH") is None
