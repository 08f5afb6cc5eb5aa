"""Column cleaning on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.codes import categorize, map_code, map_value
from ...functions.dates import date_key, half_year, iso_date_or, iso_weekday, nth_name, parse_date
from ...functions.text import (
    clean, concat_skip_nulls, default_if_blank, not_blank, strip_markers, strip_quotes, zero_pad,
)
from .. import values as V
from .base import case_map, query, table

# Order priority -> short code; the last one is left out on purpose.
PRIORITY_CODES = {"1-URGENT": "U1", "2-HIGH": "H2", "3-MEDIUM": "M3", "5-LOW": "L5"}
TYPE_RULES = [
    ("regex", "^ECO[A-Z]*$", "BUDGET"),
    ("equals", "PROMO", "BUDGET"),
    ("contains", "STAND", "REGULAR"),
    ("contains", "ARGE", "BIG"),
]


@query(
    "clean_trim_upper",
    """SELECT p_partkey, upper(trim('  ' || p_name || ' ñandú ')) AS name,
              trim('  ' || p_type || ' ') AS type FROM part""",
)
def clean_trim_upper(s: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" ñandú "))
    return table(s, d, "part").select(
        "p_partkey",
        clean(padded, upper=True).alias("name"),
        clean(F.concat(F.lit("  "), F.col("p_type"), F.lit(" "))).alias("type"),
    )


@query(
    "clean_strip_quotes",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN trim(text)
                WHEN doc_id % 3 = 1 THEN trim(text || 'x') ELSE trim('x' || text) END AS text
       FROM documents""",
)
def clean_strip_quotes(s: SparkSession, d: str) -> DataFrame:
    t, kind = F.col("text"), F.col("doc_id") % 3
    quoted = (
        F.when(kind == 0, F.concat(F.lit(' "'), t, F.lit('" ')))
        .when(kind == 1, F.concat(F.lit('"'), t, F.lit("x")))
        .otherwise(F.concat(F.lit("x"), t, F.lit('"')))
    )
    return table(s, d, "documents").select("doc_id", strip_quotes(quoted).alias("text"))


@query(
    "clean_strip_markers",
    """SELECT s_suppkey, s_name AS every_marker, '*' || s_name AS two_markers FROM supplier""",
)
def clean_strip_markers(s: SparkSession, d: str) -> DataFrame:
    marked = F.concat(F.lit("***"), F.col("s_name"))
    return table(s, d, "supplier").select(
        "s_suppkey",
        strip_markers(marked).alias("every_marker"),
        strip_markers(marked, at_most=2).alias("two_markers"),
    )


@query(
    "clean_zero_pad",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE WHEN length(CAST(l_partkey AS STRING)) < 3
                   THEN lpad(CAST(l_partkey AS STRING), 3, '0')
                   ELSE CAST(l_partkey AS STRING) END AS part_code FROM lineitem""",
)
def clean_zero_pad(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        zero_pad(F.col("l_partkey").cast("string"), 3).alias("part_code"),
    )


@query(
    "not_blank_filter",
    """SELECT c_custkey, c_mktsegment FROM customer
       WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')""",
)
def not_blank_filter(s: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    holed = F.when(segment == "MACHINERY", F.lit("   ")).when(segment != "BUILDING", segment)
    return (
        table(s, d, "customer")
        .select("c_custkey", holed.alias("c_mktsegment"))
        .filter(not_blank(F.col("c_mktsegment")))
    )


@query(
    "normalize_code_map",
    f"""SELECT o_orderkey,
          {case_map("o_orderpriority", PRIORITY_CODES, "o_orderpriority")} AS code,
          {case_map("o_orderpriority", PRIORITY_CODES, "NULL")} AS mapped FROM orders""",
)
def normalize_code_map(s: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.col("o_orderpriority"))
    return table(s, d, "orders").select(
        "o_orderkey",
        map_code(padded, PRIORITY_CODES).alias("code"),
        map_value(F.col("o_orderpriority"), PRIORITY_CODES).alias("mapped"),
    )


@query(
    "categorize_regex",
    """SELECT p_partkey, CASE WHEN p_type = 'MEDIUM' THEN 'NONE' WHEN p_type LIKE 'ECO%' THEN 'BUDGET'
              WHEN p_type = 'PROMO' THEN 'BUDGET' WHEN p_type LIKE '%STAND%' THEN 'REGULAR'
              WHEN p_type LIKE '%ARGE%' THEN 'BIG' ELSE p_type || '-1.' END AS category
       FROM part""",
)
def categorize_regex(s: SparkSession, d: str) -> DataFrame:
    noisy = F.when(F.col("p_type") == "MEDIUM", F.lit(" .5")).otherwise(
        F.concat(F.lit(" "), F.lower("p_type"), F.lit("-1. "))
    )
    return table(s, d, "part").select(
        "p_partkey", categorize(noisy, TYPE_RULES, "NONE").alias("category")
    )


@query(
    "default_unknown",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'DESCONOCIDO'
              ELSE c_mktsegment END AS segment FROM customer""",
)
def default_unknown(s: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    holed = F.when(segment == "FURNITURE", F.lit("  ")).when(
        segment != "BUILDING", F.concat(segment, F.lit(" "))
    )
    return table(s, d, "customer").select(
        "c_custkey", default_if_blank(holed, V.UNKNOWN_NAME).alias("segment")
    )


@query(
    "parse_date_default",
    """SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 < 2 THEN DATE '1900-01-01' ELSE CAST(o_orderdate AS DATE) END AS always,
         CASE WHEN o_orderkey % 7 = 0 THEN DATE '1900-01-01'
              WHEN o_orderkey % 7 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS if_null
       FROM orders""",
)
def parse_date_default(s: SparkSession, d: str) -> DataFrame:
    dirty = (
        F.when(F.col("o_orderkey") % 7 == 1, F.lit("sin fecha"))
        .when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return table(s, d, "orders").select(
        "o_orderkey",
        iso_date_or(dirty, V.UNKNOWN_BIRTH_DATE).alias("always"),
        iso_date_or(dirty, V.UNKNOWN_BIRTH_DATE, only_if_null=True).alias("if_null"),
    )


# What a two-digit year can say: years 2000 to 2099.
_SHORT_YEAR = """make_date(CAST(2000 + extract(year FROM l_shipdate) % 100 AS BIGINT),
                            extract(month FROM l_shipdate), extract(day FROM l_shipdate))"""


@query(
    "parse_date_patterns",
    f"""SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber % 2 = 0 THEN {_SHORT_YEAR} ELSE CAST(l_shipdate AS DATE) END AS shipped,
         CASE WHEN l_linenumber % 2 = 0 THEN {_SHORT_YEAR} END AS short_only
       FROM lineitem""",
)
def parse_date_patterns(s: SparkSession, d: str) -> DataFrame:
    shipped = F.col("l_shipdate")
    text = F.when(F.col("l_linenumber") % 2 == 0, F.date_format(shipped, V.PERIOD_DATE)).otherwise(
        F.date_format(shipped, "yyyy-MM-dd")
    )
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        parse_date(text, V.PERIOD_DATE, "yyyy-MM-dd").alias("shipped"),
        parse_date(text, V.PERIOD_DATE).alias("short_only"),
    )


@query(
    "concat_skip_nulls",
    """SELECT c_custkey, concat(nullif(c_mktsegment, 'BUILDING'), ' ', c_name) AS name,
              nullif(c_mktsegment, 'BUILDING') || ' ' || c_name AS strict_name FROM customer""",
)
def concat_parts(s: SparkSession, d: str) -> DataFrame:
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return table(s, d, "customer").select(
        "c_custkey",
        concat_skip_nulls(segment, F.lit(" "), F.col("c_name")).alias("name"),
        F.concat(segment, F.lit(" "), F.col("c_name")).alias("strict_name"),
    )


def _case_names(expr: str, names: list[str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1)) + " END"


@query(
    "date_parts_named",
    f"""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS id,
         CAST(CASE WHEN extract(month FROM o_orderdate) <= 6 THEN 1 ELSE 2 END AS INTEGER) AS half,
         CAST(extract(isodow FROM o_orderdate) AS INTEGER) AS weekday,
         {_case_names("extract(month FROM o_orderdate)", V.MONTHS)} AS month_name,
         {_case_names("extract(isodow FROM o_orderdate)", V.WEEKDAYS)} AS weekday_name
       FROM orders""",
)
def date_parts_named(s: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(s, d, "orders").select(
        "o_orderkey",
        date_key(day).alias("id"),
        half_year(day).alias("half"),
        iso_weekday(day).alias("weekday"),
        nth_name(F.month(day), V.MONTHS).alias("month_name"),
        nth_name(iso_weekday(day), V.WEEKDAYS).alias("weekday_name"),
    )
