"""Validation rules on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.codes import map_code
from ...operators.enrich import Lookup, enrich
from ...operators.refint import violators
from ...operators.rules import (
    ForeignKeyRule, UniqueRule, apply_rules, date_range, in_domain, min_date, nonzero,
    summarize_rules,
)
from .base import case_map, query, table
from .clean_queries import PRIORITY_CODES

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
_KNOWN = "(SELECT c_custkey FROM customer WHERE c_nationkey < 20)"


@query(
    "rule_domain",
    """SELECT c_custkey, c_mktsegment,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'OK' ELSE 'OUT' END AS r_segment
       FROM customer""",
)
def rule_domain(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    return apply_rules(rows, [in_domain("r_segment", F.col("c_mktsegment"), SEGMENTS, bad="OUT")])


_HOLED_KEY = "CASE WHEN l_orderkey % 50 = 0 THEN NULL ELSE l_orderkey END"


def _holed_lines(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select(
        F.expr(_HOLED_KEY).alias("l_orderkey"), "l_linenumber", "l_partkey"
    )


def _unique_sql(key: str, null_test: str, on_null: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN {null_test} THEN '{on_null}' WHEN n > 1 THEN 'DUP' ELSE 'OK' END AS r_dup
       FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS n
             FROM (SELECT {_HOLED_KEY} AS l_orderkey, l_linenumber, l_partkey FROM lineitem))"""


@query("rule_unique_single", _unique_sql("l_orderkey", "l_orderkey IS NULL", "NULL_KEY"))
def rule_unique_single(s: SparkSession, d: str) -> DataFrame:
    return apply_rules(_holed_lines(s, d), [UniqueRule("r_dup", ["l_orderkey"])])


@query("rule_unique_null_is_dup", _unique_sql("l_orderkey", "l_orderkey IS NULL", "DUP"))
def rule_unique_null_is_dup(s: SparkSession, d: str) -> DataFrame:
    return apply_rules(_holed_lines(s, d), [UniqueRule("r_dup", ["l_orderkey"], nulls="dup")])


@query("rule_unique_composite", _unique_sql("l_orderkey, l_linenumber", "false", ""))
def rule_unique_composite(s: SparkSession, d: str) -> DataFrame:
    rule = UniqueRule("r_dup", ["l_orderkey", "l_linenumber"], nulls="group")
    return apply_rules(_holed_lines(s, d), [rule])


@query(
    "rule_fk_violations",
    f"""SELECT o_orderkey, o_custkey FROM orders
        WHERE (o_custkey NOT IN {_KNOWN} OR o_orderkey % 40 = 0) AND o_orderstatus <> 'P'""",
)
def rule_fk_violations(s: SparkSession, d: str) -> DataFrame:
    orders = table(s, d, "orders").withColumn(
        "fk", F.when(F.col("o_orderkey") % 40 != 0, F.col("o_custkey"))
    )
    known = table(s, d, "customer").filter("c_nationkey < 20")
    return violators(
        orders, known, [("fk", "c_custkey")], F.col("o_orderstatus") == "P"
    ).select("o_orderkey", "o_custkey")


@query(
    "rule_date_range",
    """SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN o_orderdate < l_shipdate THEN 'OK' ELSE 'INV' END AS r_range
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def rule_date_range(s: SparkSession, d: str) -> DataFrame:
    lines = table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    dated = enrich(
        lines,
        Lookup(
            table(s, d, "orders"), [("l_orderkey", "o_orderkey")], ["o_orderdate"],
            expect="trusted", how="inner", name="order",
        ),
    )
    rule = date_range("r_range", F.col("o_orderdate"), F.col("l_shipdate"))
    return apply_rules(dated, [rule]).drop("o_orderdate", "l_shipdate")


@query(
    "rule_nonzero_id",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
         CASE WHEN nullif(l_suppkey, 1) <> 0 THEN 'OK' ELSE 'INV' END AS r_id FROM lineitem""",
)
def rule_nonzero_id(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return apply_rules(rows, [nonzero("r_id", F.nullif(F.col("l_suppkey"), F.lit(1)))])


@query(
    "rule_min_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
              THEN 'OK' ELSE 'INV' END AS r_date FROM orders""",
)
def rule_min_date(s: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 9 != 0, F.to_date("o_orderdate"))
    rows = table(s, d, "orders").select("o_orderkey", day.alias("day"))
    return apply_rules(rows, [min_date("r_date", F.col("day"), "1998-01-01")]).drop("day")


_CODE = case_map("o_orderpriority", PRIORITY_CODES, "o_orderpriority")


@query(
    "rule_normalized_domain",
    f"""SELECT o_orderkey, o_orderpriority,
          CASE WHEN {_CODE} IN ('U1', 'H2', 'M3', 'L5') THEN 'OK' ELSE 'INV' END AS r_code FROM orders""",
)
def rule_normalized_domain(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "orders").select("o_orderkey", "o_orderpriority")
    code = map_code(F.col("o_orderpriority"), PRIORITY_CODES)
    return apply_rules(rows, [in_domain("r_code", code, list(PRIORITY_CODES.values()))])


@query(
    "rule_enum",
    """SELECT l_orderkey, l_linenumber, l_returnflag,
         CASE WHEN l_returnflag IN ('A', 'R') THEN 'OK' ELSE 'INV' END AS r_flag FROM lineitem""",
)
def rule_enum(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return apply_rules(rows, [in_domain("r_flag", F.col("l_returnflag"), ["A", "R"])])


@query(
    "rule_lookup_exists",
    f"""SELECT CASE WHEN o_custkey IN {_KNOWN} THEN 'OK' ELSE 'INV→DES' END AS r_cust, count(*) AS rows
        FROM orders GROUP BY 1""",
)
def rule_lookup_exists(s: SparkSession, d: str) -> DataFrame:
    known = table(s, d, "customer").filter("c_nationkey < 20")
    rule = ForeignKeyRule("r_cust", known, [("o_custkey", "c_custkey")], bad="INV→DES")
    return summarize_rules(table(s, d, "orders"), [rule]).select(
        F.col("status").alias("r_cust"), "rows"
    )


@query(
    "rule_summary",
    f"""
SELECT 'r_flag' AS rule, CASE WHEN l_returnflag IN ('A', 'R') THEN 'OK' ELSE 'INV' END AS status, count(*) AS rows
FROM lineitem GROUP BY 2
UNION ALL
SELECT 'r_qty', CASE WHEN l_quantity <> 1 THEN 'OK' ELSE 'INV' END, count(*) FROM lineitem GROUP BY 2
UNION ALL
SELECT 'r_date', CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' THEN 'OK' ELSE 'INV' END, count(*)
FROM lineitem GROUP BY 2
UNION ALL
SELECT 'r_part', CASE WHEN l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 40) THEN 'OK' ELSE 'FK_INV' END, count(*)
FROM lineitem GROUP BY 2
UNION ALL
SELECT 'r_dup', CASE WHEN n > 1 THEN 'DUP' ELSE 'OK' END, count(*)
FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) GROUP BY 2
""",
)
def rule_summary(s: SparkSession, d: str) -> DataFrame:
    parts = table(s, d, "part").filter("p_size < 40")
    return summarize_rules(
        table(s, d, "lineitem"),
        [
            in_domain("r_flag", F.col("l_returnflag"), ["A", "R"]),
            nonzero("r_qty", F.col("l_quantity") - 1),
            min_date("r_date", F.to_date("l_shipdate"), "1998-01-01"),
            ForeignKeyRule("r_part", parts, [("l_partkey", "p_partkey")]),
            UniqueRule("r_dup", ["l_orderkey", "l_linenumber"]),
        ],
    )
