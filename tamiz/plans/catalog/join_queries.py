"""Referential integrity and enrichment on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.enrich import Lookup, duplicate_keys, enrich, join_audit
from ...operators.joins import lookup_join, salted_join
from ...operators.refint import flag_reference, keep_valid, lookup_or_default, violators
from .base import query, table

# Customers of these nations count as known.
KNOWN_NATIONS = 20


def _known_customers(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").filter(F.col("c_nationkey") < KNOWN_NATIONS)


def _nation_lookups(s: SparkSession, d: str, how: str = "left") -> list[Lookup]:
    return [
        Lookup(
            table(s, d, "nation"), [("c_nationkey", "n_nationkey")],
            {"n_name": "nation", "n_regionkey": "region_key"}, how=how, name="nation",
        ),
        Lookup(
            table(s, d, "region"), [("region_key", "r_regionkey")], {"r_name": "region"},
            how=how, name="region",
        ),
    ]


@query(
    "fact_enrich",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
               CAST(o_orderdate AS DATE) AS order_date, c_mktsegment AS segment,
               n_name AS nation, r_name AS region
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT * FROM customer WHERE c_nationkey < {KNOWN_NATIONS}) ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def fact_enrich(s: SparkSession, d: str) -> DataFrame:
    lines = table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    orders = table(s, d, "orders").withColumn("order_date", F.to_date("o_orderdate"))
    return enrich(
        lines,
        Lookup(
            orders, [("l_orderkey", "o_orderkey")], ["o_custkey", "order_date"],
            expect="trusted", name="order",
        ),
        Lookup(
            _known_customers(s, d), [("o_custkey", "c_custkey")],
            {"c_mktsegment": "segment", "c_nationkey": "c_nationkey"},
            expect="trusted", name="customer",
        ),
        *_nation_lookups(s, d),
    ).drop("o_custkey", "c_nationkey", "region_key")


@query(
    "enrich_star",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p_brand AS brand, p_type AS type, s_name AS supplier,
              n_name AS supplier_nation
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def enrich_star(s: SparkSession, d: str) -> DataFrame:
    return enrich(
        table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        Lookup(
            table(s, d, "part"), [("l_partkey", "p_partkey")],
            {"p_brand": "brand", "p_type": "type"}, name="part",
        ),
        Lookup(
            table(s, d, "supplier"), [("l_suppkey", "s_suppkey")],
            {"s_name": "supplier", "s_nationkey": "s_nationkey"}, name="supplier",
        ),
        Lookup(
            table(s, d, "nation"), [("s_nationkey", "n_nationkey")],
            {"n_name": "supplier_nation"}, name="nation",
        ),
    ).drop("l_partkey", "s_nationkey")


@query(
    "enrich_sparse",
    """SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def enrich_sparse(s: SparkSession, d: str) -> DataFrame:
    return enrich(
        table(s, d, "documents").select("doc_id", "lang"),
        Lookup(table(s, d, "labels"), "doc_id", ["quality", "toxic"], name="labels"),
    )


@query(
    "enrich_folded_key",
    """SELECT c_custkey, c_mktsegment, cnt AS segment_rows FROM customer
       LEFT JOIN (SELECT c_mktsegment AS seg, count(*) AS cnt FROM customer
                  WHERE c_mktsegment <> 'BUILDING' GROUP BY 1) ON seg = c_mktsegment""",
)
def enrich_folded_key(s: SparkSession, d: str) -> DataFrame:
    customers = table(s, d, "customer")
    segments = (
        customers.filter("c_mktsegment <> 'BUILDING'")
        .groupBy(F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("seg"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    return enrich(
        customers.select("c_custkey", "c_mktsegment"),
        Lookup(
            segments, [("c_mktsegment", "seg")], {"cnt": "segment_rows"}, fold_case=True,
            name="segment",
        ),
    )

@query(
    "enrich_fanout",
    """SELECT c_custkey, c_mktsegment, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
)
def enrich_fanout(s: SparkSession, d: str) -> DataFrame:
    """A row per order of every customer; customers without an order stay."""
    return enrich(
        table(s, d, "customer").select("c_custkey", "c_mktsegment"),
        Lookup(
            table(s, d, "orders"), [("c_custkey", "o_custkey")], ["o_orderkey"], expect="many",
            name="orders",
        ),
    )


@query(
    "hierarchy_left",
    f"""SELECT c_custkey, n_name AS nation, n_regionkey AS region_key, r_name AS region
        FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < {KNOWN_NATIONS}) ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey""",
)
def hierarchy_left(s: SparkSession, d: str) -> DataFrame:
    return _hierarchy(s, d, "left")


@query(
    "hierarchy_inner",
    f"""SELECT c_custkey, n_name AS nation, n_regionkey AS region_key, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE n_nationkey < {KNOWN_NATIONS} AND r_name <> 'ASIA'""",
)
def hierarchy_inner(s: SparkSession, d: str) -> DataFrame:
    return _hierarchy(s, d, "inner")


def _hierarchy(s: SparkSession, d: str, how: str) -> DataFrame:
    nations = table(s, d, "nation").filter(F.col("n_nationkey") < KNOWN_NATIONS)
    regions = table(s, d, "region").filter("r_name <> 'ASIA'")
    return enrich(
        table(s, d, "customer").select("c_custkey", "c_nationkey"),
        Lookup(
            nations, [("c_nationkey", "n_nationkey")],
            {"n_name": "nation", "n_regionkey": "region_key"}, how=how, name="nation",
        ),
        Lookup(
            regions, [("region_key", "r_regionkey")], {"r_name": "region"}, how=how,
            name="region",
        ),
    ).drop("c_nationkey")


@query(
    "hierarchy_mixed",
    f"""SELECT o_orderkey, c_name AS customer, n_name AS nation
        FROM orders JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
        LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < {KNOWN_NATIONS}) ON c_nationkey = n_nationkey""",
)
def hierarchy_mixed(s: SparkSession, d: str) -> DataFrame:
    nations = table(s, d, "nation").filter(F.col("n_nationkey") < KNOWN_NATIONS)
    return enrich(
        table(s, d, "orders").select("o_orderkey", "o_custkey"),
        Lookup(
            table(s, d, "customer").filter("c_acctbal > 0"), [("o_custkey", "c_custkey")],
            {"c_name": "customer", "c_nationkey": "c_nationkey"}, how="inner", name="customer",
        ),
        Lookup(nations, [("c_nationkey", "n_nationkey")], {"n_name": "nation"}, name="nation"),
    ).drop("o_custkey", "c_nationkey")


@query(
    "salted_left_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM (
         SELECT *, CASE WHEN l_linenumber <= 3 THEN 1 WHEN l_linenumber = 4 THEN NULL ELSE l_suppkey END AS k
         FROM lineitem) LEFT JOIN supplier ON k = s_suppkey""",
)
def salted_left_join(s: SparkSession, d: str) -> DataFrame:
    """Shuffle join in which one key holds almost half of all rows."""
    line = F.col("l_linenumber")
    skewed = F.when(line <= 3, F.lit(1)).when(line != 4, F.col("l_suppkey"))
    lines = table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", skewed.alias("k")
    )
    suppliers = table(s, d, "supplier").select("s_suppkey", "s_name")
    return salted_join(lines, suppliers, [("k", "s_suppkey")], rows_per_task=5_000).drop("k")


_HOT_NATION = 3


@query(
    "salted_fanout_join",
    f"""SELECT k, count(*) AS pairs, CAST(sum(c_custkey) AS BIGINT) AS customers,
               CAST(sum(s_suppkey) AS BIGINT) AS suppliers
        FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN {_HOT_NATION} ELSE s_nationkey END AS k
              FROM supplier)
        LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN {_HOT_NATION} ELSE c_nationkey END AS n
                   FROM customer) ON k = n
        GROUP BY k""",
)
def salted_fanout_join(s: SparkSession, d: str) -> DataFrame:
    """Row-multiplying shuffle join in which one key is hot on both sides, summed up by key."""
    def hot(key: str, nation: str) -> Column:
        return F.when(F.col(key) % 3 == 0, F.lit(_HOT_NATION)).otherwise(F.col(nation))

    suppliers = table(s, d, "supplier").select("s_suppkey", hot("s_suppkey", "s_nationkey").alias("k"))
    customers = table(s, d, "customer").select("c_custkey", hot("c_custkey", "c_nationkey").alias("n"))
    joined = lookup_join(
        suppliers, customers, [("k", "n")], broadcast_rows=0, rows_per_task=1_000
    )
    return joined.groupBy("k").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("c_custkey").alias("customers"),
        F.sum("s_suppkey").alias("suppliers"),
    )


# --- references -------------------------------------------------------------

_KNOWN = f"(SELECT c_custkey FROM customer WHERE c_nationkey < {KNOWN_NATIONS})"


def _orders(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


ON_CUSTOMER = [("o_custkey", "c_custkey")]


@query(
    "ref_semi",
    f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey IN {_KNOWN}",
)
def ref_semi(s: SparkSession, d: str) -> DataFrame:
    return keep_valid(_orders(s, d), _known_customers(s, d), ON_CUSTOMER)


@query(
    "ref_anti",
    f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey NOT IN {_KNOWN}",
)
def ref_anti(s: SparkSession, d: str) -> DataFrame:
    return violators(_orders(s, d), _known_customers(s, d), ON_CUSTOMER)


@query(
    "ref_anti_exempt",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey NOT IN {_KNOWN} AND o_orderstatus <> 'P'""",
)
def ref_anti_exempt(s: SparkSession, d: str) -> DataFrame:
    return violators(
        _orders(s, d), _known_customers(s, d), ON_CUSTOMER, F.col("o_orderstatus") == "P"
    )


@query(
    "ref_flag",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN o_custkey IN {_KNOWN} THEN 'OK' ELSE 'FK_INV' END AS r_fk FROM orders""",
)
def ref_flag(s: SparkSession, d: str) -> DataFrame:
    return flag_reference(_orders(s, d), _known_customers(s, d), ON_CUSTOMER, "r_fk")


@query(
    "ref_semi_exempt",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey IN {_KNOWN} OR o_orderstatus = 'P'""",
)
def ref_semi_exempt(s: SparkSession, d: str) -> DataFrame:
    return keep_valid(
        _orders(s, d), _known_customers(s, d), ON_CUSTOMER, F.col("o_orderstatus") == "P"
    )


_SEGMENTS = "('AUTOMOBILE', 'MACHINERY', 'FURNITURE')"


def _segments(s: SparkSession, d: str) -> DataFrame:
    return (
        table(s, d, "customer").filter(f"c_mktsegment IN {_SEGMENTS}")
        .select(F.col("c_mktsegment").alias("code")).distinct()
    )


def _segment_codes(s: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    holed = (
        F.when(F.col("c_custkey") % 5 == 0, F.lit(" "))
        .when(F.col("c_custkey") % 5 == 1, F.concat(segment, F.lit(" ")))
        .when(F.col("c_custkey") % 5 != 2, segment)
    )
    return table(s, d, "customer").select("c_custkey", holed.alias("segment"))


@query(
    "lookup_or_dummy",
    f"""SELECT c_custkey, CASE WHEN c_custkey % 5 NOT IN (0, 2) AND c_mktsegment IN {_SEGMENTS}
               THEN c_mktsegment ELSE 'DES' END AS segment FROM customer""",
)
def lookup_or_dummy(s: SparkSession, d: str) -> DataFrame:
    return lookup_or_default(_segment_codes(s, d), _segments(s, d), "segment", "code", "DES")


@query(
    "lookup_or_dummy_untrimmed",
    f"""SELECT c_custkey, CASE WHEN c_custkey % 5 NOT IN (0, 1, 2) AND c_mktsegment IN {_SEGMENTS}
               THEN c_mktsegment ELSE 'DES' END AS segment FROM customer""",
)
def lookup_or_dummy_untrimmed(s: SparkSession, d: str) -> DataFrame:
    return lookup_or_default(
        _segment_codes(s, d), _segments(s, d), "segment", "code", "DES", trim_first=False
    )


@query(
    "cascade_filter",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey WHERE r_name NOT IN ('ASIA', 'EUROPE')""",
)
def cascade_filter(s: SparkSession, d: str) -> DataFrame:
    regions = table(s, d, "region").filter("r_name NOT IN ('ASIA', 'EUROPE')")
    nations = keep_valid(table(s, d, "nation"), regions, [("n_regionkey", "r_regionkey")])
    customers = keep_valid(table(s, d, "customer"), nations, [("c_nationkey", "n_nationkey")])
    return keep_valid(_orders(s, d), customers, ON_CUSTOMER)


@query(
    "cascade_filter_dummy_exempt",
    """SELECT c_custkey, c_nationkey FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       WHERE n_regionkey < 2 OR c_nationkey = 24""",
)
def cascade_filter_dummy_exempt(s: SparkSession, d: str) -> DataFrame:
    regions = table(s, d, "region").filter("r_regionkey < 2")
    nations = keep_valid(table(s, d, "nation"), regions, [("n_regionkey", "r_regionkey")])
    return keep_valid(
        table(s, d, "customer").select("c_custkey", "c_nationkey"), nations,
        [("c_nationkey", "n_nationkey")], F.col("c_nationkey") == 24,
    )


# --- audits -----------------------------------------------------------------


@query(
    "fanout_keys",
    "SELECT p_brand, p_type, count(*) AS rows FROM part GROUP BY 1, 2 HAVING count(*) > 1",
)
def fanout_keys(s: SparkSession, d: str) -> DataFrame:
    return duplicate_keys(table(s, d, "part"), ["p_brand", "p_type"])


@query(
    "fanout_audit",
    """SELECT 'brand' AS lookup, CAST(sum(n) AS BIGINT) AS rows,
              CAST(sum(CASE WHEN m IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS matched,
              CAST(sum(CASE WHEN m IS NULL THEN n ELSE 0 END) AS BIGINT) AS unmatched,
              CAST(sum(n * coalesce(m, 1)) AS BIGINT) AS joined_rows
       FROM (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) a
       LEFT JOIN (SELECT p_brand AS b, count(*) AS m FROM part WHERE p_size < 10 GROUP BY 1) ON p_brand = b""",
)
def fanout_audit(s: SparkSession, d: str) -> DataFrame:
    branded = enrich(
        table(s, d, "lineitem").select("l_partkey"),
        Lookup(table(s, d, "part"), [("l_partkey", "p_partkey")], ["p_brand"], name="part"),
    )
    return join_audit(branded, table(s, d, "part").filter("p_size < 10"), "p_brand", "brand")


@query(
    "unmatched_rate",
    """SELECT 'labels' AS lookup, count(*) AS rows, count(l.doc_id) AS matched,
              count(*) - count(l.doc_id) AS unmatched, count(*) AS joined_rows
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def unmatched_rate(s: SparkSession, d: str) -> DataFrame:
    return join_audit(
        table(s, d, "documents"), table(s, d, "labels"), "doc_id", "labels"
    )
