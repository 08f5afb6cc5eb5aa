"""Deterministic deduplication and profiles on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.cleaning import CleanSpec, clean_table
from ...operators.dedup import dedup, distinct_on
from ...operators.profile import distribution, profile_tables, sample_rows
from ...operators.report import quality_report, row_counts
from .base import TABLES, query, survivor, table

LINEITEM = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
PROFILED = TABLES


@query("dedup_by_key", survivor("SELECT * FROM lineitem", ["l_orderkey", "l_linenumber"], LINEITEM))
def dedup_by_key(s: SparkSession, d: str) -> DataFrame:
    return dedup(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dedup_latest",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey, l_suppkey, l_quantity) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    return dedup(
        rows, ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate"), F.desc("l_extendedprice")]
    )


@query(
    "dedup_exact_text",
    "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text",
)
def dedup_exact_text(s: SparkSession, d: str) -> DataFrame:
    return dedup(table(s, d, "documents").select("doc_id", "text"), "text")


@query(
    "distinct_on",
    """SELECT DISTINCT ON (c_nationkey) c_nationkey, c_custkey, c_name, c_acctbal FROM customer
       ORDER BY c_nationkey, c_acctbal DESC, c_custkey""",
)
def distinct_on_nation(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    return distinct_on(rows, "c_nationkey", [F.desc("c_acctbal"), "c_custkey"])


_FILTER = "l_returnflag <> 'R'"


@query(
    "dedup_filter_first",
    survivor(
        f"SELECT * FROM lineitem WHERE {_FILTER}", ["l_orderkey", "l_linenumber"], LINEITEM
    ),
)
def dedup_filter_first(s: SparkSession, d: str) -> DataFrame:
    spec = CleanSpec(["l_orderkey", "l_linenumber"], {}, [F.expr(_FILTER)])
    return clean_table(table(s, d, "lineitem"), spec)


@query(
    "dedup_before_filter",
    "SELECT * FROM ("
    + survivor("SELECT * FROM lineitem", ["l_orderkey", "l_linenumber"], LINEITEM)
    + f") WHERE {_FILTER}",
)
def dedup_before_filter(s: SparkSession, d: str) -> DataFrame:
    spec = CleanSpec(
        ["l_orderkey", "l_linenumber"], {}, [F.expr(_FILTER)], dedup_first=True
    )
    return clean_table(table(s, d, "lineitem"), spec)


def _holed(s: SparkSession, d: str, name: str) -> DataFrame:
    df = table(s, d, name)
    holes = {
        f.name: F.when(F.col(f.name) == "BUILDING", F.lit("  "))
        .when(F.col(f.name) != "F", F.col(f.name))
        for f in df.schema.fields
        if f.dataType.simpleString() == "string"
    }
    return df.withColumns(holes) if holes else df


_PROFILE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority",
    ],
    "lineitem": LINEITEM,
    "labels": ["doc_id", "quality", "toxic"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


@query(
    "profile_null_blank",
    "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS "table", CAST({i} AS INTEGER) AS position, '{c}' AS "column",
            count(*) AS rows,
            count(*) FILTER (WHERE CAST({c} AS STRING) IN ('BUILDING', 'F')) AS null_or_blank FROM {t}"""
        for t, columns in _PROFILE_COLUMNS.items()
        for i, c in enumerate(columns, 1)
    ),
)
def profile_null_blank(s: SparkSession, d: str) -> DataFrame:
    return profile_tables({n: _holed(s, d, n) for n in PROFILED}).drop("type")


@query(
    "sample_rows",
    "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20",
)
def sample(s: SparkSession, d: str) -> DataFrame:
    return sample_rows(table(s, d, "orders"), 20, ["o_orderdate", "o_orderkey"])


@query(
    "category_distribution",
    "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1",
)
def category_distribution(s: SparkSession, d: str) -> DataFrame:
    return distribution(table(s, d, "lineitem"), "l_returnflag")


@query(
    "row_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in PROFILED
    ),
)
def counts(s: SparkSession, d: str) -> DataFrame:
    return row_counts({n: table(s, d, n) for n in PROFILED})


@query(
    "quality_report",
    """SELECT source, original, clean, original - clean AS removed FROM (
         SELECT 'lineitem' AS source, (SELECT count(*) FROM lineitem) AS original,
                (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS clean
         UNION ALL
         SELECT 'documents', (SELECT count(*) FROM documents),
                (SELECT count(DISTINCT text) FROM documents)
         UNION ALL
         SELECT 'nation', NULL, (SELECT count(*) FROM nation))""",
)
def quality(s: SparkSession, d: str) -> DataFrame:
    # Only the keys matter for the counts.
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber")
    texts = table(s, d, "documents").select("text")
    return quality_report(
        {
            "lineitem": (lines, dedup(lines, ["l_orderkey", "l_linenumber"])),
            "documents": (texts, dedup(texts, "text")),
            "nation": (None, table(s, d, "nation")),
        }
    )
