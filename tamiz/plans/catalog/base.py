"""Registry of queries and the composition of their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# Named subqueries the oracles may refer to.
CTES: dict[str, str] = {}


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the files only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name`` with the SQL that must agree with it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn

    return register


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the named subqueries it uses, parents first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in CTES and word not in order:
                visit(CTES[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    if not order:
        return sql.strip()
    parts = ",\n".join(f"{n} AS (\n{CTES[n].strip()}\n)" for n in order)
    return f"WITH {parts}\n{sql.strip()}"


def text_list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def survivor(source: str, key: list[str], columns: list[str]) -> str:
    """First row per key by all other columns, NULLs first."""
    order = ", ".join(f"{c} NULLS FIRST" for c in columns if c not in key)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn FROM ({source})) WHERE rn = 1"
    )


def case_map(expr: str, mapping: dict[str, str], otherwise: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {otherwise} END"

