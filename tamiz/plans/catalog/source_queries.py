"""Sources and sinks: what is written is read back and must be unchanged."""

from __future__ import annotations

import contextlib
import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.ragged import clean_rows
from ...sources.counts import footer_count_frame
from ...sources.delimited import CORRUPT, declare, read_delimited
from ...sources.inference import count_types, infer_types, read_inferred, read_texts
from ...sources.publish import publish, published
from ...sources.spreadsheet import (
    MISSING_TEXTS, read_ragged, read_workbook, typed_table, workbook_rows,
)
from ...sources.staged import (
    load_tables, path_writer, read_tables, register_views, shared_folder, stage, stage_tables,
)
from .base import query, table

ROWS_PER_WORKBOOK = 5_000


@query(
    "csv_roundtrip",
    """SELECT o_orderkey, o_custkey, '0' || o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day
       FROM orders""",
)
def csv_roundtrip(s: SparkSession, d: str) -> DataFrame:
    """Semicolon file whose header starts with a byte order mark."""
    path = shared_folder(s, "csv")
    table(s, d, "orders").select(
        F.col("o_orderkey").alias("﻿o_orderkey"), "o_custkey",
        F.concat(F.lit("0"), F.col("o_orderstatus")).alias("status"),
        F.to_date("o_orderdate").alias("day"),
    ).write.option("header", True).option("sep", ";").csv(path)
    schema = declare(o_orderkey="long", o_custkey="long", status="string", day="date")
    return read_delimited(s, path, schema, sep=";").drop(CORRUPT)


# Columns of the file of which types are inferred, as SQL of both sides.
_TEXTS = {
    "o_orderkey": "CAST(o_orderkey AS STRING)",
    "big": "CAST(o_orderkey * 1000003000 AS STRING)",
    "status": "'0' || o_orderstatus",
    "code": "lpad(CAST(o_custkey AS STRING), 9, '0')",
    "price": "CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS STRING)",
    "day": "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10)",
    "moment": "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) || ' 10:11:12.5'",
    "mixed": "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' WHEN o_orderkey % 10 = 1 THEN '2024-02-30' "
             "WHEN o_orderkey % 10 = 2 THEN '1e3' WHEN o_orderkey % 10 = 3 THEN ' true ' "
             "ELSE CAST(o_custkey AS STRING) END",
    "gaps": "CASE WHEN o_orderkey % 3 = 0 THEN '  ' ELSE CAST(o_custkey AS STRING) END",
}
_FITS = {
    "int": "regexp_matches(v, '^[+-]?(0|[1-9][0-9]*)$') AND TRY_CAST(v AS INTEGER) IS NOT NULL",
    "long": "regexp_matches(v, '^[+-]?(0|[1-9][0-9]*)$') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
    "decimal": "regexp_matches(v, '^[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?$')",
    "double": "regexp_matches(v, '^[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?([eE][+-]?[0-9]+)?$')",
    "date": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND TRY_CAST(v AS DATE) IS NOT NULL",
    "timestamp": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}( .*)?$') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
    "boolean": "lower(v) IN ('true', 'false')",
    "string": "true",
}
_INFERRED = f"""
WITH v AS ({" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS col, trim({x}) AS v FROM orders" for i, (c, x) in enumerate(_TEXTS.items(), 1)
)}),
n AS (SELECT position, col, count(*) FILTER (WHERE v <> '') AS vals, count(*) FILTER (WHERE v = '') AS missing,
        {", ".join(f"count(*) FILTER (WHERE v <> '' AND {x}) AS {t}_" for t, x in _FITS.items())}
      FROM v GROUP BY 1, 2),
c AS (SELECT *, CASE {" ".join(f"WHEN vals > 0 AND {t}_ = vals THEN '{t}'" for t in _FITS)} ELSE 'string' END AS choice
      FROM n)
{" UNION ALL ".join(
    f"""SELECT CAST(position AS INTEGER) AS position, col AS "column", '{t}' AS type, vals AS "values", missing,
        vals - {t}_ AS lost, (vals - {t}_) / vals::DOUBLE AS lost_share, choice = '{t}' AS chosen FROM c"""
    for t in _FITS
)}"""


@query("infer_types", _INFERRED)
def infer_types_of_orders(s: SparkSession, d: str) -> DataFrame:
    """Types that the columns of a delimited file allow, and what each type would lose."""
    path = shared_folder(s, "csv")
    columns = [F.expr(x).alias(c) for c, x in _TEXTS.items()]
    columns[0] = columns[0].alias("\ufeffo_orderkey")
    table(s, d, "orders").select(*columns).write.option("header", True).option("sep", ";").csv(path)
    return infer_types(count_types(read_texts(s, path, ";")))


@query(
    "csv_inferred",
    f"""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, {_TEXTS["big"]} :: BIGINT AS big, {_TEXTS["status"]} AS status,
               {_TEXTS["code"]} AS code, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def csv_inferred(s: SparkSession, d: str) -> DataFrame:
    """The same file read with the inferred schema."""
    path = shared_folder(s, "csv")
    names = ["o_orderkey", "big", "status", "code", "day"]
    table(s, d, "orders").select(*[F.expr(_TEXTS[c]).alias(c) for c in names]).write.option(
        "header", True
    ).csv(path)
    return read_inferred(s, path).drop(CORRUPT)


@query(
    "csv_bad_rows",
    """SELECT CAST(count(*) FILTER (WHERE c_nationkey % 5 <> 0) AS BIGINT) AS good,
              CAST(count(*) FILTER (WHERE c_nationkey % 5 = 0) AS BIGINT) AS bad FROM customer""",
)
def csv_bad_rows(s: SparkSession, d: str) -> DataFrame:
    path = shared_folder(s, "csv")
    key = F.when(F.col("c_nationkey") % 5 == 0, F.lit("x")).otherwise(
        F.col("c_custkey").cast("string")
    )
    table(s, d, "customer").select(key.alias("c_custkey"), "c_name").write.option(
        "header", True
    ).csv(path)
    rows = read_delimited(s, path, declare(c_custkey="long", c_name="string"))
    return rows.select("c_custkey", "c_name", CORRUPT).agg(
        F.count_if(F.col(CORRUPT).isNull() & F.col("c_custkey").isNotNull()).alias("good"),
        F.count_if(F.col(CORRUPT).isNotNull() & F.col("c_name").isNotNull()).alias("bad"),
    )


@query(
    "stage_overwrite",
    "SELECT s_suppkey, upper(s_name) AS name, s_nationkey FROM supplier",
)
def stage_overwrite(s: SparkSession, d: str) -> DataFrame:
    """The second write replaces rows and schema of the first."""
    path = shared_folder(s, "stage")
    suppliers = table(s, d, "supplier")
    stage(suppliers, path)
    return stage(suppliers.select("s_suppkey", F.upper("s_name").alias("name"), "s_nationkey"), path)


@query(
    "load_report",
    """SELECT 'd_' || t AS "table", status, rows FROM (
         SELECT 'nation' AS t, 'OK' AS status, (SELECT count(*) FROM nation) AS rows
         UNION ALL SELECT 'orders', 'OK', (SELECT count(*) FROM orders)
         UNION ALL SELECT 'missing', 'ERROR', NULL)""",
)
def load_report(s: SparkSession, d: str) -> DataFrame:
    base = shared_folder(s, "load")
    for name in ("nation", "orders"):
        stage(table(s, d, name), f"{base}/{name}")
    names = ["nation", "missing", "orders"]
    return load_tables(
        s, read_tables(s, base, names), path_writer(f"{base}/target"),
        {n: f"d_{n}" for n in names},
    ).drop("error")


@query(
    "staged_sql",
    """SELECT n_name AS nation, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def staged_sql(s: SparkSession, d: str) -> DataFrame:
    """SQL over the staged layer, whatever wrote it."""
    names = ["orders", "customer", "nation"]
    register_views(
        stage_tables({n: table(s, d, n) for n in names}, shared_folder(s, "staged")), "dsa_"
    )
    return s.sql(
        """SELECT n_name AS nation, count(*) AS orders FROM dsa_orders
           JOIN dsa_customer ON o_custkey = c_custkey
           JOIN dsa_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )


@query(
    "publish_tables",
    """SELECT n_name AS nation, count(*) AS customers FROM customer
       JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 4 <> 1 GROUP BY 1""",
)
def publish_tables(s: SparkSession, d: str) -> DataFrame:
    """Readers see the last complete set, not the one of which a table failed."""
    base, name = shared_folder(s, "published"), f"set_{uuid.uuid4().hex}"
    nations, customers = table(s, d, "nation"), table(s, d, "customer")
    for rest in (0, 1):
        publish(
            s, {"nation": nations, "customer": customers.filter(F.col("c_custkey") % 4 != rest)},
            base, name,
        )
    broken = F.when(F.col("c_custkey") >= 0, F.raise_error(F.lit("broken")).cast("long"))
    with contextlib.suppress(Exception):
        publish(
            s, {"nation": nations.limit(0), "customer": customers.withColumn("c_custkey", broken)},
            base, name,
        )
    tables = published(s, name)
    return (
        tables["customer"].join(tables["nation"], F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    )


@query(
    "staged_counts",
    """SELECT 'nation' AS "table", count(*) AS rows FROM nation UNION ALL SELECT 'orders', count(*) FROM orders
       UNION ALL SELECT 'documents', count(*) FROM documents""",
)
def staged_counts(s: SparkSession, d: str) -> DataFrame:
    """Rows of tables from the footers of their files."""
    names = ["nation", "orders", "documents"]
    return footer_count_frame(s, {n: f"{d}/{n}.parquet" for n in names})


# --- workbooks made from the tables -----------------------------------------

_XML = '<?xml version="1.0" encoding="UTF-8"?>'
_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _cell(value: object) -> str:
    if value is None or value != value:
        return "<c/>"
    if isinstance(value, (int, float)):
        return f"<c><v>{value}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def make_workbook(rows: list[list[object]]) -> bytes:
    """Smallest workbook that holds ``rows``."""
    sheet = "".join(f"<row>{''.join(map(_cell, r))}</row>" for r in rows)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.comment = b"\n"
        z.writestr(
            "xl/workbook.xml",
            f'{_XML}<workbook {_MAIN} xmlns:r="{_REL}"><sheets>'
            '<sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>',
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'{_XML}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f"{_XML}<worksheet {_MAIN}><sheetData>{sheet}</sheetData></worksheet>",
        )
    return out.getvalue()


def _workbooks(rows: DataFrame, columns: list[str], header: bool) -> DataFrame:
    """One workbook per input batch, made where the rows are."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_PER_WORKBOOK):
                part = batch.iloc[at : at + ROWS_PER_WORKBOOK]
                body = [list(r) for r in part[columns].itertuples(index=False)]
                if not header:
                    body = [list(r[0]) for r in body]
                content = make_workbook(([list(columns)] if header else []) + body)
                yield pd.DataFrame({"path": ["made"], "content": [content]})

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    return rows.select(*columns).repartition(tasks).mapInPandas(
        build, "path string, content binary"
    )


@query(
    "xlsx_scan",
    """SELECT o_orderkey, o_custkey, ' ' || o_orderpriority || ' <&> ñ' AS priority, o_totalprice
       FROM orders""",
)
def xlsx_scan(s: SparkSession, d: str) -> DataFrame:
    orders = table(s, d, "orders").select(
        "o_totalprice", "o_orderkey",
        F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" <&> ñ")).alias("priority"),
        "o_custkey",
    )
    files = _workbooks(orders, orders.columns, header=True)
    return typed_table(
        files,
        declare(o_orderkey="long", o_custkey="long", priority="string", o_totalprice="double"),
    )


WRITTEN = "*.txt"


def _as_files(s: SparkSession, made: DataFrame) -> str:
    """Write workbooks held in a frame, each a file of a shared folder, where they were made.

    The tasks write them with the text source, which puts bytes out as they are and a
    line end after them: that is the workbook's comment. A folder holds one workbook.
    """
    folder = shared_folder(s, "workbooks")
    body = F.expr("substring(content, 1, octet_length(content) - 1)")
    made.select(
        F.monotonically_increasing_id().alias("book"), body.cast("string").alias("value")
    ).write.partitionBy("book").option("lineSep", "\n").text(folder)
    return folder


@query(
    "xlsx_files",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS s_name,
              1000000000000000 * (s_suppkey + 1) AS big FROM supplier""",
)
def xlsx_files(s: SparkSession, d: str) -> DataFrame:
    """Workbook files with missing-value texts and whole numbers stored as floats."""
    rows = table(s, d, "supplier").select(
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).otherwise(F.lit("N/A")).alias("s_name"),
        "s_suppkey", (F.lit(1e15) * (F.col("s_suppkey") + 1)).alias("big"),
    )
    folder = _as_files(s, _workbooks(rows, rows.columns, header=True))
    schema = declare(s_suppkey="long", s_name="string", big="long")
    return read_workbook(s, folder, schema, missing=MISSING_TEXTS, glob=WRITTEN)


@query(
    "xlsx_ragged_files",
    """SELECT n_nationkey || '|' || n_name || CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE '|' || n_regionkey END AS line
       FROM nation""",
)
def xlsx_ragged_files(s: SparkSession, d: str) -> DataFrame:
    """Files of rows without a header, cells missing here and there."""
    cells = F.array(
        F.col("n_nationkey").cast("string"), F.lit(" "), F.concat(F.lit(" "), F.col("n_name")),
        F.when(F.col("n_nationkey") % 3 != 0, F.col("n_regionkey").cast("string")),
    )
    folder = _as_files(
        s, _workbooks(table(s, d, "nation").select(cells.alias("cells")), ["cells"], False)
    )
    return clean_rows(read_ragged(s, folder, WRITTEN), "cells").select(
        F.array_join("cells", "|").alias("line")
    )


@query(
    "xlsx_ragged",
    """SELECT c_custkey || '|' || c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '|' || c_nationkey END AS line
       FROM customer""",
)
def xlsx_ragged(s: SparkSession, d: str) -> DataFrame:
    cells = F.array(
        F.lit(None).cast("string"),
        F.col("c_custkey").cast("string"),
        F.lit("  "),
        F.concat(F.lit(" "), F.col("c_name")),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_nationkey").cast("string")),
        F.lit("nan"),
    )
    files = _workbooks(table(s, d, "customer").select(cells.alias("cells")), ["cells"], False)
    return clean_rows(workbook_rows(files), "cells").select(
        F.array_join("cells", "|").alias("line")
    )
