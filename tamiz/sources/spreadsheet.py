"""XLSX workbooks as a Spark source: one workbook per task, rows streamed out.

Files are listed and shipped by Spark's ``binaryFile`` source. The Python part
only turns one workbook into rows of text cells; header handling, typing and
everything after is done on DataFrames.
"""

from __future__ import annotations

import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from decimal import Decimal
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship_package

ROWS_SCHEMA = "path string, row_no int, cells array<string>"
_BATCH_ROWS = 2000
# Fixed values of the file format: namespaces and built-in date formats.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}


def _column_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + ord(ch.upper()) - 64
    return n - 1


def _first_sheet(z: zipfile.ZipFile) -> str:
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    sheet = book.find(f"{_MAIN}sheets/{_MAIN}sheet")
    wanted = sheet.get(_RELATION)
    for rel in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")):
        if rel.get("Id") == wanted:
            return posixpath.normpath(posixpath.join("xl", rel.get("Target"))).lstrip("/")
    raise ValueError("workbook has no first sheet")


def _text(node: ElementTree.Element) -> str:
    runs = [t.text or "" for t in node.findall(f"{_MAIN}t")]
    runs += [t.text or "" for t in node.findall(f"{_MAIN}r/{_MAIN}t")]
    return "".join(runs)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    return [_text(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    custom = set()
    for f in root.iter(f"{_MAIN}numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")).lower()
        if re.search("[dmyh]", code):
            custom.add(int(f.get("numFmtId")))
    xfs = root.find(f"{_MAIN}cellXfs")
    return {
        i
        for i, xf in enumerate([] if xfs is None else xfs)
        if int(xf.get("numFmtId", "0")) in _DATE_FORMATS | custom
    }


def _first_day(z: zipfile.ZipFile) -> datetime:
    """Day 0 of the workbook's dates: it counts from 1900, or from 1904."""
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    settings = book.find(f"{_MAIN}workbookPr")
    late = settings is not None and settings.get("date1904", "0").lower() in ("1", "true")
    return datetime(1904, 1, 1) if late else datetime(1899, 12, 30)


def _number(text: str, day_0: datetime | None) -> str:
    if day_0 is not None:
        moment = day_0 + timedelta(seconds=round(float(text) * 86400))
        return moment.strftime("%Y-%m-%d %H:%M:%S")
    value = Decimal(text)
    # Whole numbers that a long can hold are written out, whatever form they are stored in.
    whole = value == value.to_integral_value() and abs(value) < 1 << 63
    return str(int(value)) if whole else text


def _cell(
    c: ElementTree.Element, strings: list[str], dates: set[int], day_0: datetime
) -> str | None:
    kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
    if kind == "inlineStr":
        inline = c.find(f"{_MAIN}is")
        return None if inline is None else _text(inline)
    if v is None or v.text is None:
        return None
    if kind == "s":
        return strings[int(v.text)]
    if kind == "n":
        return _number(v.text, day_0 if int(c.get("s", "0")) in dates else None)
    if kind == "b":
        return "True" if v.text == "1" else "False"
    return None if kind == "e" else v.text


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """``(row number, cells)`` of the first sheet, gaps filled with None."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings, dates, day_0 = _shared_strings(z), _date_styles(z), _first_day(z)
        with z.open(_first_sheet(z)) as sheet:
            number, data = 0, None
            for event, row in ElementTree.iterparse(sheet, ("start", "end")):
                if row.tag == f"{_MAIN}sheetData":
                    data = row
                if event == "start" or row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", number + 1))
                cells: list[str | None] = []
                for c in row.findall(f"{_MAIN}c"):
                    at = _column_index(c.get("r", "")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells))
                    cells.append(_cell(c, strings, dates, day_0))
                data.clear()
                yield number, cells


def _aligned(
    rows: Iterator[tuple[int, list[str | None]]], names: Sequence[str], optional: Sequence[str],
    path: str,
) -> Iterator[tuple[int, list[str | None]]]:
    """Cells in the order of ``names``, found through the first filled row."""
    at: list[int | None] | None = None
    for number, cells in rows:
        if not any(c and c.strip() for c in cells):
            continue
        if at is None:
            where = {(c or "").strip(): i for i, c in enumerate(cells)}
            at = [where.get(n) for n in names]
            absent = [n for n in names if n not in where and n not in optional]
            if absent:
                raise ValueError(f"{path} has no column {', '.join(absent)}")
        else:
            yield number, [cells[i] if i is not None and i < len(cells) else None for i in at]


def workbook_rows(
    files: DataFrame, header: Sequence[str] | None = None, optional: Sequence[str] = ()
) -> DataFrame:
    """``(path, row_no, cells)`` of the first sheet of every workbook.

    ``files`` has columns ``path`` and ``content``, as ``binaryFile`` gives them.
    With ``header`` the first filled row names the columns and ``cells`` holds
    the named ones in that order. A column the sheet lacks is an error, or NULL if
    it is ``optional``. Finding them while parsing saves a join of all rows with
    their header row.
    """
    ship_package(files.sparkSession)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                rows = sheet_rows(content)
                if header is not None:
                    rows = _aligned(rows, header, optional, path)
                while chunk := list(islice(rows, _BATCH_ROWS)):
                    yield pd.DataFrame(
                        [(path, number, cells) for number, cells in chunk],
                        columns=["path", "row_no", "cells"],
                    )

    return files.select("path", "content").mapInPandas(parse, ROWS_SCHEMA)


def workbook_files(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """All workbooks under ``path``, by the pattern of their names."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def read_ragged(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """Rows of cells of all workbooks under ``path``, no header expected."""
    return workbook_rows(workbook_files(spark, path, glob))


# Texts that common spreadsheet readers take for a missing value.
MISSING_TEXTS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def typed_table(
    files: DataFrame, schema: T.StructType, optional: Sequence[str] = (),
    missing: Sequence[str] = (),
) -> DataFrame:
    """Headed workbooks as one table; values that do not fit their type are NULL.

    Cells whose text is one of ``missing`` (for instance :data:`MISSING_TEXTS`) are
    NULL as well. Columns that are not ``optional`` must be in every sheet.
    """
    rows = workbook_rows(files, schema.fieldNames(), optional)

    def value(i: int) -> Column:
        cell = F.get("cells", F.lit(i))
        return F.when(~cell.isin(list(missing)), cell) if missing else cell

    return rows.select(
        *[value(i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    )


def read_workbook(
    spark: SparkSession, path: str, schema: T.StructType, optional: Sequence[str] = (),
    missing: Sequence[str] = (), glob: str = "*.xlsx",
) -> DataFrame:
    """Headed workbooks under ``path`` as one typed table."""
    return typed_table(workbook_files(spark, path, glob), schema, optional, missing)
