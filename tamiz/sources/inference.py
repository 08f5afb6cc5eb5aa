"""Types of text columns, found from all rows by counts that add up.

Every value is tested against every type of the lattice, from narrow to wide: whole
numbers of 32 and 64 bits, decimals, floating point, dates, timestamps, booleans, text.
Codes such as ``007`` are no numbers. The counts of a file, a partition or a load are one
row per column, so they can be stored and added, and the types of a growing table need
only its new files. A column gets the first type that fits all its values, or all but a
share that the caller allows to be lost; blank values fit everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from .delimited import read_delimited

_WHOLE = r"^[+-]?(0|[1-9][0-9]*)$"
_DECIMAL = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?$"
_FLOAT = r"^[+-]?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
# From narrow to wide; text takes what is left.
LATTICE = ("int", "long", "decimal", "double", "date", "timestamp", "boolean", "string")
MOST_DIGITS = 38

COUNTS = ["position", "column", "values", "missing", *[f"fit_{t}" for t in LATTICE],
          "whole_digits", "fraction_digits"]


def _fits(value: Column) -> dict[str, Column]:
    """Whether a trimmed value can be read as each type; shapes are tested before parsing."""
    whole = value.rlike(_WHOLE)
    digits = F.length(F.regexp_extract(value, "^[+-]?([0-9]+)", 1))
    fraction = F.length(F.regexp_extract(value, r"\.([0-9]+)$", 1))
    decimal = value.rlike(_DECIMAL)
    return {
        "int": whole & F.when(whole, value.try_cast("int")).isNotNull(),
        "long": whole & F.when(whole, value.try_cast("long")).isNotNull(),
        "decimal": decimal & (digits + fraction <= MOST_DIGITS),
        "double": value.rlike(_FLOAT),
        "date": F.when(value.rlike(_DATE), value.try_cast("date")).isNotNull(),
        "timestamp": F.when(value.rlike(_MOMENT), value.try_cast("timestamp_ntz")).isNotNull(),
        "boolean": F.lower(value).isin("true", "false"),
        "string": F.lit(True),
    }


def count_types(df: DataFrame) -> DataFrame:
    """One row per text column: values, missing ones, and how many fit each type.

    One scan and one aggregate, whatever the number of columns. Columns that are not text are left
    out. ``whole_digits`` and ``fraction_digits`` are the most digits of a decimal.
    """
    texts = [
        (i, f.name) for i, f in enumerate(df.schema.fields, 1)
        if isinstance(f.dataType, T.StringType)
    ]
    if not texts:
        raise ValueError("no text column")
    # Values below each other: the tests are compiled once, not for every column.
    values = df.select(F.posexplode(F.array(*[F.col(f"`{c}`") for _, c in texts])))
    value, there = F.trim("col"), ~is_blank(F.col("col"))
    fits = {t: there & F.coalesce(f, F.lit(False)) for t, f in _fits(value).items()}
    tested = values.select(
        "pos", there.alias("there"), *[f.alias(t) for t, f in fits.items()],
        F.length(F.regexp_extract(value, "^[+-]?([0-9]+)", 1)).alias("whole"),
        F.length(F.regexp_extract(value, r"\.([0-9]+)$", 1)).alias("fraction"),
    )

    def most(c: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("decimal"), F.col(c))), F.lit(0))

    counted = tested.groupBy("pos").agg(
        F.count_if("there").alias("values"), F.count_if(~F.col("there")).alias("missing"),
        *[F.count_if(t).alias(f"fit_{t}") for t in LATTICE],
        most("whole").alias("whole_digits"), most("fraction").alias("fraction_digits"),
    )
    # A table without rows has its columns all the same.
    listed = df.sparkSession.createDataFrame(
        [(k, i, c) for k, (i, c) in enumerate(texts)], "pos int, position int, column string"
    )
    zeros = {c: F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS[2:]}
    return listed.join(counted, "pos", "left").select("position", "column", *zeros.values())


def merge_counts(counts: DataFrame) -> DataFrame:
    """Counts of several files or loads as those of all of them together."""
    sums = ["values", "missing", *[f"fit_{t}" for t in LATTICE]]
    return counts.groupBy("column").agg(
        F.min("position").alias("position"),
        *[F.sum(c).alias(c) for c in sums],
        *[F.max(c).alias(c) for c in ("whole_digits", "fraction_digits")],
    ).select(*COUNTS)


def infer_types(counts: DataFrame, tolerate: float = 0.0) -> DataFrame:
    """``(position, column, type, values, missing, lost, lost_share, chosen)``.

    One row per column and type: the values that the type could not read, and whether
    it is the narrowest that loses at most the share ``tolerate``. A decimal must have
    room for the most whole and the most fraction digits together. A column without
    values is text.
    """
    n = F.col("values")
    wide = F.col("whole_digits") + F.col("fraction_digits") > MOST_DIGITS
    lost = {t: n - F.col(f"fit_{t}") for t in LATTICE}
    allowed = {t: (n > 0) & (lost[t] <= n * F.lit(tolerate)) for t in LATTICE}
    allowed["decimal"] = allowed["decimal"] & ~wide
    choice = F.coalesce(*[F.when(allowed[t], F.lit(t)) for t in LATTICE], F.lit("string"))
    each = F.explode(F.array(*[
        F.struct(F.lit(t).alias("type"), lost[t].alias("lost")) for t in LATTICE
    ]))
    rows = counts.select("position", "column", n, "missing", choice.alias("choice"), each.alias("e"))
    return rows.select(
        "position", "column", F.col("e.type").alias("type"), "values", "missing",
        F.col("e.lost").alias("lost"),
        F.when(n > 0, F.col("e.lost") / n).otherwise(F.lit(0.0)).alias("lost_share"),
        (F.col("e.type") == F.col("choice")).alias("chosen"),
    )


_TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampNTZType(), "boolean": T.BooleanType(),
    "string": T.StringType(),
}


def inferred_schema(counts: DataFrame, tolerate: float = 0.0) -> T.StructType:
    """The chosen types as a schema, columns in their order."""
    chosen = infer_types(counts, tolerate).filter("chosen").select("column", "type")
    digits = counts.select("column", "position", "whole_digits", "fraction_digits")
    rows = digits.join(chosen, "column").orderBy("position").collect()  # one row per column
    fields = []
    for r in rows:
        kind = _TYPES.get(r["type"]) or T.DecimalType(
            max(1, r["whole_digits"] + r["fraction_digits"]), r["fraction_digits"]
        )
        fields.append(T.StructField(r["column"], kind))
    return T.StructType(fields)


def read_texts(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """A headed delimited file with all columns as text; only its header is read for that."""
    head = (
        spark.read.option("header", True).option("sep", sep)
        .csv(path if isinstance(path, str) else list(path))
    )
    names = [c.removeprefix("﻿") for c in head.columns]
    return head.toDF(*names)


def read_inferred(
    spark: SparkSession, path: str | list[str], sep: str = ",", tolerate: float = 0.0,
    bad_rows: str = "keep",
) -> DataFrame:
    """A headed delimited file with the types that all its rows allow.

    Reads the file twice, as its types depend on every row. Declare the schema where it
    is known (:func:`tamiz.sources.delimited.read_delimited`).
    """
    schema = inferred_schema(count_types(read_texts(spark, path, sep)), tolerate)
    return read_delimited(spark, path, schema, sep, bad_rows)
