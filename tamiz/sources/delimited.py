"""Delimited text with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
_MODES = {"keep": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(),
    "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(),
}


def declare(*names: str, **typed: str) -> T.StructType:
    """Schema from names (text) and ``name="type"`` pairs; needs no session."""
    fields = [T.StructField(n, T.StringType()) for n in names]
    return T.StructType(fields + [T.StructField(n, _TYPES[t]) for n, t in typed.items()])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    bad_rows: str = "keep",
) -> DataFrame:
    """Read a headed delimited file; a byte order mark is accepted.

    The schema is declared: inference would read the data twice and turn codes
    with leading zeros into numbers. Header names are checked against it.
    ``bad_rows``: ``keep`` stores the raw line in ``_corrupt_record``, ``drop``
    leaves such rows out, ``fail`` raises.
    """
    full = schema
    if bad_rows == "keep":
        full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("mode", _MODES[bad_rows])
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )
