"""The narrative census sheet and its cleaned levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ...operators.ragged import clean_rows
from .. import academic as A
from .base import query
from .census_sql import CENSUS_COLUMNS
from .raw import raw

def census(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return A.census_tables(raw(s, d, "raw_census"), "cells")


@query(
    "ragged_clean_rows",
    """SELECT array_to_string(a, '|') AS line, CAST(len(a) AS INTEGER) AS width, count(*) AS rows
       FROM census_clean GROUP BY 1, 2""",
)
def ragged_clean_rows(s: SparkSession, d: str) -> DataFrame:
    rows = clean_rows(raw(s, d, "raw_census"), "cells")
    return (
        rows.selectExpr("array_join(cells, '|') AS line", "size(cells) AS width")
        .groupBy("line", "width")
        .agg({"*": "count"})
        .withColumnRenamed("count(1)", "rows")
    )


for _t, (_source, *_rest) in CENSUS_COLUMNS.items():
    query(f"ragged_{_t}", f"SELECT * FROM {_source}")(lambda s, d, t=_t: census(s, d)[t])
    query(f"clean_{_t}", f"SELECT * FROM c_{_t}")(
        lambda s, d, t=_t: A.clean_census(census(s, d))[t]
    )
