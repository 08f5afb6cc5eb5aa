"""Dimension building: stamps, unknown members, keys, calendar, upsert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import date_key, half_year, iso_weekday, nth_name
from ..sources.staged import shared_folder, stage
from .dedup import dedup
from .joins import lookup_join


def load_stamp(run_ts: str | None) -> Column:
    """Load time: a given time for repeatable loads, else the current one.

    The type is the same either way. Pass :func:`run_time` to stamp all tables of a
    run alike.
    """
    return (F.current_timestamp() if run_ts is None else F.lit(run_ts)).cast("timestamp_ntz")


def run_time() -> str:
    """The time now, in UTC, as text for ``run_ts``."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def rename_and_stamp(
    df: DataFrame,
    columns: Mapping[str, str],
    run_ts: str | None = None,
    stamps: Sequence[str] = ("etl_fecha_carga",),
) -> DataFrame:
    """Project to dimension names and add audit columns."""
    return df.select(
        *[F.col(c).alias(o) for c, o in columns.items()],
        *[load_stamp(run_ts).alias(s) for s in stamps],
    )


def with_unknown_member(
    dim: DataFrame, values: Mapping[str, object], key: str | None = None
) -> DataFrame:
    """Add the row that facts without a match point to.

    Columns not in ``values`` are NULL; types follow the dimension. With ``key`` the
    result fails to compute if a row of the dimension has the unknown row's key.
    """
    if key is not None:
        taken = F.raise_error(F.lit(f"{key} {values[key]} is the unknown member's"))
        checked = F.when(F.col(key) == F.lit(values[key]), taken.cast(dim.schema[key].dataType))
        dim = dim.withColumn(key, checked.otherwise(F.col(key)))
    unknown = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(unknown)


def surrogate_key(
    dim: DataFrame, business_key: Sequence[str], id_column: str, buckets: int = 4096
) -> DataFrame:
    """Dense ids 1..n without a global sort.

    Rows are numbered inside hash buckets of their business key and shifted by
    the rows of the buckets before. The bucket comes from the key alone, so ids
    do not depend on partitioning and repeat on every run. ``business_key`` must
    be unique; only the per-bucket totals are ordered in one place. Rows are staged,
    as they are read for the numbers and for the totals.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in business_key])
    bucket = F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int") % F.lit(buckets)
    rows = dim.withColumn("__bucket", bucket)
    rows = stage(rows, shared_folder(dim.sparkSession, "keyed"))
    totals = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    numbered = rows.withColumn(
        "__rn", F.row_number().over(Window.partitionBy("__bucket").orderBy(*business_key))
    )
    # At most `buckets` rows: the broadcast is bounded by construction.
    return numbered.join(F.broadcast(offsets), "__bucket").select(
        (F.col("__offset") + F.col("__rn")).cast("long").alias(id_column), *dim.columns
    )


def calendar_rows(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day, column ``d``, for each (start, end) of ``bounds``."""
    return bounds.select(
        F.explode(F.sequence(F.col(start), F.col(end), F.expr("interval 1 day"))).alias("d")
    )


def calendar_attributes(
    days: DataFrame,
    month_names: Sequence[str],
    weekday_names: Sequence[str],
    half_names: Sequence[str],
) -> DataFrame:
    """Calendar dimension of the distinct days in column ``d``."""
    d = F.col("d")
    return days.select("d").distinct().select(
        date_key(d).alias("id_tiempo"),
        F.year(d).alias("anio"),
        half_year(d).alias("semestre"),
        nth_name(half_year(d), half_names).alias("semestre_nombre"),
        F.month(d).alias("mes"),
        nth_name(F.month(d), month_names).alias("mes_nombre"),
        nth_name(iso_weekday(d), weekday_names).alias("dia"),
    )


def calendar_dim(
    spark: SparkSession,
    start: str,
    end: str,
    month_names: Sequence[str],
    weekday_names: Sequence[str],
    half_names: Sequence[str],
) -> DataFrame:
    """Calendar dimension from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_attributes(
        calendar_rows(bounds, "start", "end"), month_names, weekday_names, half_names
    )


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str] = (),
    **limits: int,
) -> DataFrame:
    """Updates win over target rows of the same key; new keys are added.

    Several updates of one key are reduced to the first by ``order``. Write the
    result to a new path: the target cannot be overwritten while it is read.
    """
    latest = dedup(updates, key, order)
    kept = lookup_join(target, latest.select(*key), list(key), "left_anti", null_safe=True, **limits)
    return kept.unionByName(latest)


def merge_into(
    updates: DataFrame, table: str, key: Sequence[str], order: Sequence[Column | str] = ()
) -> None:
    """The same upsert as a MERGE, for table formats that support it.

    Updates of one key are reduced to the first by ``order``, and NULL keys are equal,
    as in :func:`upsert`.
    """
    condition = F.lit(True)
    for k in key:
        condition = condition & F.col(f"{table}.{k}").eqNullSafe(F.col(f"updates.{k}"))
    (
        dedup(updates, key, order).alias("updates")
        .mergeInto(table, condition)
        .whenMatched().updateAll()
        .whenNotMatched().insertAll()
        .merge()
    )
