"""A set of tables that readers see change all at once, or not at all.

Every run stages its tables under a path of its own. When all are there and have been
counted, one statement replaces the view ``<name>_tables`` that lists table, path and
rows: from then on readers get the new set. Until then, and if anything fails, they get
the old one. Frames made before keep reading the old files, which stay until
:func:`expire` is called. The catalog of the session is the only state.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .counts import footer_counts
from .staged import stage_tables


class PublicationError(ValueError):
    """A set of tables is not fit to be published."""


def new_version(base: str) -> str:
    """A path for the tables of one run; no other run writes there."""
    return f"{base.rstrip('/')}/version-{uuid.uuid4().hex}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def switch(
    spark: SparkSession, name: str, paths: Mapping[str, str],
    expected: Mapping[str, int] | None = None,
) -> dict[str, int]:
    """Make staged Parquet tables the ones that readers of ``name`` see; returns their rows.

    All tables are counted from their footers first, so one that is missing or broken
    stops the switch, as does one whose rows are not those ``expected``. After the
    switch every table also has a view ``<name>_<table>`` for plain SQL; those are
    replaced one by one, and readers who need tables of the same run take them from
    :func:`published`.
    """
    try:
        rows = footer_counts(spark, paths)
    except Exception as e:
        raise PublicationError(f"{name}: a table cannot be read; nothing is published") from e
    for table, n in (expected or {}).items():
        if rows.get(table) != n:
            raise PublicationError(f"{name}: {table} has {rows.get(table)} rows, not {n}")
    listed = ", ".join(f"({_quoted(t)}, {_quoted(p)}, {rows[t]}L)" for t, p in paths.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {name}_tables AS "
        f"SELECT * FROM VALUES {listed} AS listed(table, path, rows)"
    )
    for table, path in paths.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name}_{table} AS SELECT * FROM parquet.`{path}`")
    return rows


def publish(
    spark: SparkSession, tables: Mapping[str, DataFrame], base: str, name: str, at_once: int = 4
) -> dict[str, int]:
    """Stage tables and switch to them. A failure raises and changes nothing for readers."""
    version = new_version(base)
    stage_tables(tables, version, "parquet", at_once)
    return switch(spark, name, {t: f"{version}/{t}" for t in tables})


def manifest(spark: SparkSession, name: str) -> dict[str, tuple[str, int]]:
    """Path and rows of every published table, as of one moment."""
    return {r["table"]: (r["path"], r["rows"]) for r in spark.table(f"{name}_tables").collect()}


def published(
    spark: SparkSession, name: str, tables: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The published tables, all of the same run."""
    listed = manifest(spark, name)
    return {t: spark.read.parquet(listed[t][0]) for t in (tables or listed)}


def expire(spark: SparkSession, base: str, name: str, keep: Sequence[str] = ()) -> list[str]:
    """Delete the versions under ``base`` that are neither published nor in ``keep``.

    Call it when no reader of an older version is left and no run is being staged.
    Returns the paths deleted.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(base)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    used = [str(p) for p, _ in manifest(spark, name).values()] + [k.rstrip("/") + "/" for k in keep]
    gone = []
    for status in system.listStatus(folder):
        path = status.getPath()
        if not path.getName().startswith("version-"):
            continue
        if not any(f"/{path.getName()}/" in u for u in used):
            system.delete(path, True)
            gone.append(path.toString())
    return gone
