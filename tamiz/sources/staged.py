"""The staged layer and the targets behind it."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .counts import footer_counts

REPORT_SCHEMA = "table string, status string, rows long, error string"

ROWS_PER_FILE = 500_000


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a session in local mode that
    names none gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def read_staged(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read one staged table."""
    return spark.read.format(fmt).load(path)


def stage(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Overwrite a staged table, schema included, and return it re-read.

    The returned frame reads the files, so what follows neither repeats the
    plan behind ``df`` nor depends on executors that held it. A partitioned
    table is rebalanced by its partition columns first: one large partition is
    split over several files, small ones do not scatter over all tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    reader = df.sparkSession.read.format(fmt)
    if fmt == "parquet":
        # Known already; inferring would also turn partition codes into numbers.
        reader = reader.schema(df.schema)
    return reader.load(path)


def files_for(rows: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Files that so many rows fill, one at least."""
    return max(1, -(-rows // rows_per_file))


def stage_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, name: str | None = None
) -> DataFrame:
    """Stage a table in sorted buckets of ``keys`` and return it as a table.

    Tables in the same number of buckets of keys of the same types are joined on those
    keys without moving a row (:func:`tamiz.operators.joins.bucketed_join`), in every
    later job as well; the rows are dealt out once, here. The buckets are known to the
    catalog of the session, under ``name`` or one of its own.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys).write.mode("overwrite")
        .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def stage_tables(
    tables: Mapping[str, DataFrame], base: str, fmt: str = "parquet", at_once: int = 4
) -> dict[str, DataFrame]:
    """Stage every table under ``base/<name>``, a few at once.

    Small tables leave most of a cluster idle; writing some side by side fills
    it. Any failure is raised after the running writes have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {
            n: pool.submit(
                inheritable_thread_target(df.sparkSession)(stage), df, f"{base}/{n}", fmt
            )
            for n, df in tables.items()
        }
    return {n: r.result() for n, r in running.items()}


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make tables available to SQL as ``<prefix><name>``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


@dataclass(frozen=True)
class StagedTable:
    """Loader of a staged table; a missing one fails when it is called."""

    spark: SparkSession
    path: str
    fmt: str = "parquet"

    def __call__(self) -> DataFrame:
        return read_staged(self.spark, self.path, self.fmt)

    def rows(self) -> int:
        return staged_rows(self.spark, self.path, self.fmt)


def staged_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> int:
    """Rows of a staged table; those of Parquet files are in their footers."""
    if fmt == "parquet":
        return footer_counts(spark, {path: path})[path]
    return read_staged(spark, path, fmt).count()


def read_tables(
    spark: SparkSession, base: str, names: Sequence[str], fmt: str = "parquet"
) -> dict[str, StagedTable]:
    """Loaders of staged tables."""
    return {n: StagedTable(spark, f"{base}/{n}", fmt) for n in names}


def load_tables(
    spark: SparkSession,
    sources: Mapping[str, DataFrame | Callable[[], DataFrame]],
    write: Callable[[DataFrame, str], int],
    targets: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write each table to its target; one failure does not stop the others.

    ``write(frame, target)`` returns the rows it finds in the target afterwards.
    A count that differs from the source is an error too: it reveals partial
    and repeated task output. Staged tables are counted from their footers. Returns ``(table, status, rows, error)``.
    """
    names = targets or {n: n for n in sources}
    report = []
    for name, target in names.items():
        try:
            source = sources[name]
            frame = source() if callable(source) else source
            expected = source.rows() if isinstance(source, StagedTable) else frame.count()
            found = write(frame, target)
            if expected == found:
                report.append((target, "OK", found, None))
            else:
                report.append((target, "ERROR", found, f"expected {expected} rows"))
        except Exception as e:  # noqa: BLE001 - the report is the handler
            first_line = (str(e).splitlines() or [""])[0]
            report.append((target, "ERROR", None, f"{type(e).__name__}: {first_line}"))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def path_writer(base: str, fmt: str = "parquet") -> Callable[[DataFrame, str], int]:
    """Target writer for :func:`load_tables`: overwrite ``base/<target>``."""

    def write(df: DataFrame, target: str) -> int:
        stage(df, f"{base}/{target}", fmt)
        return staged_rows(df.sparkSession, f"{base}/{target}", fmt)

    return write


def jdbc_properties(driver: str, prefix: str = "DW") -> dict[str, str]:
    """Connection properties; user and password come from the environment."""
    return {
        "driver": driver,
        "user": os.environ[f"{prefix}_USER"],
        "password": os.environ[f"{prefix}_PASSWORD"],
    }


def jdbc_writer(
    url: str,
    properties: Mapping[str, str],
    schema: str | None = None,
    partitions: int = 16,
    batch_size: int = 10_000,
    truncate: bool = True,
) -> Callable[[DataFrame, str], int]:
    """Target writer for :func:`load_tables`: overwrite a database table.

    ``partitions`` bounds the connections, ``truncate`` keeps the table's
    definition and grants. Rows are counted in the target afterwards, because a
    task that is repeated after its commit would write them twice.
    """

    def write(df: DataFrame, target: str) -> int:
        table = f"{schema}.{target}" if schema else target
        options = dict(properties) | {
            "numPartitions": str(partitions),
            "batchsize": str(batch_size),
            "truncate": str(truncate).lower(),
        }
        df.write.jdbc(url, table, mode="overwrite", properties=options)
        # Counted by the database, so one row comes back.
        counted = f"(SELECT count(*) AS n FROM {table}) counted"
        found = df.sparkSession.read.jdbc(url, counted, properties=dict(properties))
        return int(found.first()[0])

    return write
