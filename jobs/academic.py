"""The academic warehouse as a Spark job.

    spark-submit jobs/academic.py build --input DIR --staging DIR [--compat] [--publish NAME]
    spark-submit jobs/academic.py dims  --staging DIR --warehouse DIR --province-map CSV
    spark-submit jobs/academic.py load  --staging DIR --jdbc-url URL --jdbc-driver CLASS
        [--targets staged=target ...]

``build`` profiles, validates, cleans, integrates and stages; ``dims`` derives the
dimensions; ``load`` copies staged tables to a database, with user and password
from DW_USER and DW_PASSWORD. The province map has a header and the columns
strCodProv (province code of a city) and cod_provincia (census code): without it
students have no home place, as the two sets of codes share none. With ``--publish``
the tables are staged under a path of their own and readers of NAME get them all at
once, see tamiz/sources/publish.py. The package is
sent to the executors, so the job runs from any folder.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tamiz.operators.dims import run_time  # noqa: E402
from tamiz.plans import academic, warehouse  # noqa: E402
from tamiz.shipping import ship_package  # noqa: E402
from tamiz.sources.delimited import declare, read_delimited  # noqa: E402
from tamiz.sources.publish import new_version, switch  # noqa: E402
from tamiz.sources.staged import (  # noqa: E402
    jdbc_properties, jdbc_writer, load_tables, read_staged, read_tables,
)

TABLES = [
    *academic.SOURCES, "dpa_provincias", "dpa_cantones", "dpa_parroquias",
    "estudiante_final", "carrera_final", "matricula_final", "graduados_final",
]


def show(title: str, df: DataFrame) -> None:
    """Print a report; reports have a few rows per table, so all of them are shown."""
    print(f"== {title}")
    df.show(df.count(), truncate=False)


def build(spark: SparkSession, args: argparse.Namespace) -> None:
    complete = academic.read_sources(spark, args.input, keep_corrupt=True)
    raw = academic.for_cleaning(complete)
    for name, df in raw.items():
        df.printSchema()
        show(name, df.limit(5))  # a look at the data; sample_rows gives a repeatable one
    show("profile", academic.profile_sources(raw))
    show("validation", academic.validate(raw))
    census = academic.read_census(spark, args.input)
    base = new_version(args.staging) if args.publish else args.staging
    staged = academic.build(raw, census, base, args.format, args.compat)
    if args.publish:
        switch(spark, args.publish, {n: f"{base}/{n}" for n in staged})
    show("quality", academic.report(complete, staged).orderBy("source"))
    lost = academic.cleaning_funnel(raw, staged, census, compat=args.compat)
    show("rows lost by step", lost.orderBy("table", "position"))


def dims(spark: SparkSession, args: argparse.Namespace) -> None:
    staged = {n: read_staged(spark, f"{args.staging}/{n}", args.format) for n in TABLES}
    mapping = None if not args.province_map else read_delimited(
        spark, args.province_map, declare("strCodProv", "cod_provincia"), ","
    ).select("strCodProv", "cod_provincia")
    done = warehouse.build_warehouse(
        staged, args.warehouse, args.format, args.run_ts or run_time(),
        province_map=mapping, compat=args.compat,
    )
    for name, df in done.items():
        print(f"{name}: {df.count()} rows")


def load(spark: SparkSession, args: argparse.Namespace) -> None:
    targets = dict(t.split("=", 1) for t in args.targets)
    names = args.tables or list(targets) or TABLES
    write = jdbc_writer(args.jdbc_url, jdbc_properties(args.jdbc_driver), args.schema)
    sources = read_tables(spark, args.staging, names, args.format)
    show("load", load_tables(spark, sources, write, {n: targets.get(n, n) for n in names}))


def parse(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, run in (("build", build), ("dims", dims), ("load", load)):
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("--staging", required=True)
        p.add_argument("--format", default="parquet")
        p.add_argument("--compat", action="store_true")
        if name == "build":
            p.add_argument("--input", required=True)
            p.add_argument("--publish", metavar="NAME")
        if name == "dims":
            p.add_argument("--warehouse", required=True)
            p.add_argument("--run-ts")
            p.add_argument("--province-map")
        if name == "load":
            p.add_argument("--jdbc-url", required=True)
            p.add_argument("--jdbc-driver", required=True)
            p.add_argument("--schema", default="dsa")
            p.add_argument("--targets", nargs="*", default=[], metavar="STAGED=TARGET")
            p.add_argument("tables", nargs="*")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName("academic").getOrCreate()
    ship_package(spark)
    args.run(spark, args)


if __name__ == "__main__":
    main()
