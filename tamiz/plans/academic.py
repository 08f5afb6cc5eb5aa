"""The academic warehouse: sources, cleaning, integration, staging, report.

``compat=True`` reproduces the behaviour of the original batch job where this
plan deliberately differs; each function says in which way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import categorize, map_code
from ..functions.dates import iso_date, iso_date_or, parse_date, period_label
from ..functions.text import (
    clean, default_if_blank, not_blank, strip_markers, strip_quotes,
)
from ..operators.cleaning import (
    CleanSpec, Reference, clean_table, date_window, funnel, present,
)
from ..operators.enrich import Lookup, enrich
from ..operators.profile import profile_tables
from ..operators.ragged import Narrative, parse_narrative
from ..operators.refint import lookup_or_default
from ..operators.report import malformed_lines, quality_report
from ..operators.rules import (
    ForeignKeyRule, UniqueRule, date_range, in_domain, min_date, nonzero,
    summarize_rules,
)
from ..sources.delimited import CORRUPT, read_delimited, declare
from ..sources.spreadsheet import MISSING_TEXTS, read_ragged, read_workbook
from ..sources.staged import stage_bucketed, stage_tables
from . import values as V

# What is done with the rows of a source and their spec: cleaning, or counting what it loses.
Cleaner = Callable[[DataFrame, CleanSpec], DataFrame]

CENSUS_WORDS = Narrative(V.LEVEL1_WORD, V.LEVEL1_PREFIX, V.LEVEL2_WORD, V.SKIP_WORD)

_NAMED = declare("strCodigo", "strNombre")


# Source -> (file, separator or None for a workbook, declared schema).
SOURCES: dict[str, tuple[str, str | None, T.StructType]] = {
    "provincias": ("provincias.csv", ",", _NAMED),
    "ciudades": ("ciudades.csv", ",", declare("strCodigo", "strNombre", "strCodProv")),
    "sexo": ("sexo.csv", ",", _NAMED),
    "facultades": ("facultades.csv", ",", _NAMED),
    "escuelas": ("escuelas.csv", ",", declare("strCodigo", "strNombre", "strCodFacultad")),
    "carreras": ("carreras.xlsx", None, declare("strCodigo", "strNombre", "strCodEscuela")),
    "periodos": (
        "periodos.csv", ";",
        declare("strCodigo", "strDescripcion", "dtFechaInic", "dtFechaFin"),
    ),
    "proyectos": ("proyectos.xlsx", None, declare(intCodProyecto="long", txtTema="string")),
    "titulo_carrera": (
        "titulo_carrera.xlsx", None,
        declare("COD_TITULO", "COD_CARRERA_PROGRAMA", "strNombre"),
    ),
    "materia": (
        "materia.xlsx", None, declare("COD_CARRERA_PROGRAMA", "COD_MATERIA", "MATERIA"),
    ),
    "estudiante": (
        "estudiante.csv", ";",
        declare(
            cedula="int", strCodigo="int", strNombres="string", strApellidos="string",
            dtFechaNac="string", strNacionalidad="string", strCodSexo="string",
            strCodCiudadProc="string",
        ),
    ),
    "matricula": (
        "matricula_aprb_repr.csv", ";",
        declare(
            COD_CARRERA_PROGRAMA="string", strCodPeriodo="string", Estudiante="int",
            strCodMateria="string", strCodFormaAprob="string",
        ),
    ),
    "graduados": (
        "graduados.xlsx", None,
        declare(
            estudiante="long", strCodTitulo="string", intCodProyecto="long",
            dtFechaGrado="string", COD_CARRERA_PROGRAMA="string",
        ),
    ),
}
CENSUS_FILE = "dpa.xlsx"

Tables = Mapping[str, DataFrame]


def read_sources(
    spark: SparkSession, base: str, keep_corrupt: bool = False
) -> dict[str, DataFrame]:
    """All inputs under ``base``; malformed delimited rows keep what parsed.

    ``keep_corrupt`` leaves delimited sources the column with the line of a malformed
    row, which :func:`report` counts and :func:`for_cleaning` drops.
    """
    out = {}
    for name, (file, sep, schema) in SOURCES.items():
        path = f"{base}/{file}"
        if sep is None:
            out[name] = read_workbook(spark, path, schema, missing=MISSING_TEXTS)
        else:
            out[name] = read_delimited(spark, path, schema, sep)
    return out if keep_corrupt else for_cleaning(out)


def for_cleaning(raw: Tables) -> dict[str, DataFrame]:
    """The sources with their declared columns only."""
    return {n: df.select(*SOURCES[n][2].fieldNames()) for n, df in raw.items()}


def read_census(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The three geographic levels of the narrative census sheet."""
    return census_tables(read_ragged(spark, f"{base}/{CENSUS_FILE}"), "cells")


def census_tables(rows: DataFrame, cells: str) -> dict[str, DataFrame]:
    """Name the columns of the parsed levels."""
    one, two, three = parse_narrative(rows, cells, CENSUS_WORDS)
    return {
        "dpa_provincias": one.toDF("cod_dpa", "nombre_provincia"),
        "dpa_cantones": two.toDF("cod_provincia_dpa", "cod_canton", "nombre_canton"),
        "dpa_parroquias": three.toDF(
            "cod_provincia_dpa", "cod_canton", "cod_parroquia", "nombre_parroquia"
        ),
    }


# --- validation -------------------------------------------------------------


def validation_rules(raw: Tables, provinces: Sequence[str] = V.PROVINCES) -> dict[str, list]:
    """The rules of each validated table, on raw data."""
    city = F.col("strCodigo")
    return {
        "provincias": [
            in_domain("r_dpa", clean(city), provinces, bad="FUERA_DPA"),
            UniqueRule("r_dup", ["strCodigo"], nulls="dup"),
        ],
        "ciudades": [
            ForeignKeyRule(
                "r_fk", raw["provincias"], [("strCodProv", "strCodigo")],
                exempt=city == V.UNKNOWN_CITY,
            )
        ],
        "periodos": [
            date_range(
                "r_rango",
                parse_date(F.col("dtFechaInic"), V.PERIOD_DATE),
                parse_date(F.col("dtFechaFin"), V.PERIOD_DATE),
            )
        ],
        "matricula": [
            nonzero("r_est", F.col("Estudiante")),
            in_domain(
                "r_per",
                map_code(F.col("strCodPeriodo"), V.PERIOD_CODES),
                list(V.PERIOD_CODES.values()),
            ),
            in_domain("r_forma", F.col("strCodFormaAprob"), V.APPROVAL_FORMS),
        ],
        "estudiante": [
            ForeignKeyRule(
                "r_ciu", raw["ciudades"], [("strCodCiudadProc", "strCodigo")], bad="INV→DES"
            )
        ],
        "materia": [
            UniqueRule("r_dup", ["COD_CARRERA_PROGRAMA", "COD_MATERIA"], nulls="group")
        ],
        "graduados": [min_date("r_fecha", iso_date(F.col("dtFechaGrado")), V.EARLIEST_DEGREE)],
    }


def validate(raw: Tables, provinces: Sequence[str] = V.PROVINCES) -> DataFrame:
    """``(table, rule, status, rows)`` of every rule."""
    out = None
    for table, rules in validation_rules(raw, provinces).items():
        part = summarize_rules(raw[table], rules).select(
            F.lit(table).alias("table"), "rule", "status", "rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


# --- cleaning ---------------------------------------------------------------


def _coded(*parents: str) -> dict:
    """Trimmed code, upper-case name, trimmed parent codes."""
    return {
        "strCodigo": clean(F.col("strCodigo")),
        "strNombre": clean(F.col("strNombre"), upper=True),
        **{p: clean(F.col(p)) for p in parents},
    }


def _coded_spec(*parents: str) -> CleanSpec:
    return CleanSpec(["strCodigo"], _coded(*parents), {"no code": present("strCodigo")})


def clean_provinces(
    raw: DataFrame, domain: Sequence[str] = V.PROVINCES, using: Cleaner = clean_table
) -> DataFrame:
    known = F.col("strCodigo").isin(list(domain))
    return using(raw, CleanSpec(["strCodigo"], _coded(), {"unknown code": known}))


def clean_sexes(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    known = F.col("strNombre").isin(V.SEX_NAMES)
    return using(raw, CleanSpec(["strCodigo"], _coded(), {"unknown name": known}))


def clean_cities(
    raw: DataFrame, provinces: DataFrame, using: Cleaner = clean_table
) -> DataFrame:
    """Cities of a clean province; the unknown city needs none."""
    in_province = Reference(
        provinces, [("strCodProv", "strCodigo")], F.col("strCodigo") == V.UNKNOWN_CITY, "no province"
    )
    return using(raw, replace(_coded_spec("strCodProv"), references=[in_province]))


def clean_faculties(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    return using(raw, _coded_spec())


def clean_schools(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    return using(raw, _coded_spec("strCodFacultad"))


def clean_programs(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    return using(raw, _coded_spec("strCodEscuela"))


def clean_periods(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    """Periods with two valid dates in order, and a rebuilt label.

    Not sorted: order belongs to whoever reads the table, not to its files.
    """
    start, end = F.col("dtFechaInic_parsed"), F.col("dtFechaFin_parsed")
    dated = raw.select(
        clean(F.col("strCodigo"), upper=True).alias("strCodigo"),
        parse_date(F.col("dtFechaInic"), V.PERIOD_DATE).alias("dtFechaInic_parsed"),
        parse_date(F.col("dtFechaFin"), V.PERIOD_DATE).alias("dtFechaFin_parsed"),
    )
    unique = using(
        dated, CleanSpec(["strCodigo"], {}, {"dates missing or out of order": date_window(start, end)})
    )
    if using is not clean_table:
        return unique
    label = period_label(
        F.col("strCodigo"), start, end, V.MONTH_BY_NUMBER, V.REMEDIAL_PREFIX, V.REMEDIAL_LABEL
    )
    return unique.select("strCodigo", label.alias("strDescripcion"), start, end)


def clean_projects(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    return using(
        raw,
        CleanSpec(
            ["intCodProyecto"],
            {"txtTema": strip_quotes(F.col("txtTema"))},
            {"no code": present("intCodProyecto"), "no text": not_blank(F.col("txtTema"))},
        ),
    )


def clean_titles(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    """Titles keep programs that exist no longer, so there is no reference."""
    columns = ["COD_TITULO", "COD_CARRERA_PROGRAMA", "strNombre"]
    return using(
        raw,
        CleanSpec(
            ["COD_TITULO", "COD_CARRERA_PROGRAMA"],
            {c: clean(F.col(c), upper=True) for c in columns},
            {"no code": present("COD_TITULO"), "no name": not_blank(F.col("strNombre"))},
        ),
    )


def clean_subjects(raw: DataFrame, using: Cleaner = clean_table) -> DataFrame:
    return using(
        raw,
        CleanSpec(
            ["COD_CARRERA_PROGRAMA", "COD_MATERIA"],
            {
                "COD_MATERIA": clean(F.col("COD_MATERIA")),
                "MATERIA": clean(F.col("MATERIA"), upper=True),
                "COD_CARRERA_PROGRAMA": clean(F.col("COD_CARRERA_PROGRAMA")),
            },
            {"no code": present("COD_MATERIA"), "no name": not_blank(F.col("MATERIA"))},
        ),
    )


def clean_students(
    raw: DataFrame, cities: DataFrame, compat: bool = False, using: Cleaner = clean_table
) -> DataFrame:
    """Students with unknown members for what is missing.

    Differs from ``compat``: city codes are trimmed before they are looked up,
    unreadable birth dates get the default as well and the column is a date,
    and invalid rows are dropped before, not after, deduplication.
    """
    birth = iso_date_or(F.col("dtFechaNac"), V.UNKNOWN_BIRTH_DATE, only_if_null=compat)
    placed = lookup_or_default(
        raw, cities, "strCodCiudadProc", "strCodigo", V.UNKNOWN_CITY, trim_first=not compat
    )
    return using(
        placed.select(*raw.columns),
        CleanSpec(
            ["cedula"],
            {
                "strNombres": clean(F.col("strNombres"), upper=True),
                "strApellidos": F.upper(default_if_blank(F.col("strApellidos"), V.UNKNOWN_NAME)),
                "strCodSexo": clean(F.col("strCodSexo"), upper=True),
                "strNacionalidad": categorize(
                    F.col("strNacionalidad"), V.NATIONALITY_RULES, V.NATIONALITY_UNKNOWN
                ),
                "dtFechaNac": birth.cast("string") if compat else birth,
            },
            {
                "no identity": present("cedula"),
                "no name": not_blank(F.col("strNombres")),
                "unknown sex": F.col("strCodSexo").isin(V.SEX_CODES),
            },
            dedup_first=compat,
        ),
    )


def clean_enrolments(
    raw: DataFrame, programs: DataFrame, using: Cleaner = clean_table
) -> DataFrame:
    return using(
        raw,
        CleanSpec(
            ["Estudiante", "strCodPeriodo", "COD_CARRERA_PROGRAMA", "strCodMateria"],
            {
                "strCodPeriodo": map_code(F.col("strCodPeriodo"), V.PERIOD_CODES),
                "COD_CARRERA_PROGRAMA": clean(F.col("COD_CARRERA_PROGRAMA")),
                "strCodMateria": clean(F.col("strCodMateria")),
            },
            {
                "no student": F.col("Estudiante") != 0,
                "unknown period": F.col("strCodPeriodo").isin(list(V.PERIOD_CODES.values())),
                "no subject": present("strCodMateria"),
                "unknown form": F.col("strCodFormaAprob").isin(V.APPROVAL_FORMS),
            },
            [_in_program(programs)],
        ),
    )


def _in_program(programs: DataFrame) -> Reference:
    return Reference(programs, [("COD_CARRERA_PROGRAMA", "strCodigo")], name="no program")


def clean_graduates(
    raw: DataFrame, programs: DataFrame, using: Cleaner = clean_table
) -> DataFrame:
    """Degrees since the earliest date; the date is compared as a date."""
    return using(
        raw,
        CleanSpec(
            ["estudiante", "COD_CARRERA_PROGRAMA", "strCodTitulo"],
            {
                "COD_CARRERA_PROGRAMA": clean(F.col("COD_CARRERA_PROGRAMA")),
                "strCodTitulo": clean(F.col("strCodTitulo"), upper=True),
            },
            {
                "no student or title": present("estudiante", "strCodTitulo"),
                "no date or too early":
                    iso_date(F.col("dtFechaGrado")) >= F.lit(V.EARLIEST_DEGREE).cast("date"),
            },
            [_in_program(programs)],
        ),
    )


def clean_census(levels: Tables, using: Cleaner = clean_table) -> dict[str, DataFrame]:
    """The three geographic tables: trimmed codes, names without markers."""
    keys = {
        "dpa_provincias": ("cod_dpa", "nombre_provincia", []),
        "dpa_cantones": ("cod_canton", "nombre_canton", ["cod_provincia_dpa"]),
        "dpa_parroquias": (
            "cod_parroquia", "nombre_parroquia", ["cod_provincia_dpa", "cod_canton"],
        ),
    }
    out = {}
    for table, (key, name, parents) in keys.items():
        upper = clean(F.col(name), upper=True)
        named = upper if table == "dpa_provincias" else strip_markers(upper, at_most=2)
        normalise = {c: clean(F.col(c)) for c in [key, *parents]} | {name: named}
        out[table] = using(levels[table], CleanSpec([key], normalise, {"no code": present(key)}))
    return out


def cleaning_funnel(
    raw: Tables, staged: Tables, census: Tables | None = None,
    provinces: Sequence[str] = V.PROVINCES, compat: bool = False,
) -> DataFrame:
    """``(table, position, step, rows)``: where every source loses rows while it is cleaned.

    ``staged`` are the clean tables that others refer to; census levels are counted if
    given. The steps of a table but ``kept`` add up to the rows it loses.
    """
    frames = {
        "provincias": clean_provinces(raw["provincias"], provinces, funnel),
        "sexo": clean_sexes(raw["sexo"], funnel),
        "ciudades": clean_cities(raw["ciudades"], staged["provincias"], funnel),
        "facultades": clean_faculties(raw["facultades"], funnel),
        "escuelas": clean_schools(raw["escuelas"], funnel),
        "carreras": clean_programs(raw["carreras"], funnel),
        "periodos": clean_periods(raw["periodos"], funnel),
        "proyectos": clean_projects(raw["proyectos"], funnel),
        "titulo_carrera": clean_titles(raw["titulo_carrera"], funnel),
        "materia": clean_subjects(raw["materia"], funnel),
        "estudiante": clean_students(raw["estudiante"], staged["ciudades"], compat, funnel),
        "matricula": clean_enrolments(raw["matricula"], staged["carreras"], funnel),
        "graduados": clean_graduates(raw["graduados"], staged["carreras"], funnel),
    }
    if census is not None:
        frames |= clean_census(census, funnel)
    return reduce(
        DataFrame.unionByName,
        [f.select(F.lit(t).alias("table"), "position", "step", "rows") for t, f in frames.items()],
    )


# --- integration ------------------------------------------------------------


def student_final(
    students: DataFrame, cities: DataFrame, provinces: DataFrame, sexes: DataFrame
) -> DataFrame:
    """Students with city, province and sex; nothing found gives NULL names."""
    joined = enrich(
        students,
        Lookup(
            cities, [("strCodCiudadProc", "strCodigo")],
            {"strNombre": "ciudad_procedencia", "strCodProv": "cod_provincia"}, name="city",
        ),
        Lookup(
            provinces, [("cod_provincia", "strCodigo")],
            {"strNombre": "provincia_procedencia"}, name="province",
        ),
        Lookup(sexes, [("strCodSexo", "strCodigo")], {"strNombre": "sexo"}, name="sex"),
    )
    names = {
        "cedula": "cedula", "strCodigo": "cod_estudiante", "strNombres": "nombres",
        "strApellidos": "apellidos", "dtFechaNac": "fecha_nacimiento",
        "strNacionalidad": "nacionalidad", "strCodSexo": "cod_sexo", "sexo": "sexo",
        "strCodCiudadProc": "cod_ciudad", "ciudad_procedencia": "ciudad_procedencia",
        "cod_provincia": "cod_provincia", "provincia_procedencia": "provincia_procedencia",
    }
    return joined.select(*[F.col(c).alias(o) for c, o in names.items()])


def program_final(programs: DataFrame, schools: DataFrame, faculties: DataFrame) -> DataFrame:
    """Programs with school and faculty."""
    joined = enrich(
        programs.select(
            F.col("strCodigo").alias("cod_carrera"),
            F.col("strNombre").alias("carrera"),
            "strCodEscuela",
        ),
        Lookup(
            schools.withColumn("cod_escuela", F.col("strCodigo")),
            [("strCodEscuela", "strCodigo")],
            {"cod_escuela": "cod_escuela", "strNombre": "escuela", "strCodFacultad": "__faculty"},
            name="school",
        ),
        Lookup(
            faculties.withColumn("cod_facultad", F.col("strCodigo")),
            [("__faculty", "strCodigo")],
            {"cod_facultad": "cod_facultad", "strNombre": "facultad"},
            name="faculty",
        ),
    )
    return joined.select(
        "cod_carrera", "carrera", "cod_escuela", "escuela", "cod_facultad", "facultad"
    )


# Keys that enrolments and subjects share, by the names of each.
ENROLMENT_SUBJECT = ["COD_CARRERA_PROGRAMA", "strCodMateria"]
SUBJECT = ["COD_CARRERA_PROGRAMA", "COD_MATERIA"]


def stage_enrolments(
    enrolments: DataFrame, subjects: DataFrame, base: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Enrolments and subjects staged in the same buckets of program and subject.

    Every load that enriches the enrolments then joins them in place. Take as many
    buckets as give tasks of a fitting size.
    """
    return (
        stage_bucketed(enrolments, f"{base}/matricula_bucketed", ENROLMENT_SUBJECT, buckets),
        stage_bucketed(subjects, f"{base}/materia_bucketed", SUBJECT, buckets),
    )


def enrolment_final(
    enrolments: DataFrame,
    periods: DataFrame,
    programs: DataFrame,
    subjects: DataFrame,
    compat: bool = False,
    placed: bool = False,
) -> DataFrame:
    """Enrolment facts with period, program hierarchy and subject.

    Subjects are unique per program, so they are joined on both columns.
    ``compat`` joins on the subject code alone, which multiplies rows. ``placed`` says
    that enrolments and subjects come from :func:`stage_enrolments`, so the join moves
    none of them.
    """
    joined = enrich(
        enrolments,
        Lookup(
            periods, [("strCodPeriodo", "strCodigo")],
            {
                "strDescripcion": "descripcion_periodo",
                "dtFechaInic_parsed": "fecha_inicio",
                "dtFechaFin_parsed": "fecha_fin",
            },
            name="period",
        ),
        Lookup(
            programs, [("COD_CARRERA_PROGRAMA", "cod_carrera")],
            ["carrera", "escuela", "facultad"], name="program",
        ),
        replace(_subject_lookup(subjects, compat), placed=placed and not compat),
    )
    names = {
        "Estudiante": "cod_estudiante", "strCodPeriodo": "cod_periodo",
        "descripcion_periodo": "descripcion_periodo", "fecha_inicio": "fecha_inicio",
        "fecha_fin": "fecha_fin", "COD_CARRERA_PROGRAMA": "cod_carrera",
        "carrera": "carrera", "escuela": "escuela", "facultad": "facultad",
        "strCodMateria": "cod_materia", "nombre_materia": "nombre_materia",
        "strCodFormaAprob": "forma_aprobacion",
    }
    return joined.select(*[F.col(c).alias(o) for c, o in names.items()])


def _subject_lookup(subjects: DataFrame, compat: bool) -> Lookup:
    on = [("strCodMateria", "COD_MATERIA")]
    if not compat:
        on.append(("COD_CARRERA_PROGRAMA", "COD_CARRERA_PROGRAMA"))
    return Lookup(
        subjects, on, {"MATERIA": "nombre_materia"},
        expect="many" if compat else "one", name="subject",
    )


def graduate_final(
    graduates: DataFrame,
    programs: DataFrame,
    titles: DataFrame,
    projects: DataFrame,
    compat: bool = False,
) -> DataFrame:
    """Degree facts with program hierarchy, title and project.

    Titles are unique per program and joined on both columns. Program codes of old
    titles match no program of today: where the pair is not found, a title code that
    has one name gives that name. ``compat`` joins on the title code alone.
    """
    by_code = ("strCodTitulo", "COD_TITULO")
    if compat:
        lookups = [Lookup(titles, [by_code], {"strNombre": "__title"}, expect="many", name="title")]
        title = F.col("__title")
    else:
        sole = titles.groupBy("COD_TITULO").agg(
            F.min("strNombre").alias("name"), F.count_distinct("strNombre").alias("names")
        ).filter("names = 1")
        lookups = [
            Lookup(
                titles, [by_code, ("COD_CARRERA_PROGRAMA", "COD_CARRERA_PROGRAMA")],
                {"strNombre": "__title"}, name="title",
            ),
            Lookup(sole, [by_code], {"name": "__sole"}, name="title by code"),
        ]
        title = F.coalesce("__title", "__sole")
    joined = enrich(
        graduates,
        Lookup(
            programs, [("COD_CARRERA_PROGRAMA", "cod_carrera")],
            ["carrera", "escuela", "facultad"], name="program",
        ),
        *lookups,
        Lookup(
            projects, "intCodProyecto", {"txtTema": "tema_proyecto"}, name="project",
        ),
    ).withColumn("nombre_titulo", title)
    names = {
        "estudiante": "cod_estudiante", "COD_CARRERA_PROGRAMA": "cod_carrera",
        "carrera": "carrera", "escuela": "escuela", "facultad": "facultad",
        "strCodTitulo": "cod_titulo", "nombre_titulo": "nombre_titulo",
        "dtFechaGrado": "fecha_graduacion", "intCodProyecto": "cod_proyecto",
        "tema_proyecto": "tema_proyecto",
    }
    return joined.select(*[F.col(c).alias(o) for c, o in names.items()])


# --- the whole run ----------------------------------------------------------


def build(
    raw: Tables,
    census: Tables,
    base: str,
    fmt: str = "parquet",
    compat: bool = False,
    provinces: Sequence[str] = V.PROVINCES,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Clean, stage, integrate from the staged copy, stage: twenty tables.

    Tables are staged before others refer to them, so none is computed twice
    and lookups are measured on files. ``only`` restricts the run to the named
    tables; what they refer to must be among them.
    """
    done: dict[str, DataFrame] = {}

    def put(**makers: Callable[[], DataFrame]) -> None:
        tables = {n: make() for n, make in makers.items() if only is None or n in only}
        done.update(stage_tables(tables, base, fmt))

    put(
        provincias=lambda: clean_provinces(raw["provincias"], provinces),
        sexo=lambda: clean_sexes(raw["sexo"]),
        facultades=lambda: clean_faculties(raw["facultades"]),
        escuelas=lambda: clean_schools(raw["escuelas"]),
        carreras=lambda: clean_programs(raw["carreras"]),
        periodos=lambda: clean_periods(raw["periodos"]),
        proyectos=lambda: clean_projects(raw["proyectos"]),
        titulo_carrera=lambda: clean_titles(raw["titulo_carrera"]),
        materia=lambda: clean_subjects(raw["materia"]),
        dpa_provincias=lambda: clean_census(census)["dpa_provincias"],
        dpa_cantones=lambda: clean_census(census)["dpa_cantones"],
        dpa_parroquias=lambda: clean_census(census)["dpa_parroquias"],
    )
    put(
        ciudades=lambda: clean_cities(raw["ciudades"], done["provincias"]),
        matricula=lambda: clean_enrolments(raw["matricula"], done["carreras"]),
        graduados=lambda: clean_graduates(raw["graduados"], done["carreras"]),
        carrera_final=lambda: program_final(
            done["carreras"], done["escuelas"], done["facultades"]
        ),
    )
    put(
        estudiante=lambda: clean_students(raw["estudiante"], done["ciudades"], compat),
        matricula_final=lambda: enrolment_final(
            done["matricula"], done["periodos"], done["carrera_final"], done["materia"], compat
        ),
        graduados_final=lambda: graduate_final(
            done["graduados"], done["carrera_final"], done["titulo_carrera"],
            done["proyectos"], compat,
        ),
    )
    put(
        estudiante_final=lambda: student_final(
            done["estudiante"], done["ciudades"], done["provincias"], done["sexo"]
        )
    )
    return done


def report(raw: Tables, staged: Tables) -> DataFrame:
    """Original, clean and removed rows; census tables have no original.

    Sources read with ``keep_corrupt`` add the column ``malformed``, the lines of a
    delimited source that did not parse (they are among the original ones, and among
    the removed ones only if cleaning found them invalid); NULL for other sources.
    """
    sides: dict[str, tuple[DataFrame | None, DataFrame]] = {
        SOURCES[n][0]: (raw[n], staged[n]) for n in SOURCES
    }
    for n in ("dpa_provincias", "dpa_cantones", "dpa_parroquias"):
        sides[n] = (None, staged[n])
    counted = quality_report(sides)
    marked = {f: o for f, (o, _) in sides.items() if o is not None and CORRUPT in o.columns}
    if not marked:
        return counted
    return counted.join(malformed_lines(marked), "source", "left")


def profile_sources(raw: Tables) -> DataFrame:
    """Null-or-blank profile of every source."""
    return profile_tables({n.upper(): df for n, df in raw.items()})
