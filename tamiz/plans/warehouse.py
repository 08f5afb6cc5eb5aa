"""Dimensions of the academic warehouse, loaded from staged tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import concat_skip_nulls
from ..operators.dedup import distinct_on
from ..operators.dims import (
    calendar_dim, load_stamp, rename_and_stamp, surrogate_key, with_unknown_member,
)
from ..operators.enrich import Lookup, enrich
from ..operators.history import apply_load, open_history
from ..sources.staged import stage_tables
from . import values as V


def academic_location(
    programs: DataFrame, schools: DataFrame, faculties: DataFrame, run_ts: str | None = None
) -> DataFrame:
    """Program, school and faculty; programs without either are left out."""
    joined = enrich(
        programs.select(
            F.col("strCodigo").alias("cod_carrera"),
            F.col("strNombre").alias("carrera"),
            F.col("strCodEscuela").alias("cod_escuela"),
        ),
        Lookup(
            schools, [("cod_escuela", "strCodigo")],
            {"strNombre": "escuela", "strCodFacultad": "cod_facultad"},
            how="inner", name="school",
        ),
        Lookup(
            faculties, [("cod_facultad", "strCodigo")], {"strNombre": "facultad"},
            how="inner", name="faculty",
        ),
    )
    names = ["cod_facultad", "facultad", "cod_escuela", "escuela", "cod_carrera", "carrera"]
    return rename_and_stamp(joined, {n: n for n in names}, run_ts)


def academic_location_dim(location: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Keyed location dimension with its unknown member 0."""
    keyed = surrogate_key(location, ["cod_carrera"], "id_ubicacademica").select(
        "*",
        F.lit(1).alias("etl_version"),
        F.lit(V.VALID_TO).cast("timestamp_ntz").alias("date_to"),
    )
    return with_unknown_member(
        keyed,
        {
            "id_ubicacademica": 0,
            **{c: V.UNKNOWN_CODE for c in ("cod_facultad", "cod_escuela", "cod_carrera")},
            **{c: V.UNKNOWN_NAME for c in ("facultad", "escuela", "carrera")},
            "etl_fecha_carga": load_stamp(run_ts),
            "etl_version": 0,
            "date_to": V.VALID_TO,
        },
    )


def subject_dim(subjects: DataFrame, run_ts: str | None = None) -> DataFrame:
    return rename_and_stamp(
        subjects, {"COD_MATERIA": "cod_materia", "MATERIA": "materia"}, run_ts
    )


def title_rows(titles: DataFrame, run_ts: str | None = None) -> DataFrame:
    return rename_and_stamp(
        titles,
        {
            "COD_TITULO": "cod_titulo",
            "COD_CARRERA_PROGRAMA": "cod_carrera",
            "strNombre": "titulo",
        },
        run_ts,
    )


def title_dim(titles: DataFrame, programs: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Keyed title dimension with validity and its unknown member 0."""
    named = enrich(
        title_rows(titles, run_ts),
        Lookup(
            programs, [("cod_carrera", "strCodigo")], {"strNombre": "carrera"}, name="program"
        ),
    )
    keyed = surrogate_key(named, ["cod_titulo", "cod_carrera"], "id_titulo").select(
        "id_titulo", "cod_carrera", "carrera", "cod_titulo", "titulo", "etl_fecha_carga",
        F.lit(1).alias("version"),
        F.lit(V.VALID_TO).cast("timestamp_ntz").alias("date_to"),
        F.lit(V.VALID_FROM).cast("timestamp_ntz").alias("date_from"),
    )
    return with_unknown_member(
        keyed,
        {
            "id_titulo": 0,
            **{c: V.UNKNOWN_CODE for c in ("cod_carrera", "carrera", "cod_titulo")},
            "titulo": V.UNKNOWN_NAME,
            "etl_fecha_carga": load_stamp(run_ts),
            "version": 0,
            "date_to": V.VALID_TO,
            "date_from": V.VALID_FROM,
        },
    )


def title_history(
    history: DataFrame | None, titles: DataFrame, programs: DataFrame, at: str
) -> DataFrame:
    """Versions of titles: the first load opens them, a later one is compared.

    Titles that a load lacks are closed. Stage the result before the next load.
    """
    rows = enrich(
        titles.select(
            F.col("COD_TITULO").alias("cod_titulo"),
            F.col("COD_CARRERA_PROGRAMA").alias("cod_carrera"), F.col("strNombre").alias("titulo"),
        ),
        Lookup(
            programs, [("cod_carrera", "strCodigo")], {"strNombre": "carrera"}, name="program"
        ),
    )
    key = ["cod_titulo", "cod_carrera"]
    if history is None:
        return open_history(rows, key, V.VALID_FROM, V.VALID_TO)
    return apply_load(history, rows, key, at, close_missing=True, forever=V.VALID_TO)


def period_dim(periods: DataFrame, run_ts: str | None = None) -> DataFrame:
    return rename_and_stamp(
        periods,
        {
            "strCodigo": "cod_periodocad",
            "strDescripcion": "periodo",
            "dtFechaInic_parsed": "fecha_ini",
            "dtFechaFin_parsed": "fecha_fin",
        },
        run_ts,
    )


def project_dim(projects: DataFrame, run_ts: str | None = None) -> DataFrame:
    return rename_and_stamp(
        projects, {"intCodProyecto": "cod_proyecto", "txtTema": "proyecto"}, run_ts
    )


def geographic_dim(census: Mapping[str, DataFrame], run_ts: str | None = None) -> DataFrame:
    """Country, province, canton and parish, one row per parish."""
    joined = enrich(
        census["dpa_parroquias"].select(
            "cod_canton", "cod_parroquia", F.col("nombre_parroquia").alias("parroquia")
        ),
        Lookup(
            census["dpa_cantones"], "cod_canton",
            {"nombre_canton": "canton", "cod_provincia_dpa": "cod_provincia"},
            how="inner", name="canton",
        ),
        Lookup(
            census["dpa_provincias"], [("cod_provincia", "cod_dpa")],
            {"nombre_provincia": "provincia"}, how="inner", name="province",
        ),
    ).select(
        F.lit(V.COUNTRY_CODE).alias("cod_pais"),
        F.lit(V.COUNTRY_NAME).alias("pais"),
        F.col("cod_provincia").alias("dpa"),
        "cod_provincia", "provincia", "cod_canton", "canton", "cod_parroquia", "parroquia",
    )
    return rename_and_stamp(
        joined, {c: c for c in joined.columns}, run_ts,
        ("etl_fecha_ini", "etl_fecha_fin", "etl_fecha_carga"),
    )


def student_dim(
    students: DataFrame,
    sexes: DataFrame,
    cities: DataFrame,
    geography: DataFrame,
    run_ts: str | None = None,
    province_map: DataFrame | None = None,
    compat: bool = False,
) -> DataFrame:
    """One row per student code, with the id of the home province.

    ``geography`` (``id_ubicgeografica``, ``cod_provincia``) holds many rows per
    province and is reduced to the first id first. ``province_map``
    (``strCodProv``, ``cod_provincia``) translates between the two code systems.
    Whoever has no home province here gets id 0; ``compat`` gives 1 to
    foreigners and NULL where the province is not found.
    """
    per_province = geography.groupBy("cod_provincia").agg(
        F.min("id_ubicgeografica").alias("__geo")
    )
    lookups = [
        Lookup(
            sexes, [("strCodSexo", "strCodigo")], {"strNombre": "sexo"}, how="inner", name="sex"
        ),
        Lookup(
            cities, [("strCodCiudadProc", "strCodigo")], {"strCodProv": "__province"},
            name="city",
        ),
    ]
    code = "__province"
    if province_map is not None:
        lookups.append(
            Lookup(
                province_map, [("__province", "strCodProv")], {"cod_provincia": "__dpa"},
                name="province map",
            )
        )
        code = "__dpa"
    lookups.append(
        Lookup(per_province, [(code, "cod_provincia")], ["__geo"], name="geography")
    )
    rows = enrich(students, *lookups)
    at_home = F.col("strNacionalidad") == V.NATIONALITY_HOME
    if compat:
        place = F.when(at_home, F.col("__geo")).otherwise(F.lit(1))
    else:
        place = F.coalesce(F.when(at_home, F.col("__geo")), F.lit(0))
    out = rows.select(
        "cedula",
        F.col("strCodigo").alias("codestud"),
        concat_skip_nulls(F.col("strNombres"), F.lit(" "), F.col("strApellidos")).alias(
            "estudiante"
        ),
        F.col("dtFechaNac").alias("fecha_nacimiento"),
        "sexo",
        F.lit(V.UNKNOWN_CODE).alias("discapacidad"),
        F.lit(V.UNKNOWN_CODE).alias("etnia"),
        place.cast("long").alias("id_ubicgeografica"),
        load_stamp(run_ts).alias("etl_fecha_carga"),
    )
    return distinct_on(out, "codestud", ["cedula"])


def time_dim(
    spark: SparkSession, start: str = "2000-01-01", end: str = "2030-12-31"
) -> DataFrame:
    """Calendar dimension with Spanish names."""
    return calendar_dim(spark, start, end, V.MONTHS, V.WEEKDAYS, V.HALF_YEARS)


def geographic_location_dim(geography: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Keyed geographic dimension with its unknown member 0."""
    keyed = surrogate_key(geography, ["cod_parroquia"], "id_ubicgeografica")
    codes = ("cod_pais", "dpa", "cod_provincia", "cod_canton", "cod_parroquia")
    names = ("pais", "provincia", "canton", "parroquia")
    stamps = ("etl_fecha_ini", "etl_fecha_fin", "etl_fecha_carga")
    return with_unknown_member(
        keyed,
        {
            "id_ubicgeografica": 0,
            **{c: V.UNKNOWN_CODE for c in codes},
            **{c: V.UNKNOWN_NAME for c in names},
            **{c: load_stamp(run_ts) for c in stamps},
        },
    )


def build_warehouse(
    staged: Mapping[str, DataFrame],
    base: str,
    fmt: str = "parquet",
    run_ts: str | None = None,
    province_map: DataFrame | None = None,
    compat: bool = False,
) -> dict[str, DataFrame]:
    """All dimensions from the staged tables, written under ``base``."""
    t = staged
    spark = t["carreras"].sparkSession
    location = academic_location(t["carreras"], t["escuelas"], t["facultades"], run_ts)
    done = stage_tables(
        {
            "d_ubicacion_academica": academic_location_dim(location, run_ts),
            "d_materia": subject_dim(t["materia"], run_ts),
            "d_titulo": title_dim(t["titulo_carrera"], t["carreras"], run_ts),
            "d_periodicidad": period_dim(t["periodos"], run_ts),
            "d_proyecto": project_dim(t["proyectos"], run_ts),
            "d_ubicgeografica": geographic_location_dim(geographic_dim(t, run_ts), run_ts),
            "d_tiempo": time_dim(spark),
        },
        base, fmt,
    )
    students = student_dim(
        t["estudiante"], t["sexo"], t["ciudades"],
        done["d_ubicgeografica"].filter("id_ubicgeografica <> 0"),
        run_ts, province_map, compat,
    )
    return done | stage_tables({"d_estudiante": students}, base, fmt)
