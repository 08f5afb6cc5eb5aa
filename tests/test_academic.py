"""The academic plan from files to report, on a small synthetic university."""

import os
import subprocess
import sys
from datetime import date
from pathlib import Path

import pytest
from workbooks import write_xlsx

from tamiz.plans import academic as A
from tamiz.plans import warehouse as W

CSV = {
    "provincias.csv": "strCodigo,strNombre\nCHI,Chimborazo\nAZU ,azuay\nTX,Texas\nDES,DESCONOCIDA\nCHI,copia\n",
    "ciudades.csv": "strCodigo,strNombre,strCodProv\nRIO ,Riobamba,CHI\nCUE,cuenca,AZU\nDAL,Dallas,TX\n"
                    "low,Baja,chi\nDES,Desconocida,DES\n",
    "sexo.csv": "strCodigo,strNombre\nFEM,Femenino\nMAS,masculino \nOTR,otro\n",
    "facultades.csv": "strCodigo,strNombre\nF1,Ciencias\n",
    "escuelas.csv": "strCodigo,strNombre,strCodFacultad\nE1,Física,F1\nE2,Música,F9\n",
    "periodos.csv": "strCodigo;strDescripcion;dtFechaInic;dtFechaFin\n"
                    "p0002;x;1/09/04;6/03/05\nP0001;MARZO;1/03/04;31/08/04\nR001;r;1/08/08;5/09/08\n"
                    "P0003;mal;7/03/05;xx\nP0004;al revés;9/09/05;8/09/05",
    "estudiante.csv": "cedula;strCodigo;strNombres;strApellidos;dtFechaNac;strNacionalidad;strCodSexo;strCodCiudadProc\n"
                      "1;100;Ana ;Paz;1990-01-02 00:00:00;Ecuatoriana.;fem;RIO\n"
                      "2;101;Luis;;no sé;;MAS;RIO \n"
                      "3;102;Eva;Gil;;colombiano;FEM;DAL\n"
                      "4;103;;Sin nombre;;ECU;FEM;CUE\n"
                      "5;104;Oto;Mal;1980-05-05;ecu;MAS;CUE\n"
                      "5;104;Aby;Mala;1980-05-05;ecu;XXX;CUE\n"
                      ";105;Nadie;Nadie;;ecu;FEM;CUE\n",
    "matricula_aprb_repr.csv": "COD_CARRERA_PROGRAMA;strCodPeriodo;Estudiante;strCodMateria;strCodFormaAprob\n"
                               "C1 ;1;100;M1;PRI\nC1;p0001;100;M1;REP\nC1;2;100;M2;CON\nC2;1;101;M1;PRI\n"
                               "C1;900;100;M1;PRI\nC1;1;0;M1;PRI\nC9;1;100;M1;PRI\nC1;1;101;;PRI\nC1;1;101;M1;ZZZ\n",
}
XLSX = {
    "carreras.xlsx": [
        ["strCodigo", "strNombre", "strCodEscuela"], ["C1", "Física", "E1"], ["C2 ", "Canto", "E2"],
        ["C3", "Sin escuela", "E9"], [None, "nada", "E1"],
    ],
    "titulo_carrera.xlsx": [
        ["COD_TITULO", "COD_CARRERA_PROGRAMA", "strNombre"], ["t1", "c1", "Físico"], ["T1", "OLD", "Antiguo"],
        ["T2", "C1", " "],
    ],
    "materia.xlsx": [
        ["COD_CARRERA_PROGRAMA", "COD_MATERIA", "MATERIA"], ["C1", "M1", "Álgebra"], ["C2", "M1", "Solfeo"],
        ["C1", "M1 ", "Repetida"], ["C1", "M3", None],
    ],
    "proyectos.xlsx": [["intCodProyecto", "txtTema"], [7, '"Tema"'], [8, ' "" '], [None, "x"]],
    "graduados.xlsx": [
        ["estudiante", "strCodTitulo", "intCodProyecto", "dtFechaGrado", "COD_CARRERA_PROGRAMA"],
        [100, "t1", 7, "2010-05-05 00:00:00.000", "C1"], [101, "T1", None, "1989-12-31 00:00:00.000", "C1"],
        [102, None, 7, "2010-05-05 00:00:00.000", "C1"], [103, "T9", 99, "2010-05-05 00:00:00.000", "C1 "],
    ],
    "dpa.xlsx": [
        ["texto"], ["06", "PROVINCIA DE CHIMBORAZO"], ["06", "01", "CANTÓN RIOBAMBA"],
        ["06", "01", 1, "*Lizarzaburu", "06", "01", "50", "Riobamba, Comprende"],
        ["06", "01", "51", "Licto"], ["09", "01", "01", "Huérfana"],
    ],
}


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    folder = tmp_path_factory.mktemp("datos")
    for name, text in CSV.items():
        (folder / name).write_text(text, encoding="utf-8-sig")
    for name, data in XLSX.items():
        write_xlsx(folder / name, data)
    return folder


@pytest.fixture(scope="module")
def raw(spark, base):
    return A.read_sources(spark, str(base))


@pytest.fixture(scope="module")
def tables(spark, base, raw):
    return A.build(raw, A.read_census(spark, str(base)), str(base / "staged"))


@pytest.fixture(scope="module")
def compat(spark, base, raw):
    return A.build(raw, A.read_census(spark, str(base)), str(base / "compat"), compat=True)


def test_twenty_tables(tables):
    assert len(tables) == 20


def test_row_counts(spark, raw, tables):
    report = {r["source"]: (r["original"], r["clean"], r["removed"]) for r in A.report(raw, tables).collect()}
    assert report == {
        "provincias.csv": (5, 2, 3), "ciudades.csv": (5, 3, 2), "sexo.csv": (3, 2, 1),
        "facultades.csv": (1, 1, 0), "escuelas.csv": (2, 2, 0), "carreras.xlsx": (4, 3, 1),
        "periodos.csv": (5, 3, 2), "proyectos.xlsx": (3, 1, 2), "titulo_carrera.xlsx": (3, 2, 1),
        "materia.xlsx": (4, 2, 2), "estudiante.csv": (7, 4, 3), "matricula_aprb_repr.csv": (9, 3, 6),
        "graduados.xlsx": (4, 2, 2), "dpa_provincias": (None, 1, None),
        "dpa_cantones": (None, 1, None), "dpa_parroquias": (None, 3, None),
    }


def test_lookups(rows, tables):
    assert rows(tables["provincias"]) == [("AZU", "AZUAY"), ("CHI", "CHIMBORAZO")]
    assert rows(tables["ciudades"]) == [
        ("CUE", "CUENCA", "AZU"), ("DES", "DESCONOCIDA", "DES"), ("RIO", "RIOBAMBA", "CHI"),
    ]
    assert rows(tables["periodos"]) == [
        ("P0001", "MARZO 2004 - AGOSTO 2004", date(2004, 3, 1), date(2004, 8, 31)),
        ("P0002", "SEPTIEMBRE 2004 - MARZO 2005", date(2004, 9, 1), date(2005, 3, 6)),
        ("R001", "REMEDIAL 2008", date(2008, 8, 1), date(2008, 9, 5)),
    ]
    assert rows(tables["proyectos"]) == [(7, "Tema")]


STUDENT = [
    "cedula", "strNombres", "strApellidos", "dtFechaNac", "strNacionalidad", "strCodSexo",
    "strCodCiudadProc",
]


def test_students(rows, tables):
    assert rows(tables["estudiante"], *STUDENT) == [
        (1, "ANA", "PAZ", date(1990, 1, 2), "ECUATORIANA", "FEM", "RIO"),
        (2, "LUIS", "DESCONOCIDO", date(1900, 1, 1), "DESCONOCIDA", "MAS", "RIO"),
        (3, "EVA", "GIL", date(1900, 1, 1), "COLOMBIANA", "FEM", "DES"),
        (5, "OTO", "MAL", date(1980, 5, 5), "ECUATORIANA", "MAS", "CUE"),
    ]


def test_students_compat(rows, compat):
    # Unreadable date stays NULL, padded city is unknown, the invalid copy of 5 wins and goes.
    assert rows(compat["estudiante"], *STUDENT) == [
        (1, "ANA", "PAZ", "1990-01-02", "ECUATORIANA", "FEM", "RIO"),
        (2, "LUIS", "DESCONOCIDO", None, "DESCONOCIDA", "MAS", "DES"),
        (3, "EVA", "GIL", "1900-01-01", "COLOMBIANA", "FEM", "DES"),
    ]


def test_student_final(rows, tables):
    names = ["cedula", "sexo", "cod_ciudad", "ciudad_procedencia", "cod_provincia", "provincia_procedencia"]
    assert rows(tables["estudiante_final"], *names) == [
        (1, "FEMENINO", "RIO", "RIOBAMBA", "CHI", "CHIMBORAZO"),
        (2, "MASCULINO", "RIO", "RIOBAMBA", "CHI", "CHIMBORAZO"),
        (3, "FEMENINO", "DES", "DESCONOCIDA", "DES", None),
        (5, "MASCULINO", "CUE", "CUENCA", "AZU", "AZUAY"),
    ]


def test_program_final(rows, tables):
    assert rows(tables["carrera_final"]) == [
        ("C1", "FÍSICA", "E1", "FÍSICA", "F1", "CIENCIAS"),
        ("C2", "CANTO", "E2", "MÚSICA", None, None),
        ("C3", "SIN ESCUELA", None, None, None, None),
    ]


def test_enrolments_and_fan_out(rows, tables, compat):
    names = ["cod_estudiante", "cod_periodo", "cod_carrera", "cod_materia", "nombre_materia"]
    assert rows(tables["matricula_final"], *names) == [
        (100, "P0001", "C1", "M1", "REPETIDA"),
        (100, "P0002", "C1", "M2", None),
        (101, "P0001", "C2", "M1", "SOLFEO"),
    ]
    one = tables["matricula_final"].count()
    assert one == tables["matricula"].count() == 3
    assert compat["matricula_final"].count() == 5


def test_graduates(rows, tables, compat):
    names = ["cod_estudiante", "cod_titulo", "nombre_titulo", "tema_proyecto"]
    assert rows(tables["graduados_final"], *names) == [
        (100, "T1", "FÍSICO", "Tema"), (103, "T9", None, None),
    ]
    assert compat["graduados_final"].count() == 3


def test_output_schemas(compat):
    assert dict(compat["estudiante_final"].dtypes) == {
        "cedula": "int", "cod_estudiante": "int", "nombres": "string", "apellidos": "string",
        "fecha_nacimiento": "string", "nacionalidad": "string", "cod_sexo": "string",
        "sexo": "string", "cod_ciudad": "string", "ciudad_procedencia": "string",
        "cod_provincia": "string", "provincia_procedencia": "string",
    }
    assert dict(compat["matricula_final"].dtypes) == {
        "cod_estudiante": "int", "cod_periodo": "string", "descripcion_periodo": "string",
        "fecha_inicio": "date", "fecha_fin": "date", "cod_carrera": "string", "carrera": "string",
        "escuela": "string", "facultad": "string", "cod_materia": "string",
        "nombre_materia": "string", "forma_aprobacion": "string",
    }
    assert dict(compat["graduados_final"].dtypes)["cod_estudiante"] == "bigint"


def test_validation(raw):
    got = {(r["table"], r["rule"], r["status"]): r["rows"] for r in A.validate(raw).collect()}
    assert got[("provincias", "r_dpa", "FUERA_DPA")] == 2
    assert got[("provincias", "r_dup", "DUP")] == 2
    assert got[("ciudades", "r_fk", "FK_INV")] == 2
    assert got[("periodos", "r_rango", "INV")] == 2
    assert got[("matricula", "r_per", "INV")] == 1
    assert got[("matricula", "r_est", "INV")] == 1
    assert got[("matricula", "r_forma", "INV")] == 1
    assert got[("graduados", "r_fecha", "INV")] == 1


def test_profile_of_sources(raw):
    got = {(r["table"], r["column"]): r["null_or_blank"] for r in A.profile_sources(raw).collect()}
    assert len(got) == 45
    assert got[("ESTUDIANTE", "cedula")] == 1 and got[("CARRERAS", "strCodigo")] == 1


def test_census_and_geography(spark, rows, tables):
    assert rows(tables["dpa_parroquias"], "cod_parroquia", "nombre_parroquia") == [
        ("060101", "LIZARZABURU"), ("060151", "LICTO"), ("090101", "HUÉRFANA"),
    ]
    geo = W.geographic_dim(tables, "2024-01-01 00:00:00")
    assert rows(geo, "cod_pais", "provincia", "canton", "parroquia") == [
        ("EC", "CHIMBORAZO", "RIOBAMBA", "LICTO"), ("EC", "CHIMBORAZO", "RIOBAMBA", "LIZARZABURU"),
    ]


def test_dimensions(spark, rows, tables):
    run = "2024-01-01 00:00:00"
    location = W.academic_location(tables["carreras"], tables["escuelas"], tables["facultades"], run)
    dim = W.academic_location_dim(location, run)
    assert rows(dim, "id_ubicacademica", "cod_carrera", "facultad", "etl_version") == [
        (0, "ND", "DESCONOCIDO", 0), (1, "C1", "CIENCIAS", 1),
    ]
    titles = W.title_dim(tables["titulo_carrera"], tables["carreras"], run)
    assert sorted(r["id_titulo"] for r in titles.collect()) == [0, 1, 2]
    assert titles.filter("id_titulo = 0").first()["carrera"] == "ND"
    assert W.subject_dim(tables["materia"], run).count() == 2
    assert W.period_dim(tables["periodos"], run).columns[0] == "cod_periodocad"
    assert W.project_dim(tables["proyectos"], run).count() == 1


def test_student_dimension(spark, rows, tables, compat):
    geography = spark.createDataFrame([(5, "06"), (4, "06")], "id_ubicgeografica int, cod_provincia string")
    mapping = spark.createDataFrame([("CHI", "06")], "strCodProv string, cod_provincia string")
    args = (tables["sexo"], tables["ciudades"], geography, "2024-01-01 00:00:00")
    mapped = W.student_dim(tables["estudiante"], *args, province_map=mapping)
    assert rows(mapped, "codestud", "estudiante", "id_ubicgeografica") == [
        (100, "ANA PAZ", 4), (101, "LUIS DESCONOCIDO", 0), (102, "EVA GIL", 0), (104, "OTO MAL", 0),
    ]
    old = W.student_dim(compat["estudiante"], *args, compat=True)
    assert rows(old, "codestud", "id_ubicgeografica") == [(100, None), (101, 1), (102, 1)]


def test_job_from_files_to_dimensions(spark, base, capsys):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "jobs"))
    import academic as job

    stage, target = str(base / "job"), str(base / "edw")
    job.main(["build", "--input", str(base), "--staging", stage])
    assert "matricula_aprb_repr.csv" in capsys.readouterr().out
    job.main(["dims", "--staging", stage, "--warehouse", target, "--run-ts", "2024-01-01 00:00:00"])
    out = capsys.readouterr().out
    assert "d_tiempo: 11323 rows" in out and "d_estudiante: 4 rows" in out
    geography = spark.read.parquet(f"{target}/d_ubicgeografica")
    assert sorted(r["id_ubicgeografica"] for r in geography.collect()) == [0, 1, 2]


def test_job_loads_what_it_can(base, tables, monkeypatch, capsys):
    sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "jobs"))
    import academic as job

    monkeypatch.setenv("DW_USER", "u")
    monkeypatch.setenv("DW_PASSWORD", "p")
    monkeypatch.setattr(
        job, "jdbc_writer", lambda url, properties, schema: lambda df, target: df.count()
    )
    job.main(
        ["load", "--staging", str(base / "staged"), "--jdbc-url", "jdbc:x", "--jdbc-driver", "d",
         "sexo", "dim_ciudad_provincia"]
    )
    out = capsys.readouterr().out
    assert "|sexo" in out and "OK" in out and "ERROR" in out


def test_job_runs_from_another_folder_and_finds_home_places(spark, base, tmp_path):
    job = str(Path(__file__).resolve().parents[1] / "jobs" / "academic.py")
    stage, target = f"{tmp_path}/stage", f"{tmp_path}/edw"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    settings = "--conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4"

    def run(*args):
        done = subprocess.run(
            [sys.executable, job, *args], cwd=tmp_path, capture_output=True, text=True,
            env=env | {"PYSPARK_SUBMIT_ARGS": f"--master local[4] {settings} pyspark-shell"},
        )
        assert done.returncode == 0, done.stderr[-2000:]

    run("build", "--input", str(base), "--staging", stage)
    cities = spark.read.parquet(f"{stage}/ciudades").select("strCodProv").distinct().collect()
    census = spark.read.parquet(f"{stage}/dpa_provincias").agg({"cod_dpa": "min"}).first()[0]
    lines = [f"{r['strCodProv']},{census}" for r in cities if r["strCodProv"]]
    (tmp_path / "map.csv").write_text("\n".join(["strCodProv,cod_provincia", *lines]) + "\n")
    run("dims", "--staging", stage, "--warehouse", target, "--province-map", f"{tmp_path}/map.csv")
    students = spark.read.parquet(f"{target}/d_estudiante")
    assert students.filter("id_ubicgeografica > 0").count() > 0
    assert students.schema["etl_fecha_carga"].dataType.simpleString() == "timestamp_ntz"


def test_titles_of_programs_that_are_gone(spark, rows):
    degrees = spark.createDataFrame(
        [(1, "P1", "T1"), (2, "OLD", "T1"), (3, "OLD", "T2"), (4, "P2", "T2")],
        "estudiante int, COD_CARRERA_PROGRAMA string, strCodTitulo string",
    ).selectExpr("*", "date'2001-01-01' dtFechaGrado", "1 intCodProyecto")
    titles = spark.createDataFrame(
        [("T1", "P1", "one"), ("T2", "P1", "two"), ("T2", "P2", "zwei")],
        "COD_TITULO string, COD_CARRERA_PROGRAMA string, strNombre string",
    )
    programs = spark.createDataFrame(
        [("P1", "a", "b", "c")], "cod_carrera string, carrera string, escuela string, facultad string"
    )
    projects = spark.createDataFrame([(1, "x")], "intCodProyecto int, txtTema string")
    got = A.graduate_final(degrees, programs, titles, projects)
    assert rows(got, "cod_estudiante", "nombre_titulo") == [
        (1, "one"), (2, "one"), (3, None), (4, "zwei")]


def test_malformed_lines_are_counted(spark, base, tables, tmp_path):
    for name, text in CSV.items():
        (tmp_path / name).write_text(text, encoding="utf-8-sig")
    for name, data in XLSX.items():
        write_xlsx(tmp_path / name, data)
    with (tmp_path / "estudiante.csv").open("a", encoding="utf-8") as f:
        f.write("\nno number;100;Una\nx9;1;2;3;4;5;6;7;8;9\n")
    with (tmp_path / "sexo.csv").open("a", encoding="utf-8") as f:
        f.write("\nMAS\n")
    raw = A.read_sources(spark, str(tmp_path), keep_corrupt=True)
    report = {r["source"]: r for r in A.report(raw, tables).collect()}
    bad = {n: r["malformed"] for n, r in report.items()}
    assert (bad["estudiante.csv"], bad["sexo.csv"], bad["ciudades.csv"]) == (2, 1, 0)
    assert bad["carreras.xlsx"] is None and bad["dpa_cantones"] is None
    assert all("_corrupt_record" not in df.columns for df in A.for_cleaning(raw).values())
