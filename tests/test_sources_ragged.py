from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from workbooks import write_xlsx

from tamiz.operators.ragged import clean_rows, level1, level2, level3, parse_narrative
from tamiz.plans.academic import CENSUS_WORDS
from tamiz.sources import staged
from tamiz.sources.delimited import CORRUPT, declare, read_delimited
from tamiz.sources.spreadsheet import MISSING_TEXTS, read_ragged, read_workbook, sheet_rows


def cells_frame(spark, data):
    return spark.createDataFrame([(r,) for r in data], "cells array<string>")


def test_cells_are_stripped_of_all_white_space(spark, rows):
    df = cells_frame(spark, [["\t a ", "  ", None, "nan", "b\n"], ["", None], []])
    assert [r[0] for r in clean_rows(df, "cells").collect()] == [["a", "b"]]


def test_level1(spark, rows):
    df = cells_frame(
        spark,
        [
            ["01", "Provincia del Azuay"], ["02", "PROVINCIA DE LOS RÍOS"], ["03", "provincia  x"],
            ["1", "PROVINCIA A"], ["04", "REGIÓN"], ["05", "PROVINCIA A", "z"], ["06", "PROVINCIA DELA B"],
        ],
    )
    assert rows(level1(df, "cells", CENSUS_WORDS)) == [
        ("01", "AZUAY"), ("02", "LOS RÍOS"), ("03", "X"), ("06", "B"),
    ]


def test_level2(spark, rows):
    df = cells_frame(
        spark,
        [
            ["01", "02", "CANTÓN **Cuenca"], ["01", "03", "Cantón Girón"], ["01", "04", "PARROQUIA X"],
            ["01", "5", "CANTÓN Y"], ["01", "06", "* CANTÓN Z"],
        ],
    )
    assert rows(level2(df, "cells", CENSUS_WORDS)) == [
        ("01", "0102", "CUENCA"), ("01", "0103", "CANTÓN GIRÓN"), ("01", "0106", "Z"),
    ]


def test_level3_reads_every_full_group(spark, rows):
    df = cells_frame(
        spark,
        [
            ["01", "02", "3", "*Baños", "01", "02", "50", "Quinta"],
            ["01", "02", "4", "ab"],
            ["01", "02", "5", "Comprende: algo"],
            ["01", "02", "123", "Larga"],
            ["01", "02", "6", "Sexta", "sobra"],
            ["01", "02", "7", "Uno", "01", "02", "8", "Dos", "01", "02", "9", "Tres"],
            ["01", "02", "3"],
        ],
    )
    got = rows(level3(df, "cells", CENSUS_WORDS), "code", "name")
    assert got == [
        ("010203", "BAÑOS"), ("010206", "SEXTA"), ("010207", "UNO"), ("010208", "DOS"),
        ("010209", "TRES"), ("010250", "QUINTA"),
    ]


def test_ragged_workbook_to_levels(spark, rows, tmp_path):
    write_xlsx(
        tmp_path / "census.xlsx",
        [
            ["DIVISIÓN POLÍTICA"], [], ["01", None, "PROVINCIA DE AZUAY"],
            ["01", "01", None, "CANTÓN CUENCA"], [None, "01", "01", 5, "Baños "],
        ],
    )
    one, two, three = parse_narrative(read_ragged(spark, str(tmp_path)), "cells", CENSUS_WORDS)
    assert rows(one) == [("01", "AZUAY")]
    assert rows(two) == [("01", "0101", "CUENCA")]
    assert rows(three) == [("01", "0101", "010105", "BAÑOS")]


def test_workbook_columns_are_found_by_name(spark, rows, tmp_path):
    write_xlsx(
        tmp_path / "a.xlsx",
        [[], ["day", "code", "n"], [38047, "01 & <x>", 7], [None, None, None], [38047.5, "ñ", 2.5]],
        dates=(0,),
    )
    write_xlsx(tmp_path / "b.xlsx", [[" n ", "other"], [9, "z"], ["x", "z"]])
    schema = declare(code="string", n="long", day="timestamp")
    with pytest.raises(Exception, match="b.xlsx has no column code, day"):
        read_workbook(spark, str(tmp_path), schema).collect()
    got = read_workbook(spark, str(tmp_path), schema, optional=["code", "day"])
    assert got.dtypes == [("code", "string"), ("n", "bigint"), ("day", "timestamp_ntz")]
    assert [(c, n, str(d)) for c, n, d in rows(got)] == [
        (None, None, "None"), (None, 9, "None"),
        ("01 & <x>", 7, "2004-03-01 00:00:00"), ("ñ", None, "2004-03-01 12:00:00"),
    ]


def write_csv(folder, text):
    folder.mkdir()
    (folder / "f.csv").write_text(text, encoding="utf-8-sig")
    return str(folder)


def test_delimited_with_mark_and_leading_zeros(spark, rows, tmp_path):
    path = write_csv(tmp_path / "d", "code;n\n01;5\n02;x\n03\n04;6;7")
    schema = declare(code="string", n="int")
    kept = read_delimited(spark, path, schema, sep=";")
    assert kept.columns == ["code", "n", CORRUPT]
    assert rows(kept) == [
        ("01", 5, None), ("02", None, "02;x"), ("03", None, "03"), ("04", 6, "04;6;7"),
    ]
    assert rows(read_delimited(spark, path, schema, sep=";", bad_rows="drop")) == [("01", 5)]
    with pytest.raises(Exception):
        read_delimited(spark, path, schema, sep=";", bad_rows="fail").collect()


def test_header_must_match_the_schema(spark, tmp_path):
    path = write_csv(tmp_path / "d", "n,code\n1,a")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, path, declare(code="string", n="string")).collect()


def test_stage_replaces_rows_and_schema(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    staged.stage(spark.range(5), path)
    again = staged.stage(spark.range(2).selectExpr("'01' AS y", "id AS x"), path, partition_by=["y"])
    assert again.dtypes == [("x", "bigint"), ("y", "string")]
    assert rows(again) == [(0, "01"), (1, "01")]


def test_stage_tables_and_views(spark, tmp_path):
    tables = {f"t{i}": spark.range(i) for i in range(6)}
    done = staged.stage_tables(tables, str(tmp_path))
    assert {n: df.count() for n, df in done.items()} == {f"t{i}": i for i in range(6)}
    staged.register_views(done, "v_")
    assert spark.sql("SELECT count(*) FROM v_t5 JOIN v_t3 USING (id)").first()[0] == 3


def test_load_report_goes_on_after_a_failure(spark, rows, tmp_path):
    staged.stage(spark.range(3), f"{tmp_path}/a")
    sources = staged.read_tables(spark, str(tmp_path), ["a", "missing"])
    sources["short"] = spark.range(4)

    def write(df, target):
        n = staged.path_writer(f"{tmp_path}/out")(df, target)
        return n - 1 if target == "d_short" else n

    names = {"missing": "d_missing", "a": "d_a", "short": "d_short"}
    report = staged.load_tables(spark, sources, write, names)
    assert rows(report, "table", "status", "rows") == [
        ("d_a", "OK", 3), ("d_missing", "ERROR", None), ("d_short", "ERROR", 3),
    ]
    errors = {r["table"]: r["error"] for r in report.collect()}
    assert errors["d_a"] is None and errors["d_short"] == "expected 4 rows"
    assert "missing" in errors["d_missing"].lower()


def test_jdbc_writer_passes_its_options(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

    seen = {}
    monkeypatch.setattr(
        DataFrameWriter, "jdbc",
        lambda self, url, table, mode=None, properties=None: seen.update(
            url=url, table=table, mode=mode, properties=properties
        ),
    )
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, url, table, properties=None: spark.range(3).selectExpr("count(*) n")
    )
    monkeypatch.setenv("DW_USER", "u")
    monkeypatch.setenv("DW_PASSWORD", "p")
    write = staged.jdbc_writer("jdbc:x", staged.jdbc_properties("drv"), schema="dsa", partitions=4)
    report = staged.load_tables(spark, {"t": spark.range(3)}, write)
    assert [tuple(r) for r in report.collect()] == [("t", "OK", 3, None)]
    assert seen == {
        "url": "jdbc:x", "table": "dsa.t", "mode": "overwrite",
        "properties": {
            "driver": "drv", "user": "u", "password": "p", "numPartitions": "4",
            "batchsize": "10000", "truncate": "true",
        },
    }


class Session:
    """What shared_folder looks at, as a cluster would answer."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(
            get=lambda key, default: (folder if key == "spark.checkpoint.dir" else None) or default
        )


def test_shared_folder_is_taken_from_the_session(spark):
    on_cluster = Session("spark://host:7077", "hdfs://x/shared/")
    assert staged.shared_folder(on_cluster, "p").startswith("hdfs://x/shared/p-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staged.shared_folder(Session("yarn"), "p")
    assert staged.shared_folder(spark, "p") != staged.shared_folder(spark, "p")


def test_rows_of_many_workbooks_are_kept(spark, tmp_path):
    for i in range(3):
        write_xlsx(tmp_path / f"{i}.xlsx", [["n"]] + [[i * 3000 + j] for j in range(3000)])
    got = read_workbook(spark, str(tmp_path), declare(n="long"))
    assert got.agg(F.count("n"), F.countDistinct("n"), F.max("n")).first()[:] == (9000, 9000, 8999)


def test_missing_texts_and_large_whole_numbers(spark, rows, tmp_path):
    write_xlsx(tmp_path / "a.xlsx", [["n", "t"], [1e15, "N/A"], ["1e16", "x"], [2.5e17, "NA "]])
    schema = declare(n="long", t="string")
    got = rows(read_workbook(spark, str(tmp_path), schema, missing=MISSING_TEXTS))
    assert got == [(None, "x"), (10**15, None), (25 * 10**16, "NA ")]
    kept = read_workbook(spark, str(tmp_path), schema).filter("t = 'N/A'")
    assert kept.count() == 1


@pytest.mark.parametrize(
    "settings, day",
    [("", "2024-01-31"), ('<workbookPr date1904="1"/>', "2028-02-01"), ('<workbookPr date1904="0"/>', "2024-01-31"),
     ('<workbookPr/>', "2024-01-31"), ('<workbookPr date1904="true"/>', "2028-02-01")],
)
def test_dates_count_from_1900_or_1904(tmp_path, settings, day):
    write_xlsx(tmp_path / "a.xlsx", [["when", "n"], [45322.5, 45322]], dates={0}, settings=settings)
    rows = [cells for _, cells in sheet_rows((tmp_path / "a.xlsx").read_bytes())]
    assert rows == [["when", "n"], [f"{day} 12:00:00", "45322"]]
