"""Dirty academic inputs derived from the given tables.

The given tables have no nulls, blanks or orphans, so these views plant them by
expression. Their text is written once in the SQL both engines share; ``{name}``
stands for a table, ``{array}`` for the array constructor.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .base import CTES, TABLES, table

# Provinces that count as valid for the derived data.
PROVINCE_DOMAIN = [f"NATION_{i}" for i in range(20)]

RAW = {
    "raw_provincias": """
SELECT CASE WHEN n_nationkey % 5 = 0 THEN n_name || ' ' ELSE n_name END AS strCodigo,
       CASE WHEN n_nationkey % 4 = 0 THEN ' cañar ' || n_name ELSE lower(n_name) END AS strNombre
FROM {nation}
UNION ALL
SELECT n_name, 'copia ' || n_name FROM {nation} WHERE n_nationkey % 3 = 0
UNION ALL
SELECT CAST(NULL AS STRING), n_name FROM {nation} WHERE n_nationkey % 12 = 0
""",
    "raw_sexo": """
SELECT CASE r_regionkey WHEN 0 THEN 'FEM' WHEN 1 THEN 'MAS ' ELSE 'X' || r_regionkey END AS strCodigo,
       CASE r_regionkey WHEN 0 THEN 'Femenino ' WHEN 1 THEN ' masculino' ELSE r_name END AS strNombre
FROM {region}
""",
    "raw_ciudades": """
SELECT 'C' || s_suppkey || CASE WHEN s_suppkey % 7 = 0 THEN '  ' ELSE '' END AS strCodigo,
       lower(s_name) AS strNombre,
       CASE WHEN s_suppkey % 11 = 0 THEN 'nation_' || s_nationkey
            WHEN s_suppkey % 13 = 0 THEN 'NATION_' || s_nationkey || ' '
            WHEN s_suppkey % 19 = 0 THEN NULL
            ELSE 'NATION_' || s_nationkey END AS strCodProv
FROM {supplier}
UNION ALL
SELECT 'C' || s_suppkey, 'copia', 'NATION_1' FROM {supplier} WHERE s_suppkey % 10 = 0
UNION ALL
SELECT CAST(NULL AS STRING), s_name, 'NATION_2' FROM {supplier} WHERE s_suppkey % 17 = 0
UNION ALL
SELECT 'DES', 'desconocida', 'DES' FROM {region} WHERE r_regionkey = 0
""",
    "raw_facultades": """
SELECT 'F' || r_regionkey || ' ' AS strCodigo, lower(r_name) AS strNombre FROM {region}
""",
    "raw_escuelas": """
SELECT ' E' || n_nationkey AS strCodigo, lower(n_name) AS strNombre,
       CASE WHEN n_nationkey % 6 = 5 THEN 'F9' ELSE 'F' || n_regionkey END AS strCodFacultad
FROM {nation}
""",
    "raw_carreras": """
SELECT 'PR' || s_suppkey || ' ' AS strCodigo, lower(s_name) AS strNombre,
       CASE WHEN s_suppkey % 9 = 0 THEN 'E99' ELSE 'E' || s_nationkey END AS strCodEscuela
FROM {supplier} WHERE s_suppkey % 8 <> 3
UNION ALL
SELECT 'PR' || s_suppkey, 'copia', 'E1' FROM {supplier} WHERE s_suppkey % 10 = 0
UNION ALL
SELECT CAST(NULL AS STRING), s_name, 'E1' FROM {supplier} WHERE s_suppkey % 20 = 0
""",
    "raw_halves": """
SELECT DISTINCT extract(year FROM o_orderdate) AS y,
       CASE WHEN extract(month FROM o_orderdate) <= 6 THEN 1 ELSE 2 END AS h
FROM {orders}
""",
    "raw_periodos": """
SELECT CASE WHEN h = 2 AND y % 3 = 0 THEN 'r' ELSE ' p' END
         || lpad(CAST((y - 1995) * 2 + h AS STRING), 4, '0') AS strCodigo,
       'texto libre' AS strDescripcion,
       CASE WHEN y = 1997 THEN '1/3/97'
            ELSE '1/' || CASE h WHEN 1 THEN '03' ELSE '09' END || '/' || substr(CAST(y AS STRING), 3, 2)
       END AS dtFechaInic,
       CASE WHEN y = 1996 AND h = 1 THEN 'sin fecha'
            WHEN h = 1 THEN '31/08/' || substr(CAST(y AS STRING), 3, 2)
            ELSE '28/02/' || substr(CAST(y + 1 AS STRING), 3, 2) END AS dtFechaFin
FROM {raw_halves}
UNION ALL
SELECT 'P' || lpad(CAST((y - 1995) * 2 + h AS STRING), 4, '0'), 'copia',
       '5/04/' || substr(CAST(y AS STRING), 3, 2), '6/10/' || substr(CAST(y AS STRING), 3, 2)
FROM {raw_halves} WHERE y % 2 = 0
""",
    "raw_proyectos": """
SELECT nullif(doc_id, 50) AS intCodProyecto,
       CASE doc_id % 5 WHEN 0 THEN '"' || text || '"'
                       WHEN 1 THEN ' "' || text || 'x'
                       WHEN 2 THEN 'x' || text || '" '
                       WHEN 3 THEN '   '
                       ELSE 'x' || text || 'x' END AS txtTema
FROM {documents}
UNION ALL
SELECT doc_id, '"copia"' FROM {documents} WHERE doc_id % 20 = 1
""",
    "raw_titulo_carrera": """
SELECT CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE 't' || (p_partkey % 40) END AS COD_TITULO,
       ' pr' || (p_partkey % 100) AS COD_CARRERA_PROGRAMA,
       CASE WHEN p_partkey % 11 = 0 THEN '  ' ELSE p_name END AS strNombre
FROM {part}
""",
    "raw_materia": """
SELECT 'PR' || (p_partkey % 60) || CASE WHEN p_partkey % 3 = 0 THEN ' ' ELSE '' END AS COD_CARRERA_PROGRAMA,
       CASE WHEN p_partkey % 83 = 0 THEN NULL
            WHEN p_partkey % 5 = 0 THEN ' m' || (p_partkey % 700)
            ELSE 'M' || (p_partkey % 700) END AS COD_MATERIA,
       CASE WHEN p_partkey % 13 = 0 THEN '' ELSE lower(p_type) || ' ' || p_name END AS MATERIA
FROM {part}
""",
    "raw_estudiante": """
SELECT CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE c_custkey END AS cedula,
       c_custkey % 1000 AS strCodigo,
       CASE WHEN c_custkey % 43 = 0 THEN ' ' ELSE lower(c_name) || ' ' END AS strNombres,
       CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE ' ' || lower(c_mktsegment) END AS strApellidos,
       CASE WHEN c_custkey % 8 = 0 THEN NULL
            WHEN c_custkey % 8 = 1 THEN 'sin fecha'
            ELSE '19' || lpad(CAST(c_custkey % 100 AS STRING), 2, '0') || '-'
                 || lpad(CAST(c_custkey % 14 AS STRING), 2, '0') || '-15 00:00:00' END AS dtFechaNac,
       CASE c_custkey % 9 WHEN 0 THEN 'Ecuatoriano.' WHEN 1 THEN 'ecu' WHEN 2 THEN 'Riobamba '
            WHEN 3 THEN 'austriaca' WHEN 4 THEN 'Chino' WHEN 5 THEN 'colombiana '
            WHEN 6 THEN NULL WHEN 7 THEN ' ' ELSE ' Perú' END AS strNacionalidad,
       CASE c_custkey % 5 WHEN 0 THEN 'fem ' WHEN 1 THEN 'FEM' WHEN 2 THEN ' mas'
            WHEN 3 THEN 'MAS' ELSE 'X' END AS strCodSexo,
       CASE c_custkey % 10 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'ZZZ'
            WHEN 3 THEN 'C' || (c_custkey % 130) || ' '
            ELSE 'C' || (c_custkey % 130) END AS strCodCiudadProc
FROM {customer}
UNION ALL
SELECT c_custkey, c_custkey % 1000, 'aa copia', 'aa', '1980-01-01', 'ecu',
       CASE WHEN c_custkey % 20 = 0 THEN 'X' ELSE 'FEM' END, 'DES'
FROM {customer} WHERE c_custkey % 10 = 0
""",
    "raw_matricula": """
SELECT ' PR' || (l_suppkey % 110) AS COD_CARRERA_PROGRAMA,
       CASE WHEN l_partkey % 30 = 0 THEN 'p0011'
            WHEN l_partkey % 30 = 1 THEN '905'
            ELSE ' ' || (l_partkey % 25) END AS strCodPeriodo,
       CASE WHEN l_orderkey % 77 = 0 THEN NULL ELSE l_orderkey % 500 END AS Estudiante,
       CASE WHEN l_partkey % 61 = 0 THEN NULL
            WHEN l_partkey % 5 = 0 THEN 'm' || (l_partkey % 700) || ' '
            ELSE 'M' || (l_partkey % 700) END AS strCodMateria,
       CASE WHEN l_linenumber = 7 THEN 'XXX' WHEN l_returnflag = 'A' THEN 'PRI'
            WHEN l_returnflag = 'N' THEN 'REP' ELSE 'CON' END AS strCodFormaAprob
FROM {lineitem}
""",
    "raw_graduados": """
SELECT CASE WHEN o_orderkey % 91 = 0 THEN NULL ELSE o_custkey END AS estudiante,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 't' || (o_orderkey % 40) || ' ' END AS strCodTitulo,
       o_orderkey % 300 AS intCodProyecto,
       CASE WHEN o_orderkey % 8 = 0 THEN NULL
            WHEN o_orderkey % 8 = 1 THEN '1989-12-31 00:00:00.000'
            ELSE substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) || ' 00:00:00.000'
       END AS dtFechaGrado,
       ' PR' || (o_orderkey % 110) AS COD_CARRERA_PROGRAMA
FROM {orders}
""",
    "raw_census": """
SELECT {array}(' ' || lpad(CAST(r_regionkey + 1 AS STRING), 2, '0'), '  ',
       CASE r_regionkey WHEN 0 THEN 'Provincia ' WHEN 1 THEN 'PROVINCIA DE ' WHEN 2 THEN 'Provincia del '
            WHEN 3 THEN 'PROVINCIA  DELA ' ELSE 'la provincia ' END || lower(r_name)) AS cells
FROM {region}
UNION ALL
SELECT {array}(lpad(CAST(n_regionkey + 1 AS STRING), 2, '0'), lpad(CAST(n_nationkey AS STRING), 2, '0'),
       CASE n_nationkey % 4 WHEN 0 THEN 'CANTÓN **' WHEN 1 THEN 'Cantón ' WHEN 2 THEN 'CANTÓN * ' ELSE 'CANTÓN ' END || n_name)
FROM {nation}
UNION ALL
SELECT {array}(lpad(CAST(n_regionkey + 1 AS STRING), 2, '0'), lpad(CAST(n_nationkey AS STRING), 2, '0'),
       CAST(c_custkey % 100 AS STRING), '**' || lower(c_name),
       lpad(CAST(n_regionkey + 1 AS STRING), 2, '0'), lpad(CAST(n_nationkey AS STRING), 2, '0'),
       CAST(c_custkey % 120 AS STRING),
       CASE WHEN c_custkey % 4 = 0 THEN 'Comprende ' || c_name WHEN c_custkey % 4 = 1 THEN 'ab' ELSE c_mktsegment END)
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
UNION ALL
SELECT {array}(lpad(CAST(n_regionkey + 1 AS STRING), 2, '0'), NULL, lpad(CAST(n_nationkey AS STRING), 2, '0'),
       'nan', CAST(s_suppkey % 1000 AS STRING), s_name, CASE WHEN s_suppkey % 2 = 0 THEN 'suelto' END)
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
UNION ALL
SELECT {array}(CASE WHEN s_suppkey % 2 = 0 THEN 'titulo ' ELSE ' ' END || s_name, ' ') FROM {supplier}
""",
}


def _names(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


for _name, _text in RAW.items():
    CTES[_name] = _text.format(
        array="list_value", **{n: n for n in _names(_text) if n != "array"}
    )


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views as a DataFrame."""
    text = RAW[name].replace("{array}", "array")
    sources = {
        n: table(spark, sf_dir, n) if n in TABLES else raw(spark, sf_dir, n)
        for n in _names(text)
    }
    return spark.sql(text, **sources)


class RawTables(dict):
    """All raw tables by source name, each derived when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = raw(self.spark, self.sf_dir, f"raw_{name}")
        return self[name]
