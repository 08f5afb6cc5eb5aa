"""Loads that follow one another: partial upserts, lasting keys, versions of members."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.history import valid_at
from ...operators.keymap import extend_key_map, with_ids
from ...operators.partial_profile import StoredProfile
from ...operators.partitions import upsert_buckets, write_buckets
from ...sources.staged import shared_folder, stage
from .. import values as V
from .. import warehouse as W
from .academic_queries import staged
from .base import query, table
from .dim_queries import dense_key

BUCKETS = 16


@query(
    "dim_upsert_partitions",
    """SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
       WHERE c_custkey % 2 = 0 AND NOT (c_custkey % 3 = 0 AND c_nationkey = 7)
       UNION ALL
       SELECT c_custkey, 'NEW', max(v) FROM (
         SELECT c_custkey, c_nationkey, c_acctbal + 1 AS v FROM customer WHERE c_custkey % 3 = 0
         UNION ALL SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 9 = 0)
       WHERE c_nationkey = 7 GROUP BY 1""",
)
def dim_upsert_partitions(s: SparkSession, d: str) -> DataFrame:
    """Updates of one nation's customers go into the buckets that hold them."""
    customers = table(s, d, "customer")
    columns = ["c_custkey", "c_mktsegment", "c_acctbal"]
    path = shared_folder(s, "upsert-target")
    write_buckets(customers.filter("c_custkey % 2 = 0").select(*columns), path, ["c_custkey"], BUCKETS)
    of_nation = customers.filter("c_nationkey = 7")
    changed = of_nation.filter("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    stale = of_nation.filter("c_custkey % 9 = 0")
    updates = changed.unionByName(stale).withColumn("c_mktsegment", F.lit("NEW")).select(*columns)
    return upsert_buckets(s, path, updates, ["c_custkey"], [F.desc("c_acctbal")]).select(*columns)


_FIRST = "SELECT DISTINCT c_mktsegment, c_custkey FROM customer WHERE c_custkey % 3 <> 0"


@query(
    "dim_key_map",
    f"""WITH one AS ({_FIRST}),
        first_ids AS (SELECT {dense_key(["c_mktsegment", "c_custkey"])} AS id, * FROM one),
        two AS (SELECT c_mktsegment, c_custkey FROM customer
                WHERE c_custkey % 5 <> 0 AND c_custkey % 3 = 0),
        both_ids AS (
          SELECT * FROM first_ids UNION ALL
          SELECT (SELECT max(id) FROM first_ids) + {dense_key(["c_mktsegment", "c_custkey"])}, * FROM two)
        SELECT c.c_custkey, c.c_mktsegment, coalesce(id, 0) AS id FROM customer c
        LEFT JOIN both_ids b ON b.c_custkey = c.c_custkey AND b.c_mktsegment = c.c_mktsegment""",
)
def dim_key_map(s: SparkSession, d: str) -> DataFrame:
    """Ids of customers after two loads; customers of neither point to the unknown member."""
    customers = table(s, d, "customer").select("c_custkey", "c_mktsegment")
    key, folder = ["c_mktsegment", "c_custkey"], shared_folder(s, "key-map")
    known = stage(
        extend_key_map(None, customers.filter("c_custkey % 3 <> 0"), key, "id"), f"{folder}/1"
    )
    second = customers.filter("c_custkey % 5 <> 0")
    known = stage(extend_key_map(known, second, key, "id"), f"{folder}/2")
    return with_ids(customers, known, key, "id")


SECOND_LOAD = "2024-06-30 00:00:00"
_AT, _TO, _FROM = (f"TIMESTAMP '{t}'" for t in (SECOND_LOAD, V.VALID_TO, V.VALID_FROM))
_TITLES = """SELECT COD_TITULO AS cod_titulo, COD_CARRERA_PROGRAMA AS cod_carrera,
                    t.strNombre AS titulo, p.strNombre AS carrera, length(t.strNombre) AS n
             FROM c_titulo_carrera t LEFT JOIN c_carreras p ON COD_CARRERA_PROGRAMA = p.strCodigo"""


@query(
    "title_history",
    f"""SELECT cod_titulo, cod_carrera, titulo, carrera, 1 AS version, {_FROM} AS date_from,
               CASE WHEN n % 7 = 5 OR n % 5 = 0 THEN {_AT} ELSE {_TO} END AS date_to
        FROM ({_TITLES}) WHERE n % 7 <> 3
        UNION ALL
        SELECT cod_titulo, cod_carrera, CASE WHEN n % 5 = 0 THEN titulo || ' B' ELSE titulo END, carrera,
               CASE WHEN n % 7 = 3 THEN 1 ELSE 2 END, {_AT}, {_TO}
        FROM ({_TITLES}) WHERE n % 7 <> 5 AND (n % 7 = 3 OR n % 5 = 0)""",
)
def title_history(s: SparkSession, d: str) -> DataFrame:
    """Two loads of titles: some are renamed, some new, some gone."""
    t, folder = staged(s, d, "titulo_carrera", "carreras"), shared_folder(s, "title-history")
    titles, n = t["titulo_carrera"], F.length("strNombre")
    second = titles.filter(n % 7 != 5).withColumn(
        "strNombre", F.when(n % 5 == 0, F.concat("strNombre", F.lit(" B"))).otherwise(F.col("strNombre"))
    )
    first = W.title_history(None, titles.filter(n % 7 != 3), t["carreras"], "")
    history = stage(first, f"{folder}/1")
    history = stage(W.title_history(history, second, t["carreras"], SECOND_LOAD), f"{folder}/2")
    # Once more: a load that was applied changes nothing.
    return W.title_history(history, second, t["carreras"], SECOND_LOAD).drop("row_hash")


@query(
    "title_history_then",
    f"""SELECT cod_titulo, cod_carrera, titulo, 1 AS version FROM ({_TITLES}) WHERE n % 7 <> 3""",
)
def title_history_then(s: SparkSession, d: str) -> DataFrame:
    """The titles as they were before the second load."""
    return valid_at(title_history(s, d), F.lit("2024-01-31").cast("timestamp_ntz")).select(
        "cod_titulo", "cod_carrera", "titulo", "version"
    )


# Columns of the profiled orders as SQL of both sides; blanks and NULLs are planted.
_ORDERS = {
    "o_orderkey": "o_orderkey",
    "o_custkey": "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END",
    "priority": "CASE WHEN o_orderkey % 5 = 0 THEN '  ' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END",
    "year": "extract(year FROM o_orderdate)",
}


@query(
    "profile_incremental",
    " UNION ALL ".join(
        f"""SELECT 'orders' AS "table", CAST({i} AS INTEGER) AS position, '{c}' AS "column", count(*) AS rows,
            count(*) FILTER (WHERE {x} IS NULL OR trim(CAST({x} AS STRING)) = '') AS null_or_blank FROM orders"""
        for i, (c, x) in enumerate(_ORDERS.items(), 1)
    ),
)
def profile_incremental(s: SparkSession, d: str) -> DataFrame:
    """A profile kept up with three loads; each reads the partitions it adds or changes."""
    orders = table(s, d, "orders").select(*[F.expr(x).alias(c) for c, x in _ORDERS.items()])
    base = shared_folder(s, "profiled")
    stored = StoredProfile(s, f"{base}/orders", f"{base}/states", "year")
    old, rest = F.col("year") < 1995, F.col("year") % 2 == 0

    def load(rows: DataFrame) -> None:
        (
            rows.hint("rebalance", "year").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(stored.path)
        )
        stored.refresh()

    load(orders.filter(old & rest))
    load(orders.filter(old))
    load(orders.filter(~old))
    return stored.profile("orders").drop("type")
