"""Loads that follow one another."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamiz.operators.dims import upsert
from tamiz.operators.history import apply_load, open_history, row_hash, valid_at
from tamiz.operators.joins import bucketed_join, lookup_join
from tamiz.operators.keymap import extend_key_map, with_ids
from tamiz.operators.partial_profile import StoredProfile
from tamiz.operators.partitions import bucket_column, key_bucket, upsert_buckets, write_buckets
from tamiz.operators.profile import profile
from tamiz.sources.staged import stage, stage_bucketed

SMALL = {"broadcast_rows": 0, "rows_per_task": 2}


def files(spark, path):
    """Names and buckets of the files of a table."""
    found = spark.read.parquet(path)
    column, _ = bucket_column(found)
    listed = found.select(column, F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {(r[column], r["f"]) for r in listed}


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_untouched_buckets_keep_their_files(spark, rows, tmp_path, limits):
    path = f"file://{tmp_path}/t"
    target = spark.range(500).selectExpr("cast(if(id = 0, null, id) as int) k", "concat('v', id) v")
    write_buckets(target, path, ["k"], 8)
    before = files(spark, path)
    updates = spark.createDataFrame([(3, "new"), (3, "old"), (None, "none"), (1003, "added")], "k long, v string")
    merged = upsert_buckets(spark, path, updates, ["k"], [F.asc("v")], **limits)
    touched = {r[0] for r in updates.select(key_bucket(["k"], 8)).collect()}
    after = files(spark, path)
    assert 0 < len(touched) < 8
    assert {f for f in before if f[0] not in touched} == {f for f in after if f[0] not in touched}
    assert not {f for f in before if f[0] in touched} & after
    typed = updates.select(F.col("k").cast("int").alias("k"), "v")
    found = rows(merged, "k", "v")
    assert found == rows(upsert(target, typed, ["k"], [F.asc("v")]))
    again = upsert_buckets(spark, path, updates, ["k"], [F.asc("v")], **limits)
    assert rows(again, "k", "v") == found


def test_no_updates_write_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    target = write_buckets(spark.range(50).selectExpr("id k", "id v"), path, ["k"], 4)
    before = files(spark, path)
    upsert_buckets(spark, path, target.select("k", "v").filter("false"), ["k"])
    assert files(spark, path) == before


def test_only_touched_buckets_are_read(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    target = write_buckets(spark.range(50).selectExpr("id k", "id v"), path, ["k"], 4)
    plan = target.filter(F.col("bucket_of_4").isin([1]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_of_4" in plan
    with pytest.raises(ValueError):
        bucket_column(spark.range(1))


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_old_ids_stay_and_new_ones_are_dense(spark, tmp_path, limits):
    known, seen = None, {}
    rng = random.Random(4)
    for load in range(4):
        keys = [(rng.choice(["a", "b", None]), rng.randrange(40 * (load + 1))) for _ in range(60)]
        frame = spark.createDataFrame(keys, "a string, b int").repartition(load + 1)
        known = stage(extend_key_map(known, frame, ["a", "b"], "id", **limits), f"file://{tmp_path}/{load}")
        ids = {(r["a"], r["b"]): r["id"] for r in known.collect()}
        assert seen.items() <= ids.items() and set(keys) <= set(ids)
        assert sorted(ids.values()) == list(range(1, len(ids) + 1)) and known.count() == len(ids)
        seen = ids
    again = extend_key_map(known, frame, ["a", "b"], "id", **limits)
    assert again.count() == known.count()
    more = spark.createDataFrame([("zz", 1)], "a string, b int")
    assert [r["id"] for r in with_ids(more, known, ["a", "b"], "id", **limits).collect()] == [0]


def plain_history(loads):
    """(key, value) loads in time order applied one row at a time."""
    history = {}
    for at, load in loads:
        for k, versions in history.items():
            if versions[-1][2] is None and load.get(k, None) != versions[-1][0]:
                versions[-1][2] = at
        for k, v in load.items():
            versions = history.setdefault(k, [])
            if not versions or versions[-1][2] is not None:
                versions.append([v, at, None])
    return {(k, n + 1, *map(str, v)) for k, vs in history.items() for n, v in enumerate(vs)}


@pytest.mark.parametrize("limits", [{}, SMALL])
def test_history_equals_a_plain_one(spark, tmp_path, limits):
    rng = random.Random(8)
    loads = [
        (f"2024-0{n}-01 00:00:00", {k: rng.choice("xyz") for k in range(30) if rng.random() < 0.8})
        for n in range(1, 6)
    ]
    history = None
    for n, (at, load) in enumerate(loads):
        frame = spark.createDataFrame([*load.items()], "k int, v string").repartition(3)
        if history is None:
            history = open_history(frame, ["k"], at)
        else:
            history = apply_load(history, frame, ["k"], at, close_missing=True, **limits)
        history = stage(history, f"file://{tmp_path}/{n}")
        again = apply_load(history, frame, ["k"], at, close_missing=True, **limits)
        assert again.exceptAll(history).count() == 0 == history.exceptAll(again).count()
    to = F.when(F.col("date_to") == "2999-12-31 00:00:00", "None").otherwise(F.col("date_to").cast("string"))
    found = {tuple(r) for r in history.select("k", "version", "v", F.col("date_from").cast("string"), to).collect()}
    assert found == plain_history(loads)
    for at, load in loads:
        then = valid_at(history, F.lit(at).cast("timestamp_ntz"))
        assert {r["k"]: r["v"] for r in then.collect()} == load


def test_members_that_a_load_lacks_stay_unless_asked(spark, rows):
    first = open_history(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"], "2020-01-01")
    load = spark.createDataFrame([(1, "a"), (3, None), (3, None)], "k int, v string")
    kept = apply_load(first, load, ["k"], "2021-01-01")
    assert rows(kept, "k", "version") == [(1, 1), (2, 1), (3, 1)]
    assert kept.filter("k = 3").first()["date_from"] == datetime(2021, 1, 1)


def test_a_change_must_be_later(spark):
    first = open_history(spark.createDataFrame([(1, "a")], "k int, v string"), ["k"], "2020-01-01")
    load = spark.createDataFrame([(1, "b")], "k int, v string")
    with pytest.raises(Exception, match="not later"):
        apply_load(first, load, ["k"], "2020-01-01").collect()


def test_row_hash_knows_borders_and_nulls(spark):
    data = [("ab", "c"), ("a", "bc"), (None, "x"), ("", "x"), ("x", None), ("n:", ""), ("|", ":")]
    found = spark.createDataFrame(data, "a string, b string").select(row_hash(["a", "b"])).distinct()
    assert found.count() == len(data)


def _partitioned(spark, path, rows, mode="append"):
    (spark.createDataFrame(rows, "a string, b int, day string").write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path))


def test_a_profile_scans_new_and_changed_partitions_only(spark, rows, tmp_path):
    path, states = f"file://{tmp_path}/t", f"file://{tmp_path}/s"
    stored = StoredProfile(spark, path, states, "day")
    _partitioned(spark, path, [("x", 1, "d1"), (" ", None, "d1"), (None, 2, "d2")])
    assert stored.refresh() == ["d1", "d2"] and stored.refresh() == []
    _partitioned(spark, path, [("y", 1, "d3"), ("", 3, None)])
    assert sorted(r["part"] for r in stored.outdated().collect()) == ["__HIVE_DEFAULT_PARTITION__", "d3"]
    scan = stored.to_scan(["d3"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan.replace("isnotnull(", "").replace("cast(", "")
    assert {f.split("/")[-2] for f in scan.inputFiles()} == {"day=d3"} or scan.count() == 1
    stored.refresh()
    _partitioned(spark, path, [("z", None, "d1"), ("", None, "d1"), ("", 4, "d1")], "overwrite")
    assert stored.refresh() == ["d1"]
    expected = profile(spark.read.parquet(path), "t")
    assert rows(stored.profile("t")) == rows(expected)


def test_a_profile_of_a_partition_that_is_gone(spark, rows, tmp_path):
    import shutil

    path = f"file://{tmp_path}/t"
    stored = StoredProfile(spark, path, f"file://{tmp_path}/s", "day")
    _partitioned(spark, path, [("x", 1, "d1"), (None, 2, "d2")])
    stored.refresh()
    shutil.rmtree(tmp_path / "t" / "day=d2")
    assert stored.refresh() == []
    assert [r["rows"] for r in stored.profile("t").collect()] == [1, 1, 1]


@pytest.fixture
def bucketed(spark, tmp_path):
    facts = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 400)) a", "if(id % 11 = 0, null, cast(id % 2 as int)) b", "id"
    )
    names = spark.range(500).selectExpr("concat('k', id) x", "cast(id % 2 as int) y", "concat('n', id) name")
    names = names.union(spark.createDataFrame([("hot", 0, "zero"), ("hot", 1, "one")], "x string, y int, name string"))
    return (
        stage_bucketed(facts, f"file://{tmp_path}/facts", ["a", "b"], 4),
        stage_bucketed(names, f"file://{tmp_path}/names", ["x", "y"], 4),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_task", [100, 100_000])
def test_bucketed_tables_join_in_place(spark, rows, bucketed, how, rows_per_task):
    facts, names = bucketed
    on = [("b", "y"), ("a", "x")]
    found = bucketed_join(facts, names, on, how, rows_per_task)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan, plan
    assert "SortMergeJoin" in plan
    assert rows(found) == rows(lookup_join(facts, names, on, how))


def test_enrolments_join_their_subjects_in_place(spark, rows, tmp_path):
    from tamiz.plans import academic as A

    facts = spark.createDataFrame(
        [(i, "p1", f"c{i % 3}", f"m{i % 7}", "PRI") for i in range(100)],
        "Estudiante int, strCodPeriodo string, COD_CARRERA_PROGRAMA string, strCodMateria string, strCodFormaAprob string")
    subjects = spark.createDataFrame(
        [(f"c{c}", f"m{m}", f"S{c}{m}") for c in range(3) for m in range(5)],
        "COD_CARRERA_PROGRAMA string, COD_MATERIA string, MATERIA string")
    periods = spark.createDataFrame([("p1", "P", None, None)],
                                    "strCodigo string, strDescripcion string, dtFechaInic_parsed date, dtFechaFin_parsed date")
    programs = spark.createDataFrame([("c0", "C", "E", "F")], "cod_carrera string, carrera string, escuela string, facultad string")
    placed = A.stage_enrolments(facts, subjects, f"file://{tmp_path}", 4)
    found = A.enrolment_final(placed[0], periods, programs, placed[1], placed=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows(found) == rows(A.enrolment_final(facts, periods, programs, subjects))
