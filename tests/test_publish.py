"""All-or-nothing publication and counts from footers."""

import pytest
from pyspark.sql import functions as F

from tamiz.sources import staged
from tamiz.sources.counts import footer_count_frame, footer_counts
from tamiz.sources.publish import PublicationError, expire, manifest, publish, published, switch

NAMES = [f"t{i:02d}" for i in range(20)]


def tables(spark, run):
    return {n: spark.range(i + run).select("id", F.lit(run).alias("run")) for i, n in enumerate(NAMES)}


def seen(spark, name):
    """Runs and rows that every kind of reader sees."""
    by_frame = {n: (df.count(), {r["run"] for r in df.select("run").distinct().collect()})
                for n, df in published(spark, name).items()}
    by_view = {n: (spark.table(f"{name}_{n}").count(), {r["run"] for r in spark.table(f"{name}_{n}").collect()})
               for n in NAMES}
    assert by_frame == by_view
    return by_frame


def test_a_failing_table_leaves_the_old_set(spark, tmp_path):
    base, name = f"file://{tmp_path}/p", "pub_fail"
    assert publish(spark, tables(spark, 1), base, name) == {n: i + 1 for i, n in enumerate(NAMES)}
    before, paths = seen(spark, name), manifest(spark, name)
    bad = tables(spark, 2)
    bad[NAMES[12]] = bad[NAMES[12]].withColumn("run", F.raise_error(F.lit("table 13")).cast("int"))
    with pytest.raises(Exception, match="table 13"):
        publish(spark, bad, base, name)
    assert seen(spark, name) == before and manifest(spark, name) == paths


def test_frames_of_an_older_set_go_on_reading(spark, tmp_path):
    base, name = f"file://{tmp_path}/p", "pub_old"
    publish(spark, tables(spark, 1), base, name)
    old = published(spark, name)
    publish(spark, tables(spark, 3), base, name)
    assert {df.first()["run"] for df in old.values()} == {1}
    assert {r for _, runs in seen(spark, name).values() for r in runs} == {3}
    gone = expire(spark, base, name)
    assert len(gone) == 1 and {r for _, runs in seen(spark, name).values() for r in runs} == {3}
    assert expire(spark, base, name) == []


def test_a_switch_needs_all_tables_and_rows(spark, tmp_path):
    base, name = f"file://{tmp_path}/p", "pub_switch"
    publish(spark, tables(spark, 1), base, name)
    paths = manifest(spark, name)
    here = {n: p for n, (p, _) in paths.items()}
    with pytest.raises(PublicationError, match="cannot be read"):
        switch(spark, name, here | {"t05": f"{base}/none"})
    with pytest.raises(PublicationError, match="t05 has 6 rows, not 7"):
        switch(spark, name, here, {"t05": 7})
    assert manifest(spark, name) == paths


def test_counts_come_from_footers(spark, tmp_path):
    path = f"file://{tmp_path}/n"
    spark.range(1000).selectExpr("id", "id % 3 AS p").repartition(4).write.partitionBy("p").parquet(path)
    spark.range(0).write.parquet(f"{path}-none")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    frame = footer_count_frame(spark, {"n": path})
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert footer_counts(spark, {"n": path, "none": f"{path}-none"}) == {"n": 1000, "none": 0}
    assert footer_counts(spark, {}) == {}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_loads_count_staged_tables_without_a_scan(spark, tmp_path, monkeypatch):
    base, counted = f"file://{tmp_path}/s", []
    staged.stage(spark.range(30), f"{base}/a")
    original = staged.footer_counts
    monkeypatch.setattr(staged, "footer_counts", lambda s, p: counted.append(p) or original(s, p))
    report = staged.load_tables(
        spark, staged.read_tables(spark, base, ["a", "b"]), staged.path_writer(f"{base}/target")
    ).collect()
    assert [(r["table"], r["status"], r["rows"]) for r in report] == [("a", "OK", 30), ("b", "ERROR", None)]
    assert [list(c) for c in counted] == [[f"{base}/a"], [f"{base}/target/a"]]
