import random

import pytest
from pyspark.sql import functions as F

from tamiz.operators import heavy
from tamiz.operators.cleaning import CleanSpec, Reference, clean_table, funnel
from tamiz.operators.dedup import dedup, distinct_on
from tamiz.operators.enrich import FanOutError, Lookup, duplicate_keys, enrich, join_audit
from tamiz.operators.joins import key_counts, split_keys, lookup_join, measure, salted_join


def test_dedup_is_idempotent_and_ignores_partitioning(spark, rows):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), i % 5) for i in range(200)]
    expected = None
    for parts in (1, 7):
        shuffled = data[:]
        rng.shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "k int, t string, n int").repartition(parts)
        once = dedup(df, "k", [F.desc("n")])
        got = rows(once)
        assert got == rows(dedup(once, "k", [F.desc("n")]))
        expected = expected or got
        assert got == expected
    assert len(expected) == 4


def test_dedup_handles_maps_and_arrays(spark, rows):
    df = spark.sql(
        "SELECT 1 AS k, map('a', 2) AS m, array(1) AS a UNION ALL SELECT 1, map('a', 1), array(1)"
    )
    assert [r["m"] for r in dedup(df, "k").collect()] == [{"a": 1}]


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS v")
    plan = dedup(df, "k")._jdf.queryExecution().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_distinct_on_needs_an_order(spark):
    with pytest.raises(ValueError):
        distinct_on(spark.range(1), "id", [])


def test_filter_runs_before_dedup_unless_asked(spark, rows):
    df = spark.createDataFrame([(1, "a", "X"), (1, "b", "OK")], "k int, v string, s string")
    keep = [F.col("s") == "OK"]
    assert rows(clean_table(df, CleanSpec(["k"], {}, keep))) == [(1, "b", "OK")]
    assert rows(clean_table(df, CleanSpec(["k"], {}, keep, dedup_first=True))) == []


def test_references_cascade_with_exemption(spark, rows):
    parents = spark.createDataFrame([("A",), (None,)], "code string")
    df = spark.createDataFrame(
        [("1", "A"), ("2", "B"), ("DES", "Z"), ("3", None)], "code string, parent string"
    )
    spec = CleanSpec(
        ["code"], {}, references=[Reference(parents, [("parent", "code")], F.col("code") == "DES")]
    )
    assert rows(clean_table(df, spec)) == [("1", "A"), ("DES", "Z")]


@pytest.fixture
def skewed(spark):
    """One key with a third of the rows, NULL keys, full copies, orphans."""
    data = [(1, "copy")] * 100 + [(None, f"n{i}") for i in range(50)]
    data += [(i % 9, f"v{i}") for i in range(150)]
    return spark.createDataFrame(data, "k int, v string").repartition(5)


@pytest.fixture
def lookup(spark):
    return spark.createDataFrame(
        [(1, "one"), (2, "two"), (7, None), (None, "null"), (50, "none")], "id int, name string"
    )


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast_join(rows, skewed, lookup, how, null_safe):
    on = [("k", "id")]
    plain = lookup_join(skewed, lookup, on, how, null_safe=null_safe)
    salted = salted_join(skewed, lookup, on, how, null_safe, rows_per_task=7)
    forced = lookup_join(
        skewed, lookup, on, how, null_safe=null_safe, broadcast_rows=0, rows_per_task=7
    )
    assert plain.columns == salted.columns == forced.columns
    assert rows(plain) == rows(salted) == rows(forced)


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_keys_hot_on_both_sides_meet_once(spark, rows, skewed, how, null_safe):
    names = [(1, f"a{i}") for i in range(20)] + [(2, f"b{i}") for i in range(9)]
    names += [(None, f"n{i}") for i in range(11)] + [(4, "c"), (4, "d"), (60, "none")]
    many = spark.createDataFrame(names, "id int, name string")
    on = [("k", "id")]
    plain = lookup_join(skewed, many, on, how, null_safe=null_safe)
    salted = lookup_join(
        skewed, many, on, how, null_safe=null_safe, broadcast_rows=0, rows_per_task=7
    )
    assert plain.columns == salted.columns
    assert rows(salted) == rows(plain)


def test_salts_spread_a_hot_key_and_its_copies(spark, skewed, lookup):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(skewed, lookup, [("k", "id")], rows_per_task=7)
        copies = joined.filter("v = 'copy'").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(copies) > 2


def test_semi_and_anti_part_the_input(rows, skewed, lookup):
    semi = lookup_join(skewed, lookup, [("k", "id")], "left_semi")
    anti = lookup_join(skewed, lookup, [("k", "id")], "left_anti")
    assert rows(semi.unionByName(anti)) == rows(skewed)


def test_measure(spark, lookup):
    size, summed = measure([(lookup.unionByName(lookup), ["id"]), (lookup, [])])
    assert (size.rows, size.max_per_key, summed.rows) == (10, 2, 5)
    assert size.fits() and not size.fits(rows=9) and not size.fits(size=1)
    empty = measure([(lookup.filter("false"), ["id"])])[0]
    assert (empty.rows, empty.bytes, empty.max_per_key) == (0, 0, 0)


def test_enrich_guards_against_fan_out(spark, rows, lookup):
    facts = spark.createDataFrame([(1, 2.0), (9, 3.0)], "k int, x double")
    once = enrich(facts, Lookup(lookup, [("k", "id")], {"name": "n"}))
    assert rows(once) == [(1, 2.0, "one"), (9, 3.0, None)]
    twice = Lookup(lookup.unionByName(lookup), [("k", "id")], {"name": "n"}, name="names")
    with pytest.raises(FanOutError, match="names"):
        enrich(facts, twice)
    many = Lookup(twice.frame, [("k", "id")], {"name": "n"}, expect="many")
    assert enrich(facts, many).count() == 3


def test_null_keys_do_not_count_as_fan_out(spark, lookup):
    nulls = lookup.unionByName(lookup.filter("id IS NULL"))
    facts = spark.createDataFrame([(1,), (None,)], "k int")
    assert enrich(facts, Lookup(nulls, [("k", "id")], ["name"])).count() == 2


def test_enrich_folds_case_on_both_sides(spark, rows):
    facts = spark.createDataFrame([(" m1",), ("M2",)], "code string")
    names = spark.createDataFrame([("M1 ", "x"), ("m2", "y")], "code string, name string")
    exact = enrich(facts, Lookup(names, "code", ["name"]))
    folded = enrich(facts, Lookup(names, "code", ["name"], fold_case=True))
    assert rows(exact) == [(" m1", None), ("M2", None)]
    assert rows(folded) == [(" m1", "x"), ("M2", "y")]


def test_audits(spark, rows, skewed, lookup):
    twice = lookup.unionByName(lookup.filter("id = 1"))
    audit = join_audit(skewed, twice, [("k", "id")], "names").first()
    joined = lookup_join(skewed, twice, [("k", "id")])
    assert audit["rows"] == 300 and audit["joined_rows"] == joined.count()
    assert audit["matched"] + audit["unmatched"] == 300
    assert rows(duplicate_keys(twice, ["id"])) == [(1, 2)]


def test_shuffled_lookups_read_the_fact_a_bounded_number_of_times(spark, rows, tmp_path):
    """Four lookups past the broadcast limit: every step reads what it joins once more."""
    base = f"file://{tmp_path}"
    spark.range(400).selectExpr(
        "id", *[f"cast(if(id % 3 = 0, 1, id % {k + 20}) as int) k{k}" for k in range(4)]
    ).write.parquet(f"{base}/fact")
    fact = spark.read.parquet(f"{base}/fact")
    names = spark.range(30).selectExpr("cast(id as int) id", "concat('n', id) name")
    lookups = [Lookup(names, [(f"k{k}", "id")], {"name": f"name{k}"}) for k in range(4)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = enrich(fact, *lookups, broadcast_rows=0, rows_per_task=50)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert rows(found) == rows(enrich(fact, *lookups))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The last step joins staged rows, keys and names: one relation of each at most twice.
    assert plan.count("Relation [") <= 4


def test_every_hot_key_is_split(spark, rows):
    """More hot keys than any table of fixed size: all are split, none is lost."""
    facts = spark.range(6_000).selectExpr("cast(id % 2000 as int) k", "id")
    names = spark.range(2_000).selectExpr("cast(id as int) id2", "concat('n', id) name")
    split = split_keys(key_counts(facts, ["k"]), ["k"], 2)
    assert split.size.rows == split.frame.count() == 2_000
    joined = salted_join(facts, names, [("k", "id2")], rows_per_task=2)
    assert joined.filter("name = concat('n', k)").count() == 6_000


def test_finding_hot_keys_moves_no_rows(spark, rows, tmp_path):
    """The fact is exchanged once, for the join; hot keys are found from its scan."""
    path = f"file://{tmp_path}/facts"
    spark.range(20_000).selectExpr(
        "if(id % 4 = 0, 5, id) AS k", "if(id % 3 = 0, 'x', cast(id % 700 as string)) AS c", "id"
    ).write.parquet(path)
    facts = spark.read.parquet(path)
    names = spark.range(20_000).selectExpr(
        "cast(id as int) AS id2", "if(id = 5, 'x', cast(id % 700 as string)) AS c2", "concat('n', id) AS name"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = heavy.sketch(facts, F.xxhash64("k", "c"))
        staged = [found._jdf.queryExecution().executedPlan().toString()]
        joined = salted_join(facts, names, [("k", "id2"), ("c", "c2")], rows_per_task=1000)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        lines = staged[0].splitlines()
        below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange" in line]
        assert below and all("partial_" in line for line in below), staged[0]
        assert "partial_approx_top_k_accumulate" in staged[0]
        assert plan.count("Exchange hashpartitioning") == 2
        assert rows(joined) == rows(lookup_join(facts, names, [("k", "id2"), ("c", "c2")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [3, 40, 1000])
def test_no_key_above_the_limit_is_missed(spark, limit):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 3, F.floor(F.sqrt("id")).cast("long") % 300)
        .otherwise(F.col("id")).alias("k")
    ).repartition(5)
    found = heavy.heavy_keys(df, F.col("k"), limit)
    got = {r[0]: r[1] for r in found.frame.collect()}
    true = {r[0]: r[1] for r in df.groupBy("k").count().filter(F.col("count") > found.limit).collect()}
    assert found.limit == limit and found.keys == len(got)
    assert set(true) <= set(got) and all(got[k] >= n for k, n in true.items())


def test_a_sketch_that_is_too_small_raises_the_limit(spark, monkeypatch):
    monkeypatch.setattr(heavy, "TRACKED", 8)
    monkeypatch.setattr(heavy, "MOST_TRACKED", 32)
    df = spark.range(10_000).select((F.col("id") % 2500).alias("k"))
    found = heavy.heavy_keys(df, F.col("k"), 2)
    assert found.limit == heavy.reach(10_000, 32) > 2 and found.keys == 0
    none = heavy.heavy_keys(df.filter("false"), F.col("k"), 2)
    assert none.keys == 0 and none.frame.columns == ["__hash", "__rows"]


def test_sketches_of_loads_merge(spark):
    loads = [spark.range(n * 1000, n * 1000 + 1000).select(F.when(F.col("id") % 2 == 0, -1)
             .otherwise(F.col("id")).alias("k")) for n in range(3)]
    merged = heavy.merge_sketches(
        heavy.sketch(loads[0], F.col("k")).union(heavy.sketch(loads[1], F.col("k")))
        .union(heavy.sketch(loads[2], F.col("k")))
    )
    top = heavy.estimates(merged).orderBy(F.desc("count")).first()
    assert heavy.estimates(merged).filter("item IS NULL").count() == 1
    assert tuple(top) == (3000, -1, 1500)


def test_keys_that_a_hash_would_part_are_counted(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, "A")] * 30, "i int, k string")
    left = left.select("i", F.collate("k", "UTF8_LCASE").alias("k"))
    right = spark.createDataFrame([("A", 1)], "x string, v int").select(
        F.collate("x", "UTF8_LCASE").alias("x"), "v"
    )
    assert heavy.key_hashes(left, right, [("k", "x")]) is None
    joined = salted_join(left, right, [("k", "x")], rows_per_task=7)
    assert joined.filter("v = 1").count() == 60


def test_keys_of_different_types_meet(spark, rows):
    left = spark.createDataFrame([(float(i % 3), i) for i in range(90)], "k double, i int")
    right = spark.createDataFrame([(0, "zero"), (2, "two")], "x int, v string")
    on = [("k", "x")]
    assert rows(salted_join(left, right, on, rows_per_task=10)) == rows(lookup_join(left, right, on))
    text = left.select(F.col("k").cast("int").cast("string").alias("k"), "i")
    assert rows(salted_join(text, right, on, rows_per_task=10)) == rows(lookup_join(text, right, on))


@pytest.mark.parametrize("dedup_first", [False, True])
def test_funnel_adds_up_to_what_cleaning_loses(spark, rows, dedup_first):
    parents = spark.createDataFrame([("A",), ("B",)], "code string")
    data = [(i % 40 if i % 11 else None, ["A", "B", "Z", None][i % 4], i % 5) for i in range(200)]
    df = spark.createDataFrame(data, "k int, parent string, n int").repartition(3)
    spec = CleanSpec(
        ["k"], {"n": F.col("n") - 1}, {"key": F.col("k").isNotNull(), "positive": F.col("n") > 0},
        [Reference(parents, [("parent", "code")], F.col("k") == 7, "parent")],
        dedup_first=dedup_first,
    )
    found = [tuple(r) for r in funnel(df, spec).orderBy("position").collect()]
    steps = ["key", "positive", "parent"]
    expected = ["duplicate", *steps, "kept"] if dedup_first else [*steps, "duplicate", "kept"]
    assert [s for _, s, _ in found] == expected and [p for p, _, _ in found] == [1, 2, 3, 4, 5]
    counts = {s: n for _, s, n in found}
    assert counts["kept"] == clean_table(df, spec).count()
    assert sum(counts.values()) == 200
    if not dedup_first:
        assert counts["key"] == sum(k is None for k, _, _ in data)
        assert counts["positive"] == sum(k is not None and n < 2 for k, _, n in data)


def test_funnel_reads_its_table_once(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(100).selectExpr("id", "id % 7 AS k").write.parquet(path)
    spec = CleanSpec(["k"], {}, {f"c{i}": F.col("id") != i for i in range(9)})
    plan = funnel(spark.read.parquet(path), spec)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    none = funnel(spark.read.parquet(path).filter("id < 0"), spec)
    assert {r["rows"] for r in none.collect()} == {0}


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_grid_of_split_keys_is_one_join(spark, how, null_safe):
    """Every pair meets once, and rows without a match stay, without a union behind the join."""
    from tamiz.operators.joins import LookupSize, lookup_join

    left = [(k, i) for k, n in ((1, 30), (2, 3), (3, 40), (4, 2), (None, 25), (6, 31)) for i in range(n)]
    right = [(k, i) for k, n in ((1, 35), (2, 30), (3, 2), (5, 50), (None, 12), (6, 1)) for i in range(n)]
    left += left[:5]
    l = spark.createDataFrame(left, "k int, a int")
    r = spark.createDataFrame(right, "x long, b int")
    want = []
    for k, a in left:
        met = [b for x, b in right if k == x and (null_safe or k is not None)]
        want += [(k, a, b) for b in met] or ([(k, a, None)] if how == "left" else [])
    joined = lookup_join(l, r, [("k", "x")], how, LookupSize(130, 1, 50), null_safe,
                         broadcast_rows=0, rows_per_task=10)
    assert joined.columns == ["k", "a", "b"]
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(want, key=str)
    assert "Union" not in joined._jdf.queryExecution().optimizedPlan().toString()
