import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tierkit.operators import merge_insert_only, merge_keys
from tierkit.sources import read_table, write_table

KV = "k int, v string"


def table_rows(spark, path, ddl=KV):
    return sorted((tuple(r) for r in read_table(spark, path, ddl).collect()), key=repr)


def test_merge_keys_parsing(spark):
    assert merge_keys("target.StopID = source.StopID") == [("StopID", "StopID", False)]
    pairs = merge_keys("target.a = source.b AND source.c <=> target.d")
    assert pairs == [("a", "b", False), ("d", "c", True)]
    assert merge_keys(["a", ("b", "c")]) == [("a", "a", False), ("b", "c", False)]
    assert merge_keys("target.`odd name` = source.`odd name`") == [("odd name", "odd name", False)]


@pytest.mark.parametrize(
    "bad", ["target.a > source.a", "target.a = target.b", "target.a = source.a OR target.b = source.b", "true", ""]
)
def test_merge_keys_refuses_non_equi(spark, bad):
    with pytest.raises(ValueError):
        merge_keys(bad)


@pytest.mark.parametrize("limit", [None, 0])
def test_insert_only_semantics(spark, scratch, limit):
    p = scratch("merge")
    write_table(spark.createDataFrame([(1, "old"), (2, "old")], KV), p)
    src = spark.createDataFrame([(1, "new"), (3, "new"), (3, "dup"), (None, "n")], KV)
    merge_insert_only(spark, src, p, "target.k = source.k", broadcast_max_bytes=limit)
    # matched row not updated; new key in; duplicates within source both in; null key in
    assert table_rows(spark, p) == sorted([(1, "old"), (2, "old"), (3, "new"), (3, "dup"), (None, "n")], key=repr)
    merge_insert_only(spark, src, p, "target.k = source.k", broadcast_max_bytes=limit)
    # a null key never matches: inserted again on every run
    assert len([r for r in table_rows(spark, p) if r[0] is None]) == 2


@pytest.mark.parametrize("limit", [None, 0])
def test_null_safe_key_is_idempotent(spark, scratch, limit):
    p = scratch("merge")
    src = spark.createDataFrame([(1, None), (1, "a")], "k int, r string")
    pred = "target.k = source.k AND target.r <=> source.r"
    merge_insert_only(spark, src, p, pred, broadcast_max_bytes=limit)
    merge_insert_only(spark, src, p, pred, broadcast_max_bytes=limit)
    assert table_rows(spark, p, "k int, r string") == sorted([(1, None), (1, "a")], key=repr)


def test_create_when_absent_keeps_duplicates(spark, scratch):
    p = scratch("merge")
    src = spark.createDataFrame([(1, "a"), (1, "b")], KV)
    merge_insert_only(spark, src, p, ["k"])
    assert len(table_rows(spark, p)) == 2


def test_create_partitioned(spark, scratch):
    p = scratch("merge")
    src = spark.createDataFrame([(1, "a"), (2, "b")], KV)
    merge_insert_only(spark, src, p, ["k"], partition_cols="v")
    merge_insert_only(spark, spark.createDataFrame([(3, "a")], KV), p, ["k"], partition_cols="v")
    assert sorted(r["k"] for r in read_table(spark, p, KV).collect()) == [1, 2, 3]


def test_columns_by_name_and_mismatch(spark, scratch):
    p = scratch("merge")
    write_table(spark.createDataFrame([(1, "a")], KV), p)
    reordered = spark.createDataFrame([("b", 2)], "v string, k int")
    merge_insert_only(spark, reordered, p, ["k"], schema=spark.createDataFrame([], KV).schema)
    assert table_rows(spark, p) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="columns differ"):
        merge_insert_only(spark, spark.createDataFrame([(3,)], "k int"), p, ["k"], schema=spark.createDataFrame([], KV).schema)
    with pytest.raises(ValueError, match="types differ"):
        merge_insert_only(spark, spark.createDataFrame([(3, 1)], "k int, v int"), p, ["k"], schema=spark.createDataFrame([], KV).schema)
    with pytest.raises(KeyError):
        merge_insert_only(spark, spark.createDataFrame([(3, "x")], KV), p, ["absent"])


def test_broadcast_path_does_not_shuffle_target(spark, scratch, capsys):
    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.range(1000).selectExpr("cast(id as int) as k", "'t' as v"), p)
    tgt = read_table(spark, p, KV)
    src = spark.createDataFrame([(1, "s"), (5000, "s")], KV)
    out = new_rows(src, tgt, merge_keys(["k"]))
    out.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "LeftAnti" in plan
    assert [r["k"] for r in out.collect()] == [5000]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    target=st.lists(st.integers(0, 20), max_size=15),
    source=st.lists(st.integers(0, 20), min_size=1, max_size=15),
    limit=st.sampled_from([None, 0]),
)
def test_merge_twice_equals_once(spark, scratch, target, source, limit):
    p = scratch("prop")
    if target:
        write_table(spark.createDataFrame([(k, "t") for k in target], KV), p)
    src = spark.createDataFrame([(k, "s") for k in source], KV)
    merge_insert_only(spark, src, p, ["k"], schema=src.schema, broadcast_max_bytes=limit)
    once = table_rows(spark, p)
    merge_insert_only(spark, src, p, ["k"], schema=src.schema, broadcast_max_bytes=limit)
    assert table_rows(spark, p) == once
    expected = [(k, "t") for k in target] + ([(k, "s") for k in source if k not in set(target)] if target else [(k, "s") for k in source])
    assert once == sorted(expected, key=repr)


@pytest.mark.parametrize("hot_key", [7, None])
def test_shuffled_merge_keeps_hot_rows_in_place(spark, scratch, capsys, hot_key):
    from pyspark.sql import functions as F

    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.range(0, 3000, 2).selectExpr("cast(id as int) as k", "'t' as v"), p)
    tgt = read_table(spark, p, KV)
    # a third of the source rows on one key (absent from the target), rest spread
    hot = F.lit(hot_key).cast("int")
    src = spark.range(3000).select(
        F.when(F.col("id") < 1000, hot).otherwise(F.col("id").cast("int")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    out = new_rows(src, tgt, merge_keys(["k"]), broadcast_max_bytes=0)
    got = sorted((r["k"], r["v"]) for r in out.collect() if r["k"] != hot_key)
    expected = sorted((i, str(i)) for i in range(1000, 3000) if i % 2 == 1)
    assert got == expected
    assert sum(1 for r in out.collect() if r["k"] == hot_key) == 1000
    out.explain()
    plan = capsys.readouterr().out
    assert "__h0" in plan and "__m0" in plan and "Union" in plan


def test_shuffled_merge_hot_key_present_in_target(spark, scratch):
    from pyspark.sql import functions as F

    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.createDataFrame([(7, "t"), (8, "t")], KV), p)
    tgt = read_table(spark, p, KV)
    src = spark.range(900).select(
        F.when(F.col("id") < 600, F.lit(7)).otherwise(F.col("id")).cast("int").alias("k"), F.lit("s").alias("v")
    )
    out = new_rows(src, tgt, merge_keys(["k"]), broadcast_max_bytes=0)
    assert sorted(r["k"] for r in out.collect()) == list(range(600, 900))


def test_noop_merge_adds_no_files(spark, scratch):
    import glob

    p = scratch("merge")
    src = spark.range(100).selectExpr("cast(id as int) as k", "cast(id as string) as v")
    merge_insert_only(spark, src, p, ["k"])
    files = lambda: len(glob.glob(p.replace("file:", "") + "/*.parquet"))
    before = files()
    merge_insert_only(spark, src, p, ["k"])
    merge_insert_only(spark, src, p, ["k"])
    assert files() == before
    merge_insert_only(spark, spark.createDataFrame([(500, "new")], KV), p, ["k"])
    assert files() > before and read_table(spark, p, KV).count() == 101


def test_create_checks_declared_schema(spark, scratch):
    with pytest.raises(ValueError, match="types differ"):
        merge_insert_only(spark, spark.createDataFrame([(1, 2)], "k int, v int"), scratch("m"), ["k"],
                          schema=spark.createDataFrame([], KV).schema)


@pytest.mark.parametrize("limit", [None, 0])
def test_merge_reads_only_target_keys(spark, scratch, capsys, limit):
    import re

    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.range(50).selectExpr("cast(id as int) as k", "cast(id as string) as v", "id * 2 as w"), p)
    tgt = read_table(spark, p, "k int, v string, w bigint")
    src = spark.createDataFrame([(1, "s", 0), (99, "s", 0)], "k int, v string, w bigint")
    new_rows(src, tgt, merge_keys(["k"]), broadcast_max_bytes=limit).explain()
    plan = capsys.readouterr().out
    # the source is a local table: every file scan in the plan reads the target
    target_scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert target_scans, plan
    for ln in target_scans:
        assert re.search(r"ReadSchema: struct<k:int>", ln), ln


def test_merge_survives_retried_tasks():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = os.path.join(root, "tests", "scripts", "task_retry_merge.py")
    res = subprocess.run([sys.executable, script, root], capture_output=True, text=True, timeout=600)
    assert res.returncode == 0, res.stderr[-2000:]
    counts = json.loads(res.stdout.strip().splitlines()[-1])
    # 500 target keys (even) + 1500 new keys (odd 1..1999 and even 1000..1998), no duplicates
    assert counts == {"broadcast": [2000, 2000], "shuffled": [2000, 2000], "dedup_exact": True}


def test_small_merges_write_few_files(spark, scratch):
    import glob

    p = scratch("merge")
    files = lambda: len(glob.glob(p.replace("file:", "") + "/*.parquet"))
    first = spark.range(0, 300, 1, 6).selectExpr("cast(id as int) as k", "'a' as v")
    merge_insert_only(spark, first, p, ["k"])
    assert files() == 1
    more = spark.range(200, 600, 1, 6).selectExpr("cast(id as int) as k", "'b' as v")
    merge_insert_only(spark, more, p, ["k"])
    assert files() == 2 and read_table(spark, p, KV).count() == 600


@pytest.mark.parametrize("known", [True, False])
def test_equal_rows_of_a_hot_key_do_not_meet_in_one_task(spark, scratch, known):
    from pyspark.sql import functions as F

    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.createDataFrame([(-1 if known else -2, "t"), (5, "t")], KV), p)
    src = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).cast("int").alias("k"), F.lit("s").alias("v")
    )
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = new_rows(src, read_table(spark, p, KV), merge_keys(["k"]), broadcast_max_bytes=0)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(sizes) == (19_999 if known else 39_999)
    assert max(sizes) <= 2 * sum(sizes) / len(sizes) + 1


def test_merge_checks_the_files_schema(spark, scratch):
    p = scratch("merge")
    write_table(spark.createDataFrame([(1, "a")], KV), p)
    for bad in ("k int", "k int, v string, x int", "id int, v string", "k int, v int", "k long, v string"):
        for schema in (None, spark.createDataFrame([], bad).schema):
            with pytest.raises(ValueError, match="differ"):
                merge_insert_only(spark, spark.createDataFrame([], bad), p, [bad.split()[0]], schema=schema)
    assert table_rows(spark, p) == [(1, "a")]
    merge_insert_only(spark, spark.createDataFrame([("b", 2)], "v string, k int"), p, ["k"])
    assert table_rows(spark, p) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("limit", [None, 0])
def test_other_terms_besides_the_equality(spark, scratch, limit):
    p = scratch("merge")
    write_table(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], KV), p)
    src = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], KV)
    merge_insert_only(spark, src, p, "target.k = source.k AND target.v = 'a'", broadcast_max_bytes=limit)
    assert table_rows(spark, p) == [(1, "a"), (2, "b"), (2, "x"), (3, "c"), (4, "d")]


def test_merge_keeps_the_sources_parallelism(spark, scratch):
    p = scratch("merge")
    seen = spark.sparkContext.accumulator(0)
    src = spark.range(0, 4000, 1, 40).selectExpr("cast(id as int) as k", "cast(id as string) as v")
    tasks = src.rdd.mapPartitions(lambda rows: (seen.add(1), rows)[1]).toDF(KV)
    merge_insert_only(spark, tasks, p, ["k"])
    assert seen.value == 40 and read_table(spark, p, KV).count() == 4000


def _merged(spark, scratch, predicate, limit=None, hot=0):
    """Rows (k, z, v) of a table after a merge of source rows under a predicate."""
    ddl = "k int, z int, v string"
    p = scratch("merge")
    write_table(spark.createDataFrame([(1, 10, "a"), (2, 20, "x AND target.z = source.z AND y"), (3, 30, "c")], ddl), p)
    src = spark.createDataFrame([(1, 11, "new"), (2, 21, "new"), (3, 30, "new"), (4, 40, "new")] + [(3, 31, "new")] * hot, ddl)
    counts = merge_insert_only(spark, src, p, predicate, broadcast_max_bytes=limit)
    rows = table_rows(spark, p, ddl)
    assert counts.read == 4 + hot and counts.inserted == len(rows) - 3 and counts.matched == counts.read - counts.inserted
    return [r for r in rows if r[2] == "new"]


@pytest.mark.parametrize("limit", [None, 0])
def test_terms_in_quotes_and_parentheses_stay_terms(spark, scratch, limit):
    quoted = "target.k = source.k AND target.v <> 'x AND target.z = source.z AND y'"
    assert _merged(spark, scratch, quoted, limit) == [(2, 21, "new"), (4, 40, "new")]
    grouped = "target.k = source.k AND (target.z = source.z AND target.v = 'c')"
    assert _merged(spark, scratch, grouped, limit) == [(1, 11, "new"), (2, 21, "new"), (4, 40, "new")]
    negated = "target.k = source.k AND NOT (target.v = 'a' AND target.z < source.z)"
    assert _merged(spark, scratch, negated, limit) == [(1, 11, "new"), (4, 40, "new")]
    either = "target.k = source.k AND (target.z = source.z OR target.z BETWEEN 10 AND 15)"
    assert _merged(spark, scratch, either, limit) == [(2, 21, "new"), (4, 40, "new")]


@pytest.mark.parametrize("hot", [0, 500])
def test_terms_beside_a_hot_key(spark, scratch, hot):
    term = "target.k = source.k AND target.z <= source.z - 1"
    got = _merged(spark, scratch, term, 0, hot)
    assert got == [(3, 30, "new"), (4, 40, "new")]


def test_false_hot_keys_do_no_harm(spark, scratch):
    from pyspark.sql import functions as F

    from tierkit.operators import merge

    src = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("s").alias("v"))
    tgt = spark.range(0, 200, 2).select(F.col("id").cast("int").alias("__t0"))
    keys = [merge.KeyPair("k", "k", False)]
    hashes = [r[0] for r in src.where("k < 50").select(F.xxhash64("k")).collect()] + [12345]
    stats = merge.KeyStats(0, 48, 200, [(h, 60) for h in hashes])
    match = F.col("source.k") == F.col("target.__t0")
    for out in (merge._in_place(src, tgt, keys, stats), merge._by_lots(src, tgt, keys, match, stats, 4)):
        assert sorted(r["k"] for r in out.collect()) == list(range(1, 200, 2))


def test_filter_keeps_absent_keys_out_of_the_shuffle(spark, scratch, capsys):
    from tierkit.operators.merge import new_rows

    p = scratch("merge")
    write_table(spark.range(0, 100_000).selectExpr("id as k", "'t' as v"), p)
    src = spark.range(99_000, 101_000).selectExpr("id as k", "'s' as v")
    out = new_rows(src, read_table(spark, p, "k long, v string"), merge_keys(["k"]), broadcast_max_bytes=6_000)
    assert out.count() == 1000
    out.explain()
    assert "bitmap_construct_agg" in capsys.readouterr().out
