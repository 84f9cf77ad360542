import datetime as dt
import warnings

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierkit.operators import (
    cast_columns,
    dedup_first,
    drop_strict,
    explode_columns,
    flatten,
    impute,
    parse_list_literal,
    rename_columns,
    select_strict,
    stamp_capture,
)


@pytest.fixture()
def stops(spark):
    return spark.createDataFrame(
        [("1", "A", ["r1", "r2"]), ("01", "B", []), ("2", "C", None), ("3", None, ["r3"])],
        "StopID string, Name string, Routes array<string>",
    )


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# ---- columns ---------------------------------------------------------------------


def test_select_strict_orders_and_raises(stops):
    assert select_strict(stops, ["Name", "StopID"]).columns == ["Name", "StopID"]
    with pytest.raises(KeyError, match="nope"):
        select_strict(stops, ["StopID", "nope"])


def test_drop_strict_raises_on_missing(stops):
    assert drop_strict(stops, "Routes").columns == ["StopID", "Name"]
    with pytest.raises(KeyError):
        drop_strict(stops, ["Routes", "absent"])


def test_rename_ignores_missing(stops):
    out = rename_columns(stops, {"Name": "Stop_Name", "absent": "x"})
    assert out.columns == ["StopID", "Stop_Name", "Routes"]


# ---- cleaning --------------------------------------------------------------------


def test_impute_only_mapped_and_present(stops):
    out = impute(stops, {"Name": "Null", "absent": "x"})
    assert rows(out, "StopID", "Name") == rows(stops.fillna({"Name": "Null"}), "StopID", "Name")
    assert out.where(F.col("Routes").isNull()).count() == 1  # untouched


def test_impute_wrong_type_fails(spark):
    df = spark.createDataFrame([(None,)], "n int")
    with pytest.raises(Exception):
        impute(df, {"n": "Null"}).collect()


def test_cast_columns_missing_column_raises(stops):
    with pytest.raises(KeyError):
        cast_columns(stops, {"absent": "int"})


def test_cast_then_dedup_collapses_padded_keys(stops):
    typed = cast_columns(stops, {"StopID": "int32"})
    assert typed.schema["StopID"].dataType.simpleString() == "int"
    first = dedup_first(typed, "StopID", F.col("Name"))
    assert rows(first, "StopID", "Name") == [(1, "A"), (2, "C"), (3, None)]


def test_dedup_keeps_first_under_order(spark):
    df = spark.createDataFrame(
        [(1, 3, "late"), (1, 1, "early"), (1, 2, "mid"), (2, 5, "only"), (None, 9, "n1"), (None, 4, "n2")],
        "k int, o int, v string",
    )
    out = dedup_first(df, "k", "o")
    assert rows(out) == rows(spark.createDataFrame([(1, 1, "early"), (2, 5, "only"), (None, 4, "n2")], df.schema))
    assert out.columns == df.columns


def test_dedup_null_order_values_still_ranked(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k int, o int, v string")
    # nulls sort first, like any other value: the row is not dropped
    assert rows(dedup_first(df, "k", "o"), "v") == [("a",)]


def test_dedup_default_is_stored_order(spark, scratch):
    path = scratch("stored")
    spark.createDataFrame([(1, "first"), (2, "x")], "k int, v string").coalesce(1).write.parquet(path)
    spark.createDataFrame([(1, "second")], "k int, v string").coalesce(1).write.mode("append").parquet(path)
    back = spark.read.schema("k int, v string").parquet(path)
    assert rows(dedup_first(back, "k"), "k", "v") == [(1, "first"), (2, "x")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=40, unique_by=lambda t: t),
    parts=st.integers(1, 5),
)
def test_dedup_independent_of_partitioning(spark, data, parts):
    df = spark.createDataFrame(data, "k int, o int")
    out = dedup_first(df.repartition(parts), "k", "o")
    expected = sorted((k, min(o for kk, o in data if kk == k)) for k in {k for k, _ in data})
    assert rows(out) == expected


def test_dedup_hot_key_reduced_before_shuffle(spark, capsys):
    hot = spark.range(100).withColumn("k", F.when(F.col("id") < 50, F.lit(1)).otherwise(F.col("id")))
    dedup_first(hot, "k", "id").explain()
    plan = capsys.readouterr().out
    partial = plan.index("WindowGroupLimit", plan.index("Exchange"))
    assert "Partial" in plan[partial:].splitlines()[0]


# ---- lists -----------------------------------------------------------------------


def test_parse_list_text_and_passthrough(spark, stops):
    text = spark.createDataFrame([(1, "['A','B']"), (2, "[]"), (3, None)], "k int, r string")
    assert rows(parse_list_literal(text, "r"), "k", "r") == [(1, ["A", "B"]), (2, []), (3, None)]
    assert parse_list_literal(stops, "Routes") is stops
    with pytest.raises(TypeError):
        parse_list_literal(spark.createDataFrame([(1,)], "k int"), "k")


def test_explode_empty_and_null_give_null_row(stops):
    out = explode_columns(stops, ["StopID", "Routes"], ["Routes"])
    assert rows(out) == sorted([("1", "r1"), ("1", "r2"), ("01", None), ("2", None), ("3", "r3")], key=repr)
    assert out.schema["Routes"].dataType.simpleString() == "string"


def test_explode_chain_is_cross_product(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x", "y", "z"])], "k int, w array<string>, t array<string>")
    assert explode_columns(df, ["k", "w", "t"], ["w", "t"]).count() == 6


def test_long_lists_are_exploded_by_chunks(spark):
    data = [(1, list(range(1000)), ["x", "y", "z"]), (2, [], None), (3, None, ["w"] * 8), (4, [5, None], []), (4, [5, None], [])]
    df = spark.createDataFrame(data, "k int, n array<int>, t array<string>")
    want = sorted(
        [(k, a, b) for k, n, t in data for a in (n or [None]) for b in (t or [None])], key=repr
    )
    for items in (1, 2, 7, 1000, 5000):
        assert rows(explode_columns(df, ["k", "n", "t"], ["n", "t"], chunk_items=items)) == want
    one = explode_columns(df, ["k", "n"], "n", chunk_items=10).where("k = 1")
    held = [n for n in one.rdd.glom().map(len).collect() if n]
    assert sum(held) == 1000 and len(held) > 1 and max(held) < 1000  # one row's items lie in several tasks
    with pytest.raises(ValueError):
        explode_columns(df, ["k", "n"], "n", chunk_items=0)


def test_explode_non_list_warns_and_keeps(stops):
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        out = explode_columns(stops, ["StopID", "Name"], ["Name"])
    assert any("does not hold lists" in str(w.message) for w in caught)
    assert out.count() == stops.count()


def test_explode_requires_columns(stops):
    with pytest.raises(KeyError):
        explode_columns(stops, ["StopID"], ["Routes"])
    with pytest.raises(KeyError):
        explode_columns(stops, ["StopID", "absent"], [])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lists=st.lists(st.one_of(st.none(), st.lists(st.sampled_from("abc"), max_size=4)), min_size=1, max_size=12))
def test_explode_row_count_property(spark, lists):
    df = spark.createDataFrame(list(enumerate(lists)), "k int, l array<string>")
    expected = sum(max(1, len(x or [])) for x in lists)
    assert explode_columns(df, ["k", "l"], ["l"]).count() == expected


# ---- nested ----------------------------------------------------------------------


def test_flatten_nested_structs(spark):
    df = spark.createDataFrame(
        [(1, (("x", 2), [1, 2])), (2, None)],
        "id int, a struct<b: struct<c: string, d: int>, e: array<int>>",
    )
    out = flatten(df)
    assert out.columns == ["id", "a.b.c", "a.b.d", "a.e"]
    assert out.count() == 2
    assert rows(out) == sorted([(1, "x", 2, [1, 2]), (2, None, None, None)], key=repr)
    assert flatten(df, sep="_").columns == ["id", "a_b_c", "a_b_d", "a_e"]


# ---- stamps ----------------------------------------------------------------------


def test_stamp_capture_constant_and_column(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    const = stamp_capture(df, dt.datetime(2025, 1, 1, 23, 32, 35)).first()
    assert (const["fecha_consulta"], const["hora_consulta"]) == (dt.date(2025, 1, 1), "23:32:35")
    per_row = stamp_capture(df, F.col("ts")).first()
    assert (per_row["fecha_consulta"], per_row["hora_consulta"]) == (dt.date(2024, 1, 2), "03:04:05")
    assert stamp_capture(df).columns == ["ts", "fecha_consulta", "hora_consulta"]


def test_dedup_ties_broken_by_remaining_columns(spark):
    data = [(1, 1, "b", 2.0), (1, 1, "a", 9.0), (1, 1, "a", 3.0), (2, 0, "z", None)]
    df = spark.createDataFrame(data, "k int, o int, v string, w double")
    for parts in (1, 3):
        out = dedup_first(df.repartition(parts), "k", "o")
        assert rows(out) == [(1, 1, "a", 3.0), (2, 0, "z", None)]


def test_dedup_skips_unorderable_tiebreakers(spark):
    df = spark.createDataFrame([(1, 1, {"x": 1}), (1, 0, {"y": 2})], "k int, o int, m map<string,int>")
    assert [r["m"] for r in dedup_first(df, "k", "o").collect()] == [{"y": 2}]


def test_dedup_stored_order_needs_file_table(spark):
    with pytest.raises(ValueError, match="order_by"):
        dedup_first(spark.range(3), "id")


def test_impute_strict_with_ansi_off(spark):
    df = spark.createDataFrame([(None,)], "n int")
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            impute(df, {"n": "Null"}).collect()
        assert impute(df, {"n": 0}).first()["n"] == 0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
