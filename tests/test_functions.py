import datetime as dt

import pytest
from pyspark.sql import functions as F

from tierkit.functions import capture_date, capture_time, list_literal, resolve_type, strict_cast


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_resolve_type_accepts_pandas_names():
    assert resolve_type("int16").simpleString() == "smallint"
    assert resolve_type("int8").simpleString() == "tinyint"
    assert resolve_type("datetime64[ns]").simpleString() == "timestamp_ntz"
    assert resolve_type("category").simpleString() == "string"
    assert resolve_type("int").simpleString() == "int"


def test_strict_cast_trims_text(spark):
    assert one(spark, strict_cast(F.lit(" 12 "), "int32")) == 12


@pytest.mark.parametrize("text,to", [("12x", "int32"), ("300", "int8"), ("40000", "int16"), ("", "int32")])
def test_strict_cast_bad_text_or_overflow_raises(spark, text, to):
    with pytest.raises(Exception, match="cannot cast"):
        one(spark, strict_cast(F.lit(text), to))


def test_strict_cast_long_overflow_raises_not_wraps(spark):
    with pytest.raises(Exception, match="bad value"):
        one(spark, strict_cast(F.lit(300).cast("bigint"), "int8"))


def test_strict_cast_null_policy(spark):
    null = F.lit(None).cast("string")
    with pytest.raises(Exception, match="null value"):
        one(spark, strict_cast(null, "int32"))
    assert one(spark, strict_cast(null, "int32", nulls="keep")) is None


def test_strict_cast_null_policy_validated():
    with pytest.raises(ValueError):
        strict_cast("x", "int", nulls="drop")


def test_strict_cast_timestamp(spark):
    assert one(spark, strict_cast(F.lit("2024-01-02T03:04:05"), "datetime64[ns]")) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, strict_cast(F.lit("2024-01-02"), "timestamp_ntz")) == dt.datetime(2024, 1, 2)
    assert one(spark, strict_cast(F.lit("2024-01-02T03:04:05.123456"), "timestamp_ntz")).microsecond == 123456


@pytest.mark.parametrize("text", ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02 03:04:05-0500"])
def test_strict_cast_timestamp_rejects_zone(spark, text):
    with pytest.raises(Exception, match="zone"):
        one(spark, strict_cast(F.lit(text), "timestamp_ntz"))


def test_strict_cast_timestamp_bad_text(spark):
    with pytest.raises(Exception, match="bad value"):
        one(spark, strict_cast(F.lit("yesterday"), "timestamp_ntz"))


@pytest.mark.parametrize(
    "text,expected",
    [
        ("['A', 'B']", ["A", "B"]),
        ('["A","B"]', ["A", "B"]),
        ("[]", []),
        ("['it\\'s']", ["it's"]),
        ("['A', None]", ["A", None]),
        ("[None]", [None]),
        ("['None']", ["None"]),
    ],
)
def test_list_literal(spark, text, expected):
    assert one(spark, list_literal(F.lit(text))) == expected


def test_list_literal_null_stays_null(spark):
    assert one(spark, list_literal(F.lit(None).cast("string"))) is None


@pytest.mark.parametrize("text", ["not a list", "['A', 'B'", "{'a': 1}"])
def test_list_literal_malformed_raises(spark, text):
    with pytest.raises(Exception):
        one(spark, list_literal(F.lit(text)))


def test_capture_stamp_constant(spark):
    ts = dt.datetime(2025, 1, 1, 23, 32, 35)
    assert one(spark, capture_date(ts)) == dt.date(2025, 1, 1)
    assert one(spark, capture_time(ts)) == "23:32:35"
    assert one(spark, capture_time("2025-01-01 07:08:09")) == "07:08:09"


def test_capture_stamp_column(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 6, 1, 2, 3),)], "ts timestamp_ntz")
    row = df.select(capture_date(F.col("ts")).alias("d"), capture_time(F.col("ts")).alias("t")).first()
    assert row["d"] == dt.date(2024, 5, 6) and row["t"] == "01:02:03"


def test_strict_cast_raises_with_ansi_off(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad value"):
            one(spark, strict_cast(F.lit("300"), "int8"))
        with pytest.raises(Exception, match="bad value"):
            one(spark, strict_cast(F.lit(300).cast("bigint"), "tinyint"))
        assert one(spark, strict_cast(F.lit("12"), "int16")) == 12
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_strict_cast_auto_nulls_by_target_type(spark):
    null = F.lit(None).cast("string")
    assert one(spark, strict_cast(null, "timestamp_ntz")) is None
    assert one(spark, strict_cast(null, "category")) is None
    with pytest.raises(Exception, match="null value"):
        one(spark, strict_cast(null, "int16"))
    with pytest.raises(Exception, match="null value"):
        one(spark, strict_cast(null, "string", nulls="fail"))


@pytest.mark.parametrize(
    "text,expected",
    [
        ("[', None]', None]", [", None]", None]),
        ('["a, None", None, \'b\']', ["a, None", None, "b"]),
        ("['\\\\x41', '\\x41']", ["\\x41", "A"]),
    ],
)
def test_list_literal_quotes_are_opaque(spark, text, expected):
    assert one(spark, list_literal(F.lit(text))) == expected


def test_checkpoint_root_prefers_session_setting(spark):
    from tierkit.session import checkpoint_root, scratch_path

    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root + "/tierkit-scratch/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_resolve_type_complex_names(spark):
    assert resolve_type("decimal(10,2)").simpleString() == "decimal(10,2)"
    assert resolve_type("array<string>").simpleString() == "array<string>"
    assert one(spark, strict_cast(F.lit("12.345"), "decimal(10,2)")) == __import__("decimal").Decimal("12.35")


@pytest.mark.parametrize("n", [300, 20_000])
def test_list_literal_of_any_length(spark, n):
    items = [f"it's {i}" for i in range(n)] + [None, "x" * 1_000_000]
    assert one(spark, list_literal(F.lit(repr(items)))) == items


@pytest.mark.parametrize("text,expected", [("['A',]", ["A"]), ("[ 'A' , None , ]", ["A", None]), ("['\\u00e9\\n']", ["é\n"])])
def test_list_literal_python_forms(spark, text, expected):
    assert one(spark, list_literal(F.lit(text))) == expected


@pytest.mark.parametrize(
    "text",
    ["['A' 'B']", "[1, True]", "['\\U000e0001']", "['\\101']", "['\\a']", "['\\0']", "[['A']]", "['A',,]", "[,]", "['\\ud83d']", "['\\q']", "['a\nb']"],
)
def test_list_literal_refuses_what_it_does_not_decode(spark, text):
    with pytest.raises(Exception, match="not a list of texts"):
        one(spark, list_literal(F.lit(text)))


def test_capture_time_of_a_zone_less_column_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 9, 2, 30),), (None,)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r["t"] for r in df.select(capture_time(F.col("ts")).alias("t")).collect()] == ["02:30:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
