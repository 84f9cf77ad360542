"""Property checks (hypothesis) for the scalar helpers and flatten."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierkit.functions import list_literal, strict_cast
from tierkit.operators import flatten

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
RANGES = {"int8": (-(2**7), 2**7 - 1), "int16": (-(2**15), 2**15 - 1), "int32": (-(2**31), 2**31 - 1)}


@SETTINGS
@given(
    texts=st.lists(
        st.one_of(
            st.integers(-(2**40), 2**40).map(str),
            st.integers(-300, 300).map(lambda i: f" {i} "),
            st.text(alphabet="0123456789x-+. ", min_size=1, max_size=6),
        ),
        min_size=1,
        max_size=8,
    ),
    to=st.sampled_from(sorted(RANGES)),
)
def test_strict_int_cast_matches_python(spark, texts, to):
    lo, hi = RANGES[to]
    for text in texts:
        try:
            expected = int(text)  # Python also trims blanks and takes a sign
        except ValueError:
            expected = None
        expr = strict_cast(F.lit(text), to).alias("v")
        if expected is not None and lo <= expected <= hi:
            assert spark.range(1).select(expr).first()["v"] == expected, text
        else:
            with pytest.raises(Exception):
                spark.range(1).select(expr).first()


@SETTINGS
@given(
    items=st.lists(
        st.one_of(st.none(), st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0x24F), max_size=8)),
        max_size=6,
    )
)
def test_list_literal_round_trips_python_repr(spark, items):
    text = repr(items)
    assert spark.range(1).select(list_literal(F.lit(text)).alias("v")).first()["v"] == items


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 9), st.one_of(st.none(), st.tuples(st.integers(0, 9), st.one_of(st.none(), st.text(max_size=3))))),
        max_size=10,
    )
)
def test_flatten_keeps_rows_and_leaves(spark, rows):
    df = spark.createDataFrame(rows, "id int, s struct<a: int, b: string>")
    out = flatten(df)
    assert out.columns == ["id", "s.a", "s.b"]
    assert out.count() == len(rows)


key_value = st.one_of(st.none(), st.integers(0, 3))


@SETTINGS
@given(
    source=st.lists(st.tuples(key_value, key_value, st.integers(0, 9)), min_size=1, max_size=30),
    target=st.lists(st.tuples(key_value, key_value), max_size=15),
    null_safe=st.tuples(st.booleans(), st.booleans()),
    limit=st.sampled_from([None, 0]),
)
def test_anti_join_matches_brute_force(spark, source, target, null_safe, limit):
    from tierkit.operators.merge import KeyPair, new_rows

    src = spark.createDataFrame(source, "a int, b int, v int")
    tgt = spark.createDataFrame(target, "a int, b int")
    keys = [KeyPair("a", "a", null_safe[0]), KeyPair("b", "b", null_safe[1])]

    def eq(x, y, ns):
        return x == y if ns else (x is not None and y is not None and x == y)

    expected = sorted(
        (s for s in source if not any(eq(s[0], t[0], null_safe[0]) and eq(s[1], t[1], null_safe[1]) for t in target)),
        key=repr,
    )
    got = sorted((tuple(r) for r in new_rows(src, tgt, keys, broadcast_max_bytes=limit).collect()), key=repr)
    assert got == expected


@SETTINGS
@given(
    data=st.lists(st.tuples(key_value, key_value, st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 5)), min_size=1, max_size=30),
    parts=st.integers(1, 4),
)
def test_dedup_matches_brute_force(spark, data, parts):
    from tierkit.operators import dedup_first

    df = spark.createDataFrame(data, "k int, o int, p int, w int").repartition(parts)
    nulls_first = lambda x: (x is not None, x if x is not None else 0)
    groups: dict = {}
    for row in data:
        best = groups.get(row[0])
        # order: o, then the remaining columns p, w (k is the key)
        rank = tuple(nulls_first(x) for x in (row[1], row[2], row[3]))
        if best is None or rank < best[0]:
            groups[row[0]] = (rank, row)
    expected = sorted((r for _, r in groups.values()), key=repr)
    got = sorted((tuple(r) for r in dedup_first(df, "k", "o").collect()), key=repr)
    assert got == expected
