"""The membership filter keeps every row that has a partner."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.operators.membership import BITS_PER_KEY, filter_bytes, hashes_alike, key_filter, possible_rows


@pytest.mark.parametrize("n", [0, 1, 50, 20_000])
def test_filter_drops_only_absent_keys(spark, n):
    rng = random.Random(n)
    keys = [(rng.randint(0, 10**9), rng.choice(["a", "b", None])) for _ in range(n)]
    held = spark.createDataFrame(keys, "k long, s string")
    others = spark.range(10**9, 10**9 + 30_000).select(F.col("id").alias("k"), F.lit("c").alias("s"), F.lit(1).alias("words"))
    rows = held.withColumn("words", F.lit(2)).unionByName(others)
    of = key_filter(held, ["k", "s"], n, 1 << 30)
    kept = possible_rows(rows, ["k", "s"], of)
    assert kept.columns == rows.columns
    assert kept.where("words = 2").count() == n
    assert kept.where("words = 1").count() <= 1.5 * 30_000 / BITS_PER_KEY


def test_filter_is_not_built_beyond_its_bound(spark):
    assert key_filter(spark.range(1), ["id"], 10**6, filter_bytes(10**6) - 1) is None
    assert filter_bytes(10**6) < 2.1 * 10**6


def test_every_bit_of_a_bucket_is_found_again(spark):
    held = spark.range(3000)
    of = key_filter(held, ["id"], 3000, 1 << 30)
    total = of.buckets.select(F.aggregate("__words", F.lit(0), lambda a, w: a + F.bit_count(w)).alias("n")).agg(F.sum("n")).first()[0]
    distinct = held.select(F.pmod(F.xxhash64("id"), F.lit(of.bits))).distinct().count()
    assert total == distinct and possible_rows(held, ["id"], of).count() == 3000


def test_types_that_hash_alike():
    assert hashes_alike([T.LongType(), T.StringType()], [T.LongType(), T.StringType()])
    assert not hashes_alike([T.LongType()], [T.IntegerType()])
    assert not hashes_alike([T.DoubleType()], [T.DoubleType()])
