"""Membership filter: a bitmap over key hashes, to drop rows before a shuffle.

The keys of one side set one bit each in a bitmap that a distributed aggregate
builds, ``bitmap_construct_agg`` per bucket of 32,768 bits.  Rows of the other
side whose bit is not set have no partner; they are dropped where they are read.
A set bit proves nothing, so an exact join still follows.  A bitmap takes
``BITS_PER_KEY / 8`` bytes a key whatever the keys are, some forty times less
than a broadcast of the keys, and its size is known before it is built.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.operators._names import q

#: About 1 in ``BITS_PER_KEY`` absent keys has a bit that another key set.
BITS_PER_KEY = 16
#: Bits of a bucket of Spark's bitmap functions, and of a word of ours.
BUCKET_BITS = 32_768
WORD_BITS = 64
#: Bytes that a broadcast row takes besides its bitmap.
ROW_BYTES = 64

_HASHED_ALIKE = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BinaryType,
    T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType,
)


class KeyFilter(NamedTuple):
    """Buckets ``(__bucket, __words)`` of a bitmap of ``bits`` bits."""

    buckets: DataFrame
    bits: int


def hashes_alike(left: Sequence[T.DataType], right: Sequence[T.DataType]) -> bool:
    """True if equal keys of these types have equal hashes (floats have two
    zeros, and other types of equal values hash unlike)."""
    return all(a == b and isinstance(a, _HASHED_ALIKE) for a, b in zip(left, right))


def filter_bytes(n_keys: int) -> int:
    """Bytes of a filter of ``n_keys`` keys, as broadcast."""
    return _buckets(n_keys) * (BUCKET_BITS // 8 + ROW_BYTES)


def _buckets(n_keys: int) -> int:
    return max(1, math.ceil(n_keys * BITS_PER_KEY / BUCKET_BITS))


def _bit(cols: Sequence[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(bits))


def key_filter(keys: DataFrame, cols: Sequence[str], n_keys: int, max_bytes: int) -> KeyFilter | None:
    """The filter of the keys in ``cols``, of which there are at most ``n_keys``;
    ``None`` if it would take more than ``max_bytes``.

    Null is a value like others here.  Repeated keys do no harm."""
    if filter_bytes(n_keys) > max_bytes:
        return None
    bits = _buckets(n_keys) * BUCKET_BITS
    # Spark numbers buckets and bits from 1 and 0 for positions from 1.
    bit = keys.select((_bit([q(c) for c in cols], bits) + 1).alias("b"))
    maps = bit.groupBy(F.bitmap_bucket_number("b").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m")
    )
    # As words of 64 bits, eight bytes in reading order each: a word is found by its place.
    word = F.expr(f"transform(sequence(0, {BUCKET_BITS // WORD_BITS - 1}), i -> cast(conv(hex(substring(m, 8 * i + 1, 8)), 16, -10) as bigint))")
    return KeyFilter(maps.select("__bucket", word.alias("__words")), bits)


def possible_rows(df: DataFrame, cols: Sequence[str], of: KeyFilter) -> DataFrame:
    """Rows of ``df`` whose key in ``cols`` may be one of the filter's; narrow,
    the filter is broadcast (its size was checked when it was built)."""
    bit = _bit([q(c) for c in cols], of.bits)
    marked = df.withColumn("__bit", bit).withColumn("__of", F.floor(F.col("__bit") / BUCKET_BITS) + 1)
    met = marked.join(F.broadcast(of.buckets), F.col("__of") == F.col("__bucket"))
    at = F.pmod("__bit", F.lit(BUCKET_BITS)).cast("int")
    word = F.get("__words", F.floor(at / WORD_BITS).cast("int"))
    # The first of a word's bytes is its highest, the lowest bit of a byte its first.
    shift = (7 - F.pmod(F.floor(at / 8), F.lit(8))) * 8 + F.pmod(at, F.lit(8))
    return met.where(F.getbit(word, shift.cast("int")) == 1).select(*[q(c) for c in df.columns])
