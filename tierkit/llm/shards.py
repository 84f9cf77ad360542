"""Uniform shuffle into shards of exact size, with DataFrame operations only.

1. Stamp every row with its input partition and a number; write that once, so
   every later pass and every retry sees the same stamps.
2. From the partitions' row counts draw the communication matrix: how many
   rows of each partition go to each shard.  In a uniform shuffle the rows of
   the matrix are multivariate hypergeometric draws from what is left of the
   shards, so shard sizes come out exact.
3. Permute locally: rank a partition's rows by a random key and cut the ranks
   at the partition's row of the matrix.
4. Exchange, and permute again: each shard's rows go to random groups of
   bounded size, are ranked inside by another key, and a running total of the
   group sizes turns ranks into gapless slots.

No task holds a whole shard: the largest unit is an input partition or a group.
"""

from __future__ import annotations

import json
from math import exp, lgamma
from random import Random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep

ROWS_PER_GROUP = 10_000


def _log_choose(n: int, k: int) -> float:
    return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def hypergeometric(rng: Random, good: int, bad: int, draws: int) -> int:
    """Number of good items among ``draws`` without replacement, by inversion
    outwards from the mode (time in proportion to the standard deviation)."""
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = exp(_log_choose(good, mode) + _log_choose(bad, draws - mode) - _log_choose(good + bad, draws))
    u = rng.random() - p
    up = down = p
    i = j = mode
    while u > 0 and (i < high or j > low):
        if i < high:
            up *= (good - i) * (draws - i) / ((i + 1) * (bad - draws + i + 1))
            i += 1
            u -= up
            if u <= 0:
                return i
        if j > low:
            down *= j * (bad - draws + j) / ((good - j + 1) * (draws - j + 1))
            j -= 1
            u -= down
            if u <= 0:
                return j
    return mode


def communication_matrix(counts: list[int], sizes: list[int], rng: Random) -> list[list[int]]:
    """Rows per partition (first index) and shard; sums are ``counts`` and ``sizes``."""
    left, out = list(sizes), []
    for n in counts:
        row, rest = [], sum(left)
        for s in range(len(left)):
            rest -= left[s]
            x = hypergeometric(rng, left[s], rest, n)
            row.append(x)
            n -= x
        left = [a - b for a, b in zip(left, row)]
        out.append(row)
    return out


def uniform_shards(
    df: DataFrame,
    n_shards: int,
    seed: int = 0,
    shard_col: str = "shard",
    slot_col: str = "slot",
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """Every row of ``df`` with a shard (0 to ``n_shards`` - 1) and a slot.

    Shard sizes differ by at most one row, slots are gapless from 0, and for
    a given input layout every arrangement is equally likely over the seeds.
    Values play no part: nulls, ties and repeated rows are placed like any
    other row, and an empty table gives no rows.  Columns named like the two
    new ones are replaced; all others pass through whatever their names.  One
    number per input partition and shard reaches the driver.
    """
    columns = [c for c in df.columns if c.lower() not in (shard_col.lower(), slot_col.lower())]
    rows = df.select(F.struct("*").alias("row"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("uid"))
    rows = keep(rows, "stamped")
    counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())
    total = sum(n for _, n in counts)
    rng = Random(seed)
    extra = set(rng.sample(range(n_shards), total % n_shards))
    sizes = [total // n_shards + (s in extra) for s in range(n_shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, rng)
    upto = [{"part": p, "upto": [sum(row[: s + 1]) for s in range(n_shards)]} for (p, _), row in zip(counts, matrix)]
    told = F.from_json(F.lit(json.dumps(upto)), "array<struct<part int, upto array<bigint>>>")
    cuts = keep(df.sparkSession.range(1).select(F.inline(told)), "matrix")

    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64("uid", F.lit(seed)), "uid"))
    ranked = rows.withColumn("rank", rank).join(cuts, "part")
    groups = max(1, -(-total // (n_shards * rows_per_group)))
    key = F.xxhash64("uid", F.lit(seed + 1))
    dealt = keep(
        ranked.select(
            "row", "uid", F.size(F.filter("upto", lambda x: x < F.col("rank"))).alias("to"), key.alias("key"), F.pmod(key, F.lit(groups)).alias("group")
        ),
        "dealt",
    )
    sized = dealt.groupBy("to", "group").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("to").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sized.select("to", "group", F.coalesce(before, F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("to", "group").orderBy("key", "uid"))
    placed = dealt.withColumn("inside", inside).join(offsets, ["to", "group"])
    return placed.select(
        *[F.col("row").getField(c).alias(c) for c in columns],
        F.col("to").cast("int").alias(shard_col),
        (F.col("base") + F.col("inside") - 1).cast("long").alias(slot_col),
    )
