"""Merge with injected task failures: the first attempt of one partition of
every job that scans the source fails; Spark retries it (local[4,4]).
Prints one JSON line with the row and distinct-key counts per plan."""

import json
import sys

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

spark = (
    SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")

from tierkit.operators import merge_insert_only  # noqa: E402
from tierkit.session import scratch_path  # noqa: E402
from tierkit.sources import read_table, write_table  # noqa: E402


@F.udf(T.BooleanType())
def flaky(k):
    ctx = TaskContext.get()
    if ctx is not None and ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return True


out = {}
for label, limit in (("broadcast", None), ("shuffled", 0)):
    path = scratch_path(spark, "retry-" + label)
    write_table(spark.range(0, 1000, 2).selectExpr("id as k", "'t' as v"), path)
    source = spark.range(0, 2000, 1, 4).selectExpr("id as k", "'s' as v").where(flaky(F.col("k")))
    merge_insert_only(spark, source, path, ["k"], broadcast_max_bytes=limit)
    back = read_table(spark, path, "k bigint, v string")
    out[label] = [back.count(), back.select("k").distinct().count()]

# keep-first under the same failures: 4000 rows, keys 0..999 plus a hot key -1
from tierkit.operators import dedup_first  # noqa: E402

rows = (
    spark.range(0, 4000, 1, 4)
    .selectExpr("case when id % 4 = 0 then -1 else id % 1000 end as k", "id as o")
    .where(flaky(F.col("o")))
)
first = dedup_first(rows, "k", "o")
kept = {r["k"]: r["o"] for r in first.collect()}
expected = {}
for i in range(4000):
    k = -1 if i % 4 == 0 else i % 1000
    expected.setdefault(k, i)
out["dedup_exact"] = kept == expected
print(json.dumps(out))
