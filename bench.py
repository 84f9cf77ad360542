"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is timed end to end: its own writes plus full evaluation of the
returned frame (a no-op sink, so nothing is collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "envelope_ingest",
    "envelope_documents",
    "partitioned_write",
    "merge_single_key",
    "merge_composite_key",
    "merge_composite_shuffled",
    "merge_hot_key",
    "dedup_single",
    "dedup_composite",
    "dedup_stored_order",
    "explode_list",
    "explode_chain",
    "parse_list",
    "cast_timestamp",
    "bronze_dim",
    "bronze_fact",
    "silver_dim",
    "silver_child",
    "silver_fact",
    "fact_history",
    "full_run",
    "stream_merge",
    "stream_fact",
    "stream_dim",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from tierkit.queries import QUERIES
    from tierkit.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus), app="tierkit-bench")
    # Warm-up (JVM start, JSON reader, code generation caches): not timed.
    for name in ("snapshot_read", "dedup_single", "envelope_ingest", "merge_single_key"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
