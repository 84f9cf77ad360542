"""Print the physical plans of the key operators on the driver's tables.

Usage: python show_plans.py [sf_dir] > PLANS.md
Attribute ids and long locations are stripped so plans diff cleanly.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql import functions as F

from tierkit.operators import dedup_first
from tierkit.operators.merge import merge_keys, new_rows
from tierkit.plans import LakePaths, bronze_dimension, silver_dimension
from tierkit.plans.feeds import transit_feeds
from tierkit.plans.jobs import bronze_dimension_schema, silver_dimension_schema, _new_key_rows
from tierkit.queries import _land, _schema, stop_records, table
from tierkit.session import local_session, scratch_path
from tierkit.sources import ingest_envelope, read_table, write_envelopes, write_table


def plan(df, mode: str = "simple") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = re.sub(r"#\d+L?", "", buf.getvalue())
    text = re.sub(r"\[plan_id=\d+\]", "", text)
    text = re.sub(r"file:[^\],]*/tierkit-scratch/([a-z-]+?)-[0-9a-f]+(\.\.\.)?", r"<scratch>/\1", text)
    text = re.sub(r"file:/root/testdata/[^\],]*/", "<testdata>/", text)
    return "\n".join(line.rstrip() for line in text.strip().splitlines())


def section(title: str, note: str, df) -> None:
    print(f"## {title}\n\n{note}\n\n```\n{plan(df)}\n```\n")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print(f"# Physical plans ({sf}, local session)\n")
    print("Generated by `python show_plans.py`; ids and scratch paths are normalised.\n")

    li = table(spark, sf, "lineitem")
    section("Keep-first dedup", "Partial `WindowGroupLimit` before the `Exchange`: each task forwards at most one row per key.",
            dedup_first(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]))

    target = scratch_path(spark, "plan-target")
    write_table(li.where(F.col("l_linenumber") <= 3), target)
    tgt = read_table(spark, target, _schema(li))
    src = li.where(F.col("l_linenumber") >= 3)
    keys = merge_keys(["l_orderkey", "l_linenumber"])
    section("Merge, broadcast path", "Target read as key columns only; source keys broadcast (measured); no target shuffle.",
            new_rows(src, tgt, keys))
    section("Merge, shuffled path", "Rows of hot source keys (bounded table, broadcast) decided map-side; target keys de-duplicated before the shuffle.",
            new_rows(src, tgt, keys, broadcast_max_bytes=0))

    events = table(spark, sf, "events")
    stamped = events.select("event_id", F.to_date("ts").alias("d"), F.date_format("ts", "HH:00:00").alias("h"))
    section("Partitioned write input", "`REBALANCE` on the partition columns: AQE splits a hot value and packs small ones.",
            stamped.hint("rebalance", "d", "h"))

    landing = scratch_path(spark, "plan-landing")
    write_envelopes(table(spark, sf, "customer"), landing, "Rows")
    section("Envelope ingest", "JSON scan with the declared schema; `inline` of the data field (fails on a missing field).",
            ingest_envelope(spark, landing, "Rows", _schema(table(spark, sf, "customer")), multi_line=False))

    stops, _ = transit_feeds()
    lake = LakePaths(scratch_path(spark, "plan-lake"))
    bronze_dimension(spark, stops, _land(stop_records(table(spark, sf, "part")), spark, "plan-stops", "Stops"), lake, multi_line=False)
    silver_dimension(spark, stops, lake)
    raw = read_table(spark, lake.bronze(stops.name), bronze_dimension_schema(stops)).withColumn("StopID", F.col("StopID").cast("int"))
    rows, fresh = _new_key_rows(spark, raw, "StopID", lake.silver(stops.name), "StopID", silver_dimension_schema(stops))
    section("Refined dimension, new keys only", "Raw rows filtered by a broadcast semi join against the (cached, measured) new keys: no raw-row shuffle.",
            rows)
    if fresh is not None:
        fresh.unpersist()
    spark.stop()


if __name__ == "__main__":
    main()
