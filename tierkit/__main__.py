"""Command line: run the layers of the two transit feeds.

    python -m tierkit all --stops LANDING --positions LANDING --lake ROOT [--capture-ts TS]
    python -m tierkit bronze ...   # raw layer only
    python -m tierkit silver ...   # refined layer only (reads the raw tables)

    # on a cluster: ship the package and submit this file
    spark-submit --py-files tierkit.zip tierkit/__main__.py all --lake ... --stops ... --positions ...

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings are whatever ``spark-submit`` / ``spark-defaults.conf`` provide.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession

from tierkit.plans import (
    LakePaths,
    bronze_dimension,
    bronze_dimension_stream,
    bronze_fact,
    bronze_fact_stream,
    silver_dimension,
    silver_fact,
)
from tierkit.plans.feeds import transit_feeds


def _args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tierkit", description="raw → refined layers of the transit feeds")
    p.add_argument("layer", choices=["all", "bronze", "silver"])
    p.add_argument("--lake", required=True, help="lake root directory (shared storage)")
    p.add_argument("--namespace", default="", help="folder per source under each layer")
    p.add_argument("--stops", help="landing directory of the stop (dimension) responses")
    p.add_argument("--positions", help="landing directory of the position (fact) responses")
    p.add_argument("--capture-ts", help="capture instant, ISO text; default: now")
    p.add_argument("--json-lines", action="store_true", help="landing files hold one response per line")
    p.add_argument(
        "--stream-checkpoint",
        help="raw layer as file streams: only files landed since the last run (checkpoints under this folder)",
    )
    a = p.parse_args(argv)
    if a.layer in ("all", "bronze") and not (a.stops and a.positions):
        p.error("--stops and --positions are required for the raw layer")
    return a


def main(argv: list[str] | None = None) -> int:
    a = _args(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("tierkit").getOrCreate()
    stops, positions = transit_feeds()
    lake = LakePaths(a.lake.rstrip("/"), a.namespace)
    capture = dt.datetime.fromisoformat(a.capture_ts) if a.capture_ts else dt.datetime.now().replace(microsecond=0)
    multi_line = not a.json_lines
    if a.layer in ("all", "bronze"):
        if a.stream_checkpoint:
            ckpt = a.stream_checkpoint.rstrip("/")
            bronze_dimension_stream(spark, stops, a.stops, lake, f"{ckpt}/{stops.name}", multi_line=multi_line)
            bronze_fact_stream(spark, positions, a.positions, lake, f"{ckpt}/{positions.name}", capture, multi_line=multi_line)
        else:
            bronze_dimension(spark, stops, a.stops, lake, multi_line=multi_line)
            bronze_fact(spark, positions, a.positions, lake, capture, multi_line=multi_line)
    if a.layer in ("all", "silver"):
        silver_dimension(spark, stops, lake)
        # With a capture given, refine only that capture (partition pruning).
        silver_fact(spark, positions, lake, capture if (a.capture_ts or a.layer == "all") else None)
    print(json.dumps({"layer": a.layer, "lake": lake.root, "capture": capture.isoformat()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
