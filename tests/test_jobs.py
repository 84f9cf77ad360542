import dataclasses
import datetime as dt
import itertools
import json
import os

import pytest
from pyspark.sql import types as T

from helpers import write_text
from tierkit.sources import ingest_envelope, read_table, write_table
from tierkit.plans import (
    LakePaths,
    bronze_dimension,
    bronze_fact,
    full_run,
    silver_dimension,
    silver_fact,
    silver_fact_unseen,
    unseen_captures,
)
from tierkit.plans.feeds import transit_feeds
from tierkit.plans.jobs import (
    _captures_in,
    bronze_dimension_schema,
    bronze_fact_schema,
    silver_child_schema,
    silver_dimension_schema,
    silver_fact_schema,
)

CAPTURE = dt.datetime(2025, 1, 1, 23, 32, 35)


def stop(i, name, routes, lon=-77.0):
    return {"StopID": i, "Name": name, "Lon": lon, "Lat": 38.9, "Routes": routes}


def position(vehicle, when, trip="119010", block="B1", **extra):
    rec = {
        "VehicleID": vehicle, "Lat": 38.9, "Lon": -77.0, "Deviation": 1.5, "DateTime": when, "TripID": trip,
        "RouteID": "R1", "DirectionNum": 0, "DirectionText": "NORTH", "TripHeadsign": "X",
        "TripStartTime": "2025-01-01T23:00:00", "TripEndTime": "2025-01-01T23:59:00", "BlockNumber": block,
    }
    rec.update(extra)
    return rec


LANDINGS = itertools.count()


def land(scratch, field, records, name="r.json"):
    """A landed response, a second later than the one landed before it: two files of
    one clock tick would be ordered by their paths, which are random here."""
    d = scratch("landing")
    write_text(d, name, json.dumps({field: records}, indent=1))
    at = CAPTURE.timestamp() + next(LANDINGS)
    os.utime(os.path.join(d, name), (at, at))
    return d


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_dimension_layers(spark, scratch):
    stops, _ = transit_feeds()
    lake = LakePaths(scratch("lake"))
    first = land(scratch, "Stops", [
        stop("1", "Main St", ["A", "B"]),
        stop("1", "Main St (dup)", ["C"]),   # repeated key in one response
        stop("2", "Elm", []),                # empty list
        stop("3", "Oak", None),              # null list
    ])
    second = land(scratch, "Stops", [stop("01", "Main padded", ["Z"]), stop("4", "New", ["D"])])
    bronze_dimension(spark, stops, first, lake)
    bronze_dimension(spark, stops, first, lake)  # re-run adds nothing
    bronze_dimension(spark, stops, second, lake)  # "01" is new as text
    bronze = read_table(spark, lake.bronze("stops"), bronze_dimension_schema(stops))
    assert bronze.count() == 6  # raw keeps the in-response duplicate

    silver_dimension(spark, stops, lake)
    silver_dimension(spark, stops, lake)  # idempotent
    silver = read_table(spark, lake.silver("stops"), silver_dimension_schema(stops))
    assert silver.columns == ["StopID", "Stop_Name", "Lon", "Lat"]
    assert rows(silver, "StopID", "Stop_Name") == [(1, "Main St"), (2, "Elm"), (3, "Oak"), (4, "New")]
    child = read_table(spark, lake.silver_child("stops", "Routes"), silver_child_schema(stops))
    assert rows(child, "StopID", "Routes") == sorted([(1, "A"), (1, "B"), (2, None), (3, None), (4, "D")], key=repr)


def test_dimension_with_list_text(spark, scratch):
    stops, _ = transit_feeds()
    record = T.StructType([f if f.name != "Routes" else T.StructField("Routes", T.StringType()) for f in stops.record_schema])
    feed = dataclasses.replace(stops, record_schema=record)
    lake = LakePaths(scratch("lake"))
    bronze_dimension(spark, feed, land(scratch, "Stops", [stop("7", "Text", "['A','B']"), stop("8", "Empty", "[]")]), lake)
    silver_dimension(spark, feed, lake)
    child = read_table(spark, lake.silver_child("stops", "Routes"), silver_child_schema(feed))
    assert rows(child, "StopID", "Routes") == sorted([(7, "A"), (7, "B"), (8, None)], key=repr)


def test_fact_layers(spark, scratch):
    _, positions = transit_feeds()
    lake = LakePaths(scratch("lake"))
    landing = land(scratch, "BusPositions", [
        position("2853", "2025-01-01T21:32:24"),
        position("2853", "2025-01-01T21:30:00", trip="200"),  # repeated key, different attributes
        position("8090", "2025-01-01T21:31:00", block=None),  # null to impute
    ])
    bronze_fact(spark, positions, landing, lake, CAPTURE)
    bronze = read_table(spark, lake.bronze("positions"), bronze_fact_schema(positions))
    assert bronze.count() == 3
    assert {(r["fecha_consulta"], r["hora_consulta"]) for r in bronze.collect()} == {(dt.date(2025, 1, 1), "23:32:35")}

    silver_fact(spark, dataclasses.replace(positions, dedup_order=("DateTime",)), lake, CAPTURE)
    silver = read_table(spark, lake.silver("positions"), silver_fact_schema(positions))
    types = dict(silver.dtypes)
    assert (types["VehicleID"], types["TripID"], types["DirectionNum"], types["DateTime"]) == (
        "smallint", "int", "tinyint", "timestamp_ntz")
    got = rows(silver, "VehicleID", "TripID", "BlockNumber", "DateTime")
    assert got == [(2853, 200, "B1", dt.datetime(2025, 1, 1, 21, 30)), (8090, 119010, "Null", dt.datetime(2025, 1, 1, 21, 31))]


def test_fact_default_order_is_stored_order(spark, scratch):
    _, positions = transit_feeds()
    lake = LakePaths(scratch("lake"))
    landing = land(scratch, "BusPositions", [position("1", "2025-01-01T21:32:24", trip="10"), position("1", "2025-01-01T20:00:00", trip="20")])
    bronze_fact(spark, positions, landing, lake, CAPTURE)
    silver_fact(spark, positions, lake)
    silver = read_table(spark, lake.silver("positions"), silver_fact_schema(positions))
    assert rows(silver, "TripID") == [(10,)]


@pytest.mark.parametrize(
    "bad,match",
    [
        (dict(VehicleID="99999"), "VehicleID"),          # overflows int16
        (dict(TripID="12a"), "TripID"),                  # bad digits
        (dict(VehicleID=None), "null value"),            # null key
        (dict(DateTime="2025-01-01T21:32:24Z"), "zone"),  # zoned timestamp
        (dict(DirectionNum=300), "DirectionNum"),        # long → tinyint overflow
    ],
)
def test_fact_bad_values_fail_and_leave_target(spark, scratch, bad, match):
    _, positions = transit_feeds()
    lake = LakePaths(scratch("lake"))
    rec = position("1", "2025-01-01T21:32:24")
    rec.update(bad)
    bronze_fact(spark, positions, land(scratch, "BusPositions", [rec]), lake, CAPTURE)
    with pytest.raises(Exception, match=match):
        silver_fact(spark, positions, lake)


def test_missing_field_and_non_json_fail(spark, scratch):
    stops, positions = transit_feeds()
    lake = LakePaths(scratch("lake"))
    d = scratch("landing")
    write_text(d, "quota.json", json.dumps({"Message": "denied"}))
    with pytest.raises(Exception, match="quota.json"):
        bronze_fact(spark, positions, d, lake, CAPTURE)
    d2 = scratch("landing")
    write_text(d2, "oops.json", "not json at all")
    with pytest.raises(Exception):
        bronze_dimension(spark, stops, d2, lake)
    # no partial data: the failure comes before any write (or leaves an empty directory)
    from tierkit.sources import table_exists

    path = lake.bronze("stops")
    assert not table_exists(spark, path) or read_table(spark, path, bronze_dimension_schema(stops)).count() == 0


def test_full_run(spark, scratch):
    stops, positions = transit_feeds()
    lake = LakePaths(scratch("lake"))
    dims = land(scratch, "Stops", [stop("1", "A", ["R1", "R2"]), stop("2", "B", ["R2"])])
    facts = land(scratch, "BusPositions", [position("5", "2025-01-01T21:00:00"), position("6", "2025-01-01T21:01:00")])
    tables = full_run(spark, stops, positions, dims, facts, lake, CAPTURE)
    assert set(tables) == {"bronze_stops", "bronze_positions", "silver_stops", "silver_positions", "silver_stops_Routes"}
    assert read_table(spark, tables["silver_stops_Routes"], silver_child_schema(stops)).count() == 3
    assert read_table(spark, tables["silver_positions"], silver_fact_schema(positions)).count() == 2


def test_silver_dimension_releases_its_cache(spark, scratch):
    stops, _ = transit_feeds()
    lake = LakePaths(scratch("lake"))
    bronze_dimension(spark, stops, land(scratch, "Stops", [stop("1", "A", ["R"])]), lake)
    spark.catalog.clearCache()
    silver_dimension(spark, stops, lake)
    raw = read_table(spark, lake.bronze("stops"), bronze_dimension_schema(stops))
    # nothing stays cached after the job
    assert not raw.storageLevel.useMemory
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_silver_dimension_refines_only_new_keys(spark, scratch, capsys):
    stops, _ = transit_feeds()
    lake = LakePaths(scratch("lake"))
    bronze_dimension(spark, stops, land(scratch, "Stops", [stop("1", "A", ["R1"])]), lake)
    silver_dimension(spark, stops, lake)
    later = [stop("2", "B", ["R2"]), stop("2", "B-dup", ["R9"]), stop("01", "X", ["R8"])]
    bronze_dimension(spark, stops, land(scratch, "Stops", later), lake)
    silver_dimension(spark, stops, lake)
    silver = read_table(spark, lake.silver("stops"), silver_dimension_schema(stops))
    assert rows(silver, "StopID", "Stop_Name") == [(1, "A"), (2, "B")]
    child = read_table(spark, lake.silver_child("stops", "Routes"), silver_child_schema(stops))
    assert rows(child, "StopID", "Routes") == [(1, "R1"), (2, "R2")]


def test_command_line_runs_both_layers(spark, scratch):
    from tierkit.__main__ import main

    stops_landing = land(scratch, "Stops", [stop("1", "A", ["R1"])])
    pos_landing = land(scratch, "BusPositions", [position("5", "2025-01-01T21:00:00")])
    root = scratch("lake")
    assert main(["all", "--lake", root, "--stops", stops_landing, "--positions", pos_landing,
                 "--capture-ts", "2025-01-01T23:32:35"]) == 0
    stops, positions = transit_feeds()
    lake = LakePaths(root)
    assert read_table(spark, lake.silver("stops"), silver_dimension_schema(stops)).count() == 1
    assert read_table(spark, lake.silver("positions"), silver_fact_schema(positions)).count() == 1
    assert main(["silver", "--lake", root]) == 0


def test_nested_dimension_records_flow_through_both_layers(spark, scratch):
    from pyspark.sql import types as T

    from tierkit.plans import DimensionFeed

    record = T.StructType([
        T.StructField("StopID", T.StringType()),
        T.StructField("Geo", T.StructType([T.StructField("Lat", T.DoubleType()), T.StructField("Lon", T.DoubleType())])),
        T.StructField("Routes", T.ArrayType(T.StringType())),
    ])
    feed = DimensionFeed(
        name="geo_stops", data_field="Stops", record_schema=record, key="StopID",
        casts={"StopID": "int32", "Geo.Lat": "float"}, renames={"Geo.Lon": "Longitude"}, list_col="Routes",
    )
    lake = LakePaths(scratch("lake"))
    recs = [{"StopID": "1", "Geo": {"Lat": 38.5, "Lon": -77.0}, "Routes": ["A", "B"]},
            {"StopID": "01", "Geo": {"Lat": 0.0, "Lon": 0.0}, "Routes": []},
            {"StopID": "2", "Geo": None, "Routes": None}]
    bronze_dimension(spark, feed, land(scratch, "Stops", recs), lake)
    silver_dimension(spark, feed, lake)
    silver_dimension(spark, feed, lake)
    silver = read_table(spark, lake.silver("geo_stops"), silver_dimension_schema(feed))
    assert silver.columns == ["StopID", "Geo.Lat", "Longitude"]
    assert rows(silver, "StopID", "Geo.Lat", "Longitude") == [(1, 38.5, -77.0), (2, None, None)]
    child = read_table(spark, lake.silver_child("geo_stops", "Routes"), silver_child_schema(feed))
    assert rows(child, "StopID", "Routes") == sorted([(1, "A"), (1, "B"), (2, None)], key=repr)


def test_lake_paths_layout():
    lake = LakePaths("/lake", "api")
    assert lake.bronze("stops") == "/lake/bronze/api/stops"
    assert lake.silver_child("stops", "Routes") == "/lake/silver/api/stops_Routes"
    assert LakePaths("/lake").silver("x") == "/lake/silver/x"


def test_command_line_stream_mode_takes_new_files_only(spark, scratch):
    import os

    from tierkit.__main__ import main

    stops_landing = land(scratch, "Stops", [stop("1", "A", ["R1"])])
    pos_landing = land(scratch, "BusPositions", [position("5", "2025-01-01T21:00:00")])
    root, ckpt = scratch("lake"), scratch("ckpt")
    args = ["all", "--lake", root, "--stops", stops_landing, "--positions", pos_landing, "--stream-checkpoint", ckpt]
    assert main(args + ["--capture-ts", "2025-01-01T21:00:05"]) == 0
    with open(os.path.join(pos_landing.replace("file:", ""), "r2.json"), "w") as fh:
        fh.write(json.dumps({"BusPositions": [position("6", "2025-01-01T21:00:30")]}))
    assert main(args + ["--capture-ts", "2025-01-01T21:00:35"]) == 0
    stops, positions = transit_feeds()
    lake = LakePaths(root)
    raw = read_table(spark, lake.bronze("positions"), bronze_fact_schema(positions))
    assert sorted((r["VehicleID"], r["hora_consulta"]) for r in raw.collect()) == [("5", "21:00:05"), ("6", "21:00:35")]
    refined = read_table(spark, lake.silver("positions"), silver_fact_schema(positions)).collect()
    assert [(r["VehicleID"], r["hora_consulta"]) for r in refined] == [(6, "21:00:35")]
    assert read_table(spark, lake.silver("stops"), silver_dimension_schema(stops)).count() == 1


def test_command_line_requires_landing_for_raw_layer(capsys):
    from tierkit.__main__ import main

    with pytest.raises(SystemExit):
        main(["bronze", "--lake", "/nowhere"])
    assert "--stops and --positions are required" in capsys.readouterr().err


def test_first_by_landing_order_whatever_wrote_the_raw_table(spark, scratch):
    import glob
    import os
    import random

    from pyspark.sql import functions as F

    stops, _ = transit_feeds()
    rng = random.Random(4)
    landing = scratch("landing")
    for n, when in ((0, 2_000_000_100), (1, 2_000_000_050), (2, 2_000_000_200)):  # the second file landed first
        body = [{"StopID": str(1 + i % 7) if i % 2 else f"0{1 + i % 7}", "Name": f"file {n} row {i}", "Lon": 1.0, "Lat": 2.0, "Routes": ["A"]} for i in range(30)]
        os.utime(write_text(landing, f"f{n}.json", json.dumps({"Stops": body})), (when, when))
    # Raw keys are texts: "1" and "01" meet only after the cast, so the first of either counts.
    want = {1 + i % 7: f"file 1 row {i}" for i in reversed(range(30))}
    for _ in range(20):
        lake = LakePaths(scratch("lake"))
        rows = ingest_envelope_rows(spark, stops, landing).repartition(rng.randint(1, 6), F.rand(rng.randint(0, 99)))
        write_table(rows, lake.bronze(stops.name))
        for f in glob.glob(lake.bronze(stops.name).replace("file:", "") + "/*.parquet"):
            os.utime(f, (rng.randint(1, 10**9),) * 2)  # as if tasks had finished in another order
        silver_dimension(spark, stops, lake)
        got = read_table(spark, lake.silver(stops.name), silver_dimension_schema(stops)).collect()
        assert {r["StopID"]: r["Stop_Name"] for r in got} == want


def test_unseen_captures_are_refined_once(spark, scratch):
    _, feed = transit_feeds()
    feed = dataclasses.replace(feed, write_mode="append", dedup_order=("DateTime",))
    lake = LakePaths(scratch("lake"))
    stamps = [CAPTURE + dt.timedelta(minutes=30 * i) for i in range(4)]  # over midnight

    def capture(i, *vehicles):
        records = [position(v, f"2025-01-01T2{i}:0{n}:00") for n, v in enumerate(vehicles)]
        bronze_fact(spark, feed, land(scratch, "BusPositions", records), lake, stamps[i])

    def held():
        got = read_table(spark, lake.silver(feed.name), silver_fact_schema(feed))
        return rows(got, "VehicleID", "fecha_consulta", "hora_consulta")

    def stamp(i):
        return stamps[i].date(), stamps[i].strftime("%H:%M:%S")

    assert silver_fact_unseen(spark, feed, lake) == 0  # nothing landed
    capture(0, "1", "1", "2")
    assert silver_fact_unseen(spark, feed, lake) == 2
    capture(1, "1")
    capture(2, "1", "3", "3")
    assert unseen_captures(spark, feed, lake) == [tuple(str(v) for v in stamp(i)) for i in (1, 2)]
    assert silver_fact_unseen(spark, feed, lake) == 3  # keep-first within a capture, not across
    assert silver_fact_unseen(spark, feed, lake) == 0
    want = sorted([(1, *stamp(0)), (2, *stamp(0)), (1, *stamp(1)), (1, *stamp(2)), (3, *stamp(2))], key=repr)
    assert held() == want

    # A capture that cannot be refined adds no row of the run, and stays unseen.
    capture(3, "1", "99999999")
    with pytest.raises(Exception):
        silver_fact_unseen(spark, feed, lake)
    assert held() == want and unseen_captures(spark, feed, lake) == [tuple(str(v) for v in stamp(3))]
    with pytest.raises(ValueError):
        silver_fact_unseen(spark, dataclasses.replace(feed, write_mode="overwrite"), lake)
    with pytest.raises(ValueError):
        unseen_captures(spark, dataclasses.replace(feed, partition_cols=("RouteID",)), lake)


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_capture_without_a_row(spark, scratch, mode):
    _, feed = transit_feeds()
    feed = dataclasses.replace(feed, write_mode=mode)
    lake = LakePaths(scratch("lake"))

    def held():
        return read_table(spark, lake.bronze(feed.name), bronze_fact_schema(feed)).count()

    bronze_fact(spark, feed, land(scratch, "BusPositions", []), lake, CAPTURE)
    assert held() == 0
    bronze_fact(spark, feed, land(scratch, "BusPositions", [position("1", "2025-01-01T21:00:00")]), lake, CAPTURE)
    assert held() == 1
    # A shuffle that turns out empty as it runs, not only an empty scan.
    bronze_fact(spark, feed, land(scratch, "BusPositions", []), lake, CAPTURE + dt.timedelta(minutes=1))
    assert held() == (1 if mode == "append" else 0)


def test_unseen_captures_prune_the_raw_scan(spark, scratch):
    _, feed = transit_feeds()
    lake = LakePaths(scratch("lake"))
    feed = dataclasses.replace(feed, write_mode="append")
    for minutes in (0, 1, 45):
        bronze_fact(spark, feed, land(scratch, "BusPositions", [position("1", "2025-01-01T21:00:00")]), lake, CAPTURE + dt.timedelta(minutes=minutes))
    raw = read_table(spark, lake.bronze(feed.name), bronze_fact_schema(feed))
    some = raw.where(_captures_in([("2025-01-01", "23:33:35"), ("2025-01-02", "00:17:35")]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "PushedFilters: []" in plan
    assert some.count() == 2 and raw.where(_captures_in([])).count() == 0


def ingest_envelope_rows(spark, feed, landing):
    from tierkit.sources.envelope import LANDED

    return ingest_envelope(spark, landing, feed.data_field, feed.record_schema, order_col=LANDED)
