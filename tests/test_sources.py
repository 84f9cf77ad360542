import json
import os

import pytest
from pyspark.sql import functions as F

from tierkit.sources.tables import read_table, reads_from, write_table
from pyspark.sql import functions as F

from helpers import write_text
from tierkit.sources import TableNotFound, ingest_envelope, read_table, table_exists, write_envelopes, write_table

RECORD = "StopID string, Name string, Lon double, Lat double, Routes array<string>"


def schema(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def test_ingest_pretty_printed_documents(spark, scratch):
    d = scratch("landing")
    doc = {"Stops": [{"StopID": "1", "Name": "A", "Lon": -77.0, "Lat": 38.9, "Routes": ["R1", "R2"]}, {"StopID": "2"}]}
    write_text(d, "r1.json", json.dumps(doc, indent=2))
    write_text(d, "r2.json", json.dumps({"Stops": []}, indent=2))
    out = ingest_envelope(spark, d, "Stops", schema(spark, RECORD))
    assert out.columns == ["StopID", "Name", "Lon", "Lat", "Routes"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("1", "A", -77.0, 38.9, ["R1", "R2"]), ("2", None, None, None, None)]


def test_ingest_json_lines(spark, scratch):
    d = scratch("landing")
    lines = "\n".join(json.dumps({"Rows": [{"a": i}, {"a": i + 10}]}) for i in range(3))
    write_text(d, "part.json", lines)
    out = ingest_envelope(spark, d, "Rows", schema(spark, "a bigint"), multi_line=False)
    assert sorted(r["a"] for r in out.collect()) == [0, 1, 2, 10, 11, 12]


def test_ingest_keeps_nested_objects(spark, scratch):
    d = scratch("landing")
    write_text(d, "r.json", json.dumps({"Rows": [{"id": 1, "geo": {"lat": 1.5, "lon": 2.5}}]}))
    out = ingest_envelope(spark, d, "Rows", schema(spark, "id int, geo struct<lat: double, lon: double>"))
    assert out.schema["geo"].dataType.simpleString() == "struct<lat:double,lon:double>"


def test_ingest_missing_field_names_the_file(spark, scratch):
    d = scratch("landing")
    write_text(d, "good.json", json.dumps({"Stops": [{"StopID": "1"}]}))
    write_text(d, "bad.json", json.dumps({"Message": "quota exceeded"}))
    with pytest.raises(Exception, match="bad.json"):
        ingest_envelope(spark, d, "Stops", schema(spark, RECORD)).collect()


def test_ingest_not_json_raises(spark, scratch):
    d = scratch("landing")
    write_text(d, "html.json", "<html>503 Service Unavailable</html>")
    for multi_line in (True, False):
        with pytest.raises(Exception, match="html.json"):
            ingest_envelope(spark, d, "Stops", schema(spark, RECORD), multi_line=multi_line).collect()


def test_write_envelopes_round_trip(spark, scratch):
    src = spark.range(2500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    d = scratch("envelopes")
    write_envelopes(src, d, "Rows", rows_per_response=100)
    raw = spark.read.json(d)
    assert raw.select(F.max(F.size("Rows"))).first()[0] <= 100
    back = ingest_envelope(spark, d, "Rows", src.schema, multi_line=False)
    assert back.count() == 2500 and back.exceptAll(src).count() == 0


def test_read_missing_table(spark, scratch):
    with pytest.raises(TableNotFound):
        read_table(spark, scratch("absent"), "a int")
    assert not table_exists(spark, scratch("absent"))


def test_write_modes(spark, scratch):
    p = scratch("modes")
    df = spark.range(5)
    write_table(df, p, mode="error")
    assert table_exists(spark, p)
    write_table(spark.range(3), p, mode="ignore")
    assert read_table(spark, p, "id bigint").count() == 5
    write_table(spark.range(2), p, mode="append")
    assert read_table(spark, p, "id bigint").count() == 7
    write_table(spark.range(3), p)  # overwrite replaces the table
    assert read_table(spark, p, "id bigint").count() == 3
    with pytest.raises(Exception):
        write_table(df, p, mode="error")
    with pytest.raises(ValueError):
        write_table(df, p, mode="upsert")


def test_overwrite_of_own_input_is_refused(spark, scratch):
    p = scratch("self")
    write_table(spark.range(5), p)
    own = read_table(spark, p, "id bigint")
    with pytest.raises(ValueError, match="reads from it"):
        write_table(own.where("id > 1"), p)
    assert read_table(spark, p, "id bigint").count() == 5


def test_partitioned_write_escapes_time_and_prunes(spark, scratch, capsys):
    p = scratch("parts")
    df = spark.createDataFrame(
        [(1, "2025-01-01", "23:32:35"), (2, "2025-01-01", "23:32:35"), (3, "2025-01-02", "08:00:00")],
        "id int, d string, t string",
    ).withColumn("d", F.to_date("d"))
    write_table(df, p, partition_cols=["d", "t"])
    assert os.path.isdir(os.path.join(p.replace("file:", ""), "d=2025-01-01", "t=23%3A32%3A35"))
    back = read_table(spark, p, "id int, d date, t string")
    assert back.schema["t"].dataType.simpleString() == "string"
    one = back.where(F.col("t") == "23:32:35")
    one.explain()
    assert "PartitionFilters: [isnotnull(t" in capsys.readouterr().out
    assert sorted(r["id"] for r in one.collect()) == [1, 2]


def test_partitioned_write_requires_columns(spark, scratch):
    with pytest.raises(KeyError):
        write_table(spark.range(3), scratch("p"), partition_cols="nope")


@pytest.mark.parametrize("name", ["plain", "with space", "per%20cent", "50%"])
def test_overwrite_of_an_input_is_refused(spark, scratch, name):
    path = f"{scratch('guard')}/{name}"
    write_table(spark.range(10).toDF("k"), path)
    read = read_table(spark, path, "k long")
    cached = read_table(spark, path, "k long").cache()
    assert cached.count() == 10
    joined = spark.range(3).join(read, F.col("id") == F.col("k"))
    nested = spark.range(3).where(F.col("id").isin([1]))
    assert not reads_from(nested, path)
    for df in (read, cached, joined, cached.where("k > 3")):
        with pytest.raises(ValueError, match="refusing"):
            write_table(df, path)
    cached.unpersist()
    assert read_table(spark, path, "k long").count() == 10
    write_table(spark.range(4).toDF("k"), path)
    assert read_table(spark, path, "k long").count() == 4


def test_batch_write_into_a_stream_table_is_refused(spark, scratch):
    source, target = scratch("stream-in"), scratch("stream-out")
    write_table(spark.range(1).toDF("k"), source)
    query = spark.readStream.schema("k long").parquet(source).writeStream.format("parquet")
    query.option("checkpointLocation", scratch("ck")).trigger(availableNow=True).start(target).awaitTermination()
    with pytest.raises(ValueError, match="file sink"):
        write_table(spark.range(1).toDF("k"), target, mode="append")
    assert read_table(spark, target, "k long").count() == 1


def test_ingest_with_inferred_schema(spark, scratch):
    d = scratch("landing")
    write_text(d, "a.json", json.dumps({"Stops": [{"StopID": "1", "Lat": 38.9, "Routes": ["A"]}]}))
    write_text(d, "b.json", json.dumps({"Stops": [{"StopID": "2", "Geo": {"x": 1}}]}))
    with pytest.raises(ValueError, match="record_schema"):
        ingest_envelope(spark, d, "Stops", None)
    out = ingest_envelope(spark, d, "Stops", None, infer_schema=True)
    assert sorted(out.columns) == ["Geo", "Lat", "Routes", "StopID"]
    assert out.count() == 2
    with pytest.raises(ValueError, match="no response"):
        ingest_envelope(spark, d, "Missing", None, infer_schema=True)


def test_undeclared_fields_fail_are_kept_or_ignored(spark, scratch):
    d = scratch("drift")
    write_text(d, "a.json", '{"Stops": [{"StopID": "1", "Zone": {"a": 1}, "New": null}, {"StopID": "2"}, null]}')
    write_text(d, "b.json", '{"Stops": []}')
    with pytest.raises(Exception, match="undeclared fields Zone, New.*a.json"):
        ingest_envelope(spark, d, "Stops", spark.createDataFrame([], RECORD).schema).collect()
    schema = spark.createDataFrame([], RECORD).schema
    kept = {r["StopID"]: r["_unknown"] for r in ingest_envelope(spark, d, "Stops", schema, unknown_fields="keep").collect()}
    assert kept == {"1": '{"Zone":"{\\"a\\":1}","New":null}', "2": None, None: None} or kept["1"].startswith('{"Zone":')
    assert kept["2"] is None
    ignored = ingest_envelope(spark, d, "Stops", schema, unknown_fields="ignore")
    assert sorted(str(r["StopID"]) for r in ignored.collect()) == ["1", "2", "None"]
    with pytest.raises(ValueError):
        ingest_envelope(spark, d, "Stops", schema, unknown_fields="other")
