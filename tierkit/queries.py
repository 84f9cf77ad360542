"""One registered query per operator and job, each with its DuckDB oracle.

Every query reads the driver's tables (whole, never sampled) and returns a
DataFrame.  Queries that exercise writes put their tables in a fresh folder
under the shared checkpoint folder and return the table read back, so the
write path is part of what the oracle checks.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable
from types import SimpleNamespace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.operators import (
    cast_columns,
    dedup_first,
    drop_strict,
    explode_columns,
    flatten,
    impute,
    merge_insert_only,
    parse_list_literal,
    rename_columns,
    select_strict,
    stamp_capture,
)
from tierkit.plans import (
    LakePaths,
    bronze_dimension,
    bronze_dimension_stream,
    bronze_fact,
    full_run,
    silver_dimension,
    silver_fact,
    silver_fact_unseen,
)
from tierkit.plans.feeds import transit_feeds
from tierkit.plans.jobs import (
    bronze_dimension_schema,
    bronze_fact_schema,
    silver_child_schema,
    silver_dimension_schema,
    silver_fact_schema,
)
from tierkit.session import scratch_path
from tierkit.sources import ingest_envelope, read_table, write_envelopes, write_table
from tierkit.sources.envelope import LANDED, UNKNOWN
from tierkit.streaming import incremental_append, incremental_merge

# Declared schemas of the driver's tables (never inferred).
TABLES = {
    "documents": "doc_id bigint, text string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

CAPTURE = dt.datetime(2025, 1, 1, 23, 32, 35)
LATER = dt.datetime(2025, 1, 2, 0, 2, 35)
LATEST = dt.datetime(2025, 1, 2, 0, 32, 35)
ISO_US = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", TABLES[name])


def _schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


# ---- feeds derived from the driver's tables -----------------------------------------
# part stands for stops (its words for routes), events for vehicle positions.


def stop_records(part: DataFrame, duplicate: bool = False) -> DataFrame:
    """Stop records from ``part``.  ``duplicate=True`` gives, for the larger
    parts, a second landing whose keys equal the first only after the integer
    cast ("0" + key) and whose other fields differ."""
    src = part.where(F.col("p_size") > 25) if duplicate else part
    key = F.col("p_partkey").cast("string")
    name = F.col("p_name")
    return src.select(
        (F.concat(F.lit("0"), key) if duplicate else key).alias("StopID"),
        (F.upper(name) if duplicate else name).alias("Name"),
        (F.col("p_retailprice") + (1.0 if duplicate else 0.0)).alias("Lon"),
        F.col("p_size").cast("double").alias("Lat"),
        F.split(F.upper(name) if duplicate else name, " ").alias("Routes"),
    )


def position_records(events: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return events.select(
        F.col("user_id").cast("string").alias("VehicleID"),
        (F.col("value") / 100.0).alias("Lat"),
        (-F.col("value") / 100.0).alias("Lon"),
        F.col("value").alias("Deviation"),
        F.date_format(ts, ISO_US).alias("DateTime"),
        F.col("event_id").cast("string").alias("TripID"),
        F.col("event_type").alias("RouteID"),
        F.when(F.col("value") >= 0, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("DirectionNum"),
        F.when(F.col("value") >= 0, F.lit("NORTH")).otherwise(F.lit("SOUTH")).alias("DirectionText"),
        F.upper(F.col("event_type")).alias("TripHeadsign"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:00:00").alias("TripStartTime"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:59:59").alias("TripEndTime"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("BlockNumber"),
    )


def _ordered(positions):
    # Keep the earliest report per vehicle (trip id breaks ties).
    return dataclasses.replace(positions, dedup_order=("DateTime", "TripID"))


def _land(df: DataFrame, spark: SparkSession, label: str, field: str) -> str:
    path = scratch_path(spark, label)
    write_envelopes(df, path, field)
    return path


# ---- sources -------------------------------------------------------------------------


def q_envelope_ingest(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    landing = _land(customer, spark, "landing-customer", "Rows")
    return ingest_envelope(spark, landing, "Rows", _schema(customer), multi_line=False)


def q_envelope_documents(spark, sf_dir):
    """One response document per file, read whole (multi-line mode)."""
    orders = table(spark, sf_dir, "orders")
    landing = scratch_path(spark, "landing-orders")
    write_envelopes(orders, landing, "Rows", rows_per_response=5000, file_per_response=True)
    return ingest_envelope(spark, landing, "Rows", _schema(orders), multi_line=True)


def q_envelope_nested(spark, sf_dir):
    """Nested objects inside responses stay structs, then flatten to a.b names."""
    customer = table(spark, sf_dir, "customer")
    nested = customer.select(
        "c_custkey",
        F.struct(F.col("c_name").alias("name"), F.struct(F.col("c_nationkey").alias("key")).alias("nation")).alias("who"),
        F.struct(F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")).alias("account"),
    )
    landing = _land(nested, spark, "landing-nested", "Rows")
    records = ingest_envelope(spark, landing, "Rows", _schema(nested), multi_line=False)
    return flatten(records, sep="__")


def q_envelope_drift(spark, sf_dir):
    """Responses with fields that the schema lacks: kept beside the record."""
    stops, _ = transit_feeds()
    part = table(spark, sf_dir, "part")
    records = stop_records(part.where(F.col("p_size") <= 25)).withColumn("Zone", F.lit("Z1"))
    landing = _land(records, spark, "landing-drift", stops.data_field)
    plain = _land(stop_records(part.where(F.col("p_size") > 25)), spark, "landing-drift", stops.data_field)
    rows = [
        ingest_envelope(spark, at, stops.data_field, stops.record_schema, multi_line=False, unknown_fields="keep") for at in (landing, plain)
    ]
    return rows[0].union(rows[1]).select("StopID", "Name", F.col(UNKNOWN).alias("unknown"))


def q_json_flatten(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    nested = events.select("event_id", "user_id", F.from_json("props", "k bigint").alias("props"))
    return flatten(nested, sep="_")


def q_snapshot_read(spark, sf_dir):
    return table(spark, sf_dir, "supplier")


def q_write_overwrite(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "overwrite")
    write_table(customer, path)
    write_table(customer.where(F.col("c_acctbal") > 0), path, mode="overwrite")
    return read_table(spark, path, _schema(customer))


def q_write_append(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "append")
    write_table(supplier, path, mode="append")
    write_table(supplier, path, mode="append")
    return read_table(spark, path, _schema(supplier))


def q_write_ignore(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "ignore")
    write_table(nation.withColumn("n_name", F.upper("n_name")), path, mode="error")
    write_table(nation, path, mode="ignore")
    return read_table(spark, path, _schema(nation))


def q_write_error(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    path = scratch_path(spark, "error")
    write_table(nation.withColumn("n_name", F.upper("n_name")), path, mode="error")
    try:
        write_table(nation, path, mode="error")
    except AnalysisException:
        pass
    else:
        raise AssertionError("a second write in mode 'error' must fail")
    return read_table(spark, path, _schema(nation))


def _hour_stamp(events: DataFrame) -> DataFrame:
    return stamp_capture(events.select("event_id", "ts"), F.col("ts")).select(
        "event_id", "fecha_consulta", F.date_format("ts", "HH:00:00").alias("hora_consulta")
    )


def q_partitioned_write(spark, sf_dir):
    stamped = _hour_stamp(table(spark, sf_dir, "events"))
    path = scratch_path(spark, "partitioned")
    write_table(stamped, path, partition_cols=["fecha_consulta", "hora_consulta"])
    return read_table(spark, path, _schema(stamped))


def q_partitioned_read(spark, sf_dir):
    """One hour of the partitioned table: only its folders are read."""
    return q_partitioned_write(spark, sf_dir).where(F.col("hora_consulta") == "23:00:00")


# ---- merges --------------------------------------------------------------------------


def q_merge_single_key(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "merge-single")
    write_table(customer.where(F.col("c_acctbal") > 0), path)
    changed = customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    merge_insert_only(spark, changed, path, "target.c_custkey = source.c_custkey", schema=_schema(customer))
    return read_table(spark, path, _schema(customer))


def q_merge_composite_key(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "merge-composite")
    write_table(lineitem.where(F.col("l_linenumber") <= 3), path)
    merge_insert_only(
        spark,
        lineitem.where(F.col("l_linenumber") >= 3),
        path,
        "target.l_orderkey = source.l_orderkey AND target.l_linenumber = source.l_linenumber",
        schema=_schema(lineitem),
    )
    return read_table(spark, path, _schema(lineitem))


def q_merge_composite_shuffled(spark, sf_dir):
    """The large-source plan: no broadcast, target keys de-duplicated map-side."""
    lineitem = table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "merge-shuffled")
    write_table(lineitem.where(F.col("l_linenumber") <= 3), path)
    merge_insert_only(
        spark,
        lineitem.where(F.col("l_linenumber") >= 3),
        path,
        ["l_orderkey", "l_linenumber"],
        schema=_schema(lineitem),
        broadcast_max_bytes=0,
    )
    return read_table(spark, path, _schema(lineitem))


def q_merge_hot_key(spark, sf_dir):
    """Shuffled merge where one source key holds half of the rows (all open
    line items share key -1): the hot key's rows are decided where they are read."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    path = scratch_path(spark, "merge-hot")
    write_table(orders.where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v")), path)
    hot = F.when(F.col("l_linestatus") == "O", F.lit(-1).cast("bigint")).otherwise(F.col("l_orderkey"))
    source = lineitem.select(hot.alias("k"), F.col("l_returnflag").alias("v"))
    merge_insert_only(spark, source, path, "target.k = source.k", broadcast_max_bytes=0)
    return read_table(spark, path, "k bigint, v string")


def _residual(spark, sf_dir, broadcast_max_bytes):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "merge-residual")
    write_table(customer.where(F.col("c_nationkey") < 15), path)
    changed = customer.withColumn("c_acctbal", F.col("c_acctbal") + F.when(F.col("c_custkey") % 2 == 0, 1).otherwise(-1))
    predicate = "target.c_custkey = source.c_custkey AND target.c_acctbal BETWEEN source.c_acctbal AND source.c_acctbal + 5"
    merge_insert_only(spark, changed, path, predicate, schema=_schema(customer), broadcast_max_bytes=broadcast_max_bytes)
    return read_table(spark, path, _schema(customer))


def q_merge_residual(spark, sf_dir):
    """A predicate with a term besides the equality, source keys broadcast."""
    return _residual(spark, sf_dir, None)


def q_merge_residual_shuffled(spark, sf_dir):
    return _residual(spark, sf_dir, 0)


def _merge_under(spark, sf_dir, predicate, label, broadcast_max_bytes):
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, label)
    write_table(customer.where(F.col("c_nationkey") < 15), path)
    changed = customer.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    merge_insert_only(spark, changed, path, predicate, schema=_schema(customer), broadcast_max_bytes=broadcast_max_bytes)
    return read_table(spark, path, _schema(customer))


def q_merge_grouped_terms(spark, sf_dir):
    """Equalities inside parentheses or under NOT are terms, not keys."""
    predicate = (
        "target.c_custkey = source.c_custkey AND (target.c_name = source.c_name AND target.c_nationkey < 10) "
        "AND NOT (target.c_mktsegment = 'BUILDING' AND target.c_acctbal < source.c_acctbal)"
    )
    return _merge_under(spark, sf_dir, predicate, "merge-grouped", 0)


def q_merge_quoted_and(spark, sf_dir):
    """A quoted text that reads like a term is a text; BETWEEN has an AND of its own."""
    predicate = (
        "target.c_custkey = source.c_custkey AND target.c_mktsegment <> 'x AND target.c_acctbal = source.c_acctbal AND y' "
        "AND source.c_nationkey BETWEEN 3 AND 20"
    )
    return _merge_under(spark, sf_dir, predicate, "merge-quoted", None)


def q_merge_column_order(spark, sf_dir):
    """Columns are matched by name, checked against the table's files."""
    supplier = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "merge-order")
    write_table(supplier.where(F.col("s_nationkey") < 12), path)
    merge_insert_only(spark, supplier.select(*reversed(supplier.columns)), path, ["s_suppkey"])
    return read_table(spark, path, _schema(supplier))


def q_merge_null_dup_keys(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    keyed = nation.select(F.nullif(F.col("n_regionkey"), F.lit(0)).alias("k"), "n_name", "n_regionkey")
    path = scratch_path(spark, "merge-nulls")
    write_table(keyed.where(F.col("n_regionkey") < 3).drop("n_regionkey"), path)
    merge_insert_only(spark, keyed.drop("n_regionkey"), path, "target.k = source.k")
    return read_table(spark, path, _schema(keyed.drop("n_regionkey")))


def q_merge_create(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    path = scratch_path(spark, "merge-create")
    merge_insert_only(spark, part, path, "target.p_partkey = source.p_partkey")
    return read_table(spark, path, _schema(part))


# ---- projections ---------------------------------------------------------------------


def q_select_cols(spark, sf_dir):
    return select_strict(table(spark, sf_dir, "supplier"), ["s_suppkey", "s_name"])


def q_drop_cols(spark, sf_dir):
    return drop_strict(table(spark, sf_dir, "supplier"), ["s_acctbal"])


def q_rename_cols(spark, sf_dir):
    return rename_columns(table(spark, sf_dir, "supplier"), {"s_name": "stop_name", "absent": "ignored"})


# ---- cleaning and typing -------------------------------------------------------------


def q_impute_nulls(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    with_nulls = events.select("event_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"))
    return impute(with_nulls, {"event_type": "Null", "absent": "x"})


def q_impute_nan(spark, sf_dir):
    """NaN counts as absent in float columns, as null does."""
    events = table(spark, sf_dir, "events")
    value = F.when(F.col("value") < 0, F.lit(float("nan"))).when(F.col("event_type") != "error", F.col("value"))
    return impute(events.select("event_id", value.alias("value")), {"value": 0.5})


def q_cast_narrow(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    texts = part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        F.col("p_size").cast("string").alias("p_size"),
        F.col("p_size").alias("p_size8"),
    )
    return cast_columns(texts, {"p_partkey": "int32", "p_size": "int16", "p_size8": "int8"})


def q_cast_timestamp(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    texts = events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"))
    return cast_columns(texts, {"ts": "datetime64[ns]"})


def q_cast_category(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return cast_columns(events, {"event_type": "category"})


def q_dedup_single(spark, sf_dir):
    return dedup_first(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


def q_dedup_stored_order(spark, sf_dir):
    """Keep-first without an explicit order: the row written first wins."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "stored-order")
    write_table(orders, path, mode="append")
    write_table(orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, mode="append")
    return dedup_first(read_table(spark, path, _schema(orders)), "o_orderkey")


def q_dedup_landing_order(spark, sf_dir):
    """Keep-first by landing place: of two landings of the same stops the first
    wins, though the raw table was written anew in another order."""
    stops, _ = transit_feeds()
    records = stop_records(table(spark, sf_dir, "part"))
    later = records.withColumn("Name", F.upper("Name")).withColumn("Lon", F.col("Lon") + 1)
    landings = [_land(x, spark, "landing-order", stops.data_field) for x in (records, later)]
    path = scratch_path(spark, "landing-order-raw")
    for landing in reversed(landings):
        rows = ingest_envelope(spark, landing, stops.data_field, stops.record_schema, multi_line=False, order_col=LANDED)
        write_table(rows.repartition(5, "Name"), path, mode="append")
    raw = spark.read.parquet(path)
    return dedup_first(raw, "StopID", LANDED).select("StopID", "Name", "Lon", "Lat", F.array_join("Routes", "|").alias("Routes"))


def q_dedup_composite(spark, sf_dir):
    return dedup_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


# ---- lists ---------------------------------------------------------------------------


def _list_text(words: Column) -> Column:
    return F.concat(F.lit("['"), F.array_join(words, "', '"), F.lit("']"))


def q_parse_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    texts = part.select("p_partkey", _list_text(F.split("p_name", " ")).alias("items"))
    parsed = parse_list_literal(texts, "items")
    return parsed.select(
        "p_partkey",
        F.size("items").cast("bigint").alias("n_items"),
        F.array_join("items", "|").alias("items"),
    )


def q_parse_list_long(spark, sf_dir):
    """Long lists: all order keys of each customer, all keys of all orders of a
    status (thousands of items), and one item of all nations' names, repeated."""
    orders, nation = table(spark, sf_dir, "orders"), table(spark, sf_dir, "nation")
    keys = F.array_sort(F.collect_list("o_orderkey")).cast("array<string>")
    texts = orders.groupBy(F.col("o_custkey").cast("string").alias("k")).agg(_list_text(keys).alias("items"))
    texts = texts.unionByName(orders.groupBy(F.col("o_orderstatus").alias("k")).agg(_list_text(keys).alias("items")))
    whole = F.repeat(F.array_join(F.array_sort(F.collect_list("n_name")), ""), 100)
    texts = texts.unionByName(nation.agg(_list_text(F.array(whole)).alias("items")).withColumn("k", F.lit("all")))
    parsed = parse_list_literal(texts, "items")
    return parsed.select("k", F.size("items").cast("bigint").alias("n_items"), F.md5(F.array_join("items", "|")).alias("items_md5"))


def q_explode_list(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("word"))
    return explode_columns(part, ["p_partkey", "word"], ["word"])


def q_explode_empty(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    lists = nation.select(
        "n_nationkey",
        F.when(F.col("n_regionkey") == 0, F.array().cast("array<string>")).otherwise(F.array("n_name")).alias("item"),
    )
    return explode_columns(lists, ["n_nationkey", "item"], ["item"])


def q_explode_chain(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_partkey", F.split("p_name", " ").alias("word"), F.array("p_brand", "p_type").alias("tag")
    )
    return explode_columns(part, ["p_partkey", "word", "tag"], ["word", "tag"])


# ---- capture stamps ------------------------------------------------------------------


def q_capture_const(spark, sf_dir):
    return stamp_capture(table(spark, sf_dir, "orders").select("o_orderkey"), CAPTURE)


def q_capture_col(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return stamp_capture(events, F.col("ts")).drop("ts")


# ---- layer jobs ----------------------------------------------------------------------


def _stops_lake(spark, sf_dir, label):
    stops, _ = transit_feeds()
    part = table(spark, sf_dir, "part")
    lake = LakePaths(scratch_path(spark, label))
    first = _land(stop_records(part), spark, "landing-stops", stops.data_field)
    second = _land(stop_records(part, duplicate=True), spark, "landing-stops", stops.data_field)
    # Two captures; the first one is landed twice (a re-run adds nothing).
    for landing in (first, first, second):
        bronze_dimension(spark, stops, landing, lake, multi_line=False)
    return stops, lake


def q_bronze_dim(spark, sf_dir):
    stops, lake = _stops_lake(spark, sf_dir, "bronze-dim")
    return read_table(spark, lake.bronze(stops.name), bronze_dimension_schema(stops)).withColumn(
        "Routes", F.array_join("Routes", "|")
    )


def q_silver_dim(spark, sf_dir):
    stops, lake = _stops_lake(spark, sf_dir, "silver-dim")
    silver_dimension(spark, stops, lake)
    silver_dimension(spark, stops, lake)
    return read_table(spark, lake.silver(stops.name), silver_dimension_schema(stops))


def q_silver_child(spark, sf_dir):
    stops, lake = _stops_lake(spark, sf_dir, "silver-child")
    silver_dimension(spark, stops, lake)
    silver_dimension(spark, stops, lake)
    return read_table(spark, lake.silver_child(stops.name, stops.list_col), silver_child_schema(stops))


def q_silver_child_rebuilt(spark, sf_dir):
    """The parent table is there, its child table is not: the child comes out whole."""
    stops, lake = _stops_lake(spark, sf_dir, "silver-child")
    silver_dimension(spark, stops, lake)
    other = LakePaths(scratch_path(spark, "silver-lost"))
    schema = silver_dimension_schema(stops)
    write_table(read_table(spark, lake.silver(stops.name), schema), other.silver(stops.name))
    # The raw table as it stands, the parent copied, no child.
    lost = SimpleNamespace(bronze=lake.bronze, silver=other.silver, silver_child=other.silver_child)
    silver_dimension(spark, stops, lost)
    return read_table(spark, other.silver_child(stops.name, stops.list_col), silver_child_schema(stops))


def _positions_lake(spark, sf_dir, label):
    _, positions = transit_feeds()
    lake = LakePaths(scratch_path(spark, label))
    landing = _land(position_records(table(spark, sf_dir, "events")), spark, "landing-positions", positions.data_field)
    bronze_fact(spark, positions, landing, lake, CAPTURE, multi_line=False)
    return positions, lake


def q_bronze_fact(spark, sf_dir):
    positions, lake = _positions_lake(spark, sf_dir, "bronze-fact")
    return read_table(spark, lake.bronze(positions.name), bronze_fact_schema(positions))


def q_silver_fact(spark, sf_dir):
    positions, lake = _positions_lake(spark, sf_dir, "silver-fact")
    feed = _ordered(positions)
    silver_fact(spark, feed, lake, CAPTURE)
    return read_table(spark, lake.silver(positions.name), silver_fact_schema(positions))


def q_fact_history(spark, sf_dir):
    """Raw fact table kept in append mode: two captures, the refined layer
    reads only the later one (partition pruning on the capture stamp)."""
    _, positions = transit_feeds()
    positions = _ordered(dataclasses.replace(positions, write_mode="append"))
    lake = LakePaths(scratch_path(spark, "fact-history"))
    events = table(spark, sf_dir, "events")
    early = _land(position_records(events.where(F.col("event_type") == "view")), spark, "landing-positions", positions.data_field)
    late = _land(position_records(events), spark, "landing-positions", positions.data_field)
    bronze_fact(spark, positions, early, lake, CAPTURE, multi_line=False)
    bronze_fact(spark, positions, late, lake, LATER, multi_line=False)
    silver_fact(spark, dataclasses.replace(positions, write_mode="overwrite"), lake, LATER)
    return read_table(spark, lake.silver(positions.name), silver_fact_schema(positions))


def q_fact_history_raw(spark, sf_dir):
    """The raw fact table after two captures in append mode: both, whole."""
    _, positions = transit_feeds()
    positions = _ordered(dataclasses.replace(positions, write_mode="append"))
    lake = LakePaths(scratch_path(spark, "fact-history-raw"))
    events = table(spark, sf_dir, "events")
    for rows, capture in ((events.where(F.col("event_type") == "view"), CAPTURE), (events, LATER)):
        landing = _land(position_records(rows), spark, "landing-positions", positions.data_field)
        bronze_fact(spark, positions, landing, lake, capture, multi_line=False)
    return read_table(spark, lake.bronze(positions.name), bronze_fact_schema(positions))


def q_fact_unseen(spark, sf_dir):
    """Refined history without naming captures: one capture is refined, three more
    land, one of no row, and are refined together; a further run finds none."""
    _, positions = transit_feeds()
    positions = _ordered(dataclasses.replace(positions, write_mode="append"))
    lake = LakePaths(scratch_path(spark, "fact-unseen"))
    events = table(spark, sf_dir, "events")

    def land(rows: DataFrame, capture: dt.datetime) -> None:
        landing = _land(position_records(rows), spark, "landing-positions", positions.data_field)
        bronze_fact(spark, positions, landing, lake, capture, multi_line=False)

    land(events.where(F.col("event_type") == "view"), CAPTURE)
    silver_fact_unseen(spark, positions, lake)
    land(events, LATER)
    land(events.where(F.col("value") < 0), LATER + dt.timedelta(minutes=15))  # no such row
    land(events.where(F.col("event_type") == "error"), LATEST)
    silver_fact_unseen(spark, positions, lake)
    silver_fact_unseen(spark, positions, lake)
    return read_table(spark, lake.silver(positions.name), silver_fact_schema(positions))


def q_explode_chunked(spark, sf_dir):
    """Words of every document, long lists cut into chunks that are dealt over tasks."""
    docs = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    words = docs.select("doc_id", F.split("text", " ").alias("word"))
    return explode_columns(words, ["doc_id", "word"], "word", chunk_items=64)


def q_full_run(spark, sf_dir):
    stops, positions = transit_feeds()
    # The result tells ids as text, so they are refined as wide as events stores them.
    wide = {"VehicleID": "int64", "TripID": "int64"}
    positions = _ordered(dataclasses.replace(positions, casts=positions.casts | wide))
    lake = LakePaths(scratch_path(spark, "full-run"))
    part, events = table(spark, sf_dir, "part"), table(spark, sf_dir, "events")
    stop_landing = _land(stop_records(part), spark, "landing-stops", stops.data_field)
    pos_landing = _land(position_records(events), spark, "landing-positions", positions.data_field)
    tables = full_run(spark, stops, positions, stop_landing, pos_landing, lake, CAPTURE, multi_line=False)
    schemas = {
        "bronze_stops": bronze_dimension_schema(stops),
        "bronze_positions": bronze_fact_schema(positions),
        "silver_stops": silver_dimension_schema(stops),
        "silver_positions": silver_fact_schema(positions),
        "silver_stops_Routes": silver_child_schema(stops),
    }
    columns = {
        "bronze_stops": ("StopID", "Name", "Lon"),
        "bronze_positions": ("TripID", "BlockNumber", "Deviation"),
        "silver_stops": ("StopID", "Stop_Name", "Lon"),
        "silver_positions": ("VehicleID", "TripID", "Deviation"),
        "silver_stops_Routes": ("StopID", "Routes", None),
    }
    parts = [
        read_table(spark, tables[name], schemas[name]).select(
            F.lit(name).alias("table_name"),
            F.col(k).cast("string").alias("k"),
            F.col(v).cast("string").alias("v"),
            (F.col(x) if x else F.lit(None)).cast("double").alias("x"),
        )
        for name, (k, v, x) in columns.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def q_stream_merge(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    landing = scratch_path(spark, "stream-landing")
    target = scratch_path(spark, "stream-target")
    ckpt = scratch_path(spark, "stream-checkpoint")
    schema = _schema(nation)

    def run():
        incremental_merge(spark, landing, "Rows", schema, target, "n_nationkey", ckpt, multi_line=False, max_files_per_trigger=2)

    write_envelopes(nation.where(F.col("n_regionkey") < 3), f"{landing}/batch=1", "Rows", rows_per_response=5)
    run()
    write_envelopes(nation, f"{landing}/batch=2", "Rows", rows_per_response=10)
    run()
    run()
    return read_table(spark, target, schema)


def q_stream_fact(spark, sf_dir):
    """Fact feed landed in two waves, appended by the file-sink stream; each
    run stamps its own capture, and a run with nothing new adds nothing."""
    _, positions = transit_feeds()
    events = table(spark, sf_dir, "events")
    landing = scratch_path(spark, "stream-fact-landing")
    target = scratch_path(spark, "stream-fact-target")
    ckpt = scratch_path(spark, "stream-fact-checkpoint")

    def run(capture):
        incremental_append(spark, landing, positions.data_field, positions.record_schema, target, ckpt, capture, multi_line=False)

    write_envelopes(position_records(events.where(F.col("event_type") == "view")), f"{landing}/wave=1", positions.data_field)
    run(CAPTURE)
    write_envelopes(position_records(events.where(F.col("event_type") != "view")), f"{landing}/wave=2", positions.data_field)
    run(LATER)
    run(dt.datetime(2025, 1, 2, 0, 30, 0))
    return read_table(spark, target, bronze_fact_schema(positions))


def q_stream_dim(spark, sf_dir):
    """Stops landed in two overlapping waves, merged into the raw table by the
    dimension stream, then refined: same result as the batch layers."""
    stops, _ = transit_feeds()
    part = table(spark, sf_dir, "part")
    landing = scratch_path(spark, "stream-dim-landing")
    ckpt = scratch_path(spark, "stream-dim-checkpoint")
    lake = LakePaths(scratch_path(spark, "stream-dim"))
    write_envelopes(stop_records(part.where(F.col("p_size") <= 25)), f"{landing}/wave=1", stops.data_field)
    bronze_dimension_stream(spark, stops, landing, lake, ckpt, multi_line=False)
    write_envelopes(stop_records(part), f"{landing}/wave=2", stops.data_field)
    bronze_dimension_stream(spark, stops, landing, lake, ckpt, multi_line=False)
    silver_dimension(spark, stops, lake)
    return read_table(spark, lake.silver(stops.name), silver_dimension_schema(stops))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_ingest": q_envelope_ingest,
    "envelope_documents": q_envelope_documents,
    "envelope_nested": q_envelope_nested,
    "json_flatten": q_json_flatten,
    "snapshot_read": q_snapshot_read,
    "write_overwrite": q_write_overwrite,
    "write_append": q_write_append,
    "write_ignore": q_write_ignore,
    "write_error": q_write_error,
    "partitioned_write": q_partitioned_write,
    "partitioned_read": q_partitioned_read,
    "merge_residual": q_merge_residual,
    "merge_residual_shuffled": q_merge_residual_shuffled,
    "merge_grouped_terms": q_merge_grouped_terms,
    "merge_quoted_and": q_merge_quoted_and,
    "dedup_landing_order": q_dedup_landing_order,
    "envelope_drift": q_envelope_drift,
    "fact_history_raw": q_fact_history_raw,
    "fact_unseen": q_fact_unseen,
    "explode_chunked": q_explode_chunked,
    "merge_column_order": q_merge_column_order,
    "impute_nan": q_impute_nan,
    "parse_list_long": q_parse_list_long,
    "silver_child_rebuilt": q_silver_child_rebuilt,
    "merge_single_key": q_merge_single_key,
    "merge_composite_key": q_merge_composite_key,
    "merge_composite_shuffled": q_merge_composite_shuffled,
    "merge_hot_key": q_merge_hot_key,
    "merge_null_dup_keys": q_merge_null_dup_keys,
    "merge_create": q_merge_create,
    "select_cols": q_select_cols,
    "drop_cols": q_drop_cols,
    "rename_cols": q_rename_cols,
    "impute_nulls": q_impute_nulls,
    "cast_narrow": q_cast_narrow,
    "cast_timestamp": q_cast_timestamp,
    "cast_category": q_cast_category,
    "dedup_single": q_dedup_single,
    "dedup_composite": q_dedup_composite,
    "dedup_stored_order": q_dedup_stored_order,
    "parse_list": q_parse_list,
    "explode_list": q_explode_list,
    "explode_empty": q_explode_empty,
    "explode_chain": q_explode_chain,
    "capture_const": q_capture_const,
    "capture_col": q_capture_col,
    "bronze_dim": q_bronze_dim,
    "bronze_fact": q_bronze_fact,
    "silver_dim": q_silver_dim,
    "silver_child": q_silver_child,
    "silver_fact": q_silver_fact,
    "fact_history": q_fact_history,
    "full_run": q_full_run,
    "stream_merge": q_stream_merge,
    "stream_fact": q_stream_fact,
    "stream_dim": q_stream_dim,
}

_RESIDUAL = (
    "WITH t AS (SELECT * FROM customer WHERE c_nationkey < 15), "
    "s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END AS c_acctbal, "
    "c_mktsegment FROM customer) "
    "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t "
    "WHERE t.c_custkey = s.c_custkey AND t.c_acctbal BETWEEN s.c_acctbal AND s.c_acctbal + 5)"
)
_RAW_POSITION = (
    "CAST(user_id AS VARCHAR) AS VehicleID, value / 100.0 AS Lat, -value / 100.0 AS Lon, value AS Deviation, "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS DateTime, CAST(event_id AS VARCHAR) AS TripID, event_type AS RouteID, "
    "CAST(CASE WHEN value >= 0 THEN 0 ELSE 1 END AS BIGINT) AS DirectionNum, "
    "CASE WHEN value >= 0 THEN 'NORTH' ELSE 'SOUTH' END AS DirectionText, upper(event_type) AS TripHeadsign, "
    "strftime(ts, '%Y-%m-%dT%H:00:00') AS TripStartTime, strftime(ts, '%Y-%m-%dT%H:59:59') AS TripEndTime, "
    "NULLIF(event_type, 'error') AS BlockNumber"
)
_CHILD = "SELECT CAST(p_partkey AS INTEGER) AS StopID, unnest(string_split(p_name, ' ')) AS Routes FROM part"
_REFINED_POSITION = (
    "CAST(user_id AS SMALLINT) AS VehicleID, value / 100.0 AS Lat, -value / 100.0 AS Lon, value AS Deviation, "
    "ts AS DateTime, CAST(event_id AS INTEGER) AS TripID, event_type AS RouteID, "
    "CAST(CASE WHEN value >= 0 THEN 0 ELSE 1 END AS TINYINT) AS DirectionNum, "
    "CASE WHEN value >= 0 THEN 'NORTH' ELSE 'SOUTH' END AS DirectionText, upper(event_type) AS TripHeadsign, "
    "CAST(date_trunc('hour', ts) AS TIMESTAMP) AS TripStartTime, "
    "CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 3599 SECOND AS TripEndTime, "
    "COALESCE(NULLIF(event_type, 'error'), 'Null') AS BlockNumber"
)
_UNDER = (
    "WITH t AS (SELECT * FROM customer WHERE c_nationkey < 15), "
    "s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer) "
    "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey AND {})"
)
_FIRST_POSITION = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1"

ORACLE_SQL: dict[str, str] = {
    "envelope_ingest": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "envelope_documents": "SELECT * FROM orders",
    "envelope_nested": (
        "SELECT c_custkey, c_name AS who__name, c_nationkey AS who__nation__key, "
        "c_acctbal AS account__balance, c_mktsegment AS account__segment FROM customer"
    ),
    "json_flatten": "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events",
    "snapshot_read": "SELECT * FROM supplier",
    "write_overwrite": "SELECT * FROM customer WHERE c_acctbal > 0",
    "write_append": "SELECT * FROM supplier UNION ALL SELECT * FROM supplier",
    "write_ignore": "SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation",
    "write_error": "SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation",
    "partitioned_write": (
        "SELECT event_id, CAST(ts AS DATE) AS fecha_consulta, strftime(ts, '%H:00:00') AS hora_consulta "
        "FROM events"
    ),
    "partitioned_read": (
        "SELECT event_id, CAST(ts AS DATE) AS fecha_consulta, strftime(ts, '%H:00:00') AS hora_consulta "
        "FROM events WHERE strftime(ts, '%H:00:00') = '23:00:00'"
    ),
    "merge_residual": _RESIDUAL,
    "merge_residual_shuffled": _RESIDUAL,
    "merge_grouped_terms": _UNDER.format(
        "t.c_name = s.c_name AND t.c_nationkey < 10 AND NOT (t.c_mktsegment = 'BUILDING' AND t.c_acctbal < s.c_acctbal)"
    ),
    "merge_quoted_and": _UNDER.format("s.c_nationkey BETWEEN 3 AND 20"),
    "envelope_drift": (
        "SELECT CAST(p_partkey AS VARCHAR) AS StopID, p_name AS Name, "
        "CASE WHEN p_size <= 25 THEN '{\"Zone\":\"Z1\"}' END AS unknown FROM part"
    ),
    "dedup_landing_order": (
        "SELECT CAST(p_partkey AS VARCHAR) AS StopID, p_name AS Name, p_retailprice AS Lon, "
        "CAST(p_size AS DOUBLE) AS Lat, replace(p_name, ' ', '|') AS Routes FROM part"
    ),
    "merge_column_order": "SELECT * FROM supplier",
    "impute_nan": (
        "SELECT event_id, CASE WHEN value < 0 OR event_type = 'error' THEN 0.5::DOUBLE ELSE value END AS value FROM events"
    ),
    "parse_list_long": (
        "SELECT CAST(o_custkey AS VARCHAR) AS k, count(*) AS n_items, "
        "md5(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey)) AS items_md5 FROM orders GROUP BY 1 "
        "UNION ALL SELECT o_orderstatus, count(*), "
        "md5(string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY o_orderkey)) FROM orders GROUP BY 1 "
        "UNION ALL SELECT 'all', 1, md5(repeat(string_agg(n_name, '' ORDER BY n_name), 100)) FROM nation"
    ),
    "silver_child_rebuilt": _CHILD,
    "merge_single_key": (
        "WITH t AS (SELECT * FROM customer WHERE c_acctbal > 0), "
        "s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment FROM customer) "
        "SELECT * FROM t UNION ALL "
        "SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = s.c_custkey)"
    ),
    "merge_composite_key": (
        "WITH t AS (SELECT * FROM lineitem WHERE l_linenumber <= 3), "
        "s AS (SELECT * FROM lineitem WHERE l_linenumber >= 3) "
        "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS "
        "(SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)"
    ),
    "merge_composite_shuffled": (
        "WITH t AS (SELECT * FROM lineitem WHERE l_linenumber <= 3), "
        "s AS (SELECT * FROM lineitem WHERE l_linenumber >= 3) "
        "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS "
        "(SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)"
    ),
    "merge_hot_key": (
        "WITH t AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderstatus = 'F'), "
        "s AS (SELECT CASE WHEN l_linestatus = 'O' THEN -1 ELSE l_orderkey END AS k, l_returnflag AS v "
        "FROM lineitem) "
        "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)"
    ),
    "merge_null_dup_keys": (
        "WITH t AS (SELECT NULLIF(n_regionkey, 0) AS k, n_name FROM nation WHERE n_regionkey < 3), "
        "s AS (SELECT NULLIF(n_regionkey, 0) AS k, n_name FROM nation) "
        "SELECT * FROM t UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)"
    ),
    "merge_create": "SELECT * FROM part",
    "select_cols": "SELECT s_suppkey, s_name FROM supplier",
    "drop_cols": "SELECT s_suppkey, s_name, s_nationkey FROM supplier",
    "rename_cols": "SELECT s_suppkey, s_name AS stop_name, s_nationkey, s_acctbal FROM supplier",
    "impute_nulls": "SELECT event_id, COALESCE(NULLIF(event_type, 'error'), 'Null') AS event_type FROM events",
    "cast_narrow": (
        "SELECT CAST(CAST(p_partkey AS VARCHAR) AS INTEGER) AS p_partkey, "
        "CAST(CAST(p_size AS VARCHAR) AS SMALLINT) AS p_size, CAST(p_size AS TINYINT) AS p_size8 FROM part"
    ),
    "cast_timestamp": "SELECT event_id, CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS ts FROM events",
    "cast_category": "SELECT event_id, event_type FROM events",
    "dedup_single": f"SELECT * FROM events {_FIRST_POSITION}",
    "dedup_composite": (
        "SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
        "l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, "
        "l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, "
        "l_shipdate NULLS FIRST) = 1"
    ),
    "dedup_stored_order": "SELECT * FROM orders",
    "parse_list": (
        "SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS BIGINT) AS n_items, "
        "array_to_string(string_split(p_name, ' '), '|') AS items FROM part"
    ),
    "explode_list": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part",
    "explode_empty": "SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN NULL ELSE n_name END AS item FROM nation",
    "explode_chain": (
        "SELECT p_partkey, w.word, b.tag FROM part, "
        "unnest(string_split(p_name, ' ')) AS w(word), unnest([p_brand, p_type]) AS b(tag)"
    ),
    "capture_const": "SELECT o_orderkey, DATE '2025-01-01' AS fecha_consulta, '23:32:35' AS hora_consulta FROM orders",
    "capture_col": (
        "SELECT event_id, CAST(ts AS DATE) AS fecha_consulta, strftime(ts, '%H:%M:%S') AS hora_consulta FROM events"
    ),
    "bronze_dim": (
        "SELECT CAST(p_partkey AS VARCHAR) AS StopID, p_name AS Name, p_retailprice AS Lon, "
        "CAST(p_size AS DOUBLE) AS Lat, replace(p_name, ' ', '|') AS Routes FROM part "
        "UNION ALL "
        "SELECT '0' || CAST(p_partkey AS VARCHAR) AS StopID, upper(p_name) AS Name, p_retailprice + 1 AS Lon, "
        "CAST(p_size AS DOUBLE) AS Lat, replace(upper(p_name), ' ', '|') AS Routes FROM part WHERE p_size > 25"
    ),
    "bronze_fact": (
        f"SELECT {_RAW_POSITION}, DATE '2025-01-01' AS fecha_consulta, '23:32:35' AS hora_consulta FROM events"
    ),
    "silver_dim": (
        "SELECT CAST(p_partkey AS INTEGER) AS StopID, p_name AS Stop_Name, p_retailprice AS Lon, "
        "CAST(p_size AS DOUBLE) AS Lat FROM part"
    ),
    "silver_child": _CHILD,
    "silver_fact": f"SELECT {_REFINED_POSITION}, DATE '2025-01-01' AS fecha_consulta, '23:32:35' AS hora_consulta FROM events {_FIRST_POSITION}",
    "fact_history": f"SELECT {_REFINED_POSITION}, DATE '2025-01-02' AS fecha_consulta, '00:02:35' AS hora_consulta FROM events {_FIRST_POSITION}",
    "fact_history_raw": (
        f"SELECT {_RAW_POSITION}, DATE '2025-01-01' AS fecha_consulta, '23:32:35' AS hora_consulta FROM events WHERE event_type = 'view' "
        f"UNION ALL SELECT {_RAW_POSITION}, DATE '2025-01-02' AS fecha_consulta, '00:02:35' AS hora_consulta FROM events"
    ),
    "fact_unseen": " UNION ALL ".join(
        f"(SELECT {_REFINED_POSITION}, DATE '{date}' AS fecha_consulta, '{time}' AS hora_consulta FROM events WHERE {rows} {_FIRST_POSITION})"
        for rows, date, time in (
            ("event_type = 'view'", "2025-01-01", "23:32:35"),
            ("true", "2025-01-02", "00:02:35"),
            ("value < 0", "2025-01-02", "00:17:35"),
            ("event_type = 'error'", "2025-01-02", "00:32:35"),
        )
    ),
    "explode_chunked": "SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents WHERE text IS NOT NULL",
    "full_run": (
        "SELECT 'bronze_stops' AS table_name, CAST(p_partkey AS VARCHAR) AS k, p_name AS v, p_retailprice AS x FROM part "
        "UNION ALL SELECT 'bronze_positions', CAST(event_id AS VARCHAR), NULLIF(event_type, 'error'), value FROM events "
        "UNION ALL SELECT 'silver_stops', CAST(p_partkey AS VARCHAR), p_name, p_retailprice FROM part "
        "UNION ALL SELECT 'silver_positions', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR), value "
        f"FROM (SELECT * FROM events {_FIRST_POSITION}) "
        "UNION ALL SELECT 'silver_stops_Routes', CAST(p_partkey AS VARCHAR), unnest(string_split(p_name, ' ')), NULL FROM part"
    ),
    "stream_merge": "SELECT * FROM nation",
    "stream_dim": (
        "SELECT CAST(p_partkey AS INTEGER) AS StopID, p_name AS Stop_Name, p_retailprice AS Lon, "
        "CAST(p_size AS DOUBLE) AS Lat FROM part"
    ),
    "stream_fact": (
        f"SELECT {_RAW_POSITION}, "
        "CASE WHEN event_type = 'view' THEN DATE '2025-01-01' ELSE DATE '2025-01-02' END AS fecha_consulta, "
        "CASE WHEN event_type = 'view' THEN '23:32:35' ELSE '00:02:35' END AS hora_consulta FROM events"
    ),
}
