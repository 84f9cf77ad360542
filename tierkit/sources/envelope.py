"""Envelope ingest: landed JSON responses whose rows sit in one array field.

An API poller lands each response as a file, e.g. ``{"Rows": [{...}, ...]}``.
Ingest reads a whole landing directory with a declared schema and returns one
row per array element.  Bad JSON and a missing data field raise and name the
file, instead of giving nulls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Column of a row's landing place, and its parts: the landed file (when, which),
#: the stretch of the file a task read, the response there, the place in it.
LANDED = "_landed"
LANDED_TYPE = T.StructType(
    [
        T.StructField("at", T.TimestampType()),
        T.StructField("file", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("response", T.LongType()),
        T.StructField("place", T.IntegerType()),
    ]
)


def landing_place(place: Column, response: Column | None = None) -> Column:
    """Where a row landed, as one value that sorts in landing order.

    All of it is the landed file's own, so it is the same however often, and with
    whatever tasks, the file is ingested; the order of two rows never changes.
    ``response`` numbers the responses that a task reads, in order."""
    parts = (
        F.col("_metadata.file_modification_time").cast("timestamp"),
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start").cast("long"),
        F.lit(0).cast("long") if response is None else response,
        place.cast("int"),
    )
    return F.struct(*[c.alias(f.name) for c, f in zip(parts, LANDED_TYPE.fields)])


def envelope_schema(data_field: str, record_schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(data_field, T.ArrayType(record_schema, True), True)])


def required_rows(data_field: str, record_schema: T.StructType) -> Column:
    """The data field as an array column; a response without it raises, naming its file."""
    arr_type = T.ArrayType(record_schema, True)
    msg = F.concat(F.lit(f"response has no array field '{data_field}': "), F.col("_metadata.file_path"))
    return F.coalesce(F.col(data_field), F.raise_error(msg).cast(arr_type))


#: What to do with fields that the record schema does not declare, and the column
#: that holds them when they are kept.
UNKNOWN_FIELDS = ("fail", "keep", "ignore")
UNKNOWN = "_unknown"


def read_envelopes(
    spark: SparkSession,
    path: str,
    data_field: str,
    record_schema: T.StructType,
    multi_line: bool = True,
    stream: bool = False,
    unknown_fields: str = "ignore",
    **options: str,
) -> DataFrame:
    """The raw envelope frame (one row per response), batch or streaming.

    Records with fields that ``record_schema`` lacks are refused (``"fail"``, names
    them and their file), or keep those in ``UNKNOWN``, JSON text by name, null if
    there are none (``"keep"``); either parses the text a second time, for names.
    ``"ignore"`` drops them.  Only a record's own fields are looked at, not those
    of objects inside it.
    """
    if unknown_fields not in UNKNOWN_FIELDS:
        raise ValueError(f"unknown_fields must be one of {UNKNOWN_FIELDS}, got {unknown_fields!r}")
    reader = spark.readStream if stream else spark.read
    schema = envelope_schema(data_field, record_schema)
    if unknown_fields == "ignore":
        reader = reader.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST")
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.json(path)
    for k, v in options.items():
        reader = reader.option(k, v)
    raw = reader.text(path, wholetext=multi_line).where(F.col("value").rlike(r"\S"))  # the JSON reader passes over blank lines too
    names = T.StructType([T.StructField(data_field, T.ArrayType(T.MapType(T.StringType(), T.StringType())))])
    field = f"`{data_field}`"
    # A text that does not parse under the schema comes back here, so the error can name its file.
    bad = T.StructField("__bad", T.StringType())
    whole = F.from_json("value", T.StructType([*schema.fields, bad]), {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad.name})
    parsed = raw.select(whole.alias("__whole"), F.from_json("value", names, options).getField(data_field).alias("__names"), F.col("_metadata"))
    malformed = F.concat(F.lit("not a response of the declared schema: "), F.col("_metadata.file_path"))
    rows = F.when(F.col("__whole.__bad").isNotNull(), F.raise_error(malformed).cast(T.ArrayType(record_schema, True)))
    parsed = parsed.select(rows.otherwise(F.col("__whole").getField(data_field)).alias(data_field), "__names", "_metadata")
    declared = F.array(*[F.lit(f.name) for f in record_schema.fields])
    others = F.transform("__names", lambda m: F.map_filter(m, lambda k, _: ~F.array_contains(declared, k)))
    if unknown_fields == "fail":
        found = F.array_distinct(F.flatten(F.transform(F.filter(others, lambda m: m.isNotNull()), lambda m: F.map_keys(m))))
        told = F.concat(F.lit("records have undeclared fields "), F.array_join(found, ", "), F.lit(": "), F.col("_metadata.file_path"))
        checked = F.when(F.size(found) > 0, F.raise_error(told).cast(T.ArrayType(record_schema, True))).otherwise(F.col(field))
        return parsed.select(checked.alias(data_field), "_metadata")
    kept = F.zip_with(
        F.col(field),
        others,
        lambda r, m: F.when(r.isNotNull(), F.struct(*[r.getField(f.name).alias(f.name) for f in record_schema.fields], F.when(F.size(m) > 0, F.to_json(m)).alias(UNKNOWN))),
    )
    return parsed.select(kept.alias(data_field), "_metadata")


def infer_record_schema(
    spark: SparkSession, path: str, data_field: str, multi_line: bool = True, sampling_ratio: float = 1.0
) -> T.StructType:
    """Record schema learned from the landed responses (an extra pass over
    them, or over a share of them with ``sampling_ratio``)."""
    envelope = (
        spark.read.option("multiLine", multi_line).option("samplingRatio", str(sampling_ratio)).json(path).schema
    )
    if data_field not in envelope.names:
        raise ValueError(f"no response under {path} has the field '{data_field}'")
    field = envelope[data_field].dataType
    if not (isinstance(field, T.ArrayType) and isinstance(field.elementType, T.StructType)):
        raise ValueError(f"field '{data_field}' is {field.simpleString()}, not a list of records")
    return field.elementType


def ingest_envelope(
    spark: SparkSession,
    path: str,
    data_field: str,
    record_schema: T.StructType | None,
    multi_line: bool = True,
    infer_schema: bool = False,
    order_col: str | None = None,
    unknown_fields: str = "fail",
    **options: str,
) -> DataFrame:
    """One row per element of ``data_field`` across all responses under ``path``.

    ``multi_line=True`` reads one (possibly pretty-printed) document per file;
    such files are not splittable, so parallelism comes from the file count.
    ``multi_line=False`` reads JSON lines (one response per line), which Spark
    splits freely.  Nested objects stay structs (see ``flatten``).

    The record schema is declared; ``infer_schema=True`` (with
    ``record_schema=None``) learns it from the files instead, at the cost of
    one more pass over them.  ``order_col`` names a column for each row's landing
    place (see ``landing_place``), to be stored with it.  ``unknown_fields`` says
    what becomes of fields outside the schema (see ``read_envelopes``): by default
    they are refused, not dropped without a word.
    """
    if record_schema is None:
        if not infer_schema:
            raise ValueError("pass record_schema, or infer_schema=True to learn it from the files")
        record_schema = infer_record_schema(spark, path, data_field, multi_line)
    raw = read_envelopes(spark, path, data_field, record_schema, multi_line=multi_line, unknown_fields=unknown_fields, **options)
    if unknown_fields == "keep":
        record_schema = T.StructType([*record_schema.fields, T.StructField(UNKNOWN, T.StringType(), True)])
    rows = required_rows(data_field, record_schema)
    if order_col is None:
        return raw.select(F.inline(rows))
    # Such an id rises with the rows of a task, and a task reads a file's stretch in order.
    at = raw.select("*", F.monotonically_increasing_id().alias("__response"), F.col("_metadata"), F.posexplode(rows).alias("__place", "__row"))
    fields = [F.col("__row").getField(f.name).alias(f.name) for f in record_schema.fields]
    return at.select(*fields, landing_place(F.col("__place"), F.col("__response")).alias(order_col))


def write_envelopes(
    df: DataFrame,
    path: str,
    data_field: str,
    rows_per_response: int = 1000,
    file_per_response: bool = False,
) -> None:
    """Land ``df`` as responses ``{data_field: [rows...]}``.

    The landing side of an ingest: rows are packed into responses of at most
    ``rows_per_response`` consecutive rows of one input partition, so no
    response (group) grows with the data.  By default responses are written
    as JSON lines; ``file_per_response=True`` writes each response as its own
    file (one directory per response), as an API poller lands them.
    """
    if rows_per_response < 1:
        raise ValueError("rows_per_response must be positive")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    chunk = F.floor(F.monotonically_increasing_id() / F.lit(rows_per_response))
    packed = (
        df.select(chunk.alias("__response"), row.alias("__row"))
        .groupBy("__response")
        .agg(F.collect_list("__row").alias(data_field))
    )
    if file_per_response:
        packed.write.mode("errorifexists").partitionBy("__response").json(path)
    else:
        packed.select(data_field).write.mode("errorifexists").json(path)
