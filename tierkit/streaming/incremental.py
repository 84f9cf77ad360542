"""Incremental ingest of landed response files (Structured Streaming).

A file-source stream over the landing directory remembers (in its
checkpoint) which files it has seen, so each run with the ``availableNow``
trigger takes exactly the files landed since the previous run.

* ``incremental_merge`` (dimension feeds): each micro-batch keeps the first
  row per key — in landing order: file write time, file, position in the
  response — and insert-only merges it into the target.  ``foreachBatch`` is
  at-least-once; a replayed batch is harmless because the merge on non-null
  keys inserts nothing twice.
* ``incremental_append`` (fact feeds): rows are stamped with the run's
  capture and appended, partitioned, through the Parquet file sink, whose
  metadata log commits every file exactly once.  That table is written by
  the stream only; batch readers see committed files only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.operators.clean import dedup_first
from tierkit.operators.nested import flatten
from tierkit.operators._names import quote
from tierkit.operators.merge import merge_insert_only
from tierkit.operators.stamp import DATE_COL, TIME_COL, stamp_capture
from tierkit.sources.envelope import LANDED, landing_place, read_envelopes, required_rows

_ORDER = ["__landed"]

# A backlog is drained in batches of at most this many landed files, so a
# micro-batch (which the merge keeps in memory/disk) stays bounded.
MAX_FILES_PER_TRIGGER = 1000


def landed_rows(
    spark: SparkSession,
    landing: str,
    data_field: str,
    record_schema: T.StructType,
    multi_line: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame of response rows with their landing order."""
    options = {} if max_files_per_trigger is None else {"maxFilesPerTrigger": str(max_files_per_trigger)}
    raw = read_envelopes(spark, landing, data_field, record_schema, multi_line=multi_line, stream=True, unknown_fields="fail", **options)
    exploded = raw.select("_metadata", F.posexplode(required_rows(data_field, record_schema)).alias("__pos", "__row"))
    return exploded.select(landing_place(F.col("__pos")).alias("__landed"), *[F.col("__row").getField(f.name).alias(f.name) for f in record_schema.fields])


def incremental_merge(
    spark: SparkSession,
    landing: str,
    data_field: str,
    record_schema: T.StructType,
    target: str,
    key: str | Sequence[str],
    checkpoint: str,
    multi_line: bool = True,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    partition_cols: str | Sequence[str] | None = None,
    flatten_sep: str | None = None,
    target_schema: T.StructType | None = None,
) -> None:
    """Merge every response landed since the last run into ``target``.

    Runs with the ``availableNow`` trigger: all new files, in bounded
    batches, then stop.  Run it again later to pick up newer files.  With
    ``flatten_sep`` nested records are flattened first (as the batch raw
    layer does); ``target_schema`` is the table's schema (default: the
    records').
    """
    keys = [key] if isinstance(key, str) else list(key)
    # <=>: a null key is one key, as in keep-first, so what is inserted does not
    # depend on how the files are dealt to batches, nor on a replayed batch.
    predicate = " AND ".join(f"target.{quote(k)} <=> source.{quote(k)}" for k in keys)
    stream = landed_rows(spark, landing, data_field, record_schema, multi_line, max_files_per_trigger)

    schema = target_schema if target_schema is not None else record_schema

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        # The merge runs two jobs over the batch (size check, then the write);
        # keep the de-duplicated batch — bounded by max_files_per_trigger —
        # instead of parsing its files twice.
        rows = dedup_first(batch, keys, _ORDER).withColumnRenamed("__landed", LANDED)
        if flatten_sep is not None:
            rows = flatten(rows, flatten_sep, keep=(LANDED,))
        if LANDED not in schema.names:
            rows = rows.drop(LANDED)
        first = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            merge_insert_only(batch.sparkSession, first, target, predicate, schema=schema, partition_cols=partition_cols, compact=False)
        finally:
            first.unpersist()

    query = (
        stream.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def incremental_append(
    spark: SparkSession,
    landing: str,
    data_field: str,
    record_schema: T.StructType,
    target: str,
    checkpoint: str,
    capture_ts: dt.datetime | str | None = None,
    partition_cols: Sequence[str] = (DATE_COL, TIME_COL),
    multi_line: bool = True,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
) -> None:
    """Append every response landed since the last run, stamped with this
    run's capture (``capture_ts``, default: now) and partitioned by it."""
    ts = dt.datetime.now().replace(microsecond=0) if capture_ts is None else capture_ts
    options = {} if max_files_per_trigger is None else {"maxFilesPerTrigger": str(max_files_per_trigger)}
    raw = read_envelopes(spark, landing, data_field, record_schema, multi_line=multi_line, stream=True, unknown_fields="fail", **options)
    rows = stamp_capture(raw.select(F.inline(required_rows(data_field, record_schema))), ts)
    query = (
        rows.writeStream.format("parquet")
        .partitionBy(*partition_cols)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
