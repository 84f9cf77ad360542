"""Cut lineage through Parquet tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierkit.session import scratch_path

#: Spark drops a write's shuffle files when the write ends, not when the driver
#: next collects garbage; nothing reads them again once the table is there.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Bytes of a batch that Spark hands to a Python worker.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep(df: DataFrame, label: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` under the session's checkpoint folder and read it back.

    The table outlives lost executors, and a retried task reads the same rows,
    which a recomputed plan would not promise.  ``batch_bytes`` bounds the Arrow
    batches of this write, for rows that hold whole texts.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    during = {_DROP_SHUFFLES: "true"}
    if batch_bytes is not None:
        during[_BATCH_BYTES] = str(batch_bytes)
    before = {name: spark.conf.get(name, None) for name in during}
    for name, value in during.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete the files of kept tables that no plan to come will read."""
    for table in tables:
        spark = table.sparkSession
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
