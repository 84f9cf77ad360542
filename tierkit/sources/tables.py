"""Table directories: snapshot read, write with a save mode, partitioned write.

A table is a directory of Parquet files (optionally ``col=value``
partitioned).  Reads always take a declared schema: partition values such as
``23%3A32%3A35`` would otherwise be inferred as a TIME type.
"""

from __future__ import annotations

from collections.abc import Sequence

import time

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.sources.commit import Beside, publish, readable, staged, writer

SAVE_MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


class TableNotFound(LookupError):
    """The table directory does not exist."""


def _is_not_found(err: AnalysisException) -> bool:
    cond = err.getCondition() if hasattr(err, "getCondition") else None
    return cond == "PATH_NOT_FOUND" or (cond is None and "Path does not exist" in str(err))


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None, fmt: str = "parquet") -> DataFrame:
    """Latest snapshot of the table at ``path``, all columns; a finished write
    that is still being moved in (see ``commit``) counts.

    Raises :class:`TableNotFound` if the directory is absent; other errors
    propagate unchanged.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    at = readable(spark, path)
    try:
        return reader.load(path if at == [path] else at)
    except AnalysisException as err:
        if _is_not_found(err):
            raise TableNotFound(path) from err
        raise


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True if ``path`` holds a table (an existing directory)."""
    try:
        # A text reader lists files only; it never needs a schema.
        spark.read.format("text").load(readable(spark, path)[0])
        return True
    except AnalysisException as err:
        if _is_not_found(err):
            return False
        raise


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as the file system names it: with scheme, decoded, absolute."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(hadoop).toString()


def _scan_roots(df: DataFrame) -> list[str]:
    """Root folders and files that the analyzed plan reads, subqueries included.

    The analyzed plan still shows the files behind a cached frame, and naming
    roots does not list the files below them."""
    plan = df._jdf.queryExecution().analyzed()
    below = plan.subqueriesAll()
    out = []
    for p in [plan, *(below.apply(i) for i in range(below.size()))]:
        leaves = p.collectLeaves()
        for leaf in (leaves.apply(i) for i in range(leaves.size())):
            if leaf.getClass().getSimpleName() != "LogicalRelation":
                continue
            relation = leaf.relation()
            if relation.getClass().getSimpleName() == "HadoopFsRelation":
                roots = relation.location().rootPaths()
                out += [roots.apply(i).toString() for i in range(roots.size())]
    return out


# Plan nodes that read and narrow columns, row by row.
_NARROW = {"Project", "Filter", "SubqueryAlias", "Union", "LogicalRelation"}


def scans_columns(df: DataFrame) -> bool:
    """True if ``df`` does no more than read, filter and compute columns of Parquet
    or ORC files, so that reading a few of its columns again is cheap."""
    below = [df._jdf.queryExecution().analyzed()]
    while below:
        node = below.pop()
        if node.getClass().getSimpleName() not in _NARROW:
            return False
        if node.getClass().getSimpleName() == "LogicalRelation":
            relation = node.relation()
            if relation.getClass().getSimpleName() != "HadoopFsRelation":
                return False
            if relation.fileFormat().getClass().getSimpleName() not in ("ParquetFileFormat", "OrcFileFormat"):
                return False
        children = node.children()
        below += [children.apply(i) for i in range(children.size())]
    return True


def reads_from(df: DataFrame, path: str) -> bool:
    """True if the plan of ``df`` reads ``path``, something under it, or a
    folder that holds it."""
    target = _qualified(df.sparkSession, path)
    for root in _scan_roots(df):
        root = _qualified(df.sparkSession, root)
        if root == target or root.startswith(target + "/") or target.startswith(root.rstrip("/") + "/"):
            return True
    return False


def written_by_stream(spark: SparkSession, path: str) -> bool:
    """True if a file sink keeps its log in ``path``: readers then see only the
    files that the log names, and a batch write would vanish."""
    log = spark._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata")
    return bool(log.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(log))


def partition_values(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> set[tuple[str | None, ...]]:
    """The partitions that the table holds, as text, from its folder names alone:
    no file is opened.  A publish under way counts (see ``readable``); an absent
    table has none.  A folder without a file in it, as a failed write may leave
    behind, is no partition.  Columns in the order of the folders."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    none = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.DEFAULT_PARTITION_NAME()
    out: set[tuple[str | None, ...]] = set()
    for root in readable(spark, path):
        beside = Beside(spark, root)
        names = "/".join(f"{c}=*" for c in partition_cols)
        for status in beside.fs.globStatus(beside.child(beside.table, f"{names}/[!._]*")) or ():
            folder = status.getPath().getParent()
            values: list[str | None] = []
            for _ in partition_cols:
                text = unescape(folder.getName().split("=", 1)[1])
                values.insert(0, None if text == none else text)
                folder = folder.getParent()
            out.add(tuple(values))
    return out


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _aqe_on(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").strip().lower() == "true"


def _rows_written(spark: SparkSession, seen: Observation, folder: str, fmt: str, schema: T.StructType) -> int:
    """What the write counted; if its plan had no place to count, as one that turned
    out to be empty when it ran, the files say."""
    for _ in range(20):
        try:
            told = seen._jo.getOrEmpty()
        except Py4JJavaError:  # the place to count was dropped: a result without columns
            break
        if told.contains("rows"):
            return int(told.apply("rows"))
        time.sleep(0.05)
    return spark.read.format(fmt).schema(schema).load(folder).count()


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_cols: str | Sequence[str] | None = None,
    fmt: str = "parquet",
    rebalance: bool = True,
    compact: bool = False,
    held: Beside | None = None,
) -> int:
    """Write ``df`` to ``path`` with a save mode, optionally partitioned; returns
    the rows written, counted on the way.

    * ``overwrite`` replaces the whole table (static overwrite, whatever the
      session's partition-overwrite setting), ``append`` adds files,
      ``error`` raises if the table exists, ``ignore`` does nothing then.
    * Rows are written beside the table and moved in when all are there, so a
      write that fails leaves the table as it was; one that dies while moving is
      finished by whoever writes next, and read right until then.  An append of
      no row adds no file.
    * A table has one writer at a time; a second is refused (``commit.writer``).
      ``held`` is the caller's hold on it, if it has one.
    * Overwriting a table the plan itself reads is refused up front.
    * A partitioned write first rebalances on the partition columns, so each
      partition value lands in few, evenly sized files; AQE splits a hot value
      (one capture is one value) over many tasks instead of one.
    * ``compact=True`` rebalances an unpartitioned write the same way (one
      extra shuffle of the written rows), by bytes: meant for frequent appends.
    * A table that a stream's file sink writes is refused: its readers would
      not see the files.
    """
    mode = mode.lower()
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}, got {mode!r}")
    parts = _as_list(partition_cols)
    missing = [c for c in parts if c not in df.columns]
    if missing:
        raise KeyError(f"partition columns not in the data: {missing}")
    if written_by_stream(df.sparkSession, path):
        raise ValueError(f"refusing to write {path}: a stream's file sink writes this table")
    if mode == "overwrite" and reads_from(df, path):
        raise ValueError(f"refusing to overwrite {path}: the plan reads from it")
    if held is None:
        with writer(df.sparkSession, path) as held:
            return write_table(df, path, mode, partition_cols, fmt, rebalance, compact, held)
    there = held.fs.exists(held.table)
    if there and mode == "ignore":
        return 0
    if there and mode in ("error", "errorifexists"):
        df.write.format(fmt).mode(mode).save(path)  # raises as Spark does
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if parts and rebalance and _aqe_on(df):
        # Without AQE a rebalance is a plain hash repartition on the partition
        # columns, which would put one capture in one task: keep the input's
        # partitioning instead.
        df = df.hint("rebalance", *parts)
    elif compact and not parts and _aqe_on(df):
        # Small, frequent appends: let AQE pack the rows into few files of the
        # advisory size instead of one file per input partition.
        df = df.hint("rebalance")
    folder = staged(held)
    writing = df.write.format(fmt).mode("errorifexists")
    if parts:
        writing = writing.partitionBy(*parts)
    try:
        writing.save(folder)
        rows = _rows_written(df.sparkSession, seen, folder, fmt, df.schema)
    except BaseException:
        held.fs.delete(held.path(folder), True)
        raise
    if rows == 0 and there and mode == "append":
        held.fs.delete(held.path(folder), True)
    else:
        publish(held, folder, replace=mode == "overwrite" or not there)
    return rows
