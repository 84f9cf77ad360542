"""Insert-only merge: append the source rows no target row matches.

This is ``MERGE INTO target USING source ON <condition> WHEN NOT MATCHED THEN
INSERT *`` with no update and no delete clause, built as a left anti join and
a Parquet append:

* matched target rows are never updated, absent ones never deleted;
* duplicates inside the source are all inserted;
* with ``=`` a null key never matches, so such a row is inserted on every
  run; ``<=>`` treats nulls as equal;
* an absent target is created from the whole source (no de-duplication).

Plan.  One scan of the source's keys sums their bytes and sketches the frequent
ones.  Of the target only the keys are read, and what other terms of the
condition name.  When the source keys' bytes are within the session's bound, the
target is never shuffled: its keys are semi-joined against the broadcast source
keys, and the hits (no more than the source keys) are broadcast back into the
anti join.  Otherwise both sides shuffle: target rows first pass a bitmap of the
source's key hashes, when that fits the bound, and rows of hot keys are dealt over
several tasks.  Inserted rows are counted as they are written; none, no file.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.operators._names import q, quote
from tierkit.operators.membership import hashes_alike, key_filter, possible_rows
from tierkit.operators.predicate import SOURCE_ALIAS, TARGET_ALIAS, KeyPair, MergePredicate, parse_predicate
from tierkit.sources.commit import writer
from tierkit.sources.tables import TableNotFound, read_table, scans_columns, write_table

#: Bytes of a membership filter when the session broadcasts nothing by itself.
FILTER_BYTES = 8 << 20


def merge_keys(predicate: str | Sequence[str] | Sequence[tuple[str, str]], spark: SparkSession | None = None) -> list[KeyPair]:
    """Key pairs of a predicate of equalities alone (see ``parse_predicate``)."""
    asked = parse_predicate(spark or SparkSession.active(), predicate)
    if asked.condition is not None:
        raise ValueError(f"unsupported merge predicate {predicate!r}: only equalities can stand here")
    return asked.keys


def _eq(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


# Bytes per value of fixed-width key types.
_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _width(c: Column, dtype: T.DataType) -> Column | None:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    for cls, n in _WIDTH.items():
        if isinstance(dtype, cls):
            return F.lit(n)
    return None


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast bound in bytes (``spark.sql.autoBroadcastJoinThreshold``)."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    m = re.match(r"^(-?\d+)\s*([a-z]*)$", raw)
    if not m:
        return 10 << 20
    return int(m.group(1)) * units.get(m.group(2) or "b", 1)


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


# Fixed value: about what a hashed relation adds to a row's values (row header,
# pointer, slot of the table), so the sum bounds the broadcast, not the values.
ROW_BYTES = 40


def source_key_stats(source: DataFrame, keys: Sequence[KeyPair]) -> tuple[int | None, int]:
    """(bytes of the source's key columns, rows) in one scan, no shuffle.

    The bytes are those of the values and, per row, of the row that a broadcast
    relation keeps (``ROW_BYTES``); ``None`` if a key type has no known width.
    """
    stats = _key_stats(source, keys, None)
    return stats.n_bytes, stats.rows


class KeyStats(NamedTuple):
    """Of a source: key bytes as broadcast, rows, and hashes of keys that may be
    hot with an estimate of their rows."""

    n_bytes: int | None
    widest: int
    rows: int
    hot: list[tuple[int, int]]


def _shuffle_partitions(spark: SparkSession) -> int:
    raw = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return int(raw) if raw.isdigit() and int(raw) > 0 else 200


#: Counters that the sketch of frequent keys keeps per shuffle partition, within
#: Spark's bound; it finds every key of more rows than the rows by a third of them.
SKETCH_PER_PARTITION, SKETCH_MOST = 16, 1_000_000


def _key_hash(source: DataFrame, keys: Sequence[KeyPair]) -> Column:
    return F.xxhash64(*[q(k.source) for k in keys])


def _key_stats(source: DataFrame, keys: Sequence[KeyPair], partitions: int | None) -> KeyStats:
    """One scan without a shuffle of rows: sums, and for ``partitions`` a mergeable
    sketch of the key hashes with more rows than an average task should hold.
    Its size follows the partitions; a hash that is hot only by collision or
    estimate does no harm, since hot keys are dealt otherwise, not differently."""
    widths = [_width(q(k.source), source.schema[k.source].dataType) for k in keys]
    known = all(w is not None for w in widths)
    row = [(sum(widths, F.lit(ROW_BYTES)) if known else F.lit(0)).alias("w")]
    sums = [F.coalesce(F.sum("w"), F.lit(0)).alias("b"), F.coalesce(F.max("w"), F.lit(0)).alias("most"), F.count(F.lit(1)).alias("n")]
    if partitions is not None:
        counters = min(SKETCH_MOST, max(1024, SKETCH_PER_PARTITION * partitions))
        row.append(_key_hash(source, keys).alias("h"))
        sums.append(F.expr(f"approx_top_k(h, {min(partitions, counters)}, {counters})").alias("top"))
    found = source.select(*row).agg(*sums).first()
    hot = []
    if partitions is not None and found["n"]:
        limit = max(1, int(found["n"]) // partitions)
        hot = [(int(x["item"]), int(x["count"])) for x in found["top"] if x["count"] > limit]
    return KeyStats(int(found["b"]) if known else None, int(found["most"]), int(found["n"]), hot)


def _hot_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Some sixteen bytes a hot key, of which there are no more than shuffle
    partitions: bounded, so broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema).coalesce(1))


def _in_place(source: DataFrame, target: DataFrame, keys: Sequence[KeyPair], stats: KeyStats) -> DataFrame:
    """Shuffled anti join whose hot source keys never reach the shuffle.

    The hot keys that the target holds are looked up by hash, and broadcast; the
    caller has checked their bytes.  Rows of hot keys are kept or dropped where
    they are read, all other rows take the shuffled join.
    """
    hot = _hot_table(source.sparkSession, [(h,) for h, _ in stats.hot], "__h0 long")
    theirs = target.withColumn("__hash", F.xxhash64(*[F.col(f"__t{i}") for i in range(len(keys))]))
    held = theirs.join(hot, F.col("__hash") == F.col("__h0"), "left_semi").drop("__hash").toDF(*[f"__m{i}" for i in range(len(keys))])
    marked = source.withColumn("__hash", _key_hash(source, keys))
    is_hot = F.col("__hash") == F.col("__h0")

    def on(side: str) -> Column:
        return _all([_eq(q(k.source), F.col(f"{side}{i}"), k.null_safe) for i, k in enumerate(keys)])

    stay = marked.join(hot, is_hot, "left_semi").join(F.broadcast(held), on("__m"), "left_anti")
    move = marked.join(hot, is_hot, "left_anti").join(target, on("__t"), "left_anti")
    return stay.union(move).drop("__hash")


#: Lots of a hot key for each task that its rows fill, so that hashing spreads them.
LOTS_PER_TASK = 4


def _by_lots(source: DataFrame, target: DataFrame, keys: Sequence[KeyPair], match: Column, stats: KeyStats, partitions: int) -> DataFrame:
    """Shuffled anti join whose hot source keys are dealt over several tasks.

    A hot key's rows get one of several lots, and the target's rows of that key
    are copied to each lot, so every source row still meets all of them.
    ``target`` holds distinct rows, its keys in ``__t0``, ``__t1`` and so on;
    ``match`` is the condition on the two sides.
    """
    if not stats.hot:
        return source.alias(SOURCE_ALIAS).join(target.alias(TARGET_ALIAS), match, "left_anti")
    limit = max(1, stats.rows // partitions)
    lots = _hot_table(source.sparkSession, [(h, LOTS_PER_TASK * min(partitions, -(-n // limit))) for h, n in stats.hot], "__hot long, __lots int")
    # Equal rows get different lots too, by their place in the source's tasks.
    order = F.xxhash64(*[q(c) for c in source.columns if _hashable(source.schema[c].dataType)], F.monotonically_increasing_id())
    marked = source.withColumn("__hash", _key_hash(source, keys)).join(lots, F.col("__hash") == F.col("__hot"), "left")
    marked = marked.withColumn("__lot", F.coalesce(F.pmod(order, F.col("__lots")), F.lit(0)).cast("int")).drop("__hash", "__hot", "__lots")
    theirs = F.xxhash64(*[F.col(f"__t{i}") for i in range(len(keys))])
    copied = target.withColumn("__hash", theirs).join(lots, F.col("__hash") == F.col("__hot"), "left")
    copied = copied.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__lots") - 1, F.lit(0)))))
    copied = copied.drop("__hash", "__hot", "__lots")
    joined = marked.alias(SOURCE_ALIAS).join(copied.alias(TARGET_ALIAS), match & (F.col("__lot") == F.col("__copy")), "left_anti")
    return joined.drop("__lot")


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType) or dtype.typeName() == "variant":
        return False
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return True


def _same_types(source: DataFrame, target: DataFrame, keys: Sequence[KeyPair]) -> bool:
    return hashes_alike([source.schema[k.source].dataType for k in keys], [target.schema[k.target].dataType for k in keys])


def _plan_new_rows(
    source: DataFrame,
    target: DataFrame,
    asked: MergePredicate,
    broadcast_max_bytes: int | None,
) -> tuple[DataFrame, KeyStats]:
    """The anti-join plan, and what the scan of the source's keys found."""
    spark = source.sparkSession
    keys = asked.keys
    limit = broadcast_limit(spark) if broadcast_max_bytes is None else broadcast_max_bytes
    partitions = _shuffle_partitions(spark)
    alike = _same_types(source, target, keys)
    stats = _key_stats(source, keys, partitions if alike else None)
    small = limit > 0 and stats.n_bytes is not None and stats.n_bytes <= limit
    s_keys = source.select(*[q(k.source).alias(f"__s{i}") for i, k in enumerate(keys)])
    named = [q(k.target).alias(f"__t{i}") for i, k in enumerate(keys)]
    # Of the target, only its keys and what the condition reads of it.
    resolved = {c.lower(): c for c in target.columns}
    read = [] if asked.condition is None else [resolved[c.lower()] for c in asked.target_columns if c.lower() in resolved]
    theirs = target.select(*named, *[q(c) for c in dict.fromkeys(read)])
    if small:
        # The target is only scanned: its rows of the (measured) source keys.
        semi = _all([_eq(F.col(f"__t{i}"), F.col(f"__s{i}"), k.null_safe) for i, k in enumerate(keys)])
        theirs = theirs.join(F.broadcast(s_keys), semi, "left_semi")
    elif alike:
        # More source keys than can be broadcast, but perhaps not than bits for them:
        # target rows whose key the source surely lacks stay out of the shuffle.
        of = key_filter(s_keys, s_keys.columns, stats.rows, limit if limit > 0 else FILTER_BYTES)
        if of is not None:
            theirs = possible_rows(theirs, [f"__t{i}" for i in range(len(keys))], of)
    if all(_hashable(f.dataType) for f in theirs.schema.fields):
        theirs = theirs.distinct()
    equal = _all([_eq(F.col(f"{SOURCE_ALIAS}.{quote(k.source)}"), F.col(f"{TARGET_ALIAS}.__t{i}"), k.null_safe) for i, k in enumerate(keys)])
    match = equal if asked.condition is None else equal & F.expr(asked.condition)
    if small and asked.condition is None:
        # No more hits than source keys, so they go back to the source's own tasks.
        theirs = F.broadcast(theirs)
    if small or not alike:
        return source.alias(SOURCE_ALIAS).join(theirs.alias(TARGET_ALIAS), match, "left_anti"), stats
    if stats.hot and asked.condition is None and len(stats.hot) * stats.widest <= (limit if limit > 0 else FILTER_BYTES):
        return _in_place(source, theirs, keys, stats), stats
    return _by_lots(source, theirs, keys, match, stats, partitions), stats


def new_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[KeyPair],
    broadcast_max_bytes: int | None = None,
) -> DataFrame:
    """Rows of ``source`` that no ``target`` row matches on ``keys``."""
    return _plan_new_rows(source, target, MergePredicate(list(keys), None, [k.target for k in keys]), broadcast_max_bytes)[0]


def _check_schema(source: DataFrame, target_schema: T.StructType) -> DataFrame:
    s_names, t_names = set(source.columns), set(target_schema.names)
    if s_names != t_names:
        raise ValueError(
            f"source and target columns differ: only in source {sorted(s_names - t_names)}, "
            f"only in target {sorted(t_names - s_names)}"
        )
    s_types = dict((f.name, f.dataType) for f in source.schema.fields)
    wrong = [
        f"{f.name}: {s_types[f.name].simpleString()} vs {f.dataType.simpleString()}"
        for f in target_schema.fields
        if s_types[f.name].simpleString() != f.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"source and target column types differ: {wrong}")
    return source.select(*[q(c) for c in target_schema.names])


def _check_stored(spark: SparkSession, path: str, declared: T.StructType, parts: Sequence[str]) -> bool:
    """True if a table stands at ``path``; its files' schema must agree with
    the declared one (partition values carry no type of their own)."""
    try:
        stored = read_table(spark, path, None).schema
    except TableNotFound:
        return False
    except AnalysisException as err:
        if err.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            raise
        return True
    s_names, t_names = set(declared.names), set(stored.names)
    if s_names != t_names:
        raise ValueError(
            f"source and target columns differ: only in source {sorted(s_names - t_names)}, "
            f"only in target {sorted(t_names - s_names)}"
        )
    wrong = [
        f"{f.name}: {f.dataType.simpleString()} vs {stored[f.name].dataType.simpleString()}"
        for f in declared.fields
        if f.name not in parts and f.dataType.simpleString() != stored[f.name].dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"source and target column types differ: {wrong}")
    return True


class MergeCounts(NamedTuple):
    """Rows of the source, of them matched by the target, and inserted."""

    read: int
    matched: int
    inserted: int


def merge_insert_only(
    spark: SparkSession,
    new_df: DataFrame,
    path: str,
    predicate: str | Sequence[str] | Sequence[tuple[str, str]],
    schema: T.StructType | None = None,
    partition_cols: str | Sequence[str] | None = None,
    broadcast_max_bytes: int | None = None,
    compact: bool = True,
) -> MergeCounts:
    """Insert the rows of ``new_df`` that match no row of the table at ``path``.

    ``schema`` is the table's declared schema (default: ``new_df``'s);
    columns are matched by name and must agree in name and type with each
    other and with the table's files.  An absent table is created from all of
    ``new_df``, partitioned by ``partition_cols``; appends must pass the same
    partition columns.  The table is held by one writer from its first read to
    its last file (see ``sources.commit``); rows are counted as they are written,
    and appear together.  ``compact=False`` keeps the source's row order in the
    files (a rebalanced write does not), for tables whose stored order counts.
    """
    asked = parse_predicate(spark, predicate)
    missing = [k.source for k in asked.keys if k.source not in new_df.columns]
    if missing:
        raise KeyError(f"merge keys not in the source: {missing}")
    table_schema = schema if schema is not None else new_df.schema
    source = _check_schema(new_df, table_schema) if schema is not None else new_df
    parts = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols or ())
    with writer(spark, path) as held:
        if not _check_stored(spark, path, table_schema, parts):
            inserted = write_table(source, path, mode="errorifexists", partition_cols=parts, compact=compact, held=held)
            return MergeCounts(inserted, 0, inserted)
        target = read_table(spark, path, table_schema)
        missing = [k.target for k in asked.keys if k.target not in target.columns]
        if missing:
            raise KeyError(f"merge keys not in the target: {missing}")
        # A scan of columns is cheap to repeat; anything else is evaluated once.
        kept = None if scans_columns(source) else source.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            inserts, stats = _plan_new_rows(source, target, asked, broadcast_max_bytes)
            inserted = write_table(inserts, path, mode="append", partition_cols=parts, compact=compact, held=held)
        finally:
            if kept is not None:
                kept.unpersist()
    return MergeCounts(stats.rows, stats.rows - inserted, inserted)
