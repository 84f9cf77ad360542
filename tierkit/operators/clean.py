"""Cleaning and typing: null imputation, strict casts, keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.functions.casts import strict_cast
from tierkit.operators._names import as_list, q, require

# Stored order of a file table: files in the order they were written, rows in
# file order.  Used when no explicit order is given.
FILE_ORDER = ("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index")


def impute(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """Replace nulls, and NaN in float columns; names not present are ignored.

    The fill value is cast strictly to the column's type, so a text fill for a
    numeric column fails at planning instead of being skipped.
    """
    present = {c: v for c, v in mapping.items() if c in df.columns and v is not None}
    if not present:
        return df
    fills = {c: strict_cast(F.lit(v), df.schema[c].dataType, nulls="keep", label=f"fill value for {c}") for c, v in present.items()}


    def absent(c: str) -> Column:
        floating = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        return q(c).isNull() | F.isnan(q(c)) if floating else q(c).isNull()

    return df.withColumns({c: F.when(absent(c), fill).otherwise(q(c)) for c, fill in fills.items()})


def cast_columns(df: DataFrame, mapping: Mapping[str, str], nulls: str = "auto") -> DataFrame:
    """Cast columns by map (Spark or pandas type names) with strict errors.

    Overflow, bad text and zoned timestamps raise; nulls raise for integer
    targets (``nulls="auto"``, see ``strict_cast``).  A column named in the
    map but absent raises.
    """
    require(df, list(mapping))
    return df.withColumns({c: strict_cast(q(c), t, nulls=nulls, label=c) for c, t in mapping.items()})


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType) or dtype.typeName() == "variant":
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def _order_cols(df: DataFrame, keys: list[str], order_by: str | Column | Sequence[str | Column] | None) -> list[Column]:
    if order_by is None:
        return [F.col(c) for c in FILE_ORDER]
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    named = {c for c in items if isinstance(c, str)} | set(keys)
    # Ties on the given order are broken by the remaining columns, so the kept
    # row depends only on the data — a recomputed task keeps the same row.
    tiebreak = [q(f.name) for f in df.schema.fields if f.name not in named and _orderable(f.dataType)]
    return [q(c) if isinstance(c, str) else c for c in items] + tiebreak


def dedup_first(
    df: DataFrame,
    subset: str | Sequence[str],
    order_by: str | Column | Sequence[str | Column] | None = None,
) -> DataFrame:
    """Keep the first row of each ``subset`` key under ``order_by``.

    "First" needs an order: pass one (ties are broken by the remaining
    columns in schema order, so the result never depends on task timing), or
    leave ``order_by`` unset to use the stored order of a file table (write
    time, file, row).  Null keys form one group; nulls sort first.

    Plan: ``row_number() = 1`` over a window on the key.  Catalyst turns the
    filter into a partial group limit *before* the hash shuffle, so every
    input task forwards at most one row per key: a key holding a third of all
    rows moves as one row per task, and no task ever holds a whole group.
    """
    keys = as_list(subset)
    require(df, keys, "key columns")
    if order_by is None:
        try:
            df.select(*[F.col(c) for c in FILE_ORDER]).schema
        except Exception as err:
            raise ValueError("dedup_first without order_by needs a file table (stored order); pass order_by") from err
    window = Window.partitionBy(*[q(k) for k in keys]).orderBy(*_order_cols(df, keys, order_by))
    rank = "__first_rank"
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)
