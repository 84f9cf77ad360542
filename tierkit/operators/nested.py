"""Flatten nested records: struct fields become ``a.b.c`` columns."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tierkit.operators._names import q


def _leaves(prefix: list[str], col: Column, dtype: T.DataType, sep: str) -> list[Column]:
    if isinstance(dtype, T.StructType) and len(dtype.fields) > 0:
        out: list[Column] = []
        for f in dtype.fields:
            out += _leaves(prefix + [f.name], col.getField(f.name), f.dataType, sep)
        return out
    return [col.alias(sep.join(prefix))]


def flatten(df: DataFrame, sep: str = ".", keep: Collection[str] = ()) -> DataFrame:
    """Replace every struct column by its leaf fields, named by path joined
    with ``sep``.  Lists (and structs inside lists) stay whole; a missing
    field is null.  Columns in ``keep`` stay as they are.  A walk over the schema
    only — no data is touched.
    """
    cols: list[Column] = []
    for f in df.schema.fields:
        cols += [q(f.name)] if f.name in keep else _leaves([f.name], q(f.name), f.dataType, sep)
    return df.select(*cols)
