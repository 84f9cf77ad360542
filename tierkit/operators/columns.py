"""Select, drop and rename, with the strictness of the pandas originals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tierkit.operators._names import as_list, q, require


def select_strict(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Keep ``cols`` in the given order; a missing name raises, listing all."""
    names = as_list(cols)
    require(df, names)
    return df.select(*[q(c) for c in names])


def drop_strict(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Drop ``cols``; unlike ``DataFrame.drop`` a missing name raises."""
    names = as_list(cols)
    require(df, names)
    return df.select(*[q(c) for c in df.columns if c not in set(names)])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored (as in pandas)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df
