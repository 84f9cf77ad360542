"""List columns: parse list-literal text, explode lists into rows."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.functions.lists import list_literal
from tierkit.operators._names import as_list, q, require


def parse_list_literal(df: DataFrame, col: str) -> DataFrame:
    """Make ``col`` an ``array<string>``: text like ``['A','B']`` is parsed,
    a column that already holds arrays passes through unchanged.

    Dispatch is by column type, decided once from the schema, not per cell.
    """
    require(df, [col])
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.ArrayType):
        return df
    if isinstance(dtype, T.StringType):
        return df.withColumn(col, list_literal(q(col)))
    raise TypeError(f"column {col!r} is {dtype.simpleString()}, neither text nor a list")


def _chunks(col: Column, items: int) -> Column:
    """The list cut into lists of at most ``items``, in order; one chunk of its own
    for an empty or null list."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(col), F.lit(1)), F.lit(items))
    return F.when(F.size(col) > items, F.transform(starts, lambda at: F.slice(col, at, items))).otherwise(F.array(col))


def explode_columns(
    df: DataFrame,
    cols_to_select: str | Sequence[str],
    cols_to_explode: str | Sequence[str],
    chunk_items: int | None = None,
) -> DataFrame:
    """Select ``cols_to_select`` and turn each list in ``cols_to_explode`` into rows.

    An empty or null list gives one row with a null item; several exploded
    columns give their cross product per row.  A column that is not a list is
    left as it is, with a warning.  Narrow: no shuffle.

    With ``chunk_items``, for lists so long that one row's items are too much for
    the task that holds it: a list with more items is cut into chunks of at most
    that many (several columns: into pairs of chunks), which are dealt over all
    tasks and exploded there.  Only rows with such a list are shuffled, as chunks;
    the input is read once for them and once for the others.  Same rows either way.
    """
    if chunk_items is not None and chunk_items < 1:
        raise ValueError("chunk_items must be positive")
    select = as_list(cols_to_select)
    explode = as_list(cols_to_explode)
    require(df, select + [c for c in explode if c not in select])
    not_selected = [c for c in explode if c not in select]
    if not_selected:
        raise KeyError(f"columns to explode must be selected too: {not_selected}")
    out = df.select(*[q(c) for c in select])
    lists = []
    for c in explode:
        if isinstance(out.schema[c].dataType, T.ArrayType):
            lists.append(c)
        else:
            warnings.warn(f"column {c!r} does not hold lists; left as it is", stacklevel=2)
    if chunk_items is None or not lists:
        return _explode(out, lists)
    long = F.greatest(*[F.coalesce(F.size(q(c)), F.lit(0)) for c in lists], F.lit(0)) > chunk_items
    cut = out.where(long)
    for c in lists:
        cut = cut.withColumn(c, F.explode(_chunks(q(c), chunk_items)))
    # Dealt in turn, not by key: the chunks of one row must part.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _explode(out.where(~long), lists).union(_explode(cut.repartition(tasks), lists))


def _explode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.explode_outer(q(c)))
    return df
