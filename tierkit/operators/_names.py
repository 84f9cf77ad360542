from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """A column name as an exact reference (names may contain dots)."""
    return "`" + name.replace("`", "``") + "`"


def q(name: str) -> Column:
    """Column by exact name (names may contain dots, e.g. after ``flatten``)."""
    return F.col(quote(name))


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def require(df: DataFrame, cols: Sequence[str], what: str = "columns") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} not found in the data: {missing}; available: {df.columns}")
