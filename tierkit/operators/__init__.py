"""DataFrame → DataFrame operators (and the insert-only merge sink)."""

from tierkit.operators.arrays import explode_columns, parse_list_literal
from tierkit.operators.clean import cast_columns, dedup_first, impute
from tierkit.operators.columns import drop_strict, rename_columns, select_strict
from tierkit.operators.merge import merge_insert_only, merge_keys
from tierkit.operators.nested import flatten
from tierkit.operators.stamp import stamp_capture

__all__ = [
    "cast_columns",
    "dedup_first",
    "drop_strict",
    "explode_columns",
    "flatten",
    "impute",
    "merge_insert_only",
    "merge_keys",
    "parse_list_literal",
    "rename_columns",
    "select_strict",
    "stamp_capture",
]
