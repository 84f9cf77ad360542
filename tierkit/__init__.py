"""tierkit — two-layer (raw / refined) batch data jobs on Spark DataFrames.

Every public function takes and returns DataFrames (or writes one), so the
same jobs run on one machine or on a cluster.  See ``README.md`` for the map
from feature to module.
"""

from tierkit.functions import capture_date, capture_time, list_literal, strict_cast
from tierkit.operators import (
    cast_columns,
    dedup_first,
    drop_strict,
    explode_columns,
    flatten,
    impute,
    merge_insert_only,
    parse_list_literal,
    rename_columns,
    select_strict,
    stamp_capture,
)
from tierkit.sources import ingest_envelope, read_table, table_exists, write_envelopes, write_table
from tierkit.streaming import incremental_append, incremental_merge

__all__ = [
    "capture_date",
    "capture_time",
    "cast_columns",
    "dedup_first",
    "drop_strict",
    "explode_columns",
    "flatten",
    "impute",
    "incremental_append",
    "incremental_merge",
    "ingest_envelope",
    "list_literal",
    "merge_insert_only",
    "parse_list_literal",
    "read_table",
    "rename_columns",
    "select_strict",
    "stamp_capture",
    "strict_cast",
    "table_exists",
    "write_envelopes",
    "write_table",
]
