"""Sources and sinks: landed JSON responses and Parquet table directories."""

from tierkit.sources.envelope import envelope_schema, infer_record_schema, ingest_envelope, write_envelopes
from tierkit.sources.tables import TableNotFound, read_table, table_exists, write_table

__all__ = [
    "TableNotFound",
    "envelope_schema",
    "infer_record_schema",
    "ingest_envelope",
    "read_table",
    "table_exists",
    "write_envelopes",
    "write_table",
]
