"""Incremental ingest of newly landed response files (Structured Streaming)."""

from tierkit.streaming.incremental import incremental_append, incremental_merge

__all__ = ["incremental_append", "incremental_merge"]
