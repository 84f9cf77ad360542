"""Column-level expressions (JVM built-ins only; no Python UDFs)."""

from tierkit.functions.casts import resolve_type, strict_cast
from tierkit.functions.lists import list_literal
from tierkit.functions.stamps import capture_date, capture_time

__all__ = ["capture_date", "capture_time", "list_literal", "resolve_type", "strict_cast"]
