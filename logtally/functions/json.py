"""Schema-less JSON lookups on raw line strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_field(line: Column | str, json_path: str) -> Column:
    """``get_json_object``: NULL for malformed JSON, blank lines and missing
    keys. Keys match case-sensitively."""
    c = F.col(line) if isinstance(line, str) else line
    return F.get_json_object(c, json_path)
