"""Column-level helpers (all JVM-side built-ins, no Python UDFs)."""

from logtally.functions.calendar import calendar_parts, epoch_millis, epoch_seconds
from logtally.functions.json import json_field
from logtally.functions.paths import decode_file_path, relative_name

__all__ = [
    "calendar_parts",
    "decode_file_path",
    "epoch_millis",
    "epoch_seconds",
    "json_field",
    "relative_name",
]
