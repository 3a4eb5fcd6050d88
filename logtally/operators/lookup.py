"""Per-line JSON field lookups (H9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from logtally.functions.json import json_field


def line_field(lines: DataFrame, json_path: str, alias: str,
               keep: Sequence[str] = ("fileName",), line_col: str = "line",
               limit: int | None = None) -> DataFrame:
    """``(*keep, alias)`` with ``alias`` the JSON path value of each line.

    ``limit`` is for display only (any rows, no order)."""
    out = lines.select(*keep, json_field(line_col, json_path).alias(alias))
    return out.limit(limit) if limit is not None else out
