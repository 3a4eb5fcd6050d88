"""Sinks: managed Parquet tables, snappy text staging, delimited export, versioned tables."""

from logtally.sinks import versions
from logtally.sinks.writers import (
    drop_tables,
    export_delimited,
    read_delimited,
    register_delimited,
    register_lines,
    stage_lines,
    write_managed,
)

__all__ = ["drop_tables", "export_delimited", "read_delimited", "register_delimited", "register_lines",
           "stage_lines", "versions", "write_managed"]
