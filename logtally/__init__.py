"""logtally: Spark-native ingest, profiling and reconciliation of event logs."""

from logtally.operators import (
    counts_match,
    distinct_files,
    event_counts,
    explode_dimensions,
    explode_locations,
    file_line_counts,
    left_reconcile,
    line_field,
    rare_keys,
    rare_keys_by_digest,
    reconcile,
    reconcile_spine,
    tag_lines,
)
from logtally.plans.incremental import refresh
from logtally.plans.setup import SetupConfig, run_setup
from logtally.session import build_session
from logtally.sources import (
    parse_events,
    read_events,
    read_valid_lines,
    scan_events,
    scan_lines,
    validate_landing,
)

__version__ = "0.1.0"

__all__ = [
    "SetupConfig",
    "build_session",
    "counts_match",
    "distinct_files",
    "event_counts",
    "explode_dimensions",
    "explode_locations",
    "file_line_counts",
    "left_reconcile",
    "line_field",
    "parse_events",
    "rare_keys",
    "rare_keys_by_digest",
    "read_events",
    "read_valid_lines",
    "reconcile",
    "reconcile_spine",
    "refresh",
    "run_setup",
    "scan_events",
    "scan_lines",
    "tag_lines",
    "validate_landing",
]
