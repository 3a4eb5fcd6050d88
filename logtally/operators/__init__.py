"""User-level operators composed from DataFrame built-ins."""

from logtally.operators.counts import (
    assert_consistent,
    count_rows,
    counts_match,
    event_counts,
    file_line_counts,
    rare_keys,
    valid_json_rows,
)
from logtally.operators.explode import explode_dimensions, explode_locations
from logtally.operators.lookup import line_field
from logtally.operators.rare import rare_keys_by_digest
from logtally.operators.reconcile import distinct_files, left_reconcile, reconcile, reconcile_spine
from logtally.operators.tagging import tag_lines

__all__ = [
    "assert_consistent",
    "count_rows",
    "counts_match",
    "distinct_files",
    "event_counts",
    "explode_dimensions",
    "explode_locations",
    "file_line_counts",
    "left_reconcile",
    "line_field",
    "rare_keys",
    "rare_keys_by_digest",
    "reconcile",
    "reconcile_spine",
    "tag_lines",
    "valid_json_rows",
]
