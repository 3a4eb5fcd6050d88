"""Sources: text-line scans with provenance, typed JSON events, landing checks."""

from logtally.sources.events import parse_events, read_events, scan_events
from logtally.sources.landing import check_new, read_manifest, read_valid_lines, validate_landing
from logtally.sources.lines import scan_lines

__all__ = ["check_new", "parse_events", "read_events", "read_manifest", "read_valid_lines", "scan_events", "scan_lines",
           "validate_landing"]
