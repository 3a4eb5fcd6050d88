"""Structured Streaming form of the landing ingest."""

from logtally.streaming.compact import compact_batches, read_event_counts
from logtally.streaming.ingest import stream_event_counts, stream_lines, stream_tagged_lines

__all__ = ["compact_batches", "read_event_counts", "stream_event_counts", "stream_lines", "stream_tagged_lines"]
