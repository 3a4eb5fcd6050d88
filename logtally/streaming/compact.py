"""Compaction of a stream's batch folders.

``stream_event_counts`` writes each micro-batch to a ``batch=<id>`` folder of its own,
so a stream that runs often piles up small files. ``compact_batches`` folds settled
batches, those that the stream's checkpoint has recorded as committed and that are thus
never written again, into files near a target size. The folded rows are a versioned table
inside the output (``_folded``), whose parts are named by the batches they hold::

    <output>/batch=17/...            not folded yet
    <output>/_folded/                parts "0-11", "12-16"

``read_event_counts`` takes the folded parts of the last commit and the batch folders
after them, so it has each batch once at every moment: before the commit from its folder,
after it from the part. Folders that a commit made needless stay until the next compaction,
for readers that began before it. The stream may run on meanwhile, and be restarted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logtally.sinks import versions
from logtally.streaming.ingest import COUNTS_SCHEMA, checkpoint_of

TARGET_BYTES = 128 << 20
_SCHEMA = f"{COUNTS_SCHEMA}, batch long"


def folded_root(output_path: str) -> str:
    return f"{output_path.rstrip('/')}/_folded"


def _batches(spark: SparkSession, output_path: str) -> list[int]:
    """Ids of the batch folders."""
    names = versions.names(spark, output_path)
    return sorted(int(n[6:]) for n in names if n.startswith("batch=") and n[6:].isdigit())


def _folders(output_path: str, ids: list[int]) -> list[str]:
    return [f"{output_path.rstrip('/')}/batch={i}" for i in ids]


def _plain(spark: SparkSession, output_path: str, ids: list[int]) -> DataFrame:
    if not ids:
        return spark.createDataFrame([], _SCHEMA)
    # Named folders: those that an overwrite or a compaction removes meanwhile are not among them.
    return spark.read.schema(_SCHEMA).option("basePath", output_path).parquet(*_folders(output_path, ids))


def _span(part: str) -> tuple[int, int]:
    first, last = part.split("-")
    return int(first), int(last)


def _through(parts: dict[str, str]) -> int:
    """The last batch that is folded."""
    return max((_span(p)[1] for p in parts), default=-1)


def settled_through(spark: SparkSession, output_path: str) -> int:
    """The last batch that the stream's checkpoint has as committed; -1 before the first."""
    done = versions.names(spark, f"{checkpoint_of(spark, output_path)}/commits")
    return max((int(n) for n in done if n.isdigit()), default=-1)


def read_event_counts(spark: SparkSession, output_path: str) -> DataFrame:
    """``(fileName, name, occurrenceCount, batch)`` of a stream's output, compacted or not."""
    parts = versions.parts(spark, folded_root(output_path)) or {}
    # Looked at after the commit was read: a batch folded since then still has its folder.
    live = [i for i in _batches(spark, output_path) if i > _through(parts)]
    plain = _plain(spark, output_path, live)
    if not parts:
        return plain
    return spark.read.schema(_SCHEMA).parquet(*sorted(parts.values())).unionByName(plain)


def compact_batches(spark: SparkSession, output_path: str, target_bytes: int = TARGET_BYTES) -> list[int]:
    """Fold the settled batches that are not folded yet; returns their ids.

    The last part joins in while it is under ``target_bytes``, so parts do not pile up either.
    One compaction of an output runs at a time.
    """
    root = folded_root(output_path)
    parts = versions.parts(spark, root) or {}
    through, settled = _through(parts), settled_through(spark, output_path)
    found = _batches(spark, output_path)
    for folder in _folders(output_path, [i for i in found if i <= through]):
        versions.delete(spark, folder)
    ids = [i for i in found if through < i <= settled]
    if not ids:
        return []
    rows, first, replaced = _plain(spark, output_path, ids), ids[0], []
    sizes = {p: versions.size(spark, f) for p, f in parts.items()}
    tail = max(parts, key=_span, default=None)
    total = sum(versions.size(spark, f) for f in _folders(output_path, ids))
    if tail is not None and sizes[tail] < target_bytes:
        rows = spark.read.schema(_SCHEMA).parquet(parts[tail]).unionByName(rows)
        first, replaced, total = _span(tail)[0], [tail], total + sizes[tail]
    # Whole small files go together without a shuffle; each task writes about the target.
    rows = rows.coalesce(max(1, -(-total // target_bytes)))
    schema = rows.schema
    folder = versions.written(spark, root, lambda f: rows.write.parquet(f))
    versions.commit(spark, root, lambda old: {**{p: f for p, f in old.items() if p not in replaced},
                                              f"{first}-{ids[-1]}": folder}, schema)
    versions.drop_old(spark, root)
    return ids

