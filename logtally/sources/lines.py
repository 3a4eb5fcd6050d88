"""Raw text-line scans that keep the file each line came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.paths import decode_file_path

PATH_COL = "sourceFileAbsolutePath"


def scan_lines(
    spark: SparkSession,
    paths: str | list[str],
    recursive: bool = False,
    glob: str | None = None,
    with_path: bool = True,
    files: Column | None = None,
) -> DataFrame:
    """Read a directory (or files) of text lines, gzip decoded transparently.

    Returns ``(sourceFileAbsolutePath, line)`` or just ``(line)``. The path
    comes from the hidden ``_metadata.file_path`` column, decoded back from
    its percent-encoded form; reading it costs no extra I/O.

    A gzip file is never split, so each one is read by one task; many small
    files are bin-packed into splits of ``spark.sql.files.maxPartitionBytes``.
    ``files``, a condition on ``_metadata`` columns, picks files before any is
    opened.
    """
    reader = spark.read.format("text")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.load(paths if isinstance(paths, list) else [paths])
    if files is not None:
        raw = raw.where(files)
    if not with_path:
        return raw.select(F.col("value").alias("line"))
    return raw.select(
        decode_file_path(F.col("_metadata.file_path")).alias(PATH_COL),
        F.col("value").alias("line"),
    )
