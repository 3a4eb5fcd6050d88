"""Incremental landing ingest with Structured Streaming.

The batch setup rebuilds everything from the whole landing folder. These
streams pick up only archives that arrived since the last run (the file
source remembers what it has read in its checkpoint), tag their lines into
the same table layout, and count events per file and name batch by batch
(files are never split across batches, so no streaming state is needed).
Run them with ``availableNow`` to drain what has landed and stop.

A stream reads an archive as soon as it is listed, so archives must appear
atomically: write them under a name the glob does not match (``x.gz.part``)
or in another folder, then rename. Names containing ``tmp`` follow the
landing convention and are left out, as in the batch landing check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logtally.functions.json import json_field
from logtally.functions.paths import decode_file_path
from logtally.operators.tagging import tag_lines
from logtally.sinks import versions
from logtally.sources.landing import GZIP_GLOB, SKIP_SUBSTRING, qualified
from logtally.sources.lines import PATH_COL


def stream_lines(spark: SparkSession, landing_root: str, glob: str = GZIP_GLOB,
                 max_files_per_trigger: int | None = None,
                 skip_substring: str | None = SKIP_SUBSTRING) -> DataFrame:
    """Streaming ``(sourceFileAbsolutePath, line)`` over newly landed files."""
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(landing_root)
    lines = raw.select(decode_file_path(F.col("_metadata.file_path")).alias(PATH_COL),
                       F.col("value").alias("line"))
    if skip_substring:
        name = F.element_at(F.split(PATH_COL, "/"), -1)
        lines = lines.where(~name.contains(skip_substring))
    return lines


COUNTS_SCHEMA = "fileName string, name string, occurrenceCount long"


def _location_file(output_path: str) -> str:
    return f"{output_path.rstrip('/')}/_checkpoint_location"


def checkpoint_of(spark: SparkSession, output_path: str) -> str:
    """The checkpoint folder of a stream's output."""
    return versions.read_text(spark, _location_file(output_path)) or f"{output_path.rstrip('/')}/_checkpoint"


def _checkpoint(spark: SparkSession, output_path: str, location: str | None) -> str:
    """The stream's memory of what it has read belongs to its output: by default
    it lies inside that folder (readers skip names that begin with ``_``), so a
    restart goes on where the output ends and no two outputs share one. A location
    given by hand is noted in the output; later starts use it, and another is refused:
    it would read everything again, or skip what the output lacks."""
    own = f"{output_path.rstrip('/')}/_checkpoint"
    wanted = (location or "").rstrip("/")
    if wanted:
        wanted = qualified(spark, wanted)
    noted = versions.read_text(spark, _location_file(output_path))
    if noted is None and not wanted:
        return own
    if noted is None and versions.names(spark, own) and wanted != qualified(spark, own):
        noted = qualified(spark, own)
    if noted is None:
        versions.create(spark, _location_file(output_path), wanted)
        noted = versions.read_text(spark, _location_file(output_path))
    if wanted and wanted != noted:
        raise ValueError(f"{output_path} was written with the checkpoint {noted}, not {wanted}")
    return noted


def stream_tagged_lines(spark: SparkSession, landing_root: str, marker: str, output_path: str,
                        checkpoint_location: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Append tagged lines of new archives to a Parquet table (exactly once
    through the file sink's log and the source checkpoint). A checkpoint
    location given by hand stays that of the output."""
    tagged = tag_lines(stream_lines(spark, landing_root), marker)
    writer = (tagged.writeStream.format("parquet").outputMode("append")
              .option("path", output_path)
              .option("checkpointLocation", _checkpoint(spark, output_path, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def stream_event_counts(spark: SparkSession, landing_root: str, marker: str, json_path: str,
                        output_path: str, checkpoint_location: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """``(fileName, name, occurrenceCount)`` of newly landed archives.

    The file source gives each micro-batch whole files, so a batch's counts
    per file and name are already final: no streaming state is kept and no
    result is rewritten. Each batch writes its counts to
    ``<output_path>/batch=<id>`` with overwrite, so a batch replayed after a
    failure replaces its own output (exactly once). A checkpoint location
    given by hand stays that of the output. Read the table back with
    ``read_event_counts``, which also knows batches that ``compact_batches``
    folded together; until the first of those, the folder is plain Parquet.
    """
    lines = stream_lines(spark, landing_root, max_files_per_trigger=max_files_per_trigger)
    tagged = tag_lines(lines, marker).select(
        "fileName", json_field("line", json_path).alias("name"))
    root = output_path.rstrip("/")

    def _write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("fileName", "name").agg(
            F.count(F.lit(1)).alias("occurrenceCount"))
        counts.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    writer = (tagged.writeStream.foreachBatch(_write)
              .option("checkpointLocation", _checkpoint(spark, output_path, checkpoint_location)))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
