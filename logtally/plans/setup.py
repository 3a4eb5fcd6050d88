"""The full setup: both log copies to derived tables, checks, report (H10).

Each derived table is written once as Parquet under ``output_root`` (a
shared folder) and read back for the next steps, so gzip is decoded once
and every later step reads a columnar, splittable, lineage-free table. Raw
and clean sides are independent; each is a short sequence of Spark jobs.

Layout under ``output_root`` (full refresh on every run; every output is a
versioned table, see ``sinks.versions``: a run that fails leaves the tables it
had not replaced yet as they were, and readers never find one missing)::

    raw/lines        tagged lines            (sourceFileAbsolutePath, fileName, name, line)
    raw/name_counts  events per path, file & name; the two below are summed from it
    raw/file_meta    lines per file          (sourceFileAbsolutePath, fileName, lineCount)
    raw/lines_check  source vs table rows    (sourceCount, derivedCount, isConsistent)
    raw/event_counts events per file & name  (fileName, name, occurrenceCount)
    clean/...        the same five, event_counts exported as Ctrl-A text
    clean/json_stage the lines as snappy text
    clean/stage_check tagged rows vs staged lines, Ctrl-A text
    clean/events     typed events (Parquet, nested) with _isValid
    clean/json_check tagged rows vs valid JSON rows, Ctrl-A text
    report/reconcile, report/left_reconcile, report/dimensions

The event name is extracted from each line once, in the gzip pass, into the
``name`` column of the line table; per-file and per-name counts then read
only small dictionary-encoded columns.

Every check counts the table it vouches for as it was written. With
``check="observe"`` (default) the number of source lines is counted by an
``Observation`` on the very write that consumes them, so the sources are not
read again; so are the valid JSON rows, and the check fails too where the
written table holds another number than was seen going in. Each observed
write is a map-only job whose metrics are taken in its result stage, counted
once per partition even when tasks are retried after an executor loss.
``check="rescan"`` recounts the sources in their own jobs as the original
job did, and reads the typed events back from the stage.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logtally.operators import (
    counts_match,
    explode_dimensions,
    left_reconcile,
    reconcile,
    tag_lines,
    valid_json_rows,
)
from logtally.sinks import versions
from logtally.sinks.writers import (
    export_delimited,
    read_delimited,
    register_delimited,
    register_lines,
    stage_lines,
    write_managed,
)
from logtally.sources.events import parse_events, read_events
from logtally.sources.landing import read_valid_lines, validate_landing
from logtally.sources.lines import PATH_COL, scan_lines

CHECK_SCHEMA = "sourceCount long, derivedCount long, isConsistent boolean"
EVENT_COUNTS_SCHEMA = "fileName string, name string, occurrenceCount long"


@dataclass
class SetupConfig:
    raw_root: str
    clean_root: str
    output_root: str
    # Fixed values of the original job: the folder marker that starts a file
    # name on each side, and the JSON path of the event name in each copy.
    raw_marker: str = "metrics/"
    clean_marker: str = "clean/"
    raw_name_path: str = "$.clientData.name"
    clean_name_path: str = "$.name"
    recursive: bool = False
    check: str = "observe"          # or "rescan"
    # Check every archive first (gzip -t semantics), keep the manifest as
    # <side>/landing_manifest and ingest only the valid archives, instead of
    # letting one corrupt archive fail the job.
    validate: bool = False
    raise_on_mismatch: bool = False
    # When set, every output is also readable as ``<database>.<side>_<name>``,
    # a view of the version that was committed last.
    database: str | None = None
    # Versions of an output that are kept: the current one, and those that
    # readers of an earlier run may still have open.
    keep_versions: int = 2
    # Events that give more rows than this in the dimension table are dealt over tasks.
    block_rows: int = 100_000
    results: dict = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return "/".join([self.output_root.rstrip("/"), *parts])

    def table(self, *parts: str) -> str | None:
        return f"{self.database}.{'_'.join(parts)}" if self.database else None

    def __post_init__(self) -> None:
        if self.check not in ("observe", "rescan"):
            raise ValueError(f"check must be 'observe' or 'rescan', not {self.check!r}")


def _table_rows(spark: SparkSession, path: str) -> int:
    """Row count of a written Parquet table (reads no column data)."""
    return versions.read(spark, path).agg(F.count(F.lit(1))).first()[0]


def check_frame(spark: SparkSession, source: int, derived: int) -> DataFrame:
    return spark.createDataFrame([(source, derived, source == derived)], CHECK_SCHEMA)


def _done(spark: SparkSession, cfg: SetupConfig, *parts: str) -> None:
    """What follows a commit: the view goes to the new version, versions out of use go."""
    root = cfg.path(*parts)
    if cfg.database:
        versions.point_view(spark, cfg.table(*parts), root)
    versions.drop_old(spark, root, cfg.keep_versions)


def _write(cfg: SetupConfig, df: DataFrame, *parts: str) -> None:
    versions.replace(df.sparkSession, cfg.path(*parts), lambda folder: write_managed(df, folder), df.schema)
    _done(df.sparkSession, cfg, *parts)


def _source_lines(spark: SparkSession, cfg: SetupConfig, root: str, side: str) -> DataFrame:
    """``(sourceFileAbsolutePath, line)`` of a side: every archive under the
    root, or with ``validate`` only those the landing check of this run
    passes (its manifest is written first and read back)."""
    if not cfg.validate:
        return scan_lines(spark, root, recursive=cfg.recursive)
    _write(cfg, validate_landing(spark, root, recursive=cfg.recursive), side, "landing_manifest")
    return read_valid_lines(spark, root, versions.read(spark, cfg.path(side, "landing_manifest")), recursive=cfg.recursive)


def _write_tagged(spark: SparkSession, cfg: SetupConfig, root: str, marker: str,
                  name_path: str, side: str) -> tuple[DataFrame, DataFrame]:
    """Scan + tag + write the line table. Returns the written table and the
    one-row frame comparing source lines with table rows."""
    lines = _source_lines(spark, cfg, root, side)
    tagged = tag_lines(lines, marker, name_path=name_path)
    target = cfg.path(side, "lines")
    if cfg.check == "observe":
        obs = Observation(f"{side}_source")
        _write(cfg, tagged.observe(obs, F.count(F.lit(1)).alias("rows")), side, "lines")
        check = check_frame(spark, obs.get["rows"], _table_rows(spark, target))
    else:
        _write(cfg, tagged, side, "lines")
        # ``lines`` is lazy: counting it scans the sources again.
        check = counts_match(lines.select("line"), versions.read(spark, target))
    return versions.read(spark, target), check


def _export(spark: SparkSession, cfg: SetupConfig, df: DataFrame, schema: str, *parts: str) -> None:
    """A text output: names may hold any character, so values are escaped."""
    root = cfg.path(*parts)
    folder = versions.replace(spark, root, lambda f: export_delimited(df, f, escape=True))
    if cfg.database:
        register_delimited(spark, cfg.table(*parts), folder, schema, escape=True)
    versions.drop_old(spark, root, cfg.keep_versions)


def _record_check(spark: SparkSession, cfg: SetupConfig, check: DataFrame, *parts: str,
                  delimited: bool = False) -> None:
    path = cfg.path(*parts)
    if delimited:
        _export(spark, cfg, check, CHECK_SCHEMA, *parts)
    else:
        _write(cfg, check, *parts)
    if check.isLocal():
        row = check.first()          # a one-row local relation: no job
    elif delimited:
        row = read_delimited(spark, versions.folder(spark, path), CHECK_SCHEMA, escape=True).first()
    else:
        row = versions.read(spark, path).first()
    cfg.results[path] = tuple(row)
    if cfg.raise_on_mismatch and not row["isConsistent"]:
        raise AssertionError(f"row counts differ for {path}: {tuple(row)}")


def _write_counts(spark: SparkSession, cfg: SetupConfig, tagged: DataFrame, side: str) -> DataFrame:
    """One aggregate of the line table; its few rows give both count tables.
    Writes the file counts, returns the event counts."""
    each = tagged.groupBy(PATH_COL, "fileName", "name").agg(F.count(F.lit(1)).alias("n"))
    _write(cfg, each, side, "name_counts")
    each = versions.read(spark, cfg.path(side, "name_counts"))
    _write(cfg, each.groupBy(PATH_COL, "fileName").agg(F.sum("n").alias("lineCount")), side, "file_meta")
    return each.groupBy("fileName", "name").agg(F.sum("n").alias("occurrenceCount"))


def build_raw(spark: SparkSession, cfg: SetupConfig) -> dict:
    tagged, check = _write_tagged(spark, cfg, cfg.raw_root, cfg.raw_marker,
                                  cfg.raw_name_path, "raw")
    _record_check(spark, cfg, check, "raw", "lines_check")
    _write(cfg, _write_counts(spark, cfg, tagged, "raw"), "raw", "event_counts")
    return cfg.results


def build_clean(spark: SparkSession, cfg: SetupConfig) -> dict:
    tagged, check = _write_tagged(spark, cfg, cfg.clean_root, cfg.clean_marker,
                                  cfg.clean_name_path, "clean")
    _record_check(spark, cfg, check, "clean", "lines_check")
    _export(spark, cfg, _write_counts(spark, cfg, tagged, "clean"), EVENT_COUNTS_SCHEMA, "clean", "event_counts")

    sources = [cfg.clean_root, cfg.path("clean", "lines")]
    stage = versions.replace(spark, cfg.path("clean", "json_stage"), lambda f: stage_lines(tagged, f, source_paths=sources))
    if cfg.database:
        register_lines(spark, cfg.table("clean", "json_stage"), stage)
    versions.drop_old(spark, cfg.path("clean", "json_stage"), cfg.keep_versions)
    seen = None
    if cfg.check == "observe":
        # Parse the splittable Parquet copy of the same lines; count valid
        # rows while writing the typed table.
        obs = Observation("clean_json")
        parsed = parse_events(tagged.select("line"))
        _write(cfg, parsed.observe(obs, F.count_if(F.col("_isValid")).alias("valid")),
               "clean", "events")
        seen = obs.get["valid"]
    else:
        _write(cfg, read_events(spark, stage), "clean", "events")
    return check_clean(spark, cfg, seen)


def check_clean(spark: SparkSession, cfg: SetupConfig, seen: int | None = None) -> dict:
    """Compare the written stage and typed events with the line table, and with
    the valid rows ``seen`` going in if they were counted."""
    tagged = versions.read(spark, cfg.path("clean", "lines"))
    staged = spark.read.text(versions.folder(spark, cfg.path("clean", "json_stage")))
    _record_check(spark, cfg, counts_match(tagged, staged), "clean", "stage_check", delimited=True)
    json_check = counts_match(tagged, valid_json_rows(versions.read(spark, cfg.path("clean", "events"))))
    if seen is not None:
        json_check = json_check.withColumn("isConsistent", F.col("isConsistent") & (F.col("derivedCount") == seen))
    _record_check(spark, cfg, json_check, "clean", "json_check", delimited=True)
    return cfg.results


def build_report(spark: SparkSession, cfg: SetupConfig) -> dict:
    raw_meta = versions.read(spark, cfg.path("raw", "file_meta"))
    clean_meta = versions.read(spark, cfg.path("clean", "file_meta"))
    _write(cfg, reconcile(raw_meta, clean_meta), "report", "reconcile")
    _write(cfg, left_reconcile(raw_meta, clean_meta), "report", "left_reconcile")
    events = valid_json_rows(versions.read(spark, cfg.path("clean", "events")))
    _write(cfg, explode_dimensions(events, block_rows=cfg.block_rows), "report", "dimensions")
    return cfg.results


def run_setup(spark: SparkSession, cfg: SetupConfig, report: bool = True,
              parallel: bool = True) -> dict:
    """Build both sides, then the report. Returns the check rows by path.

    The raw and clean sides share nothing until the report, so by default
    they are submitted from two driver threads and their jobs share the
    cluster: one side's tasks fill executors the other leaves idle, e.g.
    behind a long single-archive task.
    """
    if parallel:
        # inheritable_thread_target carries the caller's job group and local
        # properties into the threads (cancellation, event-log attribution).
        with ThreadPoolExecutor(max_workers=2, thread_name_prefix="logtally-setup") as pool:
            sides = [pool.submit(inheritable_thread_target(spark)(build), spark, cfg)
                     for build in (build_raw, build_clean)]
            for done in sides:
                done.result()
    else:
        build_raw(spark, cfg)
        build_clean(spark, cfg)
    if report:
        build_report(spark, cfg)
    return cfg.results
