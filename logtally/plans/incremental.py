"""Bring the derived tables up to date after a landing, without building them anew (H10).

Tables that hold lines or events have a part per day, the day of the archive that a line
came from; count tables are kept additive per file. A refresh

1. checks the archives that arrived, or changed, since the last one (``check_new``);
2. rewrites, in every table with days, the days of those archives, and of archives that
   are gone, each from all archives of that day that pass; events and dimension rows are
   written day by day, each day from its own part of the table before, without a sort;
3. sums the small count tables of all files into the reports;
4. commits the manifest last: a refresh that fails on the way leaves every table as some
   commit had it, and the next one finds the same archives new again.

Layout under ``output_root``, all tables versioned (``sinks.versions``)::

    <side>/landing_manifest  appended per check
    <side>/lines             by day: tagged lines (sourceFileAbsolutePath, fileName, name, line, archiveDay)
    <side>/name_counts       by day: lines per path, file and name, with archiveDay
    <side>/file_meta, <side>/event_counts, <side>/lines_check
    clean/events             by day: typed events with _isValid, archiveDay
    clean/json_check
    report/dimensions        by day; report/reconcile, report/left_reconcile

For the same landing they hold the rows of ``run_setup`` (and the column ``archiveDay``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logtally.operators import explode_dimensions, left_reconcile, reconcile, tag_lines, valid_json_rows
from logtally.plans.setup import SetupConfig, check_frame
from logtally.sinks import versions
from logtally.sources.events import parse_events
from logtally.sources.landing import check_new, read_valid_lines
from logtally.sources.lines import PATH_COL

# The day of an archive is the first date in its path; archives without one share a part.
DAY_PATTERN = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
NO_DAY = "none"
DAY = "archiveDay"

TABLES = [*[(side, name) for side in ("raw", "clean")
            for name in ("landing_manifest", "lines", "name_counts", "file_meta", "event_counts", "lines_check")],
          ("clean", "events"), ("clean", "json_check"), ("report", "dimensions"), ("report", "reconcile"), ("report", "left_reconcile")]


def archive_day(path: Column | str, pattern: str = DAY_PATTERN) -> Column:
    found = F.regexp_extract(path, pattern, 1)
    return F.when(found == "", F.lit(NO_DAY)).otherwise(found)


def _totals(spark: SparkSession, cfg: SetupConfig, side: str) -> None:
    """Count tables of all files from the counts per file and name; each is a few small rows."""
    each = versions.read(spark, cfg.path(side, "name_counts"))
    versions.replace_table(each.groupBy(PATH_COL, "fileName").agg(F.sum("n").alias("lineCount")), cfg.path(side, "file_meta"))
    versions.replace_table(each.groupBy("fileName", "name").agg(F.sum("n").alias("occurrenceCount")), cfg.path(side, "event_counts"))


def _record(spark: SparkSession, cfg: SetupConfig, side: str, name: str, source: int, derived: int) -> None:
    root = cfg.path(side, name)
    versions.replace_table(check_frame(spark, source, derived), root)
    cfg.results[root] = (source, derived, source == derived)
    if cfg.raise_on_mismatch and source != derived:
        raise AssertionError(f"row counts differ for {root}: {source} and {derived}")


def _rewrite_lines(spark: SparkSession, cfg: SetupConfig, side: str, root: str, marker: str, name_path: str,
                   manifest: DataFrame, days: list[str]) -> DataFrame:
    """The lines of ``days`` anew. Returns them as written, with their day."""
    day = archive_day(PATH_COL)
    some = manifest.where(archive_day("path").isin(days))
    lines = read_valid_lines(spark, root, some, recursive=cfg.recursive, only=lambda path: archive_day(path).isin(days))
    tagged = tag_lines(lines, marker, name_path=name_path).withColumn(DAY, day)
    seen = Observation(f"{side}_refreshed")
    target = cfg.path(side, "lines")
    versions.replace_parts(tagged, target, DAY, days, seen=seen)
    written = versions.read(spark, target, only=days)
    _record(spark, cfg, side, "lines_check", seen.get["rows"], written.count())
    counts = written.groupBy(DAY, PATH_COL, "fileName", "name").agg(F.count(F.lit(1)).alias("n"))
    versions.replace_parts(counts, cfg.path(side, "name_counts"), DAY, days)
    return written


def _rewrite_events(spark: SparkSession, cfg: SetupConfig, written: DataFrame, days: list[str]) -> None:
    target = cfg.path("clean", "events")
    lines = versions.part_reader(spark, cfg.path("clean", "lines"))
    versions.replace_each(spark, target, lambda day: parse_events(lines(day), keep=(DAY,)), days)
    _record(spark, cfg, "clean", "json_check", written.count(), valid_json_rows(versions.read(spark, target, only=days)).count())
    events = versions.part_reader(spark, target)
    versions.replace_each(spark, cfg.path("report", "dimensions"), lambda day: explode_dimensions(
        valid_json_rows(events(day)), keep=(DAY,), block_rows=cfg.block_rows), days)


def refresh(spark: SparkSession, cfg: SetupConfig) -> dict[str, dict]:
    """Take in what landed since the last refresh. By side: ``opened``, how many archives were
    checked; ``held_back``, how many are dated after the check's start and wait for the next one;
    ``days``, the days that were rewritten."""
    done: dict[str, dict] = {}
    news = {}
    for side, root, marker, name_path in (("raw", cfg.raw_root, cfg.raw_marker, cfg.raw_name_path),
                                          ("clean", cfg.clean_root, cfg.clean_marker, cfg.clean_name_path)):
        new = news[side] = check_new(spark, root, cfg.path(side, "landing_manifest"), recursive=cfg.recursive)
        # One row per day of archives that came, changed or went.
        days = sorted(r[0] for r in new.rows.select(archive_day("path")).distinct().collect())
        done[side] = {"opened": new.opened, "held_back": new.held_back, "days": days}
        if days:
            written = _rewrite_lines(spark, cfg, side, root, marker, name_path, new.manifest, days)
            if side == "clean":
                _rewrite_events(spark, cfg, written, days)
            _totals(spark, cfg, side)
    if any(d["days"] for d in done.values()) and all(
            versions.exists(spark, cfg.path(side, "file_meta")) for side in done):
        raw_meta, clean_meta = (versions.read(spark, cfg.path(side, "file_meta")) for side in ("raw", "clean"))
        versions.replace_table(reconcile(raw_meta, clean_meta), cfg.path("report", "reconcile"))
        versions.replace_table(left_reconcile(raw_meta, clean_meta), cfg.path("report", "left_reconcile"))
    for new in news.values():
        new.commit()
    for parts in TABLES:
        if versions.exists(spark, cfg.path(*parts)):
            if cfg.database:
                versions.point_view(spark, cfg.table(*parts), cfg.path(*parts))
            versions.drop_old(spark, cfg.path(*parts), cfg.keep_versions)
    return done
