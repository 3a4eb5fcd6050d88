"""Registered queries over the driver's test tables, with DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables; those that land, stream or build write and read archives and tables of
their own first, once per session and table folder. The oracle SQL computes the
same rows with the same column names on DuckDB views of the same parquet tables.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.calendar import calendar_parts, epoch_millis
from logtally.functions.paths import relative_name
from logtally.operators import (
    count_rows,
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
    valid_json_rows,
)
from logtally.plans.incremental import refresh
from logtally.plans.setup import CHECK_SCHEMA, EVENT_COUNTS_SCHEMA, SetupConfig, run_setup
from logtally.session import ensure_checkpoint_dir
from logtally.sinks import versions
from logtally.sinks.writers import drop_tables, export_delimited, read_delimited, register_delimited
from logtally.sources.events import parse_events, scan_events
from logtally.sources.landing import read_manifest, read_valid_lines, validate_landing
from logtally.sources.tables import (
    CLEAN_MARKER,
    CLEAN_MISSING_DAY,
    CLEAN_NAME_PATH,
    RAW_MARKER,
    RAW_MISSING_DAY,
    RAW_NAME_PATH,
    clean_lines,
    copy_damaged,
    event_json_lines,
    raw_lines,
    table,
    write_daily_archives,
)
from logtally.streaming import compact_batches, read_event_counts, stream_event_counts, stream_tagged_lines

Query = Callable[[SparkSession, str], DataFrame]


def raw_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return tag_lines(raw_lines(spark, sf), RAW_MARKER)


def clean_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return tag_lines(clean_lines(spark, sf), CLEAN_MARKER)


def _raw_meta(spark: SparkSession, sf: str) -> DataFrame:
    """Line counts of a raw copy without one of the clean copy's files."""
    return file_line_counts(tag_lines(raw_lines(spark, sf, RAW_MISSING_DAY), RAW_MARKER))


def _clean_meta(spark: SparkSession, sf: str) -> DataFrame:
    return file_line_counts(tag_lines(clean_lines(spark, sf, CLEAN_MISSING_DAY), CLEAN_MARKER))


def _typed_events(spark: SparkSession, sf: str, *fields: str) -> DataFrame:
    """Valid typed events parsed from JSON lines; only ``fields`` if given."""
    return valid_json_rows(parse_events(event_json_lines(spark, sf).select("line"), fields=fields or None))


def q_tag_lines(spark, sf):
    return clean_tagged(spark, sf)


def q_file_line_counts(spark, sf):
    return file_line_counts(raw_tagged(spark, sf), ordered=True)


def q_event_counts_raw(spark, sf):
    return event_counts(raw_tagged(spark, sf), RAW_NAME_PATH)


def q_event_counts_clean(spark, sf):
    return event_counts(clean_tagged(spark, sf), CLEAN_NAME_PATH, ordered=True)


def q_event_counts_props(spark, sf):
    return event_counts(table(spark, sf, "events"), "$.k", group_cols=(), line_col="props")


def q_counts_match(spark, sf):
    """The source lines against the line table the setup wrote."""
    return counts_match(raw_lines(spark, sf), _setup_table(spark, sf, "raw", "lines"))


def q_counts_differ(spark, sf):
    """All raw lines against a clean copy without one day."""
    return counts_match(raw_lines(spark, sf), clean_lines(spark, sf, CLEAN_MISSING_DAY))


def q_counts_match_json(spark, sf):
    """Lines of which some lost their last character or gained another object."""
    number = F.get_json_object("line", "$.eventId").cast("long") % 10
    lines = event_json_lines(spark, sf).select(
        F.when(number == 0, F.expr("left(line, length(line) - 1)")).when(number == 1, F.concat("line", F.lit(" {}")))
        .otherwise(F.col("line")).alias("line"))
    # Validity needs no fields beyond one: it asks whether a line is an object.
    return counts_match(lines, valid_json_rows(parse_events(lines, fields=("name",))))


def q_left_reconcile(spark, sf):
    return left_reconcile(_raw_meta(spark, sf), _clean_meta(spark, sf))


def q_reconcile(spark, sf):
    return reconcile(_raw_meta(spark, sf), _clean_meta(spark, sf))


def q_reconcile_spine(spark, sf):
    return reconcile_spine(_raw_meta(spark, sf), _clean_meta(spark, sf))


def q_distinct_files(spark, sf):
    return distinct_files(_raw_meta(spark, sf), _clean_meta(spark, sf))


def q_line_field(spark, sf):
    return line_field(clean_tagged(spark, sf), "$.siteId", "siteId")


def q_line_name_raw(spark, sf):
    return line_field(raw_tagged(spark, sf), RAW_NAME_PATH, "name", keep=("line",))


def q_rare_keys(spark, sf):
    return rare_keys(table(spark, sf, "documents"), "text")


def q_rare_keys_by_digest(spark, sf):
    return rare_keys_by_digest(table(spark, sf, "documents"), "text")


def q_rare_event_ids(spark, sf):
    return rare_keys(_typed_events(spark, sf, "eventId"), "eventId")


def q_typed_events(spark, sf):
    ev = _typed_events(spark, sf, "eventId", "name", "serverTs", "siteId", "zoomLevel", "meta")
    return ev.select("eventId", "name", "serverTs", "siteId", "zoomLevel",
                     F.size("meta.locations").alias("nLocations"),
                     F.size("meta.pseudoEvents").alias("nPseudoEvents"),
                     F.size("meta.ua.groups").alias("nUaGroups"))


def q_count_events(spark, sf):
    return count_rows(_typed_events(spark, sf, "eventId"))


def q_explode_locations(spark, sf):
    return explode_locations(_typed_events(spark, sf, "siteId", "meta"))


def q_explode_dimensions(spark, sf):
    return explode_dimensions(_typed_events(spark, sf, "serverTs", "siteId", "name", "meta"))


def q_calendar_parts(spark, sf):
    ev = table(spark, sf, "events").select("event_id", epoch_millis("ts").alias("serverTs"))
    return ev.select("event_id", "serverTs", *calendar_parts("serverTs"))


def q_split_path(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", relative_name("url", "example[.]").alias("relativeName"))


def _fresh_folder(spark: SparkSession, kind: str) -> str:
    """A new folder under the session's checkpoint directory (a shared
    folder on a cluster) for archives a query lands itself."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"


_MADE: dict[tuple, object] = {}
_MAKING = threading.Lock()


def _once(spark: SparkSession, sf: str, what: str, make: Callable[[], object]) -> object:
    """What ``make`` gives, made once per session and table folder."""
    key = (spark.sparkContext.applicationId, sf, what)
    with _MAKING:
        if key not in _MADE:
            _MADE[key] = make()
        return _MADE[key]


def _landed_archives(spark: SparkSession, sf: str) -> str:
    """The clean copy written as daily gzip archives."""
    return _once(spark, sf, "landed", lambda: write_daily_archives(
        clean_lines(spark, sf), _fresh_folder(spark, "landing")))


def _checked_archives(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The same with some days damaged, and the folder of its written manifest."""
    root = _landed_archives(spark, sf)

    def make() -> tuple[str, str]:
        damaged, manifest = copy_damaged(spark, root, _fresh_folder(spark, "damaged")), _fresh_folder(spark, "manifest")
        validate_landing(spark, damaged, recursive=True).write.parquet(manifest)
        return damaged, manifest

    return _once(spark, sf, "checked", make)


def _setup(spark: SparkSession, sf: str) -> SetupConfig:
    """The whole setup run over both copies, landed as daily archives; the clean
    one holds the typed events."""
    def make() -> SetupConfig:
        base = _fresh_folder(spark, "setup")
        cfg = SetupConfig(raw_root=write_daily_archives(raw_lines(spark, sf), f"{base}/land/raw/metrics"),
                          clean_root=write_daily_archives(event_json_lines(spark, sf), f"{base}/land/nom/clean"),
                          output_root=f"{base}/out", recursive=True)
        run_setup(spark, cfg)
        return cfg

    return _once(spark, sf, "setup", make)


def _setup_table(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    return versions.read(spark, _setup(spark, sf).path(*parts))


def _day(column: str):
    """The day of a landed file: part-file names are chosen by Spark."""
    return F.regexp_extract(column, r"day=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1).alias("day")


def q_landing_manifest(spark, sf):
    """Days by what the check found of their archives."""
    manifest = spark.read.parquet(_checked_archives(spark, sf)[1])
    return manifest.groupBy("reason", "isValid").agg(F.count_distinct(_day("path")).alias("days"))


def q_scanned_events(spark, sf):
    root = _fresh_folder(spark, "events")
    event_json_lines(spark, sf).select("line").write.option("compression", "gzip").text(root)
    ev = valid_json_rows(scan_events(spark, root).withColumn(
        "_isValid", F.col("_corrupt_record").isNull()))
    return ev.select("eventId", "name", "serverTs", "siteId", "zoomLevel",
                     F.size("meta.locations").alias("nLocations"),
                     F.size("meta.pseudoEvents").alias("nPseudoEvents"),
                     F.size("meta.ua.groups").alias("nUaGroups"))


def q_landing_validity(spark, sf):
    manifest = spark.read.parquet(_checked_archives(spark, sf)[1])
    return manifest.select(_day("path"), "isValid", "reason").distinct()


def q_landed_event_counts(spark, sf):
    root, manifest = _checked_archives(spark, sf)
    tagged = tag_lines(read_valid_lines(spark, root, spark.read.parquet(manifest), recursive=True), "day=")
    by_day = tagged.select(F.get(F.split("fileName", "/"), 0).alias("day"), "line")
    return event_counts(by_day, CLEAN_NAME_PATH, group_cols=("day",))


def q_streamed_event_counts(spark, sf):
    root = _landed_archives(spark, sf)
    out = _fresh_folder(spark, "streamed")
    stream_event_counts(spark, root, "day=", CLEAN_NAME_PATH, out).awaitTermination()
    counts = spark.read.parquet(out).drop("batch")
    return (counts.select(F.get(F.split("fileName", "/"), 0).alias("day"), "name", "occurrenceCount")
            .groupBy("day", "name").agg(F.sum("occurrenceCount").alias("occurrenceCount")))


# Archives of a batch of the compacted stream.
FILES_PER_BATCH = 10


def q_compacted_event_counts(spark, sf):
    """Archives streamed in several batches, folded together, and read back."""
    out = _fresh_folder(spark, "compacted")
    stream_event_counts(spark, _landed_archives(spark, sf), "day=", CLEAN_NAME_PATH, out,
                        max_files_per_trigger=FILES_PER_BATCH).awaitTermination()
    compact_batches(spark, out)
    return (read_event_counts(spark, out).select(F.get(F.split("fileName", "/"), 0).alias("day"), "name", "occurrenceCount")
            .groupBy("day", "name").agg(F.sum("occurrenceCount").alias("occurrenceCount")))


def q_streamed_lines(spark, sf):
    root = _landed_archives(spark, sf)
    out = _fresh_folder(spark, "streamed")
    stream_tagged_lines(spark, root, "day=", out).awaitTermination()
    return spark.read.parquet(out).select(F.get(F.split("fileName", "/"), 0).alias("day"), "line")


def q_managed_lines(spark, sf):
    return _setup_table(spark, sf, "raw", "lines").select(_day("sourceFileAbsolutePath"), "name", "line")


def q_staged_lines(spark, sf):
    staged = spark.read.text(versions.folder(spark, _setup(spark, sf).path("clean", "json_stage")))
    return staged.select(*[F.get_json_object("value", f"$.{k}").alias(k) for k in ("eventId", "name", "siteId")])


def q_exported_event_counts(spark, sf):
    folder = versions.folder(spark, _setup(spark, sf).path("clean", "event_counts"))
    counts = read_delimited(spark, folder, EVENT_COUNTS_SCHEMA, escape=True)
    return counts.groupBy(_day("fileName"), "name").agg(F.sum("occurrenceCount").alias("occurrenceCount"))


def q_setup_event_counts(spark, sf):
    return _setup_table(spark, sf, "raw", "event_counts").groupBy(_day("fileName"), "name").agg(
        F.sum("occurrenceCount").alias("occurrenceCount"))


def q_setup_reconcile(spark, sf):
    return _setup_table(spark, sf, "report", "reconcile").groupBy(_day("fileName")).agg(
        F.sum("masterEventCount").alias("masterEventCount"), F.sum("nomEventCount").alias("nomEventCount"))


def q_setup_dimensions(spark, sf):
    return _setup_table(spark, sf, "report", "dimensions")


def q_setup_checks(spark, sf):
    cfg = _setup(spark, sf)
    named = [(F.lit(name), versions.read(spark, cfg.path(*name.split("/")))) for name in ("raw/lines_check", "clean/lines_check")]
    named += [(F.lit(name), read_delimited(spark, versions.folder(spark, cfg.path(*name.split("/"))), CHECK_SCHEMA, escape=True))
              for name in ("clean/stage_check", "clean/json_check")]
    rows = [df.select(name.alias("checkName"), "sourceCount", "derivedCount", "isConsistent") for name, df in named]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


def _by_day(counts: DataFrame, path_col: str = "fileName") -> DataFrame:
    return counts.groupBy(_day(path_col), "name").agg(F.sum("occurrenceCount").alias("occurrenceCount"))


def q_replaced_event_counts(spark, sf):
    """A table of a copy without one day; a rebuild that fails; one that succeeds. The view over it
    gives the last rows that were committed."""
    root, view = _fresh_folder(spark, "replaced"), f"replaced_{uuid.uuid4().hex}"

    def build(lines: DataFrame) -> None:
        counts = event_counts(tag_lines(lines, CLEAN_MARKER), CLEAN_NAME_PATH)
        versions.replace(spark, root, counts.write.parquet, counts.schema)

    build(clean_lines(spark, sf, CLEAN_MISSING_DAY))
    lines = clean_lines(spark, sf)
    try:
        build(lines.withColumn("line", F.when(F.col("line") > "", F.raise_error(F.lit("lost source")).cast("string"))))
        raise AssertionError("the build should have failed")
    except PySparkException:
        pass
    versions.point_view(spark, view, root)
    if spark.table(view).where(F.col("fileName").contains(CLEAN_MISSING_DAY)).count():
        raise AssertionError("the failed build is visible")
    build(lines)
    versions.point_view(spark, view, root)
    versions.drop_old(spark, root, keep=1)
    counts = spark.table(view)
    day = F.regexp_extract("fileName", r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1).alias("day")
    return counts.groupBy(day, "name").agg(F.sum("occurrenceCount").alias("occurrenceCount"))


def q_dropped_export_counts(spark, sf):
    """The files of an external text table after its tables were dropped."""
    folder = _fresh_folder(spark, "external")
    counts = event_counts(clean_tagged(spark, sf), CLEAN_NAME_PATH)
    names = [f"external_{uuid.uuid4().hex}" for _ in range(2)]
    export_delimited(counts, folder, escape=True)
    for name in names:
        register_delimited(spark, name, folder, EVENT_COUNTS_SCHEMA, escape=True)
    drop_tables(spark, [*names, "never_there"])
    if any(spark.catalog.tableExists(name) for name in names):
        raise AssertionError("a table is still there")
    return read_delimited(spark, folder, EVENT_COUNTS_SCHEMA, escape=True)


# What lands late: whole days, and half of an earlier one.
_LATE_FROM, _LATE_HALF = "2024-01-25", "2024-01-05"


def _refreshed(spark: SparkSession, sf: str) -> tuple[SetupConfig, list[dict]]:
    """Both copies landed in two goes, with a refresh after each: (the tables, what each refresh did)."""
    def make() -> tuple[SetupConfig, list[dict]]:
        base = _fresh_folder(spark, "refresh")
        cfg = SetupConfig(raw_root=f"{base}/land/raw/metrics", clean_root=f"{base}/land/nom/clean",
                          output_root=f"{base}/out", recursive=True, raise_on_mismatch=True)
        day = F.regexp_extract("sourceFileAbsolutePath", r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
        late = (day >= _LATE_FROM) | ((day == _LATE_HALF) & (F.pmod(F.xxhash64("line"), F.lit(2)) == 0))
        done = []
        for go in (~late, late):
            write_daily_archives(raw_lines(spark, sf).where(go), cfg.raw_root, mode="append")
            write_daily_archives(event_json_lines(spark, sf).where(go), cfg.clean_root, mode="append")
            done.append(refresh(spark, cfg))
        return cfg, done

    return _once(spark, sf, "refreshed", make)


def _refreshed_table(spark: SparkSession, sf: str, *parts: str) -> DataFrame:
    return versions.read(spark, _refreshed(spark, sf)[0].path(*parts))


def q_refreshed_event_counts(spark, sf):
    return _by_day(_refreshed_table(spark, sf, "raw", "event_counts"))


def q_refreshed_reconcile(spark, sf):
    return _refreshed_table(spark, sf, "report", "reconcile").groupBy(_day("fileName")).agg(
        F.sum("masterEventCount").alias("masterEventCount"), F.sum("nomEventCount").alias("nomEventCount"))


def q_refreshed_dimensions(spark, sf):
    return _refreshed_table(spark, sf, "report", "dimensions").drop("archiveDay")


def q_refreshed_days(spark, sf):
    """The days that the second refresh checked archives of, and rewrote."""
    cfg, done = _refreshed(spark, sf)
    manifest = read_manifest(spark, cfg.path("clean", "landing_manifest"))
    last = manifest.agg(F.max("checkedAt")).first()[0]
    rewritten = spark.createDataFrame([(d,) for d in done[1]["clean"]["days"]], "day string")
    return manifest.where(F.col("checkedAt") == F.lit(last)).select(_day("path"), "reason").distinct().join(rewritten, "day", "full")


def q_blocked_dimensions(spark, sf):
    """The dimension rows with every event of more than four of them dealt in blocks."""
    return explode_dimensions(_typed_events(spark, sf, "serverTs", "siteId", "name", "meta"), block_rows=4)


QUERIES: dict[str, Query] = {
    "tag_lines": q_tag_lines,
    "file_line_counts": q_file_line_counts,
    "event_counts_raw": q_event_counts_raw,
    "event_counts_clean": q_event_counts_clean,
    "event_counts_props": q_event_counts_props,
    "counts_match": q_counts_match,
    "counts_differ": q_counts_differ,
    "counts_match_json": q_counts_match_json,
    "left_reconcile": q_left_reconcile,
    "reconcile": q_reconcile,
    "reconcile_spine": q_reconcile_spine,
    "distinct_files": q_distinct_files,
    "line_field": q_line_field,
    "line_name_raw": q_line_name_raw,
    "rare_keys": q_rare_keys,
    "rare_keys_by_digest": q_rare_keys_by_digest,
    "rare_event_ids": q_rare_event_ids,
    "typed_events": q_typed_events,
    "count_events": q_count_events,
    "explode_locations": q_explode_locations,
    "explode_dimensions": q_explode_dimensions,
    "calendar_parts": q_calendar_parts,
    "split_path": q_split_path,
    "scanned_events": q_scanned_events,
    "landing_manifest": q_landing_manifest,
    "landing_validity": q_landing_validity,
    "landed_event_counts": q_landed_event_counts,
    "streamed_event_counts": q_streamed_event_counts,
    "compacted_event_counts": q_compacted_event_counts,
    "streamed_lines": q_streamed_lines,
    "managed_lines": q_managed_lines,
    "staged_lines": q_staged_lines,
    "exported_event_counts": q_exported_event_counts,
    "setup_event_counts": q_setup_event_counts,
    "setup_reconcile": q_setup_reconcile,
    "setup_dimensions": q_setup_dimensions,
    "setup_checks": q_setup_checks,
    "replaced_event_counts": q_replaced_event_counts,
    "dropped_export_counts": q_dropped_export_counts,
    "refreshed_event_counts": q_refreshed_event_counts,
    "refreshed_reconcile": q_refreshed_reconcile,
    "refreshed_dimensions": q_refreshed_dimensions,
    "refreshed_days": q_refreshed_days,
    "blocked_dimensions": q_blocked_dimensions,
}

# What several queries read, made once per session: the bench times each for itself.
PREPARED: dict[str, Callable[[SparkSession, str], object]] = {
    "land_archives": _landed_archives,
    "check_archives": _checked_archives,
    "land_and_set_up": _setup,
    "land_and_refresh_twice": _refreshed,
}

# Shared DuckDB definitions of the derived frames (same rows as sources.tables).
_FRAMES = """
ev AS (SELECT *, strftime(ts, '%Y-%m-%d') AS d FROM events),
raw AS (
  SELECT 's3://lake/raw/metrics/' || d || '.gz' AS sourceFileAbsolutePath,
         '{"clientData":{"name":"' || event_type || '"},"siteId":"' || CAST(user_id AS VARCHAR) || '"}' AS line
  FROM ev),
clean AS (
  SELECT 's3://lake/nom/clean/' || d || '.gz' AS sourceFileAbsolutePath,
         '{"name":"' || event_type || '","siteId":"' || CAST(user_id AS VARCHAR) || '"}' AS line
  FROM ev),
raw_tagged AS (
  SELECT sourceFileAbsolutePath, string_split(sourceFileAbsolutePath, 'metrics/')[2] AS fileName, line
  FROM raw),
clean_tagged AS (
  SELECT sourceFileAbsolutePath, string_split(sourceFileAbsolutePath, 'clean/')[2] AS fileName, line
  FROM clean),
rm AS (SELECT sourceFileAbsolutePath, fileName, count(*) AS lineCount FROM raw_tagged
       WHERE fileName <> '2024-01-30.gz' GROUP BY ALL),
cm AS (SELECT sourceFileAbsolutePath, fileName, count(*) AS lineCount FROM clean_tagged
       WHERE fileName <> '2024-01-01.gz' GROUP BY ALL),
typed AS (
  SELECT CAST(event_id AS VARCHAR) AS eventId, event_type AS name, (epoch_us(ts) // 1000) AS serverTs,
         CAST(user_id AS VARCHAR) AS siteId, value AS zoomLevel,
         regexp_extract_all(event_type, '[aeiou]') AS locations,
         regexp_extract_all(props, '[0-9]') AS pseudoEvents,
         regexp_extract_all(CAST(user_id AS VARCHAR), '[5-9]') AS groups
  FROM events)
"""


def _with(body: str) -> str:
    return "WITH " + _FRAMES.strip() + "\n" + body.strip()


_CAL = "make_timestamp(CAST(ceil({ms} / 1000.0) AS BIGINT) * 1000000)"

# What the check finds of a day's archives, as they were damaged.
_REASON = ("CASE day(ts) % 5 WHEN 1 THEN 'truncated' WHEN 2 THEN 'bad-crc' "
           "WHEN 3 THEN 'trailing-garbage' ELSE 'ok' END")

_DAY_COUNTS = """
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS name, count(*) AS occurrenceCount
    FROM events GROUP BY ALL"""

ORACLE_SQL: dict[str, str] = {
    "tag_lines": _with("SELECT sourceFileAbsolutePath, fileName, line FROM clean_tagged"),
    "file_line_counts": _with("""
        SELECT sourceFileAbsolutePath, fileName, count(*) AS lineCount FROM raw_tagged GROUP BY ALL"""),
    "event_counts_raw": _with("""
        SELECT fileName, json_extract_string(line, '$.clientData.name') AS name,
               count(*) AS occurrenceCount
        FROM raw_tagged GROUP BY ALL"""),
    "event_counts_clean": _with("""
        SELECT fileName, json_extract_string(line, '$.name') AS name, count(*) AS occurrenceCount
        FROM clean_tagged GROUP BY ALL"""),
    "event_counts_props": """
        SELECT json_extract_string(props, '$.k') AS name, count(*) AS occurrenceCount
        FROM events GROUP BY ALL""",
    "counts_match": _with("""
        SELECT a.n AS sourceCount, b.n AS derivedCount, a.n = b.n AS isConsistent
        FROM (SELECT 1 AS k, count(*) AS n FROM raw) a
        JOIN (SELECT 1 AS k, count(*) AS n FROM raw_tagged) b ON a.k = b.k"""),
    "counts_differ": _with("""
        SELECT (SELECT count(*) FROM raw) AS sourceCount,
               (SELECT count(*) FROM clean_tagged WHERE fileName <> '2024-01-01.gz') AS derivedCount,
               (SELECT count(*) FROM raw) = (SELECT count(*) FROM clean_tagged WHERE fileName <> '2024-01-01.gz') AS isConsistent"""),
    "counts_match_json": """
        SELECT count(*) AS sourceCount, count(*) FILTER (event_id % 10 > 1) AS derivedCount,
               count(*) = count(*) FILTER (event_id % 10 > 1) AS isConsistent
        FROM events""",
    "left_reconcile": _with("""
        SELECT rm.fileName, rm.lineCount AS rawLineCount, cm.lineCount AS cleanLineCount
        FROM rm LEFT OUTER JOIN cm ON rm.fileName = cm.fileName"""),
    "reconcile": _with("""
        SELECT coalesce(r.fileName, c.fileName) AS fileName,
               CAST(coalesce(r.n, 0) AS BIGINT) AS masterEventCount,
               CAST(coalesce(c.n, 0) AS BIGINT) AS nomEventCount
        FROM (SELECT fileName, sum(lineCount) AS n FROM rm GROUP BY fileName) r
        FULL OUTER JOIN (SELECT fileName, sum(lineCount) AS n FROM cm GROUP BY fileName) c
          ON r.fileName IS NOT DISTINCT FROM c.fileName"""),
    "reconcile_spine": _with("""
        SELECT spine.fileName,
               coalesce(rm.lineCount, 0) AS masterEventCount,
               coalesce(cm.lineCount, 0) AS nomEventCount
        FROM (SELECT fileName FROM rm GROUP BY fileName
              UNION ALL
              SELECT fileName FROM cm GROUP BY fileName) AS spine
        LEFT OUTER JOIN rm ON spine.fileName = rm.fileName
        LEFT OUTER JOIN cm ON spine.fileName = cm.fileName"""),
    "distinct_files": _with("""
        SELECT fileName FROM rm GROUP BY fileName
        UNION ALL
        SELECT fileName FROM cm GROUP BY fileName"""),
    "line_field": _with("""
        SELECT fileName, json_extract_string(line, '$.siteId') AS siteId FROM clean_tagged"""),
    "line_name_raw": _with("""
        SELECT line, json_extract_string(line, '$.clientData.name') AS name FROM raw_tagged"""),
    "rare_keys": """
        SELECT text, counter FROM (
          SELECT text, count(text) AS counter FROM documents GROUP BY text) t
        WHERE counter = 1""",
    "rare_event_ids": _with("""
        SELECT eventId, counter FROM (
          SELECT eventId, count(eventId) AS counter FROM typed GROUP BY eventId) t
        WHERE counter = 1"""),
    "typed_events": _with("""
        SELECT eventId, name, serverTs, siteId, zoomLevel,
               CAST(len(locations) AS INTEGER) AS nLocations,
               CAST(len(pseudoEvents) AS INTEGER) AS nPseudoEvents,
               CAST(len(groups) AS INTEGER) AS nUaGroups
        FROM typed"""),
    "count_events": _with("SELECT count(*) AS rowCount FROM typed"),
    "scanned_events": _with("""
        SELECT eventId, name, serverTs, siteId, zoomLevel,
               CAST(len(locations) AS INTEGER) AS nLocations,
               CAST(len(pseudoEvents) AS INTEGER) AS nPseudoEvents,
               CAST(len(groups) AS INTEGER) AS nUaGroups
        FROM typed"""),
    "explode_locations": _with("""
        SELECT siteId, l.location FROM typed, unnest(typed.locations) AS l(location)"""),
    "explode_dimensions": _with(f"""
        SELECT CAST(year({_CAL.format(ms='serverTs')}) AS INTEGER) AS year,
               CAST(month({_CAL.format(ms='serverTs')}) AS INTEGER) AS month,
               CAST(day({_CAL.format(ms='serverTs')}) AS INTEGER) AS day,
               serverTs, siteId, name AS eventName, l.location, p.pseudoEvent, g.uaGroup
        FROM typed, unnest(typed.locations) AS l(location),
             unnest(typed.pseudoEvents) AS p(pseudoEvent),
             unnest(typed.groups) AS g(uaGroup)"""),
    "calendar_parts": f"""
        SELECT event_id, serverTs,
               CAST(year({_CAL.format(ms='serverTs')}) AS INTEGER) AS year,
               CAST(month({_CAL.format(ms='serverTs')}) AS INTEGER) AS month,
               CAST(day({_CAL.format(ms='serverTs')}) AS INTEGER) AS day
        FROM (SELECT event_id, (epoch_us(ts) // 1000) AS serverTs FROM events)""",
    "landing_manifest": f"""
        SELECT reason, reason = 'ok' AS isValid, count(DISTINCT day) AS days
        FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, {_REASON} AS reason FROM events) GROUP BY ALL""",
    "landing_validity": f"""
        SELECT DISTINCT day, reason = 'ok' AS isValid, reason
        FROM (SELECT strftime(ts, '%Y-%m-%d') AS day, {_REASON} AS reason FROM events)""",
    "landed_event_counts": f"""
        SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS name, count(*) AS occurrenceCount
        FROM events WHERE {_REASON} = 'ok' GROUP BY ALL""",
    "streamed_event_counts": _DAY_COUNTS,
    "compacted_event_counts": _DAY_COUNTS,
    "streamed_lines": _with("""
        SELECT d AS day, '{"name":"' || event_type || '","siteId":"' || CAST(user_id AS VARCHAR) || '"}' AS line FROM ev"""),
    "managed_lines": _with("""
        SELECT d AS day, event_type AS name,
               '{"clientData":{"name":"' || event_type || '"},"siteId":"' || CAST(user_id AS VARCHAR) || '"}' AS line FROM ev"""),
    "staged_lines": _with("SELECT eventId, name, siteId FROM typed"),
    "exported_event_counts": _DAY_COUNTS,
    "setup_event_counts": _DAY_COUNTS,
    "setup_reconcile": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS masterEventCount, count(*) AS nomEventCount
        FROM events GROUP BY ALL""",
    "setup_checks": """
        SELECT checkName, n AS sourceCount, n AS derivedCount, true AS isConsistent
        FROM (SELECT count(*) AS n FROM events),
             (SELECT unnest(['raw/lines_check', 'clean/lines_check', 'clean/stage_check', 'clean/json_check']) AS checkName)""",
    "split_path": """
        SELECT page_id, url, regexp_split_to_array(url, 'example[.]')[2] AS relativeName
        FROM pages""",
}

ORACLE_SQL["rare_keys_by_digest"] = ORACLE_SQL["rare_keys"]
ORACLE_SQL["replaced_event_counts"] = _DAY_COUNTS
ORACLE_SQL["dropped_export_counts"] = ORACLE_SQL["event_counts_clean"]
ORACLE_SQL["refreshed_event_counts"] = _DAY_COUNTS
ORACLE_SQL["refreshed_reconcile"] = ORACLE_SQL["setup_reconcile"]
ORACLE_SQL["refreshed_days"] = f"""
    SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day, 'ok' AS reason FROM events
    WHERE strftime(ts, '%Y-%m-%d') >= '{_LATE_FROM}' OR strftime(ts, '%Y-%m-%d') = '{_LATE_HALF}'"""
for _name in ("setup_dimensions", "refreshed_dimensions", "blocked_dimensions"):
    ORACLE_SQL[_name] = ORACLE_SQL["explode_dimensions"]

FLAGSHIP = "event_counts_clean"
