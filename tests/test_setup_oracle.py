"""The whole setup DAG over real gzip archives landed from ``events``,
checked against DuckDB on the source table (per day: part-file names are
chosen by Spark)."""

import duckdb
import pytest
from pyspark.sql import functions as F

from logtally.plans.setup import EVENT_COUNTS_SCHEMA, SetupConfig, run_setup
from logtally.sinks import versions
from logtally.sinks import read_delimited
from logtally.sources.tables import clean_lines, raw_lines, write_daily_archives
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def day():
    return F.regexp_extract("fileName", r"day=([0-9-]{10})/", 1).alias("d")

FRAMES = f"""
WITH ev AS (SELECT *, strftime(ts, '%Y-%m-%d') AS d FROM read_parquet('{SF}/events.parquet')),
raw AS (SELECT d, event_type AS name FROM ev),
clean AS (SELECT d, event_type AS name FROM ev)
"""


def duck(sql):
    return sorted(duckdb.sql(FRAMES + sql).fetchall(), key=repr)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    write_daily_archives(raw_lines(spark, SF), str(base / "land" / "raw" / "metrics"))
    write_daily_archives(clean_lines(spark, SF), str(base / "land" / "nom" / "clean"))
    cfg = SetupConfig(raw_root=str(base / "land" / "raw" / "metrics"),
                      clean_root=str(base / "land" / "nom" / "clean"),
                      output_root=str(base / "out"), recursive=True)
    return cfg, run_setup(spark, cfg)


def test_checks(built):
    cfg, results = built
    n_raw, n_clean = duck("SELECT (SELECT count(*) FROM raw), (SELECT count(*) FROM clean)")[0]
    assert results[cfg.path("raw", "lines_check")] == (n_raw, n_raw, True)
    assert results[cfg.path("clean", "lines_check")] == (n_clean, n_clean, True)
    assert results[cfg.path("clean", "json_check")] == (n_clean, n_clean, True)


def test_line_counts_per_day(spark, built):
    cfg, _ = built
    meta = versions.read(spark, cfg.path("raw", "file_meta"))
    got = rows(meta.groupBy(day()).agg(F.sum("lineCount").cast("long")))
    assert got == duck("SELECT d, count(*) FROM raw GROUP BY d")


def test_event_counts_per_day(spark, built):
    cfg, _ = built
    counts = versions.read(spark, cfg.path("raw", "event_counts"))
    got = rows(counts.groupBy(day(), "name")
               .agg(F.sum("occurrenceCount").cast("long")))
    assert got == duck("SELECT d, name, count(*) FROM raw GROUP BY ALL")
    clean = read_delimited(spark, versions.folder(spark, cfg.path("clean", "event_counts")), EVENT_COUNTS_SCHEMA, escape=True)
    got = rows(clean.groupBy(day(), "name").agg(F.sum("occurrenceCount").cast("long")))
    assert got == duck("SELECT d, name, count(*) FROM clean GROUP BY ALL")


def test_reconcile_totals(spark, built):
    cfg, _ = built
    rec = versions.read(spark, cfg.path("report", "reconcile"))
    got = rec.agg(F.sum("masterEventCount"), F.sum("nomEventCount")).first()
    want = duck("SELECT (SELECT count(*) FROM raw), (SELECT count(*) FROM clean)")[0]
    assert tuple(got) == want
    # every landed archive is a distinct name: no name is on both sides
    assert rec.where("masterEventCount > 0 AND nomEventCount > 0").count() == 0
