"""The driver's parquet test tables and the log frames derived from them.

The test tables hold no landed log files, so line frames are derived from
``events``: one "file" per day, the raw copy nesting the event name under
``clientData``. Both copies hold every event; for reconciliation, which is about
files of one side only, each can be had without one day the other has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.calendar import epoch_millis
from logtally.session import ship_package
from logtally.sources.landing import list_archives, open_archive, qualified, resolve
from logtally.sources.lines import PATH_COL

# Fixed values of the derived line frames.
RAW_ROOT = "s3://lake/raw/metrics/"
CLEAN_ROOT = "s3://lake/nom/clean/"
RAW_MARKER = "metrics/"
CLEAN_MARKER = "clean/"
RAW_MISSING_DAY = "2024-01-30"
CLEAN_MISSING_DAY = "2024-01-01"
RAW_NAME_PATH = "$.clientData.name"
CLEAN_NAME_PATH = "$.name"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(ts: str = "ts"):
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def _outside_day(day: str, ts: str = "ts"):
    """``ts`` not on calendar ``day``, as a range the Parquet scan can prune on."""
    start = F.lit(day).cast("timestamp_ntz")
    end = F.lit(day).cast("date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return (F.col(ts) < start) | (F.col(ts) >= end)


def _events(spark: SparkSession, sf_dir: str, missing_day: str | None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.where(_outside_day(missing_day)) if missing_day else ev


def raw_lines(spark: SparkSession, sf_dir: str, missing_day: str | None = None) -> DataFrame:
    """``(sourceFileAbsolutePath, line)`` of the raw copy."""
    return _events(spark, sf_dir, missing_day).select(
        F.concat(F.lit(RAW_ROOT), _day(), F.lit(".gz")).alias(PATH_COL),
        F.to_json(F.struct(
            F.struct(F.col("event_type").alias("name")).alias("clientData"),
            F.col("user_id").cast("string").alias("siteId"))).alias("line"),
    )


def clean_lines(spark: SparkSession, sf_dir: str, missing_day: str | None = None) -> DataFrame:
    """``(sourceFileAbsolutePath, line)`` of the clean copy."""
    return _events(spark, sf_dir, missing_day).select(
        F.concat(F.lit(CLEAN_ROOT), _day(), F.lit(".gz")).alias(PATH_COL),
        F.to_json(F.struct(
            F.col("event_type").alias("name"),
            F.col("user_id").cast("string").alias("siteId"))).alias("line"),
    )


def event_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sourceFileAbsolutePath, line)``: each event as a typed telemetry JSON object.

    The arrays are drawn from the row's own values so their lengths vary and
    some are empty: locations = vowels of the event type, pseudoEvents =
    digits of ``props``, ua.groups = digits 5-9 of the user id.
    """
    ev = table(spark, sf_dir, "events")
    site = F.col("user_id").cast("string")
    return ev.select(F.concat(F.lit(CLEAN_ROOT), _day(), F.lit(".gz")).alias(PATH_COL), F.to_json(F.struct(
        F.col("event_id").cast("string").alias("eventId"),
        F.struct(
            F.regexp_extract_all("event_type", F.lit("[aeiou]"), 0).alias("locations"),
            F.regexp_extract_all("props", F.lit("[0-9]"), 0).alias("pseudoEvents"),
            F.struct(F.regexp_extract_all(site, F.lit("[5-9]"), 0).alias("groups")).alias("ua"),
        ).alias("meta"),
        F.col("event_type").alias("name"),
        epoch_millis("ts").alias("serverTs"),
        site.alias("siteId"),
        F.col("value").alias("zoomLevel"),
    )).alias("line"))


# What happens to an archive of a day by the day's number: every fifth loses
# its end, the next has another checksum, the next bytes after the last member.
DAMAGES = {1: "truncated", 2: "bad-crc", 3: "trailing-garbage"}


def _damaged(data: bytes, kind: str | None) -> bytes:
    if kind == "truncated":
        return data[:len(data) // 2]
    if kind == "bad-crc":
        return data[:-8] + bytes(b ^ 0xFF for b in data[-8:-4]) + data[-4:]
    return data + b"garbage" if kind else data


def copy_damaged(spark: SparkSession, root: str, target: str) -> str:
    """Copy the daily archives of ``root`` (test data, an archive per task) to
    ``target``, those of some days damaged (``DAMAGES`` by day of month modulo 5)."""
    base, into = qualified(spark, root), qualified(spark, target)

    def copy(batches):
        for pdf in batches:
            for path in pdf["path"]:
                relative = path[len(base) + 1:]
                with open_archive(path) as stream:
                    data = stream.read()
                day = relative.split("day=", 1)[1][:10]
                filesystem, out = resolve(f"{into}/{relative}")
                filesystem.create_dir(out.rsplit("/", 1)[0], recursive=True)
                with filesystem.open_output_stream(out, compression=None) as sink:
                    sink.write(_damaged(data, DAMAGES.get(int(day[-2:]) % 5)))
            yield pdf

    ship_package(spark)
    list_archives(spark, root, recursive=True).select("path").mapInPandas(copy, "path string").count()
    return target


def write_daily_archives(lines: DataFrame, root: str, mode: str = "error") -> str:
    """Land ``(sourceFileAbsolutePath, line)`` as gzip text archives, one
    folder per day (``day=YYYY-MM-DD``) taken from the path; with the mode
    ``append`` next to what is there. Lines are rebalanced first: Spark sorts a
    task's lines by day."""
    day = F.regexp_extract(F.col(PATH_COL), r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)
    (lines.select("line", day.alias("day")).hint("rebalance", "day")
     .write.mode(mode).partitionBy("day").option("compression", "gzip").text(root))
    return root
