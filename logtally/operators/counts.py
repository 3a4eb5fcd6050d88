"""Counting operators: per-file lines, per-file events, rare keys, count checks.

Every count is a hash aggregate with a map-side partial count, so a hot key
(one file or one name holding a third of the rows) is collapsed inside each
map task before the shuffle; the exchange carries one row per key per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.functions.json import json_field
from logtally.sources.lines import PATH_COL


def file_line_counts(tagged: DataFrame, ordered: bool = False) -> DataFrame:
    """``(sourceFileAbsolutePath, fileName, lineCount)``: lines per file (H5).

    Only the two path columns are read (Catalyst prunes ``line``). A gzip
    file is read by a single task, so the partial aggregate already holds
    the final count of most files and the shuffle is one row per file.
    """
    out = tagged.groupBy(PATH_COL, "fileName").agg(F.count(F.lit(1)).alias("lineCount"))
    return out.orderBy(F.asc("fileName")) if ordered else out


def event_counts(
    lines: DataFrame,
    json_path: str | None,
    group_cols: Sequence[str] = ("fileName",),
    line_col: str = "line",
    name_col: str = "name",
    ordered: bool = False,
) -> DataFrame:
    """``(*group_cols, name, occurrenceCount)``: events per file and name (H6).

    The name is a JSON path into the raw line; a line without it (blank,
    malformed, key missing) counts under a NULL name, its own group. With
    ``json_path=None`` the frame already holds the name in ``name_col``
    (see ``tag_lines(name_path=...)``).
    """
    name = F.col(name_col) if json_path is None else json_field(line_col, json_path)
    out = (lines.select(*group_cols, name.alias(name_col))
           .groupBy(*group_cols, name_col)
           .agg(F.count(F.lit(1)).alias("occurrenceCount")))
    if ordered:
        out = out.orderBy(*[F.asc(c) for c in group_cols], F.desc("occurrenceCount"))
    return out


def rare_keys(df: DataFrame, key: str, n: int = 1, counter: str = "counter",
              limit: int | None = None) -> DataFrame:
    """Keys that occur exactly ``n`` times -> ``(key, counter)`` (H3).

    ``count(key)`` counts non-NULL values, so the NULL key reports 0 and is
    only returned for ``n == 0``. ``limit`` is for display only: without an
    order it returns any ``limit`` matching keys.
    """
    out = (df.select(key).groupBy(key).agg(F.count(F.col(key)).alias(counter))
           .where(F.col(counter) == n))
    return out.limit(limit) if limit is not None else out


def counts_match(
    source: DataFrame,
    derived: DataFrame,
    source_name: str = "sourceCount",
    derived_name: str = "derivedCount",
    flag_name: str = "isConsistent",
) -> DataFrame:
    """One-row ``(sourceCount, derivedCount, isConsistent)`` check (H1).

    Both inputs are reduced to a side flag, unioned and counted in a single
    global aggregate: one job, no join, and no column of either input is
    read beyond what their own filters need.
    """
    side = "_isSource"
    both = source.select(F.lit(True).alias(side)).unionByName(
        derived.select(F.lit(False).alias(side)))
    return (both.agg(F.count_if(F.col(side)).alias(source_name),
                     F.count_if(~F.col(side)).alias(derived_name))
            .withColumn(flag_name, F.col(source_name) == F.col(derived_name)))


def assert_consistent(check: DataFrame, flag_name: str = "isConsistent") -> tuple:
    """Run a ``counts_match`` frame (one row) and raise if the counts differ."""
    row = check.first()
    if row is None or not row[flag_name]:
        raise AssertionError(f"row counts differ: {row}")
    return tuple(row)


def count_rows(df: DataFrame, name: str = "rowCount") -> DataFrame:
    """Lazy global ``COUNT(*)`` as a one-row frame (D1); never ``df.count()``
    inside a plan that is still being built."""
    return df.agg(F.count(F.lit(1)).alias(name))


def valid_json_rows(parsed: DataFrame, flag: Column | str = "_isValid") -> DataFrame:
    """Rows of a ``parse_events`` result that hold a JSON object."""
    return parsed.where(F.col(flag) if isinstance(flag, str) else flag)
