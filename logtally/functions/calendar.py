"""Epoch-millisecond time handling.

Events carry time as BIGINT epoch milliseconds. Calendar parts are computed
on the UTC calendar independent of the session time zone, by way of the
day number since 1970-01-01.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Day numbers of 0001-01-01 and 9999-12-31.
_DAYS = (-719162, 2932896)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_millis(ts: Column | str) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ (read as UTC) or TIMESTAMP."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _col(ts).cast("timestamp_ntz"))


def epoch_seconds(server_ms: Column | str, rounding: str = "ceil") -> Column:
    """Whole epoch seconds of an epoch-ms value.

    ``ceil`` keeps the original job's ``CEIL(serverTs/1000)``: an event at
    23:59:59.500 on 31 December belongs to the next day (and year).
    """
    ms = _col(server_ms)
    if rounding == "ceil":
        return F.ceil(ms / 1000)
    if rounding == "floor":
        return F.floor(ms / 1000)
    raise ValueError(f"rounding must be 'ceil' or 'floor', not {rounding!r}")


def calendar_parts(server_ms: Column | str, rounding: str = "ceil") -> tuple[Column, Column, Column]:
    """(year, month, day) of an epoch-ms column on the UTC calendar.

    The original query parsed the date with pattern ``yyyy-mm-dd`` where
    ``mm`` means minutes, which made every month 1. This computes the
    evident intent, the calendar date. A time whose day number fits no date
    has NULL parts; it never fails the job.
    """
    days = F.floor(epoch_seconds(server_ms, rounding) / 86400)
    day = F.date_from_unix_date(F.when(days.between(*_DAYS), days).try_cast("int"))
    return (
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    )
