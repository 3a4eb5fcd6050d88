"""Flatten nested event arrays into dimension rows (H7, H8)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.calendar import calendar_parts


def explode_locations(events: DataFrame) -> DataFrame:
    """``(siteId, location)``: one row per element of ``meta.locations``.

    Non-OUTER explode: an event with a NULL or empty array yields no row.
    """
    return events.select("siteId", F.explode("meta.locations").alias("location"))


def _block_expr(array: str, size: int) -> str:
    """An array cut into arrays of at most ``size`` elements."""
    return f"transform(sequence(0, (size({array}) - 1) div {size}), i -> slice({array}, i * {size} + 1, {size}))"


def explode_dimensions(events: DataFrame, rounding: str = "ceil", keep: tuple[str, ...] = (),
                       block_rows: int | None = None) -> DataFrame:
    """The flat dimension table: year, month, day, serverTs, siteId,
    eventName, location, pseudoEvent, uaGroup; columns ``keep`` go along before them.

    Three chained explodes give, per event, every combination of location x
    pseudo event x UA group (so one empty array drops the event). Columns are narrowed
    before the generators and the result is meant to be written, not cached.

    With ``block_rows``, an event that gives more rows than that is not left to one
    task: its arrays are cut into blocks whose combinations give at most ``block_rows``
    rows each, and those are dealt over the tasks before the elements are combined.
    Other events are not shuffled. The events are read twice then, so they should
    come from a table.
    """
    year, month, day = calendar_parts("serverTs", rounding)
    arrays = ["_loc", "_pse", "_grp"]
    narrow = events.select(
        *keep, "serverTs", "siteId", F.col("name").alias("eventName"),
        F.col("meta.locations").alias("_loc"),
        F.col("meta.pseudoEvents").alias("_pse"),
        F.col("meta.ua.groups").alias("_grp"),
    )
    if block_rows is not None:
        # (An event with a NULL array passes neither filter: it has no rows.)
        rows = F.expr(" * ".join(f"CAST(size({a}) AS DOUBLE)" for a in arrays))
        large, side = narrow.where(rows > block_rows), max(1, math.floor(block_rows ** (1 / 3) + 1e-9))
        for a in arrays:
            large = large.withColumn(a, F.explode(F.expr(_block_expr(a, side))))
        tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        narrow = narrow.where(rows <= block_rows).unionByName(large.repartition(tasks))
    return (
        narrow.withColumn("location", F.explode("_loc"))
        .withColumn("pseudoEvent", F.explode("_pse"))
        .withColumn("uaGroup", F.explode("_grp"))
        .select(*keep, year, month, day, "serverTs", "siteId", "eventName",
                "location", "pseudoEvent", "uaGroup")
    )
