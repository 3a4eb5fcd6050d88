"""Raw-vs-clean reconciliation of per-file line counts (H2, H2b, D5+G1).

Meta tables hold one row per file. ``reconcile`` and ``reconcile_spine`` are
single aggregations over the union of both sides (no join at all), so a file
name shared by many paths can never multiply rows; ``left_reconcile`` is a
many-to-one join against the clean side pre-aggregated per name, which AQE
may turn into a broadcast join once the runtime size of that side is known,
and whose hot keys AQE's skew-join handling splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SIDE = "_isRaw"
_COUNT = "lineCount"
# The report's output column names.
MASTER_COUNT = "masterEventCount"
NOM_COUNT = "nomEventCount"


def _sides(raw_meta: DataFrame, clean_meta: DataFrame, key: str) -> DataFrame:
    return raw_meta.select(key, F.col(_COUNT), F.lit(True).alias(_SIDE)).unionByName(
        clean_meta.select(key, F.col(_COUNT), F.lit(False).alias(_SIDE)))


def _side_totals(raw_meta: DataFrame, clean_meta: DataFrame, key: str) -> DataFrame:
    return _sides(raw_meta, clean_meta, key).groupBy(key).agg(
        F.sum(F.when(F.col(_SIDE), F.col(_COUNT))).alias("_raw"),
        F.sum(F.when(~F.col(_SIDE), F.col(_COUNT))).alias("_clean"),
        F.max(F.col(_SIDE).cast("int")).alias("_inRaw"),
        F.max((~F.col(_SIDE)).cast("int")).alias("_inClean"),
    )


def reconcile(raw_meta: DataFrame, clean_meta: DataFrame, key: str = "fileName") -> DataFrame:
    """``(fileName, masterEventCount, nomEventCount)``, one row per file name.

    Line counts are summed per name on each side; a name missing on one side
    reports 0 there. NULL names form one row of their own.
    """
    return _side_totals(raw_meta, clean_meta, key).select(
        key,
        F.coalesce(F.col("_raw"), F.lit(0)).cast("long").alias(MASTER_COUNT),
        F.coalesce(F.col("_clean"), F.lit(0)).cast("long").alias(NOM_COUNT),
    )


def reconcile_spine(raw_meta: DataFrame, clean_meta: DataFrame, key: str = "fileName") -> DataFrame:
    """The original report's rows: a ``UNION ALL`` spine of each side's names.

    A name present on both sides appears twice, a NULL name reports 0/0 once
    per side that has it (NULL never matched in the join). Counts are summed
    per name, so where several paths share a name this gives one row with
    the total instead of the original's raw x clean row pairs.
    """
    totals = _side_totals(raw_meta, clean_meta, key)
    copies = F.col("_inRaw") + F.col("_inClean")
    known = F.col(key).isNotNull()
    return totals.select(
        key,
        F.when(known, F.coalesce(F.col("_raw"), F.lit(0))).otherwise(F.lit(0))
        .cast("long").alias(MASTER_COUNT),
        F.when(known, F.coalesce(F.col("_clean"), F.lit(0))).otherwise(F.lit(0))
        .cast("long").alias(NOM_COUNT),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")


def left_reconcile(raw_meta: DataFrame, clean_meta: DataFrame, key: str = "fileName") -> DataFrame:
    """``(fileName, rawLineCount, cleanLineCount)``: each raw file with the
    clean count of its name, NULL where no clean copy exists (H2b).

    A NULL name never matches. Rather than letting all such rows hash to one
    reducer of a shuffled join, each gets a deterministic stand-in key (a
    NUL-prefixed hash of its row, which no file name takes) that spreads them
    evenly and still finds no partner.
    """
    salt = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c) for c in raw_meta.columns])
                    .cast("string"))
    raw = raw_meta.select(key, F.col(_COUNT).alias("rawLineCount"),
                          F.coalesce(F.col(key), salt).alias("_joinKey"))
    clean_by_name = (clean_meta.where(F.col(key).isNotNull()).groupBy(key)
                     .agg(F.sum(_COUNT).alias("cleanLineCount"))
                     .withColumnRenamed(key, "_joinKey"))
    return (raw.join(clean_by_name, on="_joinKey", how="left")
            .select(key, "rawLineCount", "cleanLineCount"))


def distinct_files(raw_meta: DataFrame, clean_meta: DataFrame, key: str = "fileName") -> DataFrame:
    """Each side's distinct names, concatenated (``UNION ALL``) (D5 + G1)."""
    return raw_meta.select(key).distinct().unionAll(clean_meta.select(key).distinct())
