"""Mixing sources to target weights by systematic sampling, in DataFrame
functions only.

Sources in code point order (null last) weigh 5, 2, 1, repeating, and share the
words of all documents; a target stops at three times its source's words and
the excess goes to the others by weight. Each document's expected copies are
its source's target over its source's words. Their prefix sum runs within the
source over documents by size, one pseudo-random offset per source is added,
and a copy is given out at each integer the sum passes.

The prefix sum has two levels, so no task holds a source: counts per
(source, size class, hash bucket) are summed before the shuffle, a window over
those counts gives each bucket's start, and rows are numbered within their
bucket. Steps are integers in units of 1 / 2**24 copies: reruns agree to the row.

Defined results: a null text has no words; null is a source of its own; a
source without words gives each of its documents once; an empty table gives an
empty table; rows that repeat are drawn each by its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from logtally.llm.common import WORD, materialise

UNIT = 1 << 24
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
# Hash buckets of a (source, size class): 64 at least, one per 65,536 rows of the table.
LEAST_BUCKETS = 64
ROWS_PER_BUCKET = 65536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hex_number(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _source_key() -> Column:
    """The source as a string that is never null, and apart for null."""
    return F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``(source, source_size)`` -> plus ``weight, target``. One row per source:
    the windows without partitions order sources, never documents."""
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int")).cast("long")
    ranked = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * most)
    # Sources fill up in the order of most / weight; the level of the first that
    # does not fill is the common level of all that remain.
    by_fill = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(W.unboundedPreceding, -1)
    after = by_fill.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = ((F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    levelled = ranked.withColumn("level", level)
    common = F.min(F.when(F.col("level") * F.col("weight") <= F.col("most"), F.struct(F.col("most") / F.col("weight"), F.col("level")))
                   ).over(W.partitionBy())["level"]
    return levelled.withColumn("common", common).select(
        "source", "source_size", "weight",
        F.least(F.col("weight") * F.col("common"), F.col("most").cast("double")).alias("target"))


def _drawn(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str]) -> DataFrame:
    text, ident = F.col(text_col), F.col(id_col).cast("string")
    content = F.concat(F.coalesce(ident, F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    measured = [F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
                _hex_number(content, 8).alias("draw")]
    # The texts are read here, once; sources, counts and (without rows to carry) the rows come from what is written.
    narrow = materialise(docs.select(*measured), "mix-sizes")
    wide = docs.select(*measured, F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")) if carry else narrow
    buckets = max(LEAST_BUCKETS, -(-narrow.count() // ROWS_PER_BUCKET))

    def placed_in(rows: DataFrame) -> DataFrame:
        return rows.withColumn("class", F.length(F.bin("size"))).withColumn("key", _source_key()).withColumn(
            "bucket", F.pmod("draw", F.lit(buckets)))

    rows = placed_in(wide)
    counts = placed_in(narrow).groupBy("key", "source", "class", "bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("words"))
    sources = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")))
    step = F.when(F.col("source_size") > 0,
                  F.floor(F.col("target") / F.col("source_size") * UNIT).cast("long")).otherwise(F.lit(UNIT).cast("long"))
    offset = _hex_number(F.concat(F.lit(SEED + ":"), _source_key()), 6)
    sources = sources.select(_source_key().alias("key"), "source_size", "target", step.alias("step"), offset.alias("offset"))
    ahead = W.partitionBy("key").orderBy("class", "bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    starts = starts.join(sources, "key").select("key", "class", "bucket", "start", "source_size", "target", "step", "offset")
    # The window takes the rows as the join left them: one shuffle for both.
    placed = rows.join(starts, ["key", "class", "bucket"])
    order = W.partitionBy("key", "class", "bucket").orderBy("size", "id", "draw")
    passed = F.col("start") + F.row_number().over(order)
    whole = lambda n: F.shiftright(n * F.col("step") + F.col("offset"), 24)  # noqa: E731  24: of UNIT
    return placed.withColumn("passed", passed.cast("long")).withColumn(
        "copies", whole(F.col("passed")) - whole(F.col("passed") - 1))


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(<id>, size, source_size, target, taken, copies)``, one row per document."""
    return _drawn(docs, id_col, text_col, source_col, []).select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is drawn."""
    drawn = _drawn(docs, id_col, text_col, source_col, docs.columns).where("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
