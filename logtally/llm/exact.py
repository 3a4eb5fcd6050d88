"""Exact dedup by content sort.

Texts are equal when they are identical without the characters blank and
U+0009 to U+000D. Sampled splitters range-partition the normalised content
(its first bytes, then its SHA-256, so a splitter never is a whole text), each
partition is sorted externally, and neighbouring rows are compared in full.
The original length and the identifier are the last parts of the range key, so
thousands of copies of one text are dealt over several partitions; only the
first and the last run of a partition can go on in another one. Those, and the
pieces of ``RUN_ROWS`` rows in which a longer run is given out, are put together by
their digest afterwards, so no task holds a run of any length. Rows that repeat
their identifier with their text are one task's, as a stream.

Defined results: a null text counts as empty; empty texts equal each other; of
equal texts the one with the most code points in the original stays, then the
smallest identifier (null last); of rows that repeat both, one stays. An empty
table gives an empty table. Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import SPACES, materialise
from logtally.session import ship_package

# Content bytes in the range key, before the digest decides.
PREFIX_CHARS = 32
# Rows of a run that are held together.
RUN_ROWS = 1 << 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", "")


def _sorted(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """Rows in content order: range-partitioned, then sorted in each partition.
    With ``carry`` the text goes along in ``row``, else as ``content``."""
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.substring(normalised(F.col(text_col)), 1, PREFIX_CHARS).alias("prefix"),
        F.sha2(normalised(F.col(text_col)), 256).alias("sha"),
        (-F.length(text)).cast("long").alias("shorter"),
        F.col(id_col).isNull().alias("no_id"), F.col(id_col).cast("long").alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row") if carry else text.alias("content"))
    key = ["prefix", "sha", "shorter", "no_id", "id"]
    return rows.repartitionByRange(*key).sortWithinPartitions(*key)


def _stripped(texts: pa.Array) -> list[bytes]:
    return [(x or b"").translate(None, SPACES) for x in texts.cast(pa.binary()).to_pylist()]


def _decide(limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per input row, given out when its run of equal texts ends or has ``limit``
    rows; only identifiers of the open piece are held. A piece is named by partition and number."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId() << 32
    schema = pa.schema([("id", pa.int64()), ("sha", pa.string()), ("keep_id", pa.int64()), ("shorter", pa.int64()),
                        ("size", pa.int64()), ("head", pa.bool_()), ("border", pa.bool_()), ("part", pa.int64())])
    out: dict[str, list] = {f: [] for f in schema.names}
    run: list = []
    last, sha, shorter, pieces = None, None, None, 0
    first, goes_on = True, False           # the partition's first run; pieces of the open run were given out

    def close(border: bool) -> None:
        n = len(run)
        out["id"] += run
        out["head"] += [True] + [False] * (n - 1)
        for name, value in (("sha", sha), ("keep_id", run[0]), ("shorter", shorter), ("size", n),
                            ("border", border), ("part", part + pieces)):
            out[name] += [value] * n

    for batch in batches:
        for text, digest, s, i in zip(_stripped(batch.column("content")), batch.column("sha").to_pylist(),
                                      batch.column("shorter").to_pylist(), batch.column("id").to_pylist()):
            same = text == last
            if run and not (same and len(run) < limit):
                close(first or goes_on or same)
                run, pieces, first, goes_on = [], pieces + 1, first and same, same
            if not run:
                last, sha, shorter = text, digest, s
            run.append(i)
        if out["id"]:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out = {f: [] for f in schema.names}
    if run:
        close(True)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _heads(text_col: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run with what it carries."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    last, held, first = None, None, True

    def out(batch: pa.RecordBatch, border: list[bool]) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row", "sha", "shorter", "no_id", "id")]
            + [pa.array(border, pa.bool_()), pa.array([part] * n, pa.int64())],
            names=["row", "sha", "shorter", "no_id", "id", "border", "part"])

    for batch in batches:
        starts = []
        for k, text in enumerate(_stripped(batch.column("row").field(text_col))):
            if last is None or text != last:
                starts.append(k)
            last = text
        if not starts:
            continue
        if held is not None:
            yield out(held, [first])
            first = False
        if len(starts) > 1:
            done = batch.take(pa.array(starts[:-1]))
            yield out(done, [first] + [False] * (len(starts) - 2))
            first = False
        held = batch.take(pa.array(starts[-1:]))
    if held is not None:
        yield out(held, [True])


def _winner() -> Column:
    return F.min(F.struct("shorter", "no_id", "id", "part"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_rows: int = RUN_ROWS) -> DataFrame:
    """``(<id>, keep_id, group_size, kept, text_sha256)``, one row per document."""
    runs = materialise(
        _sorted(docs, id_col, text_col, []).mapInArrow(
            partial(_decide, run_rows), "id long, sha string, keep_id long, shorter long, size long, head boolean, border boolean, part long"),
        "exact-runs")
    inner = runs.where(~F.col("border")).select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"), F.col("head").alias("kept"),
        F.col("sha").alias("text_sha256"))
    border = runs.where("border")
    # Two rows per partition, and one per piece of a long run.
    heads = border.where("head").select(
        "sha", "size", "shorter", F.col("keep_id").isNull().alias("no_id"), F.col("keep_id").alias("id"), "part")
    totals = heads.groupBy("sha").agg(F.sum("size").alias("total"), _winner().alias("w"))
    # Rows meet their run's totals by piece and digest, so copies of one text stay dealt out.
    outer = border.join(heads.select("sha", "part").join(totals, "sha"), ["part", "sha"]).select(
        F.col("id").alias(id_col), F.col("w.id").alias("keep_id"), F.col("total").alias("group_size"),
        (F.col("head") & (F.col("part") == F.col("w.part"))).alias("kept"), F.col("sha").alias("text_sha256"))
    return inner.unionByName(outer)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    heads = materialise(
        _sorted(docs, id_col, text_col, docs.columns).mapInArrow(
            partial(_heads, text_col), _head_schema(docs)), "exact-heads")
    border = heads.where("border")
    winners = border.groupBy("sha").agg(_winner().alias("w")).select(F.col("sha"), F.col("w.part").alias("part"))
    kept = heads.where(~F.col("border")).select("row").unionByName(
        border.join(winners, ["sha", "part"], "left_semi").select("row"))
    return kept.select("row.*")


def _head_schema(docs: DataFrame):
    from pyspark.sql import types as T
    return T.StructType([
        T.StructField("row", docs.schema), T.StructField("sha", T.StringType()), T.StructField("shorter", T.LongType()),
        T.StructField("no_id", T.BooleanType()), T.StructField("id", T.LongType()),
        T.StructField("border", T.BooleanType()), T.StructField("part", T.LongType())])
