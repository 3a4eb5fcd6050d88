"""The corpus pipeline: stages over ``documents``, each written as Parquet and
read again as the next one's input.

Language ID drops documents it cannot tell; exact dedup and SimHash near-dedup
keep one document of each group; mixing draws each document as often as its
source's target asks; encoding gives the token ids. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.llm import bpe, exact, langid, mixing, simhash
from logtally.llm.common import own_folder, scratch
from logtally.llm.queries import BPE_RANKS
from logtally.session import ensure_checkpoint_dir
from logtally.sinks import versions


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear, by what the labelled ones teach."""
    return langid.keep_identified(docs, docs.where(~langid.held_out()))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shingles of four words, at most four differing bits, as the operator's query has them."""
    return simhash.drop_near_copies(docs, shingle=simhash.SHINGLE, max_bits=simhash.MAX_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of each drawn copy."""
    return bpe.encode(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table. A stage's own folders go when its rows are written, and those of
    the stage before with them; what the last stage reads is left to the caller (or an outer ``scratch``)."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
        if before:
            versions.delete(spark, before)
        before = folder
    own_folder(before)
    return STAGES[-1][1](spark, docs, sf_dir)


# Compression, hashes and merges have no SQL form.
ORACLE_SQL: str | None = None
