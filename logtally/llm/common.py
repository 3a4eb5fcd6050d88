"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.session import ensure_checkpoint_dir
from logtally.sinks import versions

# Word separators of every contract here: blank and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = b" \t\n\x0b\x0c\r"


# Folders of the scratch blocks that are open, the innermost last.
_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns the folders that operators materialise inside the block, and drops them at its end, also after
    an error. Write the result inside: frames that read those folders are of no use afterwards."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            versions.delete(spark, path)


def own_folder(path: str) -> None:
    """Leave a folder to the innermost ``scratch`` block, if one is open."""
    if _OPEN:
        _OPEN[-1].append(path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared checkpoint folder and
    read it back. Cuts the lineage and survives lost executors. The folder stays
    until the innermost ``scratch`` block ends; without one the caller owns it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    own_folder(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))
