"""Writers for the derived tables.

Every write is a full refresh (overwrite) through Spark's commit protocol, so
a job that loses executors and retries tasks, or is rerun whole, leaves one
complete copy.

File sizing needs no extra shuffle: map-only writes inherit input splits,
which the scan already bin-packs to ``maxPartitionBytes`` (small files are
combined), and aggregate outputs inherit AQE-coalesced shuffle partitions.
``rebalance=True`` adds a ``REBALANCE`` exchange (AQE sizes its partitions
toward ``advisoryPartitionSizeInBytes``) for inputs that are neither; it is a
full shuffle of the frame, so it stays off by default.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the delimited text export: Hive's default text table
# layout, Ctrl-A between fields and \N for NULL.
FIELD_SEP = "\x01"
NULL_TOKEN = "\\N"


def write_managed(
    df: DataFrame,
    path: str,
    table: str | None = None,
    fmt: str = "parquet",
    rebalance: bool = False,
    compression: str = "snappy",
    partition_by: Iterable[str] = (),
    bucket_by: Iterable[str] = (),
    buckets: int = 0,
) -> str:
    """Overwrite ``path`` with ``df`` (Parquet by default) and optionally
    register it as table ``table`` over that location. Returns the path.

    ``bucket_by`` with ``buckets`` writes a bucketed table (it needs
    ``table``): later aggregations and joins on those keys read it already
    hash-distributed and skip their shuffle.
    """
    out = df.hint("rebalance") if rebalance else df
    writer = (out.write.mode("overwrite").format(fmt).option("compression", compression))
    parts = list(partition_by)
    if parts:
        writer = writer.partitionBy(*parts)
    keys = list(bucket_by)
    if keys:
        if not table or buckets <= 0:
            raise ValueError("bucketing needs a table name and a positive bucket count")
        writer = writer.bucketBy(buckets, *keys)
    if table:
        writer.option("path", path).saveAsTable(table)
    else:
        writer.save(path)
    return path


def stage_lines(lines: DataFrame, path: str, source_paths: Iterable[str] = (),
                line_col: str = "line", compression: str = "snappy",
                rebalance: bool = False) -> str:
    """Rewrite the line column as compressed text in larger chunks (B4).

    The stage directory must never be an input of the same job, since an
    overwrite deletes it before the read finishes.
    """
    target = path.rstrip("/")
    for src in source_paths:
        s = src.rstrip("/")
        if s == target or s.startswith(target + "/") or target.startswith(s + "/"):
            raise ValueError(f"stage target {path!r} overlaps its source {src!r}")
    out = lines.select(line_col)
    out = out.hint("rebalance") if rebalance else out
    out.write.mode("overwrite").option("compression", compression).text(path)
    return path


# Characters a row of the layout cannot hold, and how they are escaped; the
# backslash first, so that an escape is never taken for a value.
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), (FIELD_SEP, "\\a"))


def _field(value: Column, escape: bool) -> Column:
    text = value.cast("string")
    if escape:
        for raw, escaped in _ESCAPES:
            text = F.replace(text, F.lit(raw), F.lit(escaped))
    else:
        fits = ~text.rlike("[\n\r\x01]") & (text != NULL_TOKEN)
        text = F.when(fits | text.isNull(), text).otherwise(
            F.raise_error(F.concat(F.lit("a delimited row cannot hold this value: "), text)).cast("string"))
    return F.coalesce(text, F.lit(NULL_TOKEN))


def export_delimited(df: DataFrame, path: str, compression: str | None = None,
                     rebalance: bool = False, escape: bool = False) -> str:
    """Write ``df`` as text rows with Ctrl-A separators and ``\\N`` for NULL,
    the layout an external text table over ``path`` expects (B3).

    Values are written byte for byte: blanks, quotes, backslashes and commas
    stay, the empty string and NULL are told apart. A line break, a Ctrl-A
    or the text ``\\N`` does not fit a row: by default the write fails and
    names the value; with ``escape`` they are backslash-escaped, as in a text
    table declared with an escape character (a backslash is doubled then), and
    ``read_delimited`` gives them back.
    """
    out = df.hint("rebalance") if rebalance else df
    row = F.concat_ws(FIELD_SEP, *[_field(F.col(f"`{c}`"), escape) for c in df.columns])
    writer = out.select(row.alias("value")).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
    return path


def _delimited_fields(schema: T.StructType, escape: bool) -> list[str]:
    """SQL expressions of an export's columns over a text column ``value``."""
    slash = "char(92)"
    out = []
    for k, field in enumerate(schema.fields):
        text = plain = f"split(value, char({ord(FIELD_SEP)}), -1)[{k}]"
        if escape:
            part = "x"
            for raw, escaped in _ESCAPES[1:]:
                part = f"replace({part}, concat({slash}, '{escaped[1]}'), char({ord(raw)}))"
            # Between doubled backslashes every single one begins an escape. Four match two.
            plain = f"array_join(transform(split({text}, repeat({slash}, 4), -1), x -> {part}), {slash})"
        null = f"{text} = concat({slash}, '{NULL_TOKEN[1]}')"
        out.append(f"CAST(if({null}, NULL, {plain}) AS {field.dataType.simpleString()}) AS `{field.name}`")
    return out


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, escape: bool = False) -> DataFrame:
    """Rows of an ``export_delimited`` folder; NULL and the empty string distinct."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.text(path).selectExpr(*_delimited_fields(wanted, escape))


def _folder_view(spark: SparkSession, name: str, path: str, fields: list[str]) -> None:
    folder = path.replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(fields)} FROM text.`{folder}`")


def register_delimited(spark: SparkSession, name: str, path: str, schema: T.StructType | str,
                       escape: bool = False) -> None:
    """Make an export readable as ``spark.table(name)``: a catalog view over its
    text folder. Dropping it keeps the files (B7)."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    _folder_view(spark, name, path, _delimited_fields(wanted, escape))


def register_lines(spark: SparkSession, name: str, path: str, line_col: str = "line") -> None:
    """The same for staged lines."""
    _folder_view(spark, name, path, [f"value AS `{line_col}`"])


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Drop each table or view if it is there (B6). External data survives."""
    for name in names:
        kind = spark.catalog.getTable(name).tableType if spark.catalog.tableExists(name) else "TABLE"
        spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {name}")
