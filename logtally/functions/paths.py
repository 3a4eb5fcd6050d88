"""File-path columns: provenance decoding and the name-under-root split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_file_path(path: Column | str) -> Column:
    """Undo the percent-encoding of ``_metadata.file_path``.

    Spark reports ``day 2.gz`` as ``day%202.gz``. ``url_decode`` would also
    turn ``+`` into a space, so a literal ``+`` is protected first. Paths that
    are not valid encodings are kept as they are.
    """
    p = _col(path)
    decoded = F.try_url_decode(F.regexp_replace(p, r"\+", "%2B"))
    return F.coalesce(decoded, p)


def relative_name(path: Column | str, marker: str) -> Column:
    """The piece of ``path`` after ``marker`` (a regex, as in Hive's SPLIT).

    Equivalent to ``SPLIT(path, marker)[1]`` with two safe edges: a path
    without the marker gives NULL (ANSI ``[1]`` would raise), and a path with
    the marker twice keeps only the piece between the two occurrences.
    """
    return F.get(F.split(_col(path), marker), 1)
