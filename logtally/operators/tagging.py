"""Tag every line with the file it came from (H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.functions.json import json_field
from logtally.functions.paths import relative_name
from logtally.sources.lines import PATH_COL


def tag_lines(lines: DataFrame, marker: str, path_col: str = PATH_COL,
              line_col: str = "line", name_path: str | None = None) -> DataFrame:
    """``(sourceFileAbsolutePath, fileName, line)``, fileName being the path
    after ``marker`` (see ``relative_name``). A narrow projection: no shuffle.

    With ``name_path`` the event name is extracted once here into a ``name``
    column (placed before ``line``), so later counts over a written table
    read two small dictionary-encoded columns instead of re-parsing lines.
    """
    cols = [
        F.col(path_col).alias(PATH_COL),
        relative_name(F.col(path_col), marker).alias("fileName"),
    ]
    if name_path is not None:
        cols.append(json_field(F.col(line_col), name_path).alias("name"))
    return lines.select(*cols, F.col(line_col).alias("line"))
