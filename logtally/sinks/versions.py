"""Tables that are replaced, or rewritten in part, without a gap.

A versioned table is a folder of data folders and commits::

    <root>/data/<id>/...        one per write, never changed afterwards
    <root>/_commits/<number>    JSON: the folders the table consists of, by part, and its schema

A write goes to a data folder of its own. When it is complete, a commit with the next
number names the folders of the table from then on: the new one alone (``replace``), it
and all others (``append``), or it in the place of the parts it rewrites, such as days
(``replace_parts``). Readers take the last complete commit, so they see the old table or
the new one, never none and never half of one; a write that fails leaves the table as it
was. Commit files are created, never overwritten: of two writers at once the second finds
its number taken, looks at the first one's commit and adds its own to that. ``drop_old``
removes what no recent commit names.

A folder without commits is read as it is, a table of one plain part.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The part of a table that was written as a whole.
WHOLE = ""
# Writers that may commit between one's look and its commit.
ATTEMPTS = 100


def _path(spark: SparkSession, path: str):
    """(Hadoop file system, path in it)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _commits(root: str) -> str:
    return f"{root.rstrip('/')}/_commits"


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder."""
    fs, p = _path(spark, path)
    return fs.getContentSummary(p).getLength()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _read_commit(spark: SparkSession, root: str, name: str) -> dict | None:
    """A commit; None if it is still being written, or was left half written."""
    try:
        found = json.loads(read_text(spark, f"{_commits(root)}/{name}") or "")
    except ValueError:
        return None
    return found if isinstance(found, dict) else None


def _last(spark: SparkSession, root: str) -> tuple[int, dict | None]:
    """(highest number taken, last complete commit)."""
    taken = [n for n in names(spark, _commits(root)) if n.isdigit()]
    for name in reversed(taken):
        found = _read_commit(spark, root, name)
        if found is not None:
            return int(taken[-1]), found
    return int(taken[-1]) if taken else 0, None


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file unless it is there."""
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception as error:  # noqa: BLE001 - Py4J wraps the file system's own error
        if "AlreadyExists" in str(error) or "already exists" in str(error):
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/data/{int(time.time() * 1000):013d}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def commit(spark: SparkSession, root: str, change: Callable[[dict[str, str]], dict[str, str]],
           schema: T.StructType | None = None) -> int:
    """Make ``change`` of the table's parts its next state. Returns the commit's number."""
    for _ in range(ATTEMPTS):
        number, old = _last(spark, root)
        parts = change(dict(old["parts"]) if old else {})
        kept = schema.jsonValue() if schema is not None else (old or {}).get("schema")
        base = root.rstrip("/") + "/"
        relative = {k: v[len(base):] if v.startswith(base) else v for k, v in parts.items()}
        if create(spark, f"{_commits(root)}/{number + 1:020d}", json.dumps({"parts": relative, "schema": kept})):
            return number + 1
    raise RuntimeError(f"{ATTEMPTS} other commits came first: {root}")


def parts(spark: SparkSession, root: str) -> dict[str, str] | None:
    """Folder by part, or None if nothing was committed."""
    _, last = _last(spark, root)
    return None if last is None else {k: f"{root.rstrip('/')}/{v}" for k, v in last["parts"].items()}


def folders(spark: SparkSession, root: str) -> list[str]:
    """The folders the table consists of now."""
    found = parts(spark, root)
    return [root] if found is None else sorted(found.values())


def folder(spark: SparkSession, root: str) -> str:
    """The one folder of a table that is written as a whole."""
    found = folders(spark, root)
    if len(found) != 1:
        raise ValueError(f"{root} has {len(found)} parts")
    return found[0]


def exists(spark: SparkSession, root: str) -> bool:
    return _last(spark, root)[1] is not None


def read(spark: SparkSession, root: str, only: Iterable[str] | None = None) -> DataFrame:
    """The Parquet table as last committed; ``only``: those parts of it."""
    return _read(spark, root, _last(spark, root)[1], only)


def part_reader(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """Reads single parts of the Parquet table, all as it is committed now."""
    last = _last(spark, root)[1]
    return lambda part: _read(spark, root, last, [part])


def _read(spark: SparkSession, root: str, last: dict | None, only: Iterable[str] | None) -> DataFrame:
    if last is None:
        return spark.read.parquet(root)
    some = last["parts"] if only is None else {k: v for k, v in last["parts"].items() if k in set(only)}
    paths = [f"{root.rstrip('/')}/{v}" for v in sorted(some.values())]
    schema = T.StructType.fromJson(last["schema"]) if last["schema"] else None
    if not paths:
        if schema is None:
            raise ValueError(f"{root} has no part to take a schema from")
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def written(spark: SparkSession, root: str, write: Callable[[str], object]) -> str:
    target = new_folder(root)
    try:
        write(target)
    except BaseException:
        delete(spark, target)
        raise
    return target


def replace(spark: SparkSession, root: str, write: Callable[[str], object], schema: T.StructType | None = None) -> str:
    """Let ``write(folder)`` fill a new folder, then make it the whole table. Returns it."""
    target = written(spark, root, write)
    commit(spark, root, lambda _: {WHOLE: target}, schema)
    return target


def replace_table(df: DataFrame, root: str, compression: str = "snappy") -> str:
    """Replace a Parquet table by ``df``, which may read the table itself."""
    return replace(df.sparkSession, root, lambda f: df.write.option("compression", compression).parquet(f), df.schema)


def append(df: DataFrame, root: str) -> str:
    """Add ``df`` to a Parquet table as a part of its own. Returns the folder."""
    spark = df.sparkSession
    target = written(spark, root, lambda f: df.write.parquet(f))
    commit(spark, root, lambda old: {**old, target.rsplit("/", 1)[1]: target}, df.schema)
    return target


def replace_parts(df: DataFrame, root: str, key: str, keys: Iterable[str], compression: str = "snappy",
                  seen: Observation | None = None) -> None:
    """Put the rows of ``df``, by their string column ``key``, in the place of the parts ``keys``
    and leave the others. A part without rows goes; every key in ``df`` must be among ``keys``.

    Spark sorts a task's rows by part before it writes them: the rows are rebalanced over tasks of
    the advisory size first, however much a task of ``df`` gives. ``seen`` is given the number of
    ``rows``, counted where they are written."""
    spark, keys = df.sparkSession, set(keys)
    rows = df.withColumn("_part", df[key]).hint("rebalance", "_part")
    if seen is not None:
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    target = written(spark, root, lambda f: rows.write.partitionBy("_part").option("compression", compression).parquet(f))
    new = {unquote(n.split("=", 1)[1]): f"{target}/{n}" for n in names(spark, target) if n.startswith("_part=")}
    if not set(new) <= keys:
        delete(spark, target)
        raise ValueError(f"rows of parts that are not rewritten: {sorted(set(new) - keys)[:5]}")
    _commit_parts(spark, root, keys, new, df.schema)


# Parts that are written at a time.
PARTS_AT_ONCE = 8


def replace_each(spark: SparkSession, root: str, rows_of: Callable[[str], DataFrame], keys: Iterable[str],
                 compression: str = "snappy") -> None:
    """Put the rows ``rows_of(key)`` in the place of each part of ``keys`` and leave the others. A part
    without rows goes. Each part is a write of its own, whose tasks hold no rows back to sort them; all
    are committed at once."""
    keys = list(dict.fromkeys(keys))
    schema = rows_of(keys[0]).schema if keys else None

    def write(target: str) -> None:
        def one(number: int, key: str) -> tuple[str, str] | None:
            folder = f"{target}/{number}"
            rows_of(key).write.option("compression", compression).parquet(folder)
            return None if spark.read.schema(schema).parquet(folder).isEmpty() else (key, folder)

        with ThreadPoolExecutor(PARTS_AT_ONCE, thread_name_prefix="logtally-parts") as pool:
            jobs = [pool.submit(inheritable_thread_target(spark)(one), n, key) for n, key in enumerate(keys)]
            try:
                new.update(found for found in (job.result() for job in jobs) if found)
            except BaseException:
                pool.shutdown(cancel_futures=True)
                raise

    new: dict[str, str] = {}
    if keys:
        written(spark, root, write)
        _commit_parts(spark, root, set(keys), new, schema)


def _commit_parts(spark: SparkSession, root: str, keys: set[str], new: dict[str, str], schema: T.StructType) -> None:
    commit(spark, root, lambda old: {**{k: v for k, v in old.items() if k not in keys and k != WHOLE}, **new}, schema)


def point_view(spark: SparkSession, name: str, root: str) -> None:
    """Make the table, as last committed, readable as ``spark.table(name)``: a view that is switched at once."""
    try:
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    except PySparkException:
        pass                          # a name whose folder is gone cannot be looked at; it is replaced below
    quoted = [f.replace("`", "``") for f in folders(spark, root)]
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS " + " UNION ALL ".join(f"SELECT * FROM parquet.`{f}`" for f in quoted))


def drop_old(spark: SparkSession, root: str, keep: int = 2, unfinished_s: float = 86_400) -> list[str]:
    """Remove data folders that none of the last ``keep`` commits names, and the commits before
    those. Folders newer than the last commit may belong to a write that goes on: they stay until
    they are ``unfinished_s`` seconds old. Returns the names of the removed folders."""
    taken = [n for n in names(spark, _commits(root)) if n.isdigit()]
    complete = [(n, c) for n, c in ((n, _read_commit(spark, root, n)) for n in taken) if c is not None]
    if not complete:
        return []
    used = {v.split("/")[1] for _, c in complete[-keep:] for v in c["parts"].values()}
    newest = max((v.split("/")[1] for _, c in complete for v in c["parts"].values()), default="")
    fs, p = _path(spark, f"{root.rstrip('/')}/data")
    removed = []
    for status in fs.listStatus(p) if fs.exists(p) else []:
        name = status.getPath().getName()
        old = name <= newest or time.time() - status.getModificationTime() / 1000 > unfinished_s
        if name not in used and old:
            fs.delete(status.getPath(), True)
            removed.append(name)
    for name, _ in complete[:-keep]:
        delete(spark, f"{_commits(root)}/{name}")
    return sorted(removed)
