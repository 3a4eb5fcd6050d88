"""Landing check: which gzip archives in a drop folder are intact.

Re-expresses the landing script's ``gzip -t`` loop as Spark jobs over the
folder. Folders are listed in tasks, one level of the tree per job, and every
archive, whatever its size, is streamed from storage in 1 MB steps by one
check, so memory stays flat. An archive that cannot be opened is no verdict on
the archive: it fails the job. Only archives that pass go on to the line scan.
"""

from __future__ import annotations

import fnmatch
import io
import itertools
import os
import stat
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logtally.functions.paths import decode_file_path
from logtally.session import ensure_checkpoint_dir, ship_package
from logtally.sinks import versions
from logtally.sources.lines import PATH_COL, scan_lines

# Fixed values of the landing check: archives are "*.gz" and a file whose
# name contains "tmp" is still being written and is skipped.
GZIP_GLOB = "*.gz"
SKIP_SUBSTRING = "tmp"
# Hadoop's names of stores that pyarrow knows under another one.
STORE_NAMES = {"s3a": "s3", "s3n": "s3"}

_CHUNK = 1 << 20          # compressed bytes read per step
_MAX_OUT = 8 << 20        # cap on decompressed bytes held per step
_LINES_PER_BATCH = 8192

VALID_KINDS = ("ok", "multi-member", "zero-padded")
# Kinds Spark's own gzip text reader can read; the rest are decoded in Python.
SPARK_READABLE = ("ok", "multi-member")


class ArchiveError(Exception):
    """An archive that ``gzip -t`` would reject; ``kind`` names the defect."""

    def __init__(self, kind: str):
        super().__init__(kind)
        self.kind = kind


def _stream(source) -> io.RawIOBase:
    return io.BytesIO(source) if isinstance(source, (bytes, bytearray, memoryview)) else source


def iter_members(source):
    """Yield decompressed blocks of every gzip member, in order.

    ``source`` is the archive's bytes or a binary stream (anything with
    ``read(n)``); it is consumed in ``_CHUNK`` steps and decompressed output
    comes in blocks of at most ``_MAX_OUT`` bytes, so memory stays flat
    whatever the archive size or expansion ratio. Zero bytes after the last
    member are accepted (as ``gzip -t`` does); any other defect raises
    ``ArchiveError``. The generator returns ``(members, zero_padded)``.
    """
    stream = _stream(source)
    members = 0
    pending = stream.read(_CHUNK)
    if not pending:
        raise ArchiveError("empty")
    while True:
        if not pending:
            pending = stream.read(_CHUNK)
            if not pending:
                return members, False
        if members and not any(pending):
            while True:
                more = stream.read(_CHUNK)
                if not more:
                    return members, True
                if any(more):
                    raise ArchiveError("trailing-garbage")
        while len(pending) < 2:
            more = stream.read(_CHUNK)
            if not more:
                break
            pending += more
        if pending[:2] != b"\x1f\x8b":
            raise ArchiveError("trailing-garbage" if members else "not-gzip")
        d = zlib.decompressobj(16 + zlib.MAX_WBITS)
        data, pending = pending, b""
        try:
            while True:
                yield d.decompress(data, _MAX_OUT)
                while d.unconsumed_tail and not d.eof:
                    yield d.decompress(d.unconsumed_tail, _MAX_OUT)
                if d.eof:
                    break
                data = stream.read(_CHUNK)
                if not data:
                    raise ArchiveError("truncated")
        except zlib.error as exc:
            raise ArchiveError("bad-crc" if "check" in str(exc) else "corrupt") from exc
        members += 1
        # Whatever followed this member in the last read starts the next one.
        pending = d.unused_data


def gzip_problem(source) -> str:
    """Classify an archive the way ``gzip -t`` judges it (exit status 0 = ok).

    Valid archives report ``ok``, ``multi-member`` or ``zero-padded``; invalid
    ones the defect. Decompressed output is discarded as it is produced.
    """
    it = iter_members(source if source is not None else b"")
    try:
        while True:
            next(it)
    except StopIteration as stop:
        members, padded = stop.value
    except ArchiveError as err:
        return err.kind
    if padded:
        return "zero-padded"
    return "multi-member" if members > 1 else "ok"


def iter_lines(source):
    """Lines of a valid archive, split like Spark's text reader: on ``\\n``,
    ``\\r\\n`` or ``\\r``, with no empty line after a final newline."""
    rest = b""
    for block in iter_members(source):
        if not block:
            continue
        buf = rest + block
        # A final '\r' may be the first half of '\r\n': hold it back.
        cut = len(buf) - 1 if buf.endswith(b"\r") else len(buf)
        last = max(buf.rfind(b"\n", 0, cut), buf.rfind(b"\r", 0, cut))
        if last < 0:
            rest = buf
            continue
        rest = buf[last + 1:]
        yield from buf[:last + 1].splitlines()
    if rest:
        yield from rest.splitlines()


@lru_cache(maxsize=64)
def _store(scheme: str, authority: str):
    """pyarrow's file system of a store, and the path of its root."""
    from pyarrow import fs as pafs

    if scheme == "file":
        return pafs.LocalFileSystem(), ""
    filesystem, base = pafs.FileSystem.from_uri(f"{STORE_NAMES.get(scheme, scheme)}://{authority}/")
    return filesystem, base.rstrip("/")


def resolve(uri: str):
    """(file system, path in it) of a URI as Spark shows it, unencoded."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file" or not rest.startswith("//"):
        return *_store("file", "")[:1], "/" + (rest if scheme == "file" else uri).lstrip("/")
    authority, _, path = rest[2:].partition("/")
    filesystem, base = _store(scheme, authority)
    return filesystem, f"{base}/{path}" if base else path


def open_archive(uri: str):
    """A binary input stream over ``uri`` through pyarrow's file systems
    (local, S3, HDFS, GCS, ... as configured on the executors)."""
    filesystem, path = resolve(uri)
    return filesystem.open_input_stream(path, compression=None)


def stream_problem(uri: str) -> str:
    """What is wrong with an archive; raises where it cannot be opened or read."""
    with open_archive(uri) as stream:
        return gzip_problem(stream)


# Entries of a folder that are held at a time.
LIST_PAGE = 10_000
_LISTED = "path string, isFolder boolean, length long, modified long"


def _entries(folder: str):
    """(path, whether a folder, length, epoch milliseconds) of each entry of a folder. A local folder is
    read as a stream; pyarrow's other file systems give the list of a folder as one."""
    from pyarrow import fs as pafs

    filesystem, path = resolve(folder)
    base = folder.rstrip("/")
    if isinstance(filesystem, pafs.LocalFileSystem):
        with os.scandir(path) as entries:
            for e in entries:
                try:
                    found = e.stat()
                except FileNotFoundError:        # gone since, or a link to nothing
                    continue
                yield f"{base}/{e.name}", stat.S_ISDIR(found.st_mode), found.st_size, found.st_mtime_ns // 1_000_000
        return
    for e in filesystem.get_file_info(pafs.FileSelector(path, recursive=False)):
        yield f"{base}/{e.base_name}", e.type == pafs.FileType.Directory, e.size or 0, (e.mtime_ns or 0) // 1_000_000


def _list_folders(batches, entries=_entries):
    """The entries of each folder, ``LIST_PAGE`` at a time; ``modified`` in epoch milliseconds."""
    for pdf in batches:
        for folder in pdf["path"]:
            rows = entries(folder)
            while page := list(itertools.islice(rows, LIST_PAGE)):
                yield pd.DataFrame(page, columns=["path", "isFolder", "length", "modified"]).astype(
                    {"isFolder": "bool", "length": "int64", "modified": "int64"})


def _slots(spark: SparkSession) -> int:
    """Tasks for work whose rows are small and costs are not (AQE would merge them)."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def qualified(spark: SparkSession, root: str) -> str:
    """A folder as Spark shows it in file paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/")


def _listing(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    """All files under ``root``, listed in tasks, one job per level of the tree."""
    ensure_checkpoint_dir(spark)
    level = spark.createDataFrame([(qualified(spark, root),)], "path string")
    files = None
    while True:
        listed = level.repartition(_slots(spark), "path").mapInPandas(_list_folders, _LISTED).checkpoint()
        found = listed.where(~F.col("isFolder"))
        files = found if files is None else files.unionByName(found)
        level = listed.where("isFolder").select("path")
        if not recursive or level.isEmpty():
            return files


def list_archives(
    spark: SparkSession,
    root: str,
    glob: str = GZIP_GLOB,
    skip_substring: str | None = SKIP_SUBSTRING,
    recursive: bool = False,
) -> DataFrame:
    """``(path, length, modified)`` of the archives in ``root``, by name; a row's
    task is its own, so that slow work on a few rows spreads."""
    name = F.element_at(F.split("path", "/"), -1)
    files = _listing(spark, root, recursive).where(name.rlike(fnmatch.translate(glob)))
    if skip_substring:
        files = files.where(~name.contains(skip_substring))
    return files.select("path", "length", "modified").repartition(_slots(spark), "path")


def _check_archives(batches):
    for pdf in batches:
        yield pdf.assign(reason=[stream_problem(path) for path in pdf["path"]])


def validate_landing(
    spark: SparkSession,
    root: str,
    glob: str = GZIP_GLOB,
    skip_substring: str | None = SKIP_SUBSTRING,
    recursive: bool = False,
) -> DataFrame:
    """Manifest ``(path, length, isValid, reason, checkedAt)`` of the archives in ``root``.

    ``isValid`` follows ``gzip -t``: intact, multi-member and zero-padded
    archives pass; empty, truncated, CRC-damaged, trailing-garbage and
    non-gzip files fail. Files whose name contains ``skip_substring`` are
    left out and never opened. ``checkedAt`` is when the listing began: an
    archive that arrives later waits for the next check. An archive that
    cannot be opened fails the job.
    """
    ship_package(spark)
    checked_at = int(datetime.now(timezone.utc).timestamp() * 1000)
    files = list_archives(spark, root, glob, skip_substring, recursive).where(F.col("modified") <= checked_at)
    checked = files.select("path", "length").mapInPandas(_check_archives, "path string, length long, reason string")
    return checked.select("path", "length", F.col("reason").isin(*VALID_KINDS).alias("isValid"), "reason",
                          F.timestamp_millis(F.lit(checked_at)).alias("checkedAt"))


# --- only what is new ---

MANIFEST_SCHEMA = "path string, length long, modified long, isValid boolean, reason string, checkedAt timestamp"
# Reason of an archive that is in the manifest and no longer in the folder.
GONE = "gone"
# Increments that a manifest may have before it is written as one.
MOST_INCREMENTS = 32


@dataclass
class NewArchives:
    """What one incremental check found. ``rows``: archives that came, changed or went since the last
    check; ``manifest``: the latest verdict on each archive that is there; ``opened``: how many were
    read; ``held_back``: how many are dated after the check began, and wait for the next one."""

    rows: DataFrame
    manifest: DataFrame
    opened: int
    held_back: int
    commit: Callable[[], None]


def latest_manifest(rows: DataFrame) -> DataFrame:
    """The last verdict on each archive, without those that are gone."""
    fields = [f.strip().split(" ")[0] for f in MANIFEST_SCHEMA.split(",")]
    last = rows.groupBy("path").agg(F.max_by(F.struct(*fields), F.struct("checkedAt", "modified")).alias("m"))
    return last.select("m.*").where(F.col("reason") != GONE)


def read_manifest(spark: SparkSession, store: str) -> DataFrame:
    """The manifest that ``check_new`` keeps in ``store``; empty before its first commit."""
    if not versions.exists(spark, store):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest_manifest(versions.read(spark, store))


def check_new(
    spark: SparkSession,
    root: str,
    store: str,
    glob: str = GZIP_GLOB,
    skip_substring: str | None = SKIP_SUBSTRING,
    recursive: bool = False,
) -> NewArchives:
    """Check the archives of ``root`` that the manifest in ``store`` does not know by path, length
    and modification time; the others are not opened.

    The verdicts are written as one more part of the manifest. It counts from ``commit()`` on: call it
    when whatever is made of the new archives stands, and a job that fails before finds them new again.
    Verdicts are as in ``validate_landing``; an archive that is gone is noted as such.
    """
    ship_package(spark)
    checked_at = int(datetime.now(timezone.utc).timestamp() * 1000)
    listed = list_archives(spark, root, glob, skip_substring, recursive)
    known = read_manifest(spark, store)
    same = ["path", "length", "modified"]
    fresh = listed.where(F.col("modified") <= checked_at).join(known.select(*same), same, "left_anti")
    # A row's task is its own, as reading an archive is what takes long.
    checked = fresh.select("path", "length", "modified").repartition(_slots(spark), "path").mapInPandas(
        _check_archives, "path string, length long, modified long, reason string")
    gone = known.join(listed, "path", "left_anti").select(*same, F.lit(GONE).alias("reason"))
    found = checked.unionByName(gone).select(
        *same, F.col("reason").isin(*VALID_KINDS).alias("isValid"), "reason", F.timestamp_millis(F.lit(checked_at)).alias("checkedAt"))
    target = versions.new_folder(store)
    found.write.parquet(target)
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(target)
    counts = rows.agg(F.count_if(F.col("reason") != GONE), F.count(F.lit(1))).first()
    held_back = listed.where(F.col("modified") > checked_at).count()
    manifest = latest_manifest(known.unionByName(rows))

    def commit() -> None:
        if not counts[1]:
            versions.delete(spark, target)
            return
        versions.commit(spark, store, lambda old: {**old, target.rsplit("/", 1)[1]: target}, rows.schema)
        if len(versions.parts(spark, store)) > MOST_INCREMENTS:
            versions.replace_table(read_manifest(spark, store), store)

    return NewArchives(rows, manifest, counts[0], held_back, commit)


def _decode_archives(batches):
    for pdf in batches:
        for path in pdf["path"]:
            chunk: list[str] = []
            with open_archive(path) as stream:
                for raw in iter_lines(stream):
                    chunk.append(raw.decode("utf-8", errors="replace"))
                    if len(chunk) == _LINES_PER_BATCH:
                        yield pd.DataFrame({"sourceFileAbsolutePath": path, "line": chunk})
                        chunk = []
            if chunk:
                yield pd.DataFrame({"sourceFileAbsolutePath": path, "line": chunk})


def read_valid_lines(
    spark: SparkSession,
    root: str,
    manifest: DataFrame,
    glob: str = GZIP_GLOB,
    skip_substring: str | None = SKIP_SUBSTRING,
    recursive: bool = False,
    only: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Lines of the archives of ``root`` that its manifest lets pass ->
    ``(sourceFileAbsolutePath, line)``.

    ``manifest`` is a ``validate_landing`` result with the same arguments, or the
    manifest of ``check_new``; pass one that was written and read back, or the check
    runs again. ``only``, a condition on an archive's path, limits the scan to what
    the manifest rows are about. The root is
    scanned as a whole, and what was refused, what is still being written and
    what arrived after the check is left out by filters on the file's metadata,
    which drop the file before it is opened. Only the paths that Spark's
    reader is to pass over go through the driver.

    Spark's gzip reader rejects zero-padded archives although they are valid;
    those (normally few) are streamed and decoded in tasks.
    """
    started = manifest.agg(F.max("checkedAt")).first()[0]
    if started is None:
        return spark.createDataFrame([], f"{PATH_COL} string, line string")
    passed_over = [r["path"] for r in
                   manifest.where(~F.col("isValid") | ~F.col("reason").isin(*SPARK_READABLE)).select("path").collect()]
    path, name = decode_file_path(F.col("_metadata.file_path")), F.col("_metadata.file_name")
    reads = F.col("_metadata.file_modification_time") <= F.lit(started)
    if only is not None:
        reads &= only(path)
    if passed_over:
        reads &= ~path.isin(passed_over)
    if skip_substring:
        reads &= ~decode_file_path(name).contains(skip_substring)
    if not recursive:
        reads &= path == F.concat(F.lit(qualified(spark, root) + "/"), decode_file_path(name))
    # Always a plain walk of the tree: partition discovery would pass over files beside folders.
    out = scan_lines(spark, root, recursive=True, glob=glob, files=reads)
    padded = manifest.where(F.col("isValid") & ~F.col("reason").isin(*SPARK_READABLE)).select("path")
    if not padded.isEmpty():
        ship_package(spark)
        out = out.unionByName(padded.repartition(_slots(spark), "path").mapInPandas(
            _decode_archives, f"{PATH_COL} string, line string"))
    return out
