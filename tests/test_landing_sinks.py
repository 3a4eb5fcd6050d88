import os

import pandas as pd
import pytest

from logtally.sinks import (
    drop_tables,
    export_delimited,
    read_delimited,
    register_delimited,
    register_lines,
    stage_lines,
    write_managed,
)
from logtally.sources import landing, read_valid_lines, validate_landing
from logtally.sources.landing import gzip_problem, stream_problem
from tests.conftest import rows
from tests.fixtures import gz_bytes, gzip_cases


def test_gzip_problem_kinds():
    ok = gz_bytes("x\n")
    assert gzip_problem(ok) == "ok"
    assert gzip_problem(ok + ok) == "multi-member"
    assert gzip_problem(ok + b"\0\0") == "zero-padded"
    assert gzip_problem(ok + b"junk") == "trailing-garbage"
    assert gzip_problem(b"") == "empty"
    assert gzip_problem(ok[:-8]) == "truncated"
    assert gzip_problem(b"plain text") == "not-gzip"


def test_gzip_problem_large_expansion_is_bounded():
    data = gz_bytes("0" * (64 << 20))          # 64 MB of output from ~64 KB
    assert gzip_problem(data) == "ok"


def test_validate_landing_manifest(spark, tmp_path):
    expected = gzip_cases(tmp_path / "land")
    manifest = validate_landing(spark, str(tmp_path / "land"))
    got = {r.path.rsplit("/", 1)[-1]: r.isValid for r in manifest.collect()}
    want = {k: v for k, v in expected.items() if v is not None}
    assert got == want
    reasons = {r.path.rsplit("/", 1)[-1]: r.reason for r in manifest.collect()}
    assert reasons["empty.gz"] == "empty" and reasons["badcrc.gz"] == "bad-crc"


def test_read_valid_lines_only_good_archives(spark, tmp_path):
    gzip_cases(tmp_path / "land")
    manifest = validate_landing(spark, str(tmp_path / "land"))
    lines = read_valid_lines(spark, str(tmp_path / "land"), manifest).where("sourceFileAbsolutePath NOT LIKE '%padded.gz'")
    assert rows(lines.select("line")) == sorted(
        [('{"a":1}',), ('{"a":2}',), ('{"a":1}',), ('{"a":2}',), ('{"a":3}',)], key=repr)
    none = read_valid_lines(spark, str(tmp_path / "land"), manifest.limit(0))
    assert none.collect() == []


def test_write_managed_roundtrip_and_table(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as string) AS k")
    path = write_managed(df, str(tmp_path / "t"))
    assert spark.read.parquet(path).count() == 100
    write_managed(df.limit(10), str(tmp_path / "t2"), table="lt_tmp_table")
    assert spark.table("lt_tmp_table").count() == 10
    drop_tables(spark, ["lt_tmp_table", "lt_missing_table"])
    assert not spark.catalog.tableExists("lt_tmp_table")
    assert spark.read.parquet(str(tmp_path / "t2")).count() == 10   # data survives the drop


def test_export_delimited_hive_text_layout(spark, tmp_path):
    df = spark.createDataFrame([("f1", None, 3), ("f2", "zoom", 1)],
                               "fileName string, name string, occurrenceCount long")
    out = tmp_path / "exp"
    export_delimited(df.coalesce(1), str(out))
    text = "".join(p.read_text() for p in out.iterdir() if p.name.startswith("part-"))
    assert sorted(text.splitlines()) == ["f1\x01\\N\x013", "f2\x01zoom\x011"]


def test_stage_refuses_its_own_source(spark, tmp_path):
    df = spark.createDataFrame([("a",)], "line string")
    with pytest.raises(ValueError):
        stage_lines(df, str(tmp_path / "x"), source_paths=[str(tmp_path / "x")])


def test_big_multi_member_archive_offsets():
    import os as _os
    big = gz_bytes(_os.urandom(3 << 20).hex())      # member larger than one input chunk
    assert gzip_problem(big + gz_bytes("tail\n")) == "multi-member"
    assert gzip_problem(big + gz_bytes("tail\n") + b"\0" * 10) == "zero-padded"
    assert gzip_problem(big + b"x") == "trailing-garbage"


def test_iter_lines_matches_text_reader_splitting():
    from logtally.sources.landing import iter_lines
    data = gz_bytes("a\r\nb\rc\n\nd") + gz_bytes("e\n")
    assert list(iter_lines(data)) == [b"a", b"b", b"c", b"", b"de"]


def test_read_valid_lines_decodes_zero_padded(spark, tmp_path):
    gzip_cases(tmp_path / "land")
    manifest = validate_landing(spark, str(tmp_path / "land"))
    lines = read_valid_lines(spark, str(tmp_path / "land"), manifest)
    by_file = {}
    for r in lines.collect():
        by_file.setdefault(r.sourceFileAbsolutePath.rsplit("/", 1)[-1], []).append(r.line)
    assert sorted(by_file) == ["multi.gz", "ok.gz", "padded.gz"]
    assert by_file["padded.gz"] == ['{"a":1}', '{"a":2}']
    spark_path = [p for p in
                  (r[0] for r in lines.select("sourceFileAbsolutePath").distinct().collect())]
    assert all(p.startswith("file:") for p in spark_path)


def test_large_and_small_archives_take_one_path(spark, tmp_path):
    """Content over Spark's limit for whole files, and nothing is read as a whole."""
    expected = gzip_cases(tmp_path / "land")
    old = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    try:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "1")
        manifest = validate_landing(spark, str(tmp_path / "land"))
        got = {r.path.rsplit("/", 1)[-1]: r.isValid for r in manifest.collect()}
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", old)
    assert got == {k: v for k, v in expected.items() if v is not None}


def test_an_archive_that_cannot_be_opened_fails_the_check(spark, tmp_path):
    land = tmp_path / "land"
    gzip_cases(land)
    manifest = validate_landing(spark, str(land))           # lists now, opens when it is read
    (land / "ok.gz").unlink()
    with pytest.raises(Exception, match="ok.gz"):
        manifest.collect()
    with pytest.raises(OSError):
        stream_problem(f"file:{tmp_path}/missing.gz")


def test_store_names_resolve_like_spark_shows_them(monkeypatch):
    from pyarrow import fs as pafs

    from logtally.sources import landing
    asked = []

    class Stores:
        @staticmethod
        def from_uri(uri):
            asked.append(uri)
            return None, "bucket"

    monkeypatch.setattr(pafs, "FileSystem", Stores)
    landing._store.cache_clear()
    try:
        assert landing.resolve("s3a://bucket/a b/c.gz")[1] == "bucket/a b/c.gz"
        assert asked == ["s3://bucket/"]
    finally:
        landing._store.cache_clear()
    assert landing.resolve("file:/a b/c.gz")[1] == "/a b/c.gz"


def test_folders_below_are_listed_and_read_only_when_asked(spark, tmp_path):
    land = tmp_path / "land"
    gzip_cases(land)
    for name in ("day=1/in.gz", "day=1/deep/er/in.gz", "day=1/x-tmp.gz"):
        (land / name).parent.mkdir(parents=True, exist_ok=True)
        (land / name).write_bytes(gz_bytes("inner\n"))
    flat, deep = (validate_landing(spark, str(land), recursive=r) for r in (False, True))
    assert (flat.count(), deep.count()) == (10, 12)
    lines = [read_valid_lines(spark, str(land), m, recursive=r).where("line = 'inner'").count()
             for m, r in ((flat, False), (deep, True))]
    assert lines == [0, 2]


def test_a_folder_is_listed_in_pages(monkeypatch):
    """A folder of a million entries never is one list, and pages go on before the folder ends."""
    taken = 0

    def entries(folder):
        nonlocal taken
        for taken in range(1, 1_000_001):
            yield f"{folder}/{taken}.gz", False, taken, 0
    rows = 0
    for page in landing._list_folders([pd.DataFrame({"path": ["/a"]})], entries):
        rows += len(page)
        assert len(page) <= landing.LIST_PAGE and taken == rows
    assert rows == 1_000_000


def test_entries_of_a_local_folder(spark, tmp_path, monkeypatch):
    names = [f"{k} %20é.gz" for k in range(25)]
    for k, name in enumerate(names):
        (tmp_path / name).write_bytes(b"x" * k)
    (tmp_path / "below").mkdir()
    (tmp_path / "nothing.gz").symlink_to(tmp_path / "gone")
    os.utime(tmp_path / names[3], ns=(0, 1_234_567_890))
    monkeypatch.setattr(landing, "LIST_PAGE", 10)
    pages = list(landing._list_folders([pd.DataFrame({"path": [f"file:{tmp_path}"]})]))
    rows = {r.path: (r.isFolder, r.length) for p in pages for r in p.itertuples()}
    assert [len(p) for p in pages] == [10, 10, 6]
    assert rows == {f"file:{tmp_path}/{n}": (False, k) for k, n in enumerate(names)} | {
        f"file:{tmp_path}/below": (True, rows[f"file:{tmp_path}/below"][1])}
    assert [r.modified for p in pages for r in p.itertuples() if r.path == f"file:{tmp_path}/{names[3]}"] == [1234]
    empty = tmp_path / "below"
    assert list(landing._list_folders([pd.DataFrame({"path": [str(empty)]})])) == []
    assert validate_landing(spark, str(empty)).count() == 0


def test_what_arrives_after_the_check_waits(spark, tmp_path):
    import time
    land = tmp_path / "land"
    gzip_cases(land)
    manifest = validate_landing(spark, str(land)).checkpoint()
    time.sleep(0.05)
    (land / "late.gz").write_bytes(gz_bytes("late\n")[:-4])      # and is not whole yet
    assert read_valid_lines(spark, str(land), manifest).where("line = 'late'").count() == 0


def test_stream_walker_matches_bytes_walker(tmp_path):
    import io as _io
    import os as _os
    from logtally.sources.landing import iter_lines
    big = gz_bytes(_os.urandom(3 << 20).hex() + "\nend\n")
    for data in (big + gz_bytes("x\n"), big + b"\0" * 5, big[:-3], gz_bytes("a\n")[:10]):
        assert gzip_problem(_io.BytesIO(data)) == gzip_problem(data)
    assert list(iter_lines(_io.BytesIO(big)))[-1] == b"end"


def test_manifest_and_line_paths_agree(spark, tmp_path):
    land = tmp_path / "la nd"
    gzip_cases(land)
    (land / "a b%20c.gz").write_bytes((land / "ok.gz").read_bytes())
    manifest = validate_landing(spark, str(land))
    valid = {r.path for r in manifest.where("isValid").collect()}
    lines = read_valid_lines(spark, str(land), manifest)
    seen = {r[0] for r in lines.select("sourceFileAbsolutePath").distinct().collect()}
    assert seen == valid and any(p.endswith("/la nd/a b%20c.gz") for p in seen)


def test_refused_paths_are_taken_literally(spark, tmp_path):
    land = tmp_path / "land"
    gzip_cases(land)
    (land / "a[1].gz").write_bytes(gz_bytes("bracket\n")[:-4])
    (land / "a1.gz").write_bytes(gz_bytes("plain\n"))
    manifest = validate_landing(spark, str(land))
    got = rows(read_valid_lines(spark, str(land), manifest).where("line IN ('bracket', 'plain')").select("line"))
    assert got == [("plain",)]


VALUES = ["  f.gz ", " zoom ", "", None, 'q"q', "a,b", "back\\slash", "tab\t", "end\\", "\\n", "\\a", "é"]
ODD_VALUES = ["\\N", "li\nne", "cr\rx", "c\x01a"]


def test_export_is_byte_exact(spark, tmp_path):
    df = spark.createDataFrame([(v, k) for k, v in enumerate(VALUES)], "name string, n long").coalesce(1)
    out = tmp_path / "exp"
    export_delimited(df, str(out))
    data = b"".join(p.read_bytes() for p in out.iterdir() if p.name.startswith("part-"))
    assert data == b"".join(("\\N" if v is None else v).encode() + b"\x01%d\n" % k for k, v in enumerate(VALUES))
    assert rows(read_delimited(spark, str(out), "name string, n long")) == rows(df)


def test_values_that_fit_no_row_fail_or_are_escaped(spark, tmp_path):
    for value in ODD_VALUES:
        with pytest.raises(Exception, match="cannot hold this value"):
            export_delimited(spark.createDataFrame([(value,)], "name string"), str(tmp_path / "bad"))
    df = spark.createDataFrame([(v, k) for k, v in enumerate(VALUES + ODD_VALUES)], "name string, n long")
    out = str(tmp_path / "esc")
    export_delimited(df, out, escape=True)
    assert rows(read_delimited(spark, out, "name string, n long", escape=True)) == rows(df)


def test_text_outputs_as_tables(spark, tmp_path):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", 3)], "name string, n long")
    export_delimited(df, str(tmp_path / "exp"), escape=True)
    stage_lines(spark.createDataFrame([("a",), ("b",)], "line string"), str(tmp_path / "stage"))
    register_delimited(spark, "lt_exported", str(tmp_path / "exp"), df.schema, escape=True)
    register_lines(spark, "lt_staged", str(tmp_path / "stage"))
    assert rows(spark.table("lt_exported")) == rows(df)
    assert rows(spark.table("lt_staged")) == [("a",), ("b",)]
    drop_tables(spark, ["lt_exported", "lt_staged"])
    assert not spark.catalog.tableExists("lt_exported") and not spark.catalog.tableExists("lt_staged")
    assert rows(read_delimited(spark, str(tmp_path / "exp"), df.schema, escape=True)) == rows(df)      # the files stay


def test_bucketed_table_skips_the_rare_key_shuffle(spark, tmp_path):
    import contextlib
    import io

    from logtally.operators import rare_keys
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_managed(docs.select("doc_id", "text"), str(tmp_path / "docs"), table="lt_docs_bucketed",
                  bucket_by=["text"], buckets=4)
    try:
        bucketed = rare_keys(spark.table("lt_docs_bucketed"), "text")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            bucketed.explain("formatted")
        assert "Exchange" not in buf.getvalue()
        assert rows(bucketed) == rows(rare_keys(docs, "text"))
    finally:
        drop_tables(spark, ["lt_docs_bucketed"])
    with pytest.raises(ValueError):
        write_managed(docs, str(tmp_path / "x"), bucket_by=["text"], buckets=4)
