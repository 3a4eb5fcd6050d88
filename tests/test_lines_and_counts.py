from pyspark.sql import functions as F

from logtally.operators import (
    count_rows, counts_match, event_counts, file_line_counts, rare_keys, tag_lines)
from logtally.sources import scan_lines
from tests.conftest import rows
from tests.fixtures import make_clean_root, make_raw_root


def test_scan_and_tag_keep_provenance(spark, tmp_path):
    root = make_clean_root(tmp_path)
    flat = scan_lines(spark, str(root))
    nested = scan_lines(spark, str(root), recursive=True)
    assert flat.count() == 6 + 2 + 1          # the nested folder needs recursion
    assert nested.count() == 6 + 2 + 1 + 1
    tagged = tag_lines(nested, "clean/")
    names = {r.fileName for r in tagged.select("fileName").distinct().collect()}
    assert names == {"2016-08-15.gz", "day 2.gz", "a+b.gz", "V2/"}
    paths = {r[0] for r in tagged.select("sourceFileAbsolutePath").distinct().collect()}
    assert any(p.endswith("/nom/clean/day 2.gz") for p in paths)
    assert any(p.endswith("/nom/clean/a+b.gz") for p in paths)


def test_marker_absent_gives_null_name(spark, tmp_path):
    root = make_raw_root(tmp_path)
    tagged = tag_lines(scan_lines(spark, str(root)), "clean/")
    assert tagged.where(F.col("fileName").isNull()).count() == tagged.count()


def test_file_line_counts(spark, tmp_path):
    root = make_clean_root(tmp_path)
    meta = file_line_counts(tag_lines(scan_lines(spark, str(root), recursive=True), "clean/"),
                            ordered=True)
    got = [(r.fileName, r.lineCount) for r in meta.collect()]
    assert got == [("2016-08-15.gz", 6), ("V2/", 1), ("a+b.gz", 1), ("day 2.gz", 2)]
    assert meta.schema["lineCount"].dataType.typeName() == "long"


def test_event_counts_null_name_group_and_order(spark, tmp_path):
    root = make_raw_root(tmp_path)
    tagged = tag_lines(scan_lines(spark, str(root)), "metrics/")
    counts = event_counts(tagged, "$.clientData.name", ordered=True)
    got = [tuple(r) for r in counts.collect()]
    assert [r[0] for r in got] == sorted(r[0] for r in got)
    first_file = [r for r in got if r[0] == "2016-08-15.gz"]
    assert first_file[0] == ("2016-08-15.gz", None, 3)   # blank + malformed + missing name
    assert [r[2] for r in first_file] == sorted([r[2] for r in first_file], reverse=True)
    assert set(first_file) == {("2016-08-15.gz", None, 3), ("2016-08-15.gz", "zoom", 2),
                               ("2016-08-15.gz", "tts", 1)}


def test_event_counts_sum_to_line_counts(spark, tmp_path):
    root = make_raw_root(tmp_path)
    tagged = tag_lines(scan_lines(spark, str(root)), "metrics/")
    per_file = (event_counts(tagged, "$.clientData.name").groupBy("fileName")
                .agg(F.sum("occurrenceCount").alias("n")))
    meta = file_line_counts(tagged).select("fileName", F.col("lineCount").alias("n"))
    assert rows(per_file) == rows(meta)


def test_rare_keys_counts_non_null(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,), ("c",)], "eventId string")
    assert rows(rare_keys(df, "eventId")) == [("a", 1), ("c", 1)]
    assert rows(rare_keys(df, "eventId", n=2)) == [("b", 2)]
    # NULL key counts 0 non-NULL values
    assert rows(rare_keys(df, "eventId", n=0)) == [(None, 0)]
    assert rare_keys(df, "eventId", limit=1).count() == 1


def test_counts_match_and_count_rows(spark, tmp_path):
    root = make_raw_root(tmp_path)
    lines = scan_lines(spark, str(root))
    tagged = tag_lines(lines, "metrics/")
    assert tuple(counts_match(lines, tagged).first()) == (9, 9, True)
    assert tuple(counts_match(lines, tagged.limit(3)).first()) == (9, 3, False)
    assert count_rows(tagged).first()[0] == 9
    names = counts_match(lines, tagged).columns
    assert names == ["sourceCount", "derivedCount", "isConsistent"]


def test_scan_lines_glob_filter(spark, tmp_path):
    from tests.fixtures import write_gz
    write_gz(tmp_path / "a.gz", ["x"])
    write_gz(tmp_path / "b.log.gz", ["y"])
    (tmp_path / "c.txt").write_text("z\n")
    assert rows(scan_lines(spark, str(tmp_path), glob="*.gz").select("line")) == [("x",), ("y",)]
    assert scan_lines(spark, str(tmp_path), with_path=False).columns == ["line"]


def test_tag_lines_extracts_name_once(spark, tmp_path):
    root = make_raw_root(tmp_path)
    tagged = tag_lines(scan_lines(spark, str(root)), "metrics/", name_path="$.clientData.name")
    assert tagged.columns == ["sourceFileAbsolutePath", "fileName", "name", "line"]
    from_column = event_counts(tagged, None)
    from_lines = event_counts(tagged.drop("name"), "$.clientData.name")
    assert rows(from_column) == rows(from_lines)


def test_same_file_name_under_two_roots(spark, tmp_path):
    from logtally.operators import left_reconcile, reconcile
    from tests.fixtures import event, write_gz
    write_gz(tmp_path / "east" / "clean" / "a.gz", [event("zoom"), event("tts")])
    write_gz(tmp_path / "west" / "clean" / "a.gz", [event("zoom")])
    write_gz(tmp_path / "raw" / "metrics" / "a.gz", [event("zoom")] * 4)
    clean = file_line_counts(tag_lines(scan_lines(
        spark, [str(tmp_path / "east" / "clean"), str(tmp_path / "west" / "clean")]), "clean/"))
    assert sorted(r.lineCount for r in clean.collect()) == [1, 2]        # one row per path
    raw = file_line_counts(tag_lines(scan_lines(spark, str(tmp_path / "raw" / "metrics")),
                                     "metrics/"))
    assert rows(reconcile(raw, clean)) == [("a.gz", 4, 3)]
    assert rows(left_reconcile(raw, clean)) == [("a.gz", 4, 3)]
