from pyspark.sql import functions as F

from logtally.functions import calendar_parts, decode_file_path, epoch_millis, json_field, relative_name
from tests.conftest import rows


def test_relative_name_edges(spark):
    df = spark.createDataFrame(
        [("s3://b/nom/clean/2016-08-15.gz",), ("s3://b/x/clean/V2/clean/z.gz",),
         ("s3://b/elsewhere/z.gz",), (None,)], "p string")
    got = [r[0] for r in df.select(relative_name("p", "clean/")).collect()]
    # marker twice keeps the piece between; absent marker gives NULL, not an error
    assert got == ["2016-08-15.gz", "V2/", None, None]


def test_relative_name_is_regex(spark):
    df = spark.createDataFrame([("http://a.example.com/x",), ("http://a.exampleXcom/y",)], "p string")
    got = [r[0] for r in df.select(relative_name("p", "example[.]")).collect()]
    assert got == ["com/x", None]


def test_decode_file_path(spark):
    df = spark.createDataFrame(
        [("file:/a/day%202.gz",), ("file:/a/a+b.gz",), ("file:/a/100%25.gz",), ("file:/a/bad%zz",)],
        "p string")
    got = [r[0] for r in df.select(decode_file_path("p")).collect()]
    assert got == ["file:/a/day 2.gz", "file:/a/a+b.gz", "file:/a/100%.gz", "file:/a/bad%zz"]


def test_calendar_parts_rounding(spark):
    # whole second, 999 ms, 500 ms before midnight on 31 December, NULL
    df = spark.createDataFrame([(1451606400000,), (1451606399999,), (1451606399500,),
                                (1451606399000,), (None,)], "ms long")
    ceil = rows(df.select("ms", *calendar_parts("ms")))
    assert ceil == sorted([
        (1451606400000, 2016, 1, 1), (1451606399999, 2016, 1, 1), (1451606399500, 2016, 1, 1),
        (1451606399000, 2015, 12, 31), (None, None, None, None)], key=repr)
    floor = dict((r[0], r[1:]) for r in df.select("ms", *calendar_parts("ms", "floor")).collect())
    assert floor[1451606399500] == (2015, 12, 31)
    assert floor[1451606400000] == (2016, 1, 1)


def test_calendar_parts_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([(1451606399500,)], "ms long")
        assert tuple(df.select(*calendar_parts("ms")).first()) == (2016, 1, 1)
        ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.179575' AS ts")
        assert ts.select(epoch_millis("ts")).first()[0] == 1704067207179
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_json_field_edges(spark):
    df = spark.createDataFrame(
        [('{"name":"zoom"}',), ("",), ('{"name": ',), ('{"site":"x"}',), ('{"NAME":"upper"}',),
         ('{"clientData":{"name":"nested"}}',)], "line string")
    got = [r[0] for r in df.select(json_field("line", "$.name")).collect()]
    assert got == ["zoom", None, None, None, None, None]
    nested = [r[0] for r in df.select(json_field(F.col("line"), "$.clientData.name")).collect()]
    assert nested[-1] == "nested"
