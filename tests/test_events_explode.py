from pyspark.sql import functions as F

from logtally.operators import counts_match, explode_dimensions, explode_locations, valid_json_rows
from logtally.sources import parse_events, scan_events, scan_lines
from tests.conftest import rows
from tests.fixtures import EDGE_LINES, event, write_gz


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "line string")


def test_parse_events_validity_and_types(spark):
    parsed = parse_events(_lines(spark, EDGE_LINES))
    got = {r.eventId: r for r in parsed.collect() if r.eventId}
    flags = [r._isValid for r in parsed.collect()]
    # valid, blank, malformed, missing name, wrong type, other-case key
    assert flags == [True, False, False, True, True, True]
    assert got["e1"].meta.locations == ["a", "b"]
    assert got["e2"].name is None
    assert got["e3"].zoomLevel is None and got["e3"].name == "badzoom"   # sibling survives
    assert got["e4"].meta.pseudoEvents is None and got["e4"].meta.locations == ["x"]


def test_text_vs_json_count_check(spark):
    lines = _lines(spark, EDGE_LINES)
    check = counts_match(lines, valid_json_rows(parse_events(lines)))
    assert tuple(check.first()) == (6, 4, False)


def test_scan_events_permissive_keeps_corrupt(spark, tmp_path):
    write_gz(tmp_path / "a.gz", EDGE_LINES)
    ev = scan_events(spark, str(tmp_path / "a.gz"))
    got = ev.select("eventId", "_corrupt_record").collect()
    # the JSON reader drops the blank line and keeps the malformed one
    assert len(got) == 5
    assert sum(1 for r in got if r._corrupt_record is not None) == 1


def test_explode_locations_non_outer(spark):
    lines = [
        event("a", event_id="1", meta={"locations": ["x", "y"]}),
        event("b", event_id="2", meta={"locations": ["z"]}),
        event("c", event_id="3", meta={"locations": []}),
        event("d", event_id="4", meta={"locations": None}),
        event("e", event_id="5"),
    ]
    ev = valid_json_rows(parse_events(_lines(spark, lines)))
    assert rows(explode_locations(ev)) == [("s1", "x"), ("s1", "y"), ("s1", "z")]


def test_explode_dimensions_cross_product(spark):
    lines = [
        event("a", event_id="1", site="s1", server_ts=1451606399500,
              meta={"locations": ["l1", "l2"], "pseudoEvents": ["p1", "p2", "p3"],
                    "ua": {"groups": ["g1"]}}),
        event("b", event_id="2", meta={"locations": ["l1"], "pseudoEvents": [],
                                       "ua": {"groups": ["g1"]}}),
        event("c", event_id="3", meta={"locations": ["l1"], "pseudoevents": ["p"],
                                       "ua": {"groups": ["g1"]}}),
    ]
    dims = explode_dimensions(valid_json_rows(parse_events(_lines(spark, lines))))
    assert dims.columns == ["year", "month", "day", "serverTs", "siteId", "eventName",
                            "location", "pseudoEvent", "uaGroup"]
    got = rows(dims)
    assert len(got) == 2 * 3 * 1        # empty and mis-cased arrays drop their events
    assert {r[:3] for r in got} == {(2016, 1, 1)}
    assert {(r[6], r[7]) for r in got} == {(l, p) for l in ("l1", "l2") for p in ("p1", "p2", "p3")}


def test_staged_snappy_text_reads_back(spark, tmp_path):
    from logtally.sinks import stage_lines
    write_gz(tmp_path / "in" / "a.gz", EDGE_LINES)
    src = scan_lines(spark, str(tmp_path / "in"))
    out = stage_lines(src, str(tmp_path / "stage"), source_paths=[str(tmp_path / "in")])
    back = scan_lines(spark, out, with_path=False)
    assert rows(back) == rows(src.select("line"))
    assert any(p.endswith(".snappy") for p in (x.name for x in (tmp_path / "stage").iterdir()))


def test_scan_events_modes(spark, tmp_path):
    import pytest
    write_gz(tmp_path / "a.gz", [EDGE_LINES[0], EDGE_LINES[2]])
    with pytest.raises(Exception):
        scan_events(spark, str(tmp_path / "a.gz"), mode="FAILFAST").collect()
    dropped = scan_events(spark, str(tmp_path / "a.gz"), mode="DROPMALFORMED")
    assert [r.eventId for r in dropped.select("eventId").collect()] == ["e1"]


def test_parse_events_field_subset_keeps_validity(spark):
    lines = _lines(spark, EDGE_LINES)
    full = parse_events(lines)
    sub = parse_events(lines, fields=("eventId", "name"))
    assert sub.columns == ["eventId", "name", "_isValid"]
    assert [tuple(r) for r in sub.collect()] == \
        [tuple(r) for r in full.select("eventId", "name", "_isValid").collect()]


def test_explode_reads_only_used_nested_fields(spark, tmp_path):
    import contextlib
    import io
    lines = [event("a", meta={"domain": "d", "locations": ["x"], "pseudoEvents": ["p"],
                              "ua": {"browser": "b", "groups": ["g"]}})]
    path = str(tmp_path / "events")
    parse_events(_lines(spark, lines)).write.parquet(path)
    dims = explode_dimensions(valid_json_rows(spark.read.parquet(path)))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        dims.explain("formatted")
    schema = [ln for ln in buf.getvalue().splitlines() if ln.startswith("ReadSchema")][0]
    assert "locations" in schema and "groups" in schema
    for unused in ("domain", "browser", "clientLanguage", "zoomLevel", "eventId"):
        assert unused not in schema
    assert dims.count() == 1


def test_read_events_counts_like_the_text_scan(spark, tmp_path):
    from logtally.sources import read_events
    write_gz(tmp_path / "a.gz", EDGE_LINES)
    ev = read_events(spark, str(tmp_path / "a.gz"), fields=("eventId",))
    assert ev.count() == len(EDGE_LINES)
    assert valid_json_rows(ev).count() == 4            # the count-only query works here
    text = scan_lines(spark, str(tmp_path / "a.gz"))
    assert tuple(counts_match(text, valid_json_rows(ev)).first()) == (6, 4, False)


def test_a_line_is_valid_only_as_one_whole_object(spark):
    lines = {'{"name":"a"}': True, ' {"name":"a"} ': True, '{"name":"}x"}': True, '{"name":"} {x"}': True,
             '{"meta":{"ua":{}} , "name":"b"}': True, '{"name":"a"} junk': False, '{"name":"a"}{"name":"b"}': False,
             '{"name":"a"},{"name":"b"}': False, '{"name":"a"}]': False, '{"name":"a"}],[{}': False, '{"name":"a"}}': False,
             '{"name":"a"},"b":{"c":1}': False, "[1]": False, "": False}
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = {r["line"]: r["_isValid"] for r in parse_events(df, keep=("line",), fields=("name",)).collect()}
    assert got == lines


def test_a_line_is_parsed_once_and_only_the_object_alone_counts(spark):
    good = event("n", meta={"locations": ["a"], "pseudoEvents": [], "ua": {"groups": ["x}"]}})
    lines = {good: True, good + " \t": True, "{}": True, good.replace('"n"', '"n}{\\""'): True, good.replace('["a"]', '7'): True,
             good + " {}": False, good + ",{}": False, good + "]": False, good + "} {}": False, good + ",0]": False,
             good + ",{}] {}": False, good + ',{"_last":1}]': False, good[:-1]: False, "": False, "null": False, "[{}]": False}
    parsed = parse_events(spark.createDataFrame([(x,) for x in lines], "line string"), keep=("line",))
    assert {r["line"]: r["_isValid"] for r in parsed.collect()} == lines
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    # A wrong type leaves its siblings.
    row = parsed.where(F.col("line").contains('"locations": 7')).first()
    assert row["name"] == "n" and row["meta"]["locations"] is None and row["meta"]["ua"]["groups"] == ["x}"]


def test_large_products_are_dealt_over_tasks(spark):
    """One event of 10^6 rows beside small ones: the same rows, from several tasks."""
    big = {"locations": [f"l{k}" for k in range(500)], "pseudoEvents": [f"p{k}" for k in range(100)],
           "ua": {"groups": [f"g{k}" for k in range(20)]}}
    small = {"locations": ["a", "b"], "pseudoEvents": ["p"], "ua": {"groups": ["g", "h"]}}
    none = {"locations": [], "pseudoEvents": ["p"] * 400, "ua": {"groups": ["g"] * 400}}
    lines = [event("big", meta=big), event("small", meta=small), event("none", meta=none), event("nothing")]
    events = parse_events(spark.createDataFrame([(x,) for x in lines], "line string"))
    plain, dealt = explode_dimensions(events), explode_dimensions(events, block_rows=10_000)
    assert dealt.columns == plain.columns

    def digest(df):
        h = F.xxhash64(*df.columns).cast("decimal(38,0)")
        return df.agg(F.count(F.lit(1)), F.sum(h), F.sum(h * (h % 1_000_003))).first()

    assert digest(dealt) == digest(plain) and digest(plain)[0] == 1_000_004
    tasks = dealt.where("eventName = 'big'").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) < 500_000
