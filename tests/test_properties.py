"""Property tests: operators against brute-force models of the original SQL."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from logtally.operators import counts_match, distinct_files, left_reconcile, reconcile, reconcile_spine
from tests.conftest import rows

META = "sourceFileAbsolutePath string, fileName string, lineCount long"
NAMES = st.sampled_from(["a", "b", "c", "d", None])
# One row per path; a path maps to one name (names may repeat across paths).
SIDE = st.lists(st.tuples(NAMES, st.integers(1, 50)), max_size=8)

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _meta(spark, side, prefix):
    data = [(f"{prefix}/{i}", name, n) for i, (name, n) in enumerate(side)]
    return spark.createDataFrame(data, META)


def _sums(side):
    out = defaultdict(int)
    for name, n in side:
        out[name] += n
    return out


def _sort(xs):
    return sorted(xs, key=repr)


@SETTINGS
@given(raw=SIDE, clean=SIDE)
def test_reconcile_is_full_outer_of_sums(spark, raw, clean):
    r, c = _sums(raw), _sums(clean)
    want = [(k, r.get(k, 0), c.get(k, 0)) for k in set(r) | set(c)]
    assert rows(reconcile(_meta(spark, raw, "r"), _meta(spark, clean, "c"))) == _sort(want)


@SETTINGS
@given(raw=SIDE, clean=SIDE)
def test_reconcile_spine_is_the_original_report(spark, raw, clean):
    # The original: UNION ALL of each side's distinct names, then two LEFT
    # JOINs on name (NULL never matches). Summing per name replaces the
    # raw x clean row pairs of a name shared by several paths.
    r, c = _sums(raw), _sums(clean)
    spine = list({n for n, _ in raw}) + list({n for n, _ in clean})
    want = [(k, r.get(k, 0) if k is not None else 0, c.get(k, 0) if k is not None else 0)
            for k in spine]
    got = rows(reconcile_spine(_meta(spark, raw, "r"), _meta(spark, clean, "c")))
    assert got == _sort(want)
    # With one path per name the original's own fan-out reduces to the same rows.
    if all(v == 1 for k, v in Counter(n for n, _ in raw).items() if k is not None) and \
            all(v == 1 for k, v in Counter(n for n, _ in clean).items() if k is not None):
        fan = []
        for k in spine:
            rr = [n for name, n in raw if name == k and k is not None] or [0]
            cc = [n for name, n in clean if name == k and k is not None] or [0]
            fan += [(k, x, y) for x in rr for y in cc]
        assert got == _sort(fan)


@SETTINGS
@given(raw=SIDE, clean=SIDE)
def test_left_reconcile_and_distinct_files(spark, raw, clean):
    c = _sums([(n, v) for n, v in clean if n is not None])
    want = [(name, n, c.get(name)) for name, n in raw]
    rm, cm = _meta(spark, raw, "r"), _meta(spark, clean, "c")
    assert rows(left_reconcile(rm, cm)) == _sort(want)
    files = [(n,) for n in {n for n, _ in raw}] + [(n,) for n in {n for n, _ in clean}]
    assert rows(distinct_files(rm, cm)) == _sort(files)


@SETTINGS
@given(a=st.integers(0, 30), b=st.integers(0, 30))
def test_counts_match_model(spark, a, b):
    left = spark.range(a).toDF("x")
    right = spark.range(b).toDF("y")
    assert tuple(counts_match(left, right).first()) == (a, b, a == b)


PATH_CHARS = st.text(alphabet="ab/ %+#.-_é", max_size=30)


@SETTINGS
@given(paths=st.lists(st.one_of(st.none(), PATH_CHARS), max_size=6))
def test_relative_name_matches_split_model(spark, paths):
    import re

    from logtally.functions import relative_name

    def model(p):
        if p is None:
            return None
        parts = re.split("clean/", p)
        return parts[1] if len(parts) > 1 else None

    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(relative_name("p", "clean/")).collect()]
    assert got == [model(p) for p in paths]


@SETTINGS
@given(names=st.lists(PATH_CHARS, max_size=6))
def test_decode_inverts_uri_encoding(spark, names):
    from urllib.parse import quote

    from logtally.functions import decode_file_path

    encoded = [("file:/x/" + quote(n, safe="/"),) for n in names]
    df = spark.createDataFrame(encoded, "p string")
    got = [r[0] for r in df.select(decode_file_path("p")).collect()]
    assert got == ["file:/x/" + n for n in names]


@SETTINGS
@given(ms=st.lists(st.integers(-2_000_000_000_000, 4_102_444_800_000), min_size=1, max_size=8),
       rounding=st.sampled_from(["ceil", "floor"]))
def test_calendar_parts_match_datetime(spark, ms, rounding):
    import math
    from datetime import datetime, timezone

    from logtally.functions import calendar_parts

    def model(v):
        sec = math.ceil(v / 1000) if rounding == "ceil" else math.floor(v / 1000)
        d = datetime.fromtimestamp(sec, tz=timezone.utc)
        return (v, d.year, d.month, d.day)

    df = spark.createDataFrame([(v,) for v in ms], "ms long")
    got = [tuple(r) for r in df.select("ms", *calendar_parts("ms", rounding)).collect()]
    assert got == [model(v) for v in ms]
