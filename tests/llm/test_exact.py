import hashlib

import pytest

from logtally.llm import exact
from tests.llm.helpers import documents, frame

DELETE = dict.fromkeys([0x20, *range(9, 14)])


def brute(rows):
    """Sorted (doc_id, keep_id, size, kept, sha)."""
    groups: dict = {}
    for i, text, *_ in rows:
        groups.setdefault((text or "").translate(DELETE), []).append((-len(text or ""), i is None, i))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for k, m in enumerate(members):
            out.append((m[2], members[0][2], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,parts", [(1, 1), (2, 7), (3, 40)])
def test_matches_brute_force(spark, seed, parts):
    rows = documents(seed)
    rows += [(300 + k, "same  text\n" + " " * (k % 3), None, None, 0) for k in range(50)]     # a group over many partitions
    rows += [(None, "same text", None, None, 0), (None, None, None, None, 0), rows[2], rows[2], (400, "a\x85b", None, None, 0)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = exact.exact_groups(frame(spark, rows, extra=True))
        got = sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)
        kept = exact.drop_exact_copies(frame(spark, rows, extra=True))
        texts = sorted((r["text"] or "").translate(DELETE) for r in kept.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == brute(rows)
    assert kept.columns == frame(spark, rows[:1], extra=True).columns
    assert texts == sorted({(r[1] or "").translate(DELETE) for r in rows})


def test_long_runs_go_out_in_pieces(spark):
    rows = documents(4) + [(300 + k, "same text" + " " * (k % 3), None, None, 0) for k in range(100)] + [(None, "same text", None, None, 0)] * 9
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, run_rows in ((1, 1), (1, 10), (5, 4), (3, 100)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = exact.exact_groups(frame(spark, rows), run_rows=run_rows)
            assert sorted((tuple(r) for r in got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_the_longest_then_the_smallest_stays(spark):
    rows = [(5, "a b", None, None, 0), (7, "a  b", None, None, 0), (3, "ab", None, None, 0), (6, "a \tb", None, None, 0)]
    assert [r["doc_id"] for r in exact.drop_exact_copies(frame(spark, rows)).collect()] == [6]


def test_empty_table(spark):
    assert exact.exact_groups(frame(spark, [(1, "x", None, None, 0)]).limit(0)).collect() == []
    assert exact.drop_exact_copies(frame(spark, [(1, "x", None, None, 0)]).limit(0)).collect() == []
