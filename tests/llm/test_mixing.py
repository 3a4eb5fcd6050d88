import random
import re

from logtally.llm import mixing
from tests.llm.helpers import documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def level_targets(sizes: dict) -> dict:
    """Targets by refilling round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = float(sum(sizes.values())), set(order)
    for _ in range(200):
        total = sum(weight[s] for s in open_)
        if left < 1e-9 or not total:
            break
        spare = 0.0
        for s in list(open_):
            target[s] += left * weight[s] / total
            if target[s] >= 3 * sizes[s]:
                spare += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                open_.discard(s)
        left = spare
    return target


def test_targets_copies_and_reruns(spark):
    rng = random.Random(2)
    rows = [(k, "w " * rng.randrange(0, 120), None, rng.choice(["a"] * 30 + ["b"] * 9 + ["c", "d", None, "é", "Z"]), 0) for k in range(3000)]
    df = frame(spark, rows, extra=True)
    got = mixing.mix_counts(df).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000))
    sizes: dict = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text))
    want = level_targets(sizes)
    by_doc = {r["doc_id"]: r for r in got}
    taken = dict.fromkeys(sizes, 0)
    for i, text, _, source, _ in rows:
        r = by_doc[i]
        assert r["size"] == len(WORD.findall(text)) and r["source_size"] == sizes[source]
        assert abs(r["target"] - want[source]) < 1e-6 * max(1, want[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(250, 0.02 * want[s])
    again = mixing.mix_counts(df.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_the_mix_repeats_rows_as_counted(spark):
    rows = documents(2)
    df = frame(spark, rows, extra=True)
    counts = {r["doc_id"]: r["copies"] for r in mixing.mix_counts(df).collect()}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    seen: dict = {}
    for r in mixed.collect():
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + 1
    assert seen == {i: n for i, n in counts.items() if n}


def test_wordless_sources_single_rows_and_empty_table(spark):
    rows = [(1, None, None, "empty", 0), (2, "", None, "empty", 0), (3, "a b", None, None, 0)]
    got = {r["doc_id"]: r for r in mixing.mix_counts(frame(spark, rows)).collect()}
    assert got[1]["copies"] == got[2]["copies"] == 1 and got[1]["taken"] == 0 and got[1]["target"] == 0.0
    assert got[3]["target"] == 2.0 and got[3]["taken"] == 2
    assert mixing.mix_counts(frame(spark, rows).limit(0)).collect() == []
    twins = mixing.mix_counts(frame(spark, [(1, "a b c", None, "s", 0)] * 4)).collect()
    assert len(twins) == 4 and sum(r["taken"] for r in twins) == 12


def test_no_python_in_the_plan(spark, capsys):
    mixing.mix_counts(frame(spark, documents(1))).explain()
    plan = capsys.readouterr().out
    assert not [x for x in ("Python", "Pandas", "Arrow") if x in plan.replace("PythonRDD", "")]
