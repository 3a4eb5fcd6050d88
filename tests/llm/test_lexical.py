import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from logtally.llm import lexical
from tests.llm.helpers import documents, frame

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, k=10):
    """Every document scored for every item by the formula."""
    counted = [(r[0], Counter(terms(r[1]))) for r in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    size, docs = sum(n for _, _, n in counted), len(counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counted:
            m = 25 + 75 * n * docs // size
            score = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort()
        out += [(item, rank + 1, i, -s) for rank, (s, _, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def corpus(seed):
    rows = documents(seed, 300)
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices((rows[rng.randrange(len(rows))][1] or "x").split() + ["The", "w3"], k=rng.choice([1, 3, 20, 60]))))
             for i in range(25)]
    return rows, items + [(90, None), (91, ""), (92, "?! --"), (93, "nowhere unknownword"), (94, "RIVER River river"), (None, "w1 w2")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    rows, items = corpus(seed)
    got = found(lexical.search(frame(spark, rows, extra=seed == 1), asked(spark, items)))
    assert got == brute(rows, items)


def test_queries_in_blocks_give_the_same(spark):
    rows, items = corpus(3)
    assert found(lexical.search(frame(spark, rows), asked(spark, items), block_terms=100, k=3)) == brute(rows, items, 3)


def test_ties_go_by_identifier_and_rows_that_repeat_both_rank(spark):
    rows = [(k % 40, "alpha beta", None, None, 0) for k in range(60)] + [(None, "alpha beta", None, None, 0), (99, "other words", None, None, 0)] * 2
    items = [(1, "alpha"), (1, "beta beta"), (2, "other alpha")]
    assert found(lexical.search(frame(spark, rows), asked(spark, items))) == brute(rows, items)


def test_empty_tables(spark):
    rows, items = corpus(4)
    assert found(lexical.search(frame(spark, rows).limit(0), asked(spark, items))) == []
    assert found(lexical.search(frame(spark, rows), asked(spark, items).limit(0))) == []
    assert found(lexical.search(frame(spark, [(1, None, None, None, 0), (2, "...", None, None, 0)]), asked(spark, items))) == []


def test_terms_are_the_same_in_pieces(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab Z9é日\n-_\x00\x7f", k=300)) for _ in range(40)] + ["x" * 50 + " y", "", "é" * 30, " " * 40]
    for piece in (7, 16, 1 << 20):
        monkeypatch.setattr(lexical, "PIECE", piece)
        for text in texts:
            got = [w.decode() for part in lexical.terms_of(text.encode()) for w in part]
            assert got == terms(text)


def test_bounds_prune_and_lose_nothing():
    """Buckets by length under a threshold: those passed over hold no document that reaches it."""
    rng = np.random.default_rng(1)
    passed = 0
    for _ in range(200):
        n, v = 50, 30
        dense = rng.integers(0, 1000, (n, v)) * (rng.random((n, v)) < 0.2) * rng.integers(1, 20)
        query = lexical.Query(np.flatnonzero(rng.random(v) < 0.3).astype(np.int32), None)
        query = query._replace(weights=rng.integers(0, 500, len(query.terms)))
        scores = dense[:, query.terms] @ query.weights
        hits = [np.flatnonzero(r) for r in dense]
        bucket = lexical.Bucket(np.cumsum([0, *map(len, hits)]), np.concatenate(hits), dense[dense > 0],
                                np.sqrt((dense.astype(float) ** 2).sum(1)))
        least = int(rng.choice(scores)) * int(rng.choice([1, 1, 4])) + int(rng.integers(0, 3))
        rows, got, looked = bucket.search(query, least, 5)
        passed += not looked
        want = sorted(zip((-scores).tolist(), range(n)))[:5]
        assert {(s, r) for s, r in want if -s >= max(least, 1)} <= set(zip((-got).tolist(), rows.tolist()))
        assert all(scores[r] == s for r, s in zip(rows, got))
    assert passed
