import random
from collections import Counter

import numpy as np
import pytest

from logtally.llm import suffixranks
from tests.llm.helpers import by_id, documents, frame

L = suffixranks.LENGTH


def brute(rows):
    """One (doc_id, bytes, kept, spans) per row: every window counted in a dictionary."""
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(x[k:k + L] for _, x in texts for k in range(len(x) - L + 1))
    out = []
    for i, x in texts:
        gone = bytearray(len(x))
        for k in range(len(x) - L + 1):
            if seen[x[k:k + L]] > 1:
                gone[k:k + L] = b"\1" * L
        edges = np.flatnonzero(np.diff(np.frombuffer(b"\0" + bytes(gone) + b"\0", np.int8))).tolist()
        out.append((i, len(x), bytes(c for c, g in zip(x, gone) if not g), list(zip(edges[::2], edges[1::2]))))
    return sorted(out, key=str)


def result(df):
    got = [(r["doc_id"], r["n_bytes"], bytes(r["kept"]), [tuple(s) for s in r["spans"]], r["n_removed"]) for r in df.collect()]
    assert all(sum(b - a for a, b in spans) == removed for _, _, _, spans, removed in got)
    return sorted((g[:4] for g in got), key=str)


def noise(rng, n, letters="abcdefghij klmno"):
    return "".join(rng.choices(letters, k=n))


def planted(seed):
    """Near copies, lines and passages of odd lengths in ever new surroundings, periodic texts."""
    rng = random.Random(seed)
    base, line, short = [noise(rng, 900) for _ in range(4)], noise(rng, 230), noise(rng, 120)
    texts = ["", "a" * 1000, "ab" * 300, "a" * (L - 1), "a" * L, base[2], "é日本" * 90, None]
    for _ in range(40):
        text, k = rng.choice(base), rng.randrange(800)
        texts.append(text[:k] + noise(rng, rng.randrange(3)) + text[k:])
        texts.append(noise(rng, rng.randrange(300)) + line[:rng.randrange(190, 230)] + noise(rng, 200) + short + noise(rng, 50) + line)
        texts.append(noise(rng, 400))
    texts.append(noise(rng, 3000) + base[3] + noise(rng, 100) + base[3])
    return [(i, t, None, None, 0) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limit", [suffixranks.LIMIT, 5, 60])
def test_matches_brute_force(spark, limit):
    """With a small limit, most cores are counted by Spark in place of a task."""
    rows = planted(limit)
    want = brute(rows)
    assert result(suffixranks.remove_repeated_bytes(frame(spark, rows).repartition(5), limit=limit)) == want
    assert sum(len(kept) for _, _, kept, _ in want) < 0.8 * sum(n for _, n, _, _ in want)


def test_documents_with_odd_rows_and_clashing_columns(spark):
    rows = documents(3)
    assert result(suffixranks.remove_repeated_bytes(frame(spark, rows, extra=True))) == brute(rows)


def test_rows_that_repeat_or_share_an_identifier(spark):
    rng = random.Random(2)
    a, b = noise(rng, 500), noise(rng, 260)
    rows = [(None, a, None, None, 0), (None, a, None, None, 0), (None, b, None, None, 0), (7, noise(rng, 30) + b[:230], None, None, 0),
            (7, noise(rng, 300), None, None, 0), (8, a[:L + 1], None, None, 0)]
    rows += [(None, a, None, None, 0), (9, b, None, None, 0)] * 150
    assert result(suffixranks.remove_repeated_bytes(frame(spark, rows))) == brute(rows)
    assert suffixranks.remove_repeated_bytes(frame(spark, rows).limit(0)).collect() == []


def test_texts_longer_than_a_block(spark):
    rng = random.Random(4)
    long = noise(rng, 2 * suffixranks.BLOCK + 777)
    cut = suffixranks.BLOCK
    rows = [(1, long, None, None, 0), (2, long[cut - 150:cut + 150], None, None, 0), (3, noise(rng, 50) + long[-400:], None, None, 0)]
    got = by_id(suffixranks.remove_repeated_bytes(frame(spark, rows)))
    assert [[tuple(s) for s in got[k]["spans"]] for k in (1, 2, 3)] == [
        [(cut - 150, cut + 150), (len(long) - 400, len(long))], [(0, 300)], [(50, 450)]]


def test_names_are_equal_for_equal_bytes_only():
    rng = random.Random(6)
    data = np.frombuffer(noise(rng, 2000, "ab").encode() * 2, np.uint8)
    for length in (50, 100, 200):
        name = suffixranks.names(data, length)
        strings = [data[k:k + length].tobytes() for k in range(len(name))]
        assert len(set(zip(strings, name.tolist()))) == len(set(strings)) == len(set(name.tolist()))


def test_settle_keeps_one_of_each_cover_where_a_core_is_undecided():
    core, cover = np.array([1, 2, 2, 3, 3, 3]), np.array([5, 6, 6, 7, 7, 8])
    shared, undecided, met = suffixranks.settle(core, cover, np.zeros(6, bool))
    assert shared.tolist() == [False, True, True, True, True, False]
    assert undecided.tolist() == [False] * 5 + [True] and met.tolist() == [False] * 3 + [True, False, False]
    shared, undecided, met = suffixranks.settle(core, cover, core < 3)
    assert undecided.tolist() == [True] + [False] * 4 + [True] and met.tolist() == [False, True, False, True, False, False]
