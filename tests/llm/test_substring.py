import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from logtally.llm import substring
from tests.llm.helpers import by_id, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """doc_id -> (words, removed, kept) by comparing every window with all before it."""
    out, seen = {}, set()
    for i, text in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0])):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s:s + 20])
            if window in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(window)
        out[i] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = documents(seed)
    got = by_id(substring.remove_repeats(frame(spark, rows, extra=seed == 1)))
    want = brute(rows)
    assert {i: (r["n_words"], r["n_removed"], r["kept"]) for i, r in got.items()} == want
    assert sum(n for _, n, _ in want.values()) > 500
    for r in got.values():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_periods_overlaps_and_ties(spark):
    """Repeats within a document at every period, and a long repeat with its ends elsewhere."""
    rng = random.Random(7)
    base = [f"b{k}" for k in range(90)]
    rows = []
    for p in range(1, 24):
        unit = [f"p{p}_{k}" for k in range(p)]
        rows.append((p, " ".join((unit * 60)[:rng.randrange(18, 70)]), None, None, 0))
    for k in range(40):
        a, b = sorted(rng.sample(range(91), 2))
        rows.append((100 + k, " ".join([f"l{k}", *base[a:b], f"r{k}", *base[:b - a]]), None, None, 0))
    got = by_id(substring.remove_repeats(frame(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept"]) for i, r in got.items()} == brute(rows)


def test_hot_shards_are_cut_and_lose_nothing(spark, monkeypatch):
    """A passage in every document, each in other surroundings."""
    monkeypatch.setattr(substring, "HOT", 5)
    rng = random.Random(3)
    passage = [f"c{k}" for k in range(30)]
    rows = [(k, " ".join([f"x{rng.randrange(10**9)}" for _ in range(25)] + passage + [f"y{k}_{j}" for j in range(25)]),
             None, None, 0) for k in range(60)]
    got = by_id(substring.remove_repeats(frame(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept"]) for i, r in got.items()} == brute(rows)
    assert sum(r["n_removed"] == 30 for r in got.values()) == 59


def test_one_long_document_makes_no_large_shard(spark, monkeypatch):
    """A phrase again and again within one document, always in other surroundings."""
    monkeypatch.setattr(substring, "HOT", 40)
    streamed = substring._streamed

    def bounded(batches):
        held, size = list(batches), {}
        for batch in held:
            for shard in zip(batch.column("h").to_pylist(), batch.column("part").to_pylist()):
                size[shard] = size.get(shard, 0) + 1
        assert max(size.values(), default=0) <= 40
        return streamed(iter(held))

    monkeypatch.setattr(substring, "_streamed", bounded)
    rng = random.Random(9)
    phrase = " ".join(f"p{k}" for k in range(12))
    lines = [f"{' '.join(f'x{rng.randrange(10**9)}' for _ in range(9))} {phrase}" for _ in range(300)]
    rows = [(1, "\n".join(lines + lines[50:60]), None, None, 0), (2, "\n".join(lines[100:103]), None, None, 0)]
    got = by_id(substring.remove_repeats(frame(spark, rows)))
    assert {i: (r["n_words"], r["n_removed"], r["kept"]) for i, r in got.items()} == brute(rows)
    assert got[1]["n_removed"] >= 200 and got[2]["n_removed"] == 63


def test_rows_that_repeat_and_null_identifiers(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text, None, None, 0), (4, text, None, None, 0), (4, text, None, None, 0), (9, text + " tail", None, None, 0)]
    got = sorted(((r["doc_id"], r["n_removed"]) for r in substring.remove_repeats(frame(spark, rows)).collect()), key=str)
    # The two equal rows are one document; the null identifier comes last.
    assert got == [(4, 0), (4, 0), (9, 30), (None, 30)]
    assert substring.remove_repeats(frame(spark, rows).limit(0)).collect() == []


def test_texts_without_identifier_whose_hashes_share_30_bits(spark):
    passage, again = (" ".join(f"{x}{k}" for k in range(30)) for x in "pq")
    low = lambda t: xxhash.xxh64_intdigest(t.encode(), seed=42) & (1 << 30) - 1
    one = {low(t): t for t in (f"{passage} a{k}" for k in range(60_000))}
    other = next(t for t in (f"{again} {again} b{k}" for k in range(2_000_000)) if low(t) in one)
    rows = [(1, passage, None, None, 0), (None, one[low(other)], None, None, 0), (None, other, None, None, 0)]
    got = sorted((r["n_words"], r["n_removed"]) for r in substring.remove_repeats(frame(spark, rows)).collect())
    assert got == [(30, 0), (31, 30), (61, 30)]


def test_words_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(substring, "BLOCK", 64)
    rows = [(k, " ".join(["z" * 500, *[f"w{j}" for j in range(40)], "z" * 100]), None, None, 0) for k in range(3)]
    got = by_id(substring.remove_repeats(frame(spark, rows)))
    assert [got[k]["n_removed"] for k in range(3)] == [0, 42, 42]


def test_automaton_gives_the_longest_earlier_part():
    rng = random.Random(5)
    for _ in range(50):
        word = rng.choices("ab", k=40)
        automaton = substring.SuffixAutomaton()
        for end in range(1, 41):
            got = automaton.extend(word[end - 1])
            best = max(n for n in range(end) if n == 0 or any(word[s:s + n] == word[end - n:end] for s in range(end - n)))
            assert got == best


def test_query_digest_of_kept_words(spark):
    rows = documents(4, 20)
    df = substring.remove_repeats(frame(spark, rows)).withColumn("sha", F.sha2("kept", 256))
    want = brute(rows)
    assert all(r["sha"] == hashlib.sha256(want[r["doc_id"]][2].encode()).hexdigest() for r in df.collect())
