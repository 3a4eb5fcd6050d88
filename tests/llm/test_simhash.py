import random
import re

import numpy as np
import pytest
import xxhash

from logtally.llm import simhash
from tests.llm.helpers import by_id, documents, frame


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict) -> dict:
    ids, root = sorted(prints), {}
    for i in ids:
        if i in root:
            continue
        root[i], front = i, [i]
        while front:
            a = front.pop()
            for b in ids:
                if b not in root and (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[b] = i
                    front.append(b)
    return root


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = documents(seed)
    rows += [(500 + k, t, None, None, 0) for k, t in enumerate(["One Two", "one two", "ONE two three Four five", None, "É A"])]
    got = by_id(simhash.near_groups(frame(spark, rows, extra=seed == 1)))
    prints = {r[0]: plain_print(r[1]) for r in rows}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(prints)


@pytest.mark.parametrize("limit", [4096, 4])
def test_chains_and_large_groups(spark, monkeypatch, limit):
    """Fingerprints planted at every distance, in chains, with groups over the limit."""
    monkeypatch.setattr(simhash, "GROUP_LIMIT", limit)
    rng = random.Random(4)
    prints = []
    for _ in range(12):
        at = rng.getrandbits(64)
        for _ in range(25):
            prints.append(at)
            for b in rng.sample(range(64), rng.randrange(0, 7)):
                at ^= 1 << b
    prints = sorted(set(prints + [0, (1 << 64) - 1, 1 << 63]))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df)).collect()}
    want: dict = {}
    for i, root in plain_components(dict(enumerate(prints))).items():
        want.setdefault(root, set()).add(signed[i])
    found: dict = {}
    for x in signed:
        found.setdefault(roots.get(x, x), set()).add(x)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_golay_keys_always_meet_within_four_bits():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 1 << 23, 500)
    nearest = words ^ simhash._corrections()[simhash._syndromes(words)]
    assert (simhash._syndromes(nearest) == 0).all()
    assert np.bincount(simhash.nearby_indices(words)[0]).max() == 6
    for _ in range(400):
        x = rng.integers(0, 1 << 63, 1, dtype=np.uint64)
        y = x.copy()
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y ^= np.uint64(1) << np.uint64(b)
        assert set(simhash.keys_of(x.view(np.int64))[1].tolist()) & set(simhash.keys_of(y.view(np.int64))[1].tolist())


def test_one_of_each_group_stays_with_all_columns(spark):
    rows = documents(3)
    df = frame(spark, rows, extra=True)
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    groups = plain_components({r[0]: plain_print(r[1]) for r in rows})
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(groups.values()))
    assert simhash.drop_near_copies(df.limit(0)).collect() == []


def test_null_and_shared_identifiers(spark):
    text = "one two three four five six"
    rows = [(None, text, None, None, 0), (None, text + " seven", None, None, 0), (3, "far away from all the rest here", None, None, 0),
            (3, text, None, None, 0), (2, text, None, None, 0)]
    got = simhash.near_groups(frame(spark, rows)).collect()
    assert len(got) == 5
    kept = simhash.drop_near_copies(frame(spark, rows)).collect()
    prints = [plain_print(r[1]) for r in rows]
    assert len(kept) == len(set(plain_components(dict(enumerate(prints))).values()))
