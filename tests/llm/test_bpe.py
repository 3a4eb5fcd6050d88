import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import tiktoken

from logtally.llm import bpe
from tests.llm.helpers import by_id, documents, frame

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", " ", "a", "  \n\n x", "\x1c\x1d a\x85b", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語テキスト éé", "😀😀😀 a😀", "aaaa" * 50 + " bbbb" * 40,
       "'s't're x'LL", "<|endoftext|>", "1234567 89", "the" * 9, "\r\n\r\n\t\t a", "ab" * 5000]


def test_operator_equals_the_library(spark):
    rows = documents(1) + [(1000 + k, t, None, None, 0) for k, t in enumerate(ODD)]
    got = by_id(bpe.encode_digests(frame(spark, rows, extra=True), PATH, public_tokenizers.PATTERN).select(
        "row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256"))
    for i, text, *_ in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_round_trip_through_ids(spark):
    rows = documents(2, 30)
    encoded = bpe.encode(frame(spark, rows), PATH, public_tokenizers.PATTERN, carry=["doc_id"])
    back = bpe.decode_ids(encoded.select("row.doc_id", "ids"), PATH)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in back.collect()} == {r[0]: r[1] or "" for r in rows}
    assert bpe.encode(frame(spark, rows).limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_small_chunks_and_a_forgetful_cache(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    encoder = bpe.Encoder(bpe.Merges(RANKS), public_tokenizers.PATTERN)
    for text in ODD:
        assert encoder.encode([text])[0].tolist() == LIBRARY.encode_ordinary(text)


def test_merge_that_makes_a_lower_rank_is_redone():
    """A rank table no training gives: merging ``bc`` makes ``abc``, which ranks below it."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 300, b"bc": 301, b"cd": 302, b"bcd": 299}
    library = tiktoken.Encoding("odd", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    words = [b"abcd", b"abcabc", b"xbcdx", b"ccdabc", b"aabccd", b"cdcdbcbc", b"abccd"]
    ids, counts = bpe.replay(words, bpe.Merges(ranks))
    got = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [library.encode_ordinary(w.decode()) for w in words] == [bpe.encode_word(w, ranks) for w in words]


def test_pairs_in_small_pieces(monkeypatch):
    words = [w.encode() for text in ODD for w in [text, "", text[::2]]]
    merges = bpe.Merges(RANKS)
    for some in (words, words[:1], []):
        monkeypatch.setattr(bpe, "PAIRS_AT_ONCE", 1 << 17)
        want = bpe.replay(some, merges)
        monkeypatch.setattr(bpe, "PAIRS_AT_ONCE", 3)
        assert [x.tolist() for x in bpe.replay(some, merges)] == [x.tolist() for x in want]


def test_replay_needs_few_bytes_per_byte():
    """Several arrays of 64-bit places at once made it 70."""
    rng = random.Random(3)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(4, 14))).encode() for _ in range(100_000)]
    merges = bpe.Merges(RANKS)
    tracemalloc.start()
    try:
        bpe.replay(words, merges)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 45 * sum(map(len, words))
