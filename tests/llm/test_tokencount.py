import random
import re

import public_tokenizers

from logtally.llm import tokencount
from tests.llm.helpers import by_id, documents, frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


def plain_count(text, scores, byte):
    """The same by one table over all cuts of one marked text, scores first, then fewer pieces."""
    longest = max(map(len, scores))
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        raw = len(text[end - 1].encode())
        ways = [(best[end - 1][0] + byte * raw, -(best[end - 1][1] + raw))]
        ways += [(best[s][0] + scores[text[s:end]], -(best[s][1] + 1))
                 for s in range(max(0, end - longest), end) if text[s:end] in scores]
        # Sums taken in another order differ by rounding, which must not decide a tie.
        top = max(w[0] for w in ways)
        top = max((w for w in ways if w[0] >= top - 1e-9), key=lambda w: w[1])
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_whole_texts_match_one_table_each(spark):
    """Each text at once, white space and all, against its pre-tokens counted apart."""
    pieces = tokencount.read_pieces(PATH)
    scores = {p: s for p, s in pieces.tails.items() if s is not None}
    rows = documents(1) + [(900, "日本語 ☃☃ éa", None, None, 0), (901, "ab" * 3000, None, None, 0),
                           (902, "the the\x0bthe", None, None, 0), (903, " \n\n\t  ", None, None, 0),
                           (904, "def f(x):\r\n        return  x \n", None, None, 0), (905, "", None, None, 0)]
    got = by_id(tokencount.token_counts(frame(spark, rows, extra=True), PATH))
    for i, text, *_ in rows:
        text = text or ""
        tokens = plain_count(tokencount.MARK + text.replace(" ", tokencount.MARK), scores, pieces.byte) if text else 0
        assert (got[i]["n_words"], got[i]["n_tokens"]) == (len(re.findall(r"[^\x20\x09-\x0D]+", text)), tokens), text[:40]
    assert got[903]["n_words"] == 0 and got[903]["n_tokens"] > 0
    assert tokencount.token_counts(frame(spark, rows).limit(0), PATH).collect() == []


def test_counts_are_near_those_of_the_vocabulary_itself(spark):
    """The vocabulary's own way is another (merges), so counts agree closely, not exactly."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r["text"]]
    mine = [n for _, n in tokencount.Counter(tokencount.read_pieces(PATH)).count(texts)]
    own = [len(ids) for ids in model.encode(texts, num_threads=1)]
    assert sum(abs(a - b) for a, b in zip(mine, own)) <= 0.05 * sum(own)


def test_probabilities_sum_to_one_and_pieces_across_pre_tokens_are_refused(monkeypatch):
    import math

    import pytest
    scores = tokencount.zipf_scores([f"p{k}" for k in range(1000)])
    assert abs(math.fsum(map(math.exp, scores.values())) - 1) < 1e-9
    assert list(scores.values()) == sorted(scores.values(), reverse=True)
    monkeypatch.setattr(tokencount, "ACROSS", re.compile("the"))
    with pytest.raises(ValueError, match="go over"):
        tokencount.read_pieces(PATH)


def test_shared_prefixes_ties_and_unknown_characters():
    pieces = tokencount.pieces_of({"▁a": -1.0, "b": -1.0, "▁ab": -2.0, "c": -0.5, "bc": -3.0, "▁": -4.0})
    words = sorted({"".join(w) for n in range(1, 6) for w in [random.Random(k).choices("abcx", k=n) for k in range(60)]})
    scores = {p: s for p, s in pieces.tails.items() if s is not None}
    words = [tokencount.MARK + w for w in words]
    got = dict(tokencount.walk(words, pieces))
    assert got == {w: plain_count(w, scores, pieces.byte) for w in words}
    assert dict(tokencount.walk(["▁ab"], pieces)) == {"▁ab": 1}          # equal scores: fewer pieces


def test_cache_resets_and_small_chunks(monkeypatch):
    pieces = tokencount.read_pieces(PATH)
    texts = [r[1] or "" for r in documents(2, 30)]
    want = tokencount.Counter(pieces).count(texts)
    monkeypatch.setattr(tokencount, "KEPT_WORDS", 5)
    monkeypatch.setattr(tokencount, "KEPT_LENGTH", 4)
    counter = tokencount.Counter(pieces)
    assert [counter.count([t])[0] for t in texts] == want
