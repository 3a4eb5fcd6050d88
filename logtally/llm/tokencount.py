"""Token counts under a unigram vocabulary, by trie-shared dynamic programming.

The distinct pre-tokens of a task's documents are put in a trie. It is walked
depth first: each node holds the best forward score of its prefix (the highest
sum of piece scores, then the fewest pieces), computed once from its ancestors
for all pre-tokens below it; where a pre-token ends, its count is stored.
Walking the sorted pre-tokens and keeping the scores of the common prefix is
that walk without nodes in memory.

Pieces have the log probabilities of a unigram model that follows Zipf's law over the
vocabulary's own order: the piece of rank r has probability 1 / (r * H), H the harmonic
number of their count. Nothing is trained. Characters that no piece covers cost one byte
piece per UTF-8 byte, as the vocabulary's byte fallback has it.

All of a text is counted, white space too: the text with a blank before it, blanks
written as the word mark, is cut before a mark after another character and around
runs of tabs and line feeds. No piece goes over such a cut (``read_pieces`` makes sure),
so the pre-tokens' counts add up to that of the whole text.

Defined results: a null or empty text has no words and no tokens; a text of white space
alone has tokens and no words; texts and pre-tokens of any length are counted whole;
repeated rows are counted each; an empty table gives an empty table. Counts of short
pre-tokens seen again in a task come from its bounded cache, which changes no result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import WORD
from logtally.session import ship_package

MARK = "▁"
# Pre-tokens of a marked text, and what a piece may not hold for them to be independent.
PRE_TOKEN = re.compile(f"[\t\n]+|{MARK}*[^{MARK}\t\n]+|{MARK}+")
ACROSS = re.compile(f"[\t\n]|[^{MARK}]{MARK}")
# Distinct pre-tokens that a task keeps, beyond which it starts anew, and their greatest length.
KEPT_WORDS = 500_000
KEPT_LENGTH = 64
# Pre-tokens gathered before a walk.
CHUNK_CHARS = 8_000_000


# Pieces that the vocabulary keeps for its own use score below this.
UNUSED = -1e6
# What a byte piece scores less than the least of the pieces: the last resort.
BYTE_PENALTY = 10.0


class Pieces(NamedTuple):
    """``tails``: every ending of a piece -> the piece's score, or None where it
    only is the end of a longer one; ``byte``: score of a byte piece."""
    tails: dict[str, float | None]
    byte: float


def pieces_of(scores: dict[str, float]) -> Pieces:
    tails: dict[str, float | None] = {}
    for piece in scores:
        for k in range(1, len(piece)):
            tails.setdefault(piece[k:], None)
    tails.update(scores)
    return Pieces(tails, min(scores.values(), default=0.0) - BYTE_PENALTY)


def zipf_scores(ranked: list[str]) -> dict[str, float]:
    """Log probability of each piece, the most frequent first."""
    total = math.log(math.fsum(1 / r for r in range(1, len(ranked) + 1))) if ranked else 0.0
    return {piece: -math.log(r) - total for r, piece in enumerate(ranked, 1)}


def read_pieces(path: str) -> Pieces:
    """Pieces of a model file in its order of scores (read on the driver; a fixed vocabulary)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
           and model.get_score(i) > UNUSED]
    ranked = [model.id_to_piece(i) for i in sorted(ids, key=lambda i: (-model.get_score(i), i))]
    across = [p for p in ranked if ACROSS.search(p)]
    if across:
        raise ValueError(f"pieces that go over pre-tokens: {across[:5]}")
    return pieces_of(zipf_scores(ranked))


def walk(words: Iterable[str], pieces: Pieces) -> Iterator[tuple[str, int]]:
    """(pre-token, its token count) for sorted distinct pre-tokens, in one depth-first walk."""
    get, byte, absent = pieces.tails.get, pieces.byte, object()
    best: list[float] = [0.0]      # forward score of each prefix on the path
    count: list[int] = [0]         # pieces on that best way
    last = ""
    for marked in words:
        n, shared, most = len(marked), 0, min(len(marked), len(last))
        while shared < most and marked[shared] == last[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, n + 1):
            # The byte way over the last character is always open.
            raw = len(marked[end - 1].encode("utf-8", "surrogatepass"))
            top, few = best[end - 1] + byte * raw, count[end - 1] + raw
            for start in range(end - 1, -1, -1):
                score = get(marked[start:end], absent)
                if score is None:
                    continue
                if score is absent:       # no piece ends this way, nor does any longer one
                    break
                score += best[start]
                if score > top or (score == top and count[start] + 1 < few):
                    top, few = score, count[start] + 1
            best.append(top)
            count.append(few)
        last = marked
        yield marked, count[n]


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


class Counter:
    """Counts texts chunk by chunk."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.find = pieces, re.compile(WORD).findall
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        cut = [pre_tokens(t) for t in texts]
        counts = self.known
        fresh = dict(walk(sorted({w for ws in cut for w in ws if w not in counts}), self.pieces))
        long = {w: n for w, n in fresh.items() if len(w) > KEPT_LENGTH}
        counts.update(fresh)
        got = [(len(self.find(t)), sum([counts[w] for w in ws])) for t, ws in zip(texts, cut)]
        for w in long:
            del counts[w]
        return got


def _mapper(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            got: list[tuple[int, int]] = []
            part: list[str] = []
            size = 0
            for text in batch.column("t").to_pylist():
                part.append(text)
                size += len(text)
                if size >= CHUNK_CHARS:
                    got += counter.count(part)
                    part, size = [], 0
            got += counter.count(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([w for w, _ in got], pa.int64()), pa.array([n for _, n in got], pa.int64())],
                names=["id", "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, n_words, n_tokens)`` per document. Map-only."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(read_pieces(model_path))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(
        _mapper(shared), "id long, n_words long, n_tokens long").withColumnRenamed("id", id_col)
