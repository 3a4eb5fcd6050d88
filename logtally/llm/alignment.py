"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes.

Tokens of both sides are laid over the bytes they stand for. The cumulative ends of
each side are the keys of a dictionary from end to index; the intersection of both
key sets, sorted, slices both id lists into groups, and the links of a group, the
pairs of tokens whose bytes overlap, are expanded slice by slice.

A blank after a character that is no white space always begins a token of either
side, so a text falls into words there (a property of the vocabularies that is
checked; without it the whole text is one word). A task aligns each distinct word
once and puts the documents together from the words; a text of which a word does
not give back its bytes is encoded as a whole.

How often a pair of ids is linked is counted in groups of documents (some megabytes
each, or one long text): a group gives its distinct pairs with a number each, Spark
sums them over the corpus, and the sums go back to the group, whose documents know
their pairs by number. So a pair that is in every document makes one row per group.

Defined results: a null or empty text, and one whose tokens on either side do not
give its bytes back, has no tokens and no links; the strings of special tokens are
plain text; an empty table gives an empty table. Other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.llm.common import materialise
from logtally.session import ship_package

# Code points of the documents that are counted together.
GROUP_CHARS = 4_000_000
# Aligned words that a task keeps from one group to the next.
KEPT_WORDS = 500_000
# Code points of distinct words that are encoded as one text.
TOGETHER = 100_000
# Bits of an id of side B in a pair.
ID_BITS = 32

_CUT = re.compile(r"(?<=\S)(?= )")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update((chr(256 + k), b) for k, b in enumerate(b for b in range(256) if b not in set(plain)))
    return letters


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The ends that both sides share, in order, and how many tokens of each side lie before them."""
    index_a, index_b = (dict(zip(ends, range(1, len(ends) + 1))) for ends in (ends_a, ends_b))
    common = sorted(index_a.keys() & index_b.keys())
    return common, [index_a[e] for e in common], [index_b[e] for e in common]


def links_of(ends_a: list[int], ends_b: list[int], part: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Pairs of token numbers of one group whose bytes overlap."""
    i, stop, j, _ = part
    out = []
    while i < stop:
        out.append((i, j))
        a, b = ends_a[i], ends_b[j]
        i, j = i + (a <= b), j + (b <= a)
    return out


class Aligned(NamedTuple):
    """Words aligned, one after another."""
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    links: np.ndarray       # pairs of ids: A's, then B's in the low bits


class Aligner:
    """Both tokenizers, and the words aligned so far."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a, self._b = Tokenizer.from_str(a_json), sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self._a.encode_special_tokens = True
        letters = byte_letters()
        self._bytes_a = {i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
                         for token, i in self._a.get_vocab().items()}
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(pieces)]
        parts = json.loads(a_json)
        first = parts.get("pre_tokenizer") or {}
        #: Whether a blank after another character begins a token of either side.
        self.cuts = (parts.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex", False)
                     and not first.get("add_prefix_space") and not any(re.search("[^▁]▁", p) for p in pieces))
        self._blank = self._b.piece_to_id("▁")
        # Groups of one token each, and of several with their links, as they were met.
        self._single: dict[int, str] = {}
        self._several: dict[tuple, tuple[str, list[int]]] = {}
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.n_a, self.n_b, self.n_groups = (np.zeros(0, np.int64) for _ in range(3))
        self.good = np.zeros(0, bool)
        self.groups: list[str] = []
        self.links, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def words(self, text: str) -> list[str]:
        """The blank before the text included."""
        return _CUT.split(" " + text) if self.cuts else [" " + text]

    def _one_text(self, words: list[str]) -> Aligned | None:
        """Words that follow each other in one text; None if a side's tokens do not give the bytes back."""
        whole = "".join(words)
        a = self._a.encode(whole, add_special_tokens=False).ids
        b = self._b.encode(whole[1:], num_threads=1) or [self._blank]        # nothing after the blank
        parts_a, parts_b = [self._bytes_a[i] for i in a], [self._bytes_b[i] for i in b]
        data = whole.encode("utf-8", "surrogatepass")
        if b"".join(parts_a) != data or b"".join(parts_b) != data:
            return None
        ends_a, ends_b = list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b)))
        common, to_a, to_b = map(np.array, common_ends(ends_a, ends_b))
        word_ends = np.cumsum(list(map(len, words)) if len(data) == len(whole) else [len(w.encode("utf-8", "surrogatepass")) for w in words])
        last = np.minimum(np.searchsorted(common, word_ends), len(common) - 1)
        if (common[last] != word_ends).any():
            return None
        from_a, from_b = np.append(0, to_a[:-1]), np.append(0, to_b[:-1])
        # The tokens of a group end together at its end only, so it has a link per end.
        n_links = to_a - from_a + to_b - from_b - 1
        one = n_links == 1
        pairs = np.array(a)[from_a] << ID_BITS | np.array(b)[from_b]
        for pair in np.unique(pairs[one]).tolist():
            if pair not in self._single:
                self._single[pair] = f"{pair >> ID_BITS}|{pair & (1 << ID_BITS) - 1}"
        groups = list(map(self._single.get, pairs.tolist()))
        more, known = [], self._several
        rest = np.flatnonzero(~one)
        for g, i, p, j, q in zip(rest.tolist(), *(x[rest].tolist() for x in (from_a, to_a, from_b, to_b))):
            key = (*a[i:p], -1, *b[j:q])
            if key not in known:
                known[key] = (f"{','.join(map(str, a[i:p]))}|{','.join(map(str, b[j:q]))}",
                              [a[k] << ID_BITS | b[m] for k, m in links_of(ends_a, ends_b, (i, p, j, q))])
            groups[g], links = known[key]
            more += links
        links = np.repeat(pairs, n_links)
        links[np.repeat(~one, n_links)] = more
        cuts = [0, *(last + 1).tolist()]
        totals = [np.diff(np.concatenate([[0], np.cumsum(x)])[cuts]) for x in (to_a - from_a, to_b - from_b, np.ones(len(one), np.int64), n_links)]
        return Aligned(*totals, [";".join(groups[x:y]) for x, y in zip(cuts[:-1], cuts[1:])], links)

    def align(self, words: list[str]) -> list[Aligned | None]:
        """Words, each of which begins with a blank, in runs; None for one whose bytes do not come back.
        Those that end a token on either side whatever follows are encoded as one text."""
        out: list[Aligned | None] = []
        run: list[str] = []
        size = 0

        def close() -> None:
            found = self._one_text(run) if run else None
            if found:
                out.append(found)
            else:
                out.extend(self._one_text([w]) for w in run)

        for word in words:
            if not self.cuts or word[-1].isspace() or "▁" in word or len(word) > TOGETHER:
                close()
                out.append(self._one_text([word]))
                run, size = [], 0
                continue
            run.append(word)
            size += len(word)
            if size > TOGETHER:
                close()
                run, size = [], 0
        close()
        return out

    def learn(self, words: list[str]) -> None:
        """Words not known yet, in the order of their numbers."""
        zero = np.zeros(1, np.int64)
        found = self.align(words)
        self.good = np.concatenate([self.good, *[np.full(len(x.n_a), True) if x else zero.astype(bool) for x in found]])
        for name in ("n_a", "n_b", "n_groups"):
            setattr(self, name, np.concatenate([getattr(self, name), *[getattr(x, name) if x else zero for x in found]]))
        for x in found:
            self.groups += x.groups if x else [""]
        self.links = np.concatenate([self.links, *[x.links for x in found if x]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate([x.n_links if x else zero for x in found]))])

    def documents(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of each text's words; none for a text without tokens."""
        if len(self.known) > KEPT_WORDS:
            self.forget()
        if len(self._several) > KEPT_WORDS:
            self._several.clear()
        known, old = self.known, len(self.known)
        out = []
        for text in texts:
            words = self.words(text) if text else []
            out.append(np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words)))
        if len(known) > old:
            self.learn(list(known)[old:])
        for k, own in enumerate(out):
            if len(own) and not self.good[own].all():
                # Word by word its bytes do not come back: the text as a whole decides.
                whole = " " + texts[k]
                if whole not in known:
                    known[whole] = len(known)
                    self.learn([whole])
                own = np.array([known[whole]])
                out[k] = own if self.good[own[0]] else own[:0]
        return out

    def pairs(self, words: np.ndarray) -> np.ndarray:
        """The links of words one after another."""
        n = self.starts[words + 1] - self.starts[words]
        total = int(n.sum())
        return self.links[np.arange(total) + np.repeat(self.starts[words] - (np.cumsum(n) - n), n)] if total else self.links[:0]


@lru_cache(maxsize=1)
def _aligner(a_json: str, b_model: bytes) -> Aligner:
    """Kept by a worker from one task to the next."""
    return Aligner(a_json, b_model)


# --- step 1: documents ---

def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.Array], list[str | None]]]:
    """Carried columns and texts of about ``GROUP_CHARS`` code points."""
    held, texts, size = [], [], 0
    for batch in batches:
        start = 0
        for k, text in enumerate(batch.column("t").to_pylist()):
            texts.append(text)
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield [*held, batch.column("row").slice(start, k + 1 - start)], texts
                held, texts, size, start = [], [], 0, k + 1
        if start < batch.num_rows:
            held.append(batch.column("row").slice(start))
    if texts:
        yield held, texts


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(shared, schema: pa.Schema):
    """Rows of documents, with the numbers of their pairs, and rows of the pairs of a group."""
    def batch(n: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for held, texts in _gathered(batches):
            aligner = aligner or _aligner(*shared.value)
            group = uuid.uuid4().int >> 65
            words = aligner.documents(texts)
            sums = {name: [int(getattr(aligner, name)[w].sum()) for w in words] for name in _COUNTS[:3]}
            shas = [hashlib.sha256(";".join([aligner.groups[w] for w in own.tolist()]).encode()).hexdigest() if len(own) else ""
                    for own in words]
            links = [aligner.pairs(own) for own in words]
            sums["n_links"] = [len(x) for x in links]
            pairs = np.unique(np.concatenate([np.unique(x) for x in links]))
            total = np.zeros(len(pairs), np.int64)
            numbers, times = [], []
            for own in links:
                number, n = np.unique(np.searchsorted(pairs, own), return_counts=True)
                total[number] += n
                numbers.append(number.astype(np.int32))
                times.append(n.astype(np.int32))
            ends = pa.array(np.cumsum([0, *map(len, numbers)]), pa.int32())
            yield batch(len(texts), {
                "group": pa.array([group] * len(texts), pa.int64()), "row": pa.concat_arrays(held), "groups_sha256": pa.array(shas, pa.string()),
                **{name: pa.array(v, pa.int64()) for name, v in sums.items()},
                "numbers": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(numbers))),
                "times": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times)))})
            for at in range(0, len(pairs), 10_000):
                some = pairs[at:at + 10_000]
                yield batch(len(some), {
                    "group": pa.array([group] * len(some), pa.int64()), "pair": pa.array(some),
                    "n": pa.array(total[at:at + 10_000]), "number": pa.array(np.arange(at, at + len(some), dtype=np.int32))})
    return run


# --- step 2: sums of the corpus go back to the documents ---

def _summed(schema: pa.Schema):
    """Rows sorted by group, its pairs first -> documents with the sums of their links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        parts: list[tuple[np.ndarray, ...]] = []
        counts = best = np.zeros(0, np.int64)

        def settle() -> tuple[np.ndarray, np.ndarray]:
            number, count, top = (np.concatenate(x) for x in zip(*parts))
            known, tops = np.zeros(int(number.max()) + 1, np.int64), np.zeros(int(number.max()) + 1, np.int64)
            known[number], tops[number] = count, top
            parts.clear()
            return known, tops

        for batch in batches:
            groups = batch.column("group").to_numpy()
            is_pair = batch.column("number").is_valid().to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((groups[1:] != groups[:-1]) | (is_pair[1:] != is_pair[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if groups[a] != group:
                    group, counts, best = groups[a], counts[:0], best[:0]
                    parts.clear()
                some = batch.slice(a, b - a)
                if is_pair[a]:
                    parts.append(tuple(some.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("number", "n", "top")))
                    continue
                if parts:
                    counts, best = settle()
                sums, tops = [], []
                for numbers, times in zip(_arrays(some.column("numbers")), _arrays(some.column("times"))):
                    sums.append(int((counts[numbers] * times).sum()))
                    tops.append(int((best[numbers] * times).sum()))
                columns = {"n_best": pa.array(tops, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
                yield pa.RecordBatch.from_arrays(
                    [columns[f.name] if f.name in columns else some.column(f.name) for f in schema], schema=schema)
    return run


def _arrays(column: pa.Array) -> list[np.ndarray]:
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, all by default), ``n_a, n_b, n_groups, n_links``, ``n_best``
    (links whose pair is linked most often of all with its B id), ``count_sum`` (how often the pairs of the
    links are linked, summed), ``groups_sha256``. ``a_path``: a tokenizer file of byte-level BPE; ``b_path``: a
    piece model that puts a blank before the text."""
    ship_package(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    carry = docs.columns if carry is None else carry
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))       # two vocabularies
    row = T.StructField("row", T.StructType([f for f in docs.schema.fields if f.name in carry]))
    numbers = [T.StructField(name, T.LongType()) for name in _COUNTS]
    digest = T.StructField("groups_sha256", T.StringType())
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("group", T.LongType()), row, *numbers, digest, T.StructField("numbers", ints),
                           T.StructField("times", ints), T.StructField("number", T.IntegerType()),
                           T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())])
    arrow = to_arrow_schema(schema)
    found = materialise(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c in carry]).alias("row"),
                                    F.col(text_col).alias("t")).mapInArrow(_aligned(shared, arrow), schema), "alignment")
    # One shuffle serves the sums and their way back.
    pairs = found.where("number is not null").select("group", "number", "pair", "n").repartition("pair")
    sums = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)).alias("b")
    tops = sums.groupBy(b_id).agg(F.max("n").alias("most"))       # a row per id of side B
    back = pairs.select("group", "number", "pair").join(sums, "pair").join(F.broadcast(tops), b_id == F.col("b")).select(
        "group", "number", "n", (F.col("n") == F.col("most")).cast("byte").alias("top"))
    documents = found.where("number is null").select("group", "row", *_COUNTS, "groups_sha256", "numbers", "times")
    both = documents.unionByName(back, allowMissingColumns=True)
    out = T.StructType([row, *numbers, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), digest])
    return both.repartition("group").sortWithinPartitions("group", F.col("number").isNull()).mapInArrow(
        _summed(to_arrow_schema(out)), out)
