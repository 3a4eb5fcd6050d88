"""Byte-level BPE encoding and decoding by merge replay.

A task takes the distinct pre-tokens of its documents (up to ``CHUNK_CHARS``
code points at a time), lays their bytes out in one linked list, and builds an
inverted index from the rank of each neighbouring pair to the places where it
stands. Ranks are taken in order; every merge is applied at all its places in all
words at once, and only the pairs with the touched neighbours are looked up and
indexed anew. Words are independent, so dealing the corpus over tasks changes no
result, and nothing is shuffled.

The encoding equals that of the tiktoken library: a pre-token that is a token is
taken whole; else the pair of the lowest rank merges first, the leftmost of equal
ones. Where a merge makes a pair of a lower rank than itself (possible in a rank
table that no training produced), the word is redone on its own, pair by pair.

Defined results: a null text counts as empty and gives no tokens; a byte or text
of any kind can be encoded (the 256 bytes are tokens); decoding gives the exact
bytes back; a text of any length is encoded whole (one longer than a chunk makes
a chunk of its own); an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.session import ship_package

CHUNK_CHARS = 2_500_000
# Encoded pre-tokens that a task keeps from one chunk to the next.
KEPT_WORDS = 120_000
# Neighbouring pairs that are looked up or indexed together.
PAIRS_AT_ONCE = 1 << 17


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file (read on the driver; a fixed vocabulary)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """Lookup tables of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.none = np.int32(max(ranks.values()) + 1)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, ids = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    ids.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self._keys = np.array(keys, np.int64)[order]
        self._ids = np.array(ids, np.int32)[order]
        # Some bits of a mixed key -> whether any pair can have it; spares most searches.
        self._bits = np.zeros(1 << 22, bool)
        self._bits[self._slot(self._keys)] = True
        self.tokens = {r: t for t, r in ranks.items()}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.int64(0x1E3779B97F4A7C15) >> np.int64(30)) & np.int64((1 << 22) - 1)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair's merged token, ``none`` where it is no token."""
        if len(a) > PAIRS_AT_ONCE:
            return np.concatenate([self.pair(a[k:k + PAIRS_AT_ONCE], b[k:k + PAIRS_AT_ONCE])
                                   for k in range(0, len(a), PAIRS_AT_ONCE)])
        keys = a.astype(np.int64) << 20 | b.astype(np.int64)
        out = np.full(len(keys), self.none, np.int32)
        if len(keys) and len(self._keys):
            can = np.flatnonzero(self._bits[self._slot(keys)])
            at = np.minimum(np.searchsorted(self._keys, keys[can]), len(self._keys) - 1)
            hit = self._keys[at] == keys[can]
            out[can[hit]] = self._ids[at[hit]]
        return out


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """One word, pair by pair: the plain definition, for words the replay hands back. Pairs wait in
    a heap by rank and place; one whose sides have changed since is passed over."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))     # of the part that begins at each place
    waiting: list[tuple[int, int, int, int]] = []

    def push(a: int) -> None:
        b = end[a]
        if b < n and (rank := ranks.get(word[a:end[b]])) is not None:
            heapq.heappush(waiting, (rank, a, b, end[b]))

    for a in range(n):
        push(a)
    gone = bytearray(n)
    while waiting:
        _, a, b, stop = heapq.heappop(waiting)
        if gone[a] or end[a] != b or gone[b] or end[b] != stop:
            continue
        end[a], gone[b] = stop, 1
        if stop < n:
            before[stop] = a
        push(a)
        if before[a] >= 0:
            push(before[a])
    return [ranks[word[a:end[a]]] for a in range(n) if not gone[a]]


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words in order, how many each word has). Arrays of one entry per byte hold 32 bits
    at most; what needs more is made ``PAIRS_AT_ONCE`` places at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(words) else 0
    token = merges.byte[np.frombuffer(b"".join(words), np.uint8)]
    nxt = np.arange(1, n + 1, dtype=np.int32)
    prv = np.arange(-1, n - 1, dtype=np.int32)
    nxt[ends[lengths > 0] - 1] = -1
    prv[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(n, bool)
    # rank[i]: of the pair that begins at place i.
    rank = np.full(n, merges.none, np.int32)
    if n > 1:
        rank[:-1] = merges.pair(token[:-1], token[1:])
        rank[nxt < 0] = merges.none

    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def insert(places: np.ndarray) -> None:
        """Into the inverted index, by rank."""
        r = rank[places]
        has = r < merges.none
        if not has.all():
            places, r = places[has], r[has]
        if not len(places):
            return
        order = np.argsort(r, kind="stable")
        places, r = places[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for value, a, b in zip(r[starts].tolist(), starts, [*starts[1:], len(r)]):
            known = index.get(value)
            if known is None:
                index[value] = [places[a:b]]
                heapq.heappush(waiting, value)
            else:
                known.append(places[a:b])

    for k in range(0, n, PAIRS_AT_ONCE):
        insert(np.arange(k, min(k + PAIRS_AT_ONCE, n), dtype=np.int32))
    redo: list[np.ndarray] = []
    while waiting:
        now = heapq.heappop(waiting)
        found = index.pop(now)
        places = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
        places = places[rank[places] == now]        # what an earlier merge took away drops out
        if len(places) > 1:
            # Of pairs that overlap, every second one in a row, from the left.
            chained = nxt[places[:-1]] == places[1:]
            if chained.any():
                starts = np.concatenate([[True], ~chained])
                place = np.arange(len(places))
                places = places[(place - np.maximum.accumulate(np.where(starts, place, 0))) % 2 == 0]
        if not len(places):
            continue
        gone = nxt[places]
        after = nxt[gone]
        token[places] = now
        alive[gone] = False
        rank[gone] = merges.none
        nxt[places] = after
        followed = after >= 0
        prv[after[followed]] = places[followed]
        # Only the pairs with the two neighbours change.
        before = prv[places]
        before = before[before >= 0]
        touched = np.concatenate([before, places[followed]])
        rank[places[~followed]] = merges.none
        new = merges.pair(token[touched], token[nxt[touched]])
        rank[touched] = new
        if len(new) and new.min() <= now:
            redo.append(touched[new <= now])
        insert(np.unique(touched) if len(touched) > 1 else touched)
    ids = token[alive]
    before = np.concatenate([[0], np.cumsum(alive, dtype=np.int32)])
    counts = (before[ends] - before[ends - lengths]).astype(np.int64)
    if redo:
        # The word of a place is the first that ends behind it.
        again = np.unique(np.searchsorted(ends, np.concatenate(redo), side="right")).tolist()
        pieces = np.split(ids, np.cumsum(counts)[:-1])
        for w in again:
            pieces[w] = np.array(encode_word(words[w], merges.ranks), np.int32)
        ids, counts = np.concatenate(pieces), np.fromiter(map(len, pieces), np.int64, len(pieces))
    return ids, counts


class Encoder:
    """Encodes texts chunk by chunk with the tables of one vocabulary."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.find = merges, regex.compile(pattern).findall
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        if len(self.known) > KEPT_WORDS:
            self.known, self.ids, self.starts = {}, np.zeros(0, np.int32), np.zeros(1, np.int64)
        known, docs, old = self.known, [], len(self.known)
        for text in texts:
            words = self.find(text)
            docs.append(np.fromiter([known.setdefault(w, len(known)) for w in words], np.int32, len(words)))
        new = [w.encode("utf-8", "surrogatepass") for w in list(known)[old:]] if len(known) > old else []
        if new:
            whole = np.fromiter((self.merges.ranks.get(w, -1) for w in new), np.int32, len(new))
            ids, counts = replay([b"" if r >= 0 else w for w, r in zip(new, whole.tolist())], self.merges)
            # Put the pre-tokens that are tokens themselves back in their places.
            single = whole >= 0
            counts[single] = 1
            starts = np.concatenate([[0], np.cumsum(counts)])
            filled = np.empty(starts[-1], np.int32)
            mine = np.repeat(single, counts)
            filled[mine], filled[~mine] = whole[single], ids
            self.ids = np.concatenate([self.ids, filled])
            self.starts = np.concatenate([self.starts, self.starts[-1] + starts[1:]])
        return [self._gather(d) for d in docs]

    def _gather(self, words: np.ndarray) -> np.ndarray:
        counts = self.starts[words + 1] - self.starts[words]
        total = int(counts.sum())
        if not total:
            return np.zeros(0, np.int32)
        shift = np.repeat(self.starts[words] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        return self.ids[np.arange(total) + shift]


def decode(ids: np.ndarray, tokens: dict[int, bytes]) -> bytes:
    return b"".join([tokens[i] for i in ids.tolist()])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    """Batches gathered, or cut, to about ``CHUNK_CHARS`` code points each."""
    held: list[pa.RecordBatch] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        start = 0
        for k, value in enumerate(batch.column("t")):
            text = value.as_py()
            texts.append(text)
            size += len(text)
            if size >= CHUNK_CHARS:
                yield [*held, batch.slice(start, k + 1 - start)], texts
                held, texts, size, start = [], [], 0, k + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if texts:
        yield held, texts


def _mapper(shared, pattern: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for held, texts in _chunks(batches):
            encoder = encoder or Encoder(Merges(shared.value), pattern)
            tokens = encoder.merges.tokens
            done = encoder.encode(texts)
            at = 0
            for batch in held:
                own = done[at:at + batch.num_rows]
                at += batch.num_rows
                columns = [batch.column("row"), pa.array([len(x) for x in own], pa.int64())]
                names = ["row", "n_tokens"]
                if full:
                    ends = np.cumsum([0, *map(len, own)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, np.concatenate(own) if own else np.zeros(0, np.int32)))
                    names.append("ids")
                else:
                    columns.append(pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in own], pa.string()))
                    columns.append(pa.array([hashlib.sha256(decode(x, tokens)).hexdigest() for x in own], pa.string()))
                    names += ["ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def _run(docs: DataFrame, ranks_path: str, pattern: str, text_col: str, carry: list[str] | None, full: bool) -> DataFrame:
    ship_package(docs.sparkSession)
    from pyspark.sql import types as T
    carry = docs.columns if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    fields = [T.StructField("row", T.StructType([f for f in docs.schema.fields if f.name in carry])), T.StructField("n_tokens", T.LongType())]
    fields += ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if full else
               [T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c in carry]).alias("row"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(
        _mapper(shared, pattern, full), T.StructType(fields))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
           carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, all of them by default), ``n_tokens``, ``ids``. Map-only."""
    return _run(docs, ranks_path, pattern, text_col, carry, True)


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                   carry: list[str] | None = None) -> DataFrame:
    """The same with digests of the ids and of the bytes they decode to, instead of the ids."""
    return _run(docs, ranks_path, pattern, text_col, carry, False)


def decode_ids(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the column ``decoded``: the text bytes of its ids."""
    ship_package(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {r: t for t, r in shared.value.items()}
        for batch in batches:
            texts = [None if x is None else b"".join([tokens[i] for i in x]) for x in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())],
                                             names=[*batch.schema.names, "decoded"])

    from pyspark.sql import types as T
    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))
