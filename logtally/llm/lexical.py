"""Ranked lexical search: the best documents for each query, by impacts in norm buckets.

A document is a vector with one impact per term, a query one with a weight per term,
the score their inner product. Documents are ordered by the length of their vectors
and dealt into buckets of about equal length. For a query and a bucket, with the
score that the query's k-th best document has so far:

* the product of both lengths (Cauchy-Schwarz) bounds every score of the bucket;
  where it is lower, the bucket is passed over;
* so do the greatest impacts of the bucket, coordinate by coordinate; the weakest
  coordinates that cannot reach the threshold together need not be looked up, and
  only documents with one of the others are candidates;
* a candidate's partial sum, with what the remaining coordinates can add by either
  bound, drops it or not; survivors are scored exactly in integers.

Bounds are never below the score, and equal scores are kept, so the result is exact.

1. Each text gives its number of terms and how often it has each term of the queries;
   counts over all documents give the weights.
2. Impacts and lengths are SQL expressions; documents are range-partitioned by length
   and written.
3. The longest give each query a first threshold; then every bucket is searched, in
   parallel, each task raising its own thresholds; at most k rows of a query leave a
   task.

Queries are taken in blocks of about ``BLOCK_TERMS`` terms, so what is broadcast (a
block's terms, weights, thresholds) does not grow with either table.

Defined results: a null text has no terms, and a document without terms counts
nowhere; a query without terms, or none of whose terms is in a document, has no rows;
equal scores go by ascending identifier, null last; rows that share an identifier are
documents, or queries, of their own; an empty table gives an empty table. A text of
any length is counted piece by piece.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logtally.llm.common import materialise
from logtally.session import ship_package

BEST = 10
# Documents in a bucket; terms of the queries answered together.
BUCKET, BLOCK_TERMS = 4096, 1 << 20
# Bytes of a text that are cut into terms at once.
PIECE = 1 << 20

# Fixed values of the score.
UNIT, SCALE, SATURATION, SLOPE = 1000, 1_000_000_000, 8, 75

# Bytes that separate terms become blanks, A-Z small letters; all of U+0080 on is term.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text (UTF-8), a piece at a time, cut between terms."""
    text, at = text or b"", 0
    while at < len(text):
        part, end, cut = b"", at, 0
        while not cut:
            more = text[end:end + PIECE].translate(_FOLD)
            end += len(more)
            cut = len(part) + (len(more) if end == len(text) else more.rfind(b" ") + 1)
            part += more
            if end < len(text) and b" " not in more:
                cut = 0                              # a term longer than a piece
        yield part[:cut].split()
        at += cut


class Query(NamedTuple):
    terms: np.ndarray      # numbers of its distinct terms in the block
    weights: np.ndarray    # weight times repeats


# --- step 1: terms ---

def _counted(vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, ends, found, times = [], [0], [], []
            for text in batch.column("t").to_pylist():
                n, own = 0, Counter()
                for words in terms_of(text):
                    n += len(words)
                    own.update(filter(known.__contains__, words))
                sizes.append(n)
                found += [known[w] for w in own]
                times += own.values()
                ends.append(len(found))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], names=["id", "n", "terms", "times"])
    return run


def weight(documents: int, holding: int) -> int:
    return math.floor(UNIT * math.log((2 * documents + 2) / (2 * holding + 1)))


# --- step 3: buckets ---

class Bucket:
    """Documents of about one length, their impacts by term."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray, lengths: np.ndarray):
        self.lengths = lengths
        row = np.repeat(np.arange(len(lengths)), np.diff(ends))
        order = np.argsort(terms, kind="stable")
        terms, self._rows, self._impacts = terms[order], row[order], impacts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, np.int64)
        self._terms, self._starts = terms[first], np.append(first, len(terms))
        self._greatest = np.maximum.reduceat(self._impacts, first) if len(first) else first
        self.longest = float(lengths.max()) if len(lengths) else 0.0

    def search(self, query: Query, least: int, k: int) -> tuple[np.ndarray, np.ndarray, bool]:
        """(rows, scores) of documents that score at least ``least``, all positive ones among the
        best ``k`` included; and whether the bucket was looked into."""
        none = np.zeros(0, np.int64)
        length = math.sqrt(float((query.weights.astype(float) ** 2).sum()))
        if _under(length * self.longest, least) or not len(self._terms):
            return none, none, False
        at = np.minimum(np.searchsorted(self._terms, query.terms), len(self._terms) - 1)
        here = (self._terms[at] == query.terms) & (query.weights > 0)
        at, q = at[here], query.weights[here]
        most = q * self._greatest[at]
        if not len(at) or int(most.sum()) < least:
            return none, none, False
        order = np.argsort(most, kind="stable")
        at, q, most = at[order], q[order], np.cumsum(most[order])
        weak = int(np.searchsorted(most, least, "left"))      # these together stay under the threshold
        sums, squares = np.zeros(len(self.lengths), np.int64), np.zeros(len(self.lengths))
        for t, w in zip(at[weak:].tolist(), q[weak:].tolist()):
            some = slice(self._starts[t], self._starts[t + 1])
            rows, x = self._rows[some], self._impacts[some]
            sums[rows] += w * x
            squares[rows] += x.astype(float) ** 2
        rows = np.flatnonzero(sums)
        if weak and len(rows):
            rest = math.sqrt(float((q[:weak].astype(float) ** 2).sum()))
            left = np.sqrt(np.maximum(self.lengths[rows] ** 2 * (1 + 1e-9) - squares[rows], 0))
            more = np.minimum(float(most[weak - 1]), rest * left)
            rows = rows[(sums[rows] + more) * (1 + 1e-9) + 1 >= least]
            for t, w in zip(at[:weak].tolist(), q[:weak].tolist()):
                own = self._rows[self._starts[t]:self._starts[t + 1]]
                place = np.minimum(np.searchsorted(own, rows), len(own) - 1)
                hit = own[place] == rows
                sums[rows[hit]] += w * self._impacts[self._starts[t] + place[hit]]
        scores = sums[rows]
        if len(rows) > k:
            least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        keep = scores >= max(least, 1)
        return rows[keep], scores[keep], True


def _under(bound: float, least: int) -> bool:
    return bound * (1 + 1e-9) + 1 < least


class _Best:
    """The best ``k`` documents of one query so far: by score, then identifier, null last."""

    def __init__(self, k: int, least: int):
        self.k, self.least = k, least
        self.scores, self.ids, self.null = (np.zeros(0, x) for x in (np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def _searched(block, least: dict[int, int], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[Query] = block.value
        best = [_Best(k, least.get(i, 0)) for i in range(len(queries))]
        for batch in batches:
            null = batch.column("id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("id").fill_null(0).to_numpy()
            lengths = batch.column("length").to_numpy()
            for start in range(0, batch.num_rows, BUCKET):
                terms, impacts = (batch.column(c).slice(start, BUCKET) for c in ("terms", "impacts"))
                ends = terms.offsets.to_numpy()
                bucket = Bucket(ends, terms.flatten().to_numpy(), impacts.flatten().to_numpy(), lengths[start:start + BUCKET])
                for query, own in zip(queries, best):
                    rows, scores, _ = bucket.search(query, own.least, k)
                    if len(rows):
                        own.add(scores, ids[rows + start], null[rows + start])
        n = [len(b.scores) for b in best]
        if sum(n):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best), dtype=np.int32), n)),
                 pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.null for b in best])),
                 pa.array(np.concatenate([b.scores for b in best]))], names=["q", "id", "score"])
    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _answer(docs: DataFrame, asked: list[tuple], k: int) -> DataFrame | None:
    """``(q, id, score, rank)`` for one block of queries, given as (identifier, terms)."""
    spark = docs.sparkSession
    numbers: dict[bytes, int] = {}
    for _, words in asked:
        for w in words:
            numbers.setdefault(w, len(numbers))
    counted = materialise(docs.mapInArrow(_counted(spark.sparkContext.broadcast(numbers)),
                                          "id long, n long, terms array<int>, times array<long>").where("n > 0"), "terms")
    documents, size = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    # One row per term of the block.
    holding = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.array([weight(documents, holding.get(t, 0)) for t in range(len(numbers))], np.int64)
    queries = []
    for _, words in asked:
        own = Counter(numbers[w] for w in words)
        terms = np.array(sorted(own), np.int32)
        queries.append(Query(terms, weights[terms] * np.array([own[t] for t in terms.tolist()], np.int64)))
    m = f"({100 - SLOPE} + ({SLOPE} * n * {documents}L) div {size}L)"
    vectors = counted.where("size(terms) > 0").selectExpr(
        "id", "terms", f"transform(times, f -> CAST(({SCALE}L * f) div ({UNIT} * f + {SATURATION} * {m}) AS INT)) AS impacts")
    vectors = vectors.selectExpr("*", "sqrt(aggregate(impacts, 0D, (s, x) -> s + CAST(x AS DOUBLE) * x)) AS length")
    vectors = materialise(vectors.repartitionByRange(F.desc("length"), F.hash("id")).sortWithinPartitions(F.desc("length")).withColumn(
        "part", F.spark_partition_id()), "norm-buckets")
    block = spark.sparkContext.broadcast(queries)
    schema = "q int, id long, score long"

    def search(some: DataFrame, least: dict[int, int]) -> DataFrame:
        return _top(some.select("id", "terms", "impacts", "length").mapInArrow(_searched(block, least, k), schema), k)

    # What the longest vectors score: at most k rows per query of the block.
    first = search(vectors.where("part = 0"), {}).where(F.col("rank") == k).select("q", "score").collect()
    return search(vectors, {r["q"]: r["score"] for r in first})


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [[w for part in terms_of(t) for w in part] for t in batch.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(words, pa.list_(pa.binary()))], names=["item", "words"])


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(<item>, rank, <id>, score)``: the ``k`` documents that score highest for each item."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    item_type = items.schema[item_col].dataType
    asked = materialise(items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("binary").alias("t")).mapInArrow(
        _item_terms, T.StructType([T.StructField("item", item_type), T.StructField("words", T.ArrayType(T.BinaryType()))]))
        .where("size(words) > 0").withColumn("draw", F.xxhash64("item", "words")), "queries")
    total = asked.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = math.ceil(total / block_terms)
    out = spark.createDataFrame([], T.StructType([T.StructField("item", item_type), T.StructField("rank", T.IntegerType()),
                                                  T.StructField("id", T.LongType()), T.StructField("score", T.LongType())]))
    for number in range(blocks):
        # A block of queries: about block_terms terms.
        own = [(r["item"], [bytes(w) for w in r["words"]])
               for r in asked.where(F.pmod("draw", F.lit(blocks)) == number).orderBy("draw").collect()]
        found = _answer(rows, own, k) if own else None
        if found is not None:
            named = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(own)], T.StructType(
                [T.StructField("q", T.IntegerType()), T.StructField("item", item_type)]))
            out = out.unionByName(found.join(F.broadcast(named), "q").select("item", "rank", "id", "score"))
    return out.withColumnsRenamed({"item": item_col, "id": id_col})
