"""Document fingerprints from prefix polynomial hashes.

For each text one array of prefix sums P[i] = sum of (c_j + 1) * B**j modulo a
Mersenne prime is kept, for two primes' worth of bases. The hash of any span
(i, j) is (P[j] - P[i]) * B**-i, so equal spans anywhere have equal hashes, and the
longest common extension of two positions is found by binary search over span
lengths. The fingerprint is the hash of the whole text, its length, and the
``SKETCH`` least distinct hashes of its ``GRAM``-character spans; the likeness of two
fingerprints estimates the Jaccard similarity of their span sets.

Documents are compared with the next one in descending identifier order. They
are dealt by ranges whose bounds come from quantiles of the identifiers (one per
partition), sorted there, and read as a stream; the first row of a range is also
sent to the range before, so no task and no driver sees more than a range. An
identifier that fills several ranges (or none: rows without one) is cut further by
the hash of the text, by which its documents follow each other.

Defined results: a null text is empty; equal texts have equal fingerprints; two
empty texts are alike (1), an empty and another are not (0); documents that
share an identifier follow each other by the XXH64 of their text (as a signed
number), then by text, null identifiers come last; the next of the last is the
first, so a single document is its own next; rows that repeat the one before cost
a comparison only; an empty table gives an empty table. A task holds the arrays
of two neighbouring texts (measured with two of 8 million code points: 110 bytes for each of them).
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.session import ship_package

PRIME = (1 << 31) - 1
# Fixed bases of the two hashes.
BASES = (911382323, 972663749)
GRAM, SKETCH = 12, 64
# The least 64-bit number; among quantiles it stands for rows without an identifier.
_LEAST = _NO_ID = -1 << 63
_P = np.uint64(PRIME)


class _Powers:
    """Powers of a base and of its inverse, grown as texts need them."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, PRIME)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, _mod(self.up * np.uint64(pow(self.base, k, PRIME)))])
            self.down = np.concatenate([self.down, _mod(self.down * np.uint64(pow(self.inverse, k, PRIME)))])


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo the Mersenne prime, for x below 2**62."""
    x = (x & _P) + (x >> np.uint64(31))
    return np.minimum(x, x - _P)      # below the prime the difference wraps around to a large number


_POWERS = tuple(_Powers(b) for b in BASES)


class PrefixHash:
    """Prefix arrays of one text, one for each base."""

    def __init__(self, sums: list[np.ndarray]):
        self.sums, self.n = sums, len(sums[0]) - 1

    @classmethod
    def of(cls, codes: np.ndarray) -> "PrefixHash":
        """From code points."""
        n, values, out = len(codes), codes.astype(np.uint64) + np.uint64(1), []
        for p in _POWERS:
            p.need(n + 1)
            # Terms are below 2**31, so sums of up to 2**33 of them fit.
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_mod(values * p.up[:n]), out=sums[1:])
            out.append(_mod(sums))
        return cls(out)

    def spliced(self, kept: int, other: "PrefixHash", taken: int) -> "PrefixHash":
        """The arrays of the first ``kept`` characters followed by the first ``taken`` of ``other``."""
        out = []
        for p, mine, its in zip(_POWERS, self.sums, other.sums):
            p.need(kept + taken + 1)
            out.append(np.concatenate([mine[:kept + 1], _mod(mine[kept] + _mod(its[1:taken + 1] * p.up[kept]))]))
        return PrefixHash(out)

    def spans(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        """62-bit hashes of the spans."""
        out = []
        for sums, p in zip(self.sums, _POWERS):
            down = p.down[:len(sums)][starts]
            out.append(_mod(_mod(sums[ends] + _P - sums[starts]) * down))
        return (out[0] << np.uint64(31)) | out[1]

    def span(self, start: int, end: int) -> int:
        """The same of one span."""
        a, b = ((int(s[end]) - int(s[start])) * int(p.down[start]) % PRIME for s, p in zip(self.sums, _POWERS))
        return a << 31 | b

    def grams(self) -> np.ndarray:
        """Hashes of all spans of ``GRAM`` code points (a shorter text: of itself)."""
        if self.n <= GRAM:
            return self.spans(slice(0, 1), slice(self.n, self.n + 1)) if self.n else np.zeros(0, np.uint64)
        return self.spans(slice(0, self.n - GRAM + 1), slice(GRAM, None))

    def common(self, start: int, other: "PrefixHash", other_start: int) -> int:
        """Length of the longest common extension of two positions."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(start, start + mid) == other.span(other_start, other_start + mid):
                low = mid
            else:
                high = mid - 1
        return low


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits, so that the least hashes are an even sample."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def sketch(grams: np.ndarray) -> list[int]:
    """The ``SKETCH`` least distinct mixed hashes, sorted."""
    mixed = _mixed(grams)
    k = 4 * SKETCH
    while True:
        least = np.unique(np.partition(mixed, k - 1)[:k] if k < len(mixed) else mixed)
        if len(least) >= SKETCH or k >= len(mixed):
            return least[:SKETCH].tolist()
        k *= 4


def likeness(a: list[int], b: list[int]) -> float:
    """Jaccard estimate of two sketches: of the least hashes of both together,
    the share that both have."""
    if not a and not b:
        return 1.0
    first, second = set(a), set(b)
    both = sorted(first | second)[:SKETCH]
    return sum(x in first and x in second for x in both) / len(both)


def _named(whole: int, n: int, least: list[int]) -> str:
    return f"{whole:016x}{n:08x}" + "".join([f"{x:016x}" for x in least])


class _Text:
    """A document's arrays, computed once though it is read twice."""

    def __init__(self, ident: int | None, text: str):
        self.id, self.text = ident, text
        self.prefix = PrefixHash.of(code_points(text))
        self.grams = self.prefix.grams()
        self.sketch = sketch(self.grams)
        self.name = _named(self.prefix.span(0, self.prefix.n), self.prefix.n, self.sketch)


def _row(doc: _Text, nxt: _Text) -> dict:
    n = doc.prefix.n
    changed = n // 3
    head = nxt.text[:changed]
    k, h = n - changed, len(head)
    edited = doc.text[:k] + head
    arrays = doc.prefix.spliced(k, nxt.prefix, h)
    m = arrays.n
    if min(k, h) > GRAM:
        # Spans within the kept part and within the head are known; those across are new.
        across = arrays.spans(np.arange(k - GRAM + 1, k), np.arange(k + 1, k + GRAM))
        grams = np.concatenate([doc.grams[:k - GRAM + 1], across, nxt.grams[:h - GRAM + 1]])
    else:
        grams = arrays.grams()
    least = sketch(grams)
    return {"id": doc.id, "n_chars": n, "edited_sha256": hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": doc.name, "edited_fingerprint": _named(arrays.span(0, m), m, least),
            "near_edited": likeness(doc.sketch, least), "near_next": likeness(doc.sketch, nxt.sketch),
            "common_edited": doc.prefix.common(0, arrays, 0), "common_next": doc.prefix.common(0, nxt.prefix, 0)}


_SCHEMA = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                     ("common_edited", pa.int64()), ("common_next", pa.int64())])
_EMIT = 256


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range in order, its last one the first of the next range (``guest``)."""
    held: _Text | None = None
    held_range, done, same, out = None, False, None, []
    for batch in batches:
        for rng, guest, ident, text in zip(*(batch.column(c).to_pylist() for c in ("rng", "guest", "id", "t"))):
            if rng != held_range:
                held, held_range, done, same = None, rng, False, None
            if done:                       # further rows like the guest
                continue
            cur = held if held is not None and (ident, text) == (held.id, held.text) else _Text(ident, text)
            if held is not None:
                # Of rows that repeat, all but the last have the same result.
                same = (same or _row(held, held)) if cur is held else None
                out.append(same or _row(held, cur))
                if len(out) >= _EMIT:
                    yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)
                    out = []
            held, done = cur, guest
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_SCHEMA)


def _place(ident: int | None, tie: int) -> tuple[bool, int, int]:
    """Where a document comes in the order of comparison, but for equal hashes."""
    return (True, 0, tie) if ident is None else (False, -ident, tie)


def range_edges(bounds: list[int]) -> list[tuple[bool, int, int]]:
    """The last places of all ranges but one, from quantiles of the identifiers in which null is
    ``_NO_ID``. A bound that comes ``n`` times fills ``n`` ranges or so: it is cut in as many by the hash."""
    edges = {_place(None, _LEAST - 1)}
    for bound, n in Counter(bounds).items():
        ident = None if bound == _NO_ID else bound
        n += ident is None
        edges |= {_place(ident, _LEAST + k * (1 << 64) // n - 1) for k in range(1, n + 1)}
    return sorted(edges)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``(<id>, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, common_edited, common_next)``."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("tie"), text.alias("t"))
    shares = [k / parts for k in range(1, parts)]
    bounds = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id")).agg(
        F.percentile_approx("id", shares, 4 * parts)).first()[0] if shares else None
    shared = spark.sparkContext.broadcast(range_edges(bounds or []))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = shared.value
        for batch in batches:
            rng = [bisect.bisect_left(edges, _place(i, tie))
                   for i, tie in zip(batch.column("id").to_pylist(), batch.column("tie").to_pylist())]
            yield pa.RecordBatch.from_pydict({"rng": pa.array(rng, pa.int64())} | {c: batch.column(c) for c in batch.schema.names})

    # One row per range: the first document in it.
    first = F.struct(F.bitwise_not("id").alias("falling"), "tie", "id")
    heads = {r["rng"]: (r["id"], r["tie"]) for r in rows.select("id", "tie").mapInArrow(place, "rng long, id long, tie long")
             .groupBy("rng").agg(F.min(first).alias("first")).select("rng", "first.id", "first.tie").collect()}
    if not heads:
        return spark.createDataFrame([], _DDL.replace("id long", f"`{id_col}` long", 1))
    order = sorted(heads)
    before = {r: order[k - 1] for k, r in enumerate(order)}
    guests = spark.createDataFrame([(before[r], r, *heads[r]) for r in order], "to long, own long, first long, least long")
    placed = rows.mapInArrow(place, "rng long, id long, tie long, t string")
    # Each range's first rows go to the range before as well; one row per range in the small table.
    here, there = F.struct(F.col("rng"), F.lit(False).alias("guest")), F.struct(F.col("to").alias("rng"), F.lit(True).alias("guest"))
    leads = F.col("id").eqNullSafe(F.col("first")) & (F.col("tie") == F.col("least"))
    doubled = placed.join(F.broadcast(guests), F.col("rng") == F.col("own"), "left").select(
        F.explode(F.when(leads, F.array(here, there)).otherwise(F.array(here))).alias("at"), "id", "tie", "t").select(
        "at.rng", "at.guest", "id", "tie", "t")
    dealt = doubled.repartitionByRange("rng").sortWithinPartitions("rng", "guest", F.col("id").desc_nulls_last(), "tie", "t")
    return dealt.select("rng", "guest", "id", "t").mapInArrow(_stream, _DDL).withColumnRenamed("id", id_col)


_DDL = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, common_edited long, common_next long")
