"""SimHash near-dedup with Golay-code fuzzy hashing.

Fingerprints: word shingles of the lower-cased text, XXH64 of each, and per bit
the majority. Fingerprints that differ in few bits are linked; linked documents
form a component.

The search never compares all pairs. The 64 bits are cut in three segments of 22,
21 and 21 bits. With four differing bits or fewer, pigeonhole leaves two cases:

* some segment has no error: both fingerprints share that exact segment;
* every segment has an error: then two segments have exactly one each. A segment,
  padded to 23 bits, decodes to the index of its nearest codeword of the perfect
  binary Golay code; within one error the index of one word is among the (one or
  six) indices that the other's neighbours decode to. One side spells out its
  neighbours in one segment, the other side in the other, so ten-odd keys of two
  indices per segment pair meet for certain.

Equal fingerprints are first folded into one. Rows with the same key meet in a
sorted partition and are verified by their bit distance; of each group only a
spanning forest of links goes on, so a group of m gives at most m - 1 links.
A group over ``GROUP_LIMIT`` rows is cut in blocks, and each pair of blocks is its
own group in another task: memory stays bounded and no link is lost. Components
come from alternating large-star and small-star steps over the links, each step
written to the shared checkpoint folder.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; texts with fewer words than a shingle use the
whole sequence; documents that share an identifier are rows of their own, and
the component is the smallest identifier in it (null only if all are); of a
component the row with that identifier stays (of several, the one with the least
text hash; rows that repeat identifier and text stay or go together); an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import materialise
from logtally.session import ship_package

SHINGLE, MAX_BITS, SEED = 4, 4, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
GROUP_LIMIT = 4096
# Up to this size all pairs of a group are compared at once, not one by one.
SMALL_GROUP = 8
# Generator polynomial of the binary Golay code (23, 12, 7).
GOLAY = 0b101011100011

_LOWER = bytes(c + 32 if ord("A") <= c <= ord("Z") else c for c in range(256))
_SHINGLES_AT_ONCE = 1 << 16
# Bits of each byte value, and where each of a hash's eight bytes counts its values.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.uint16)


# --- fingerprints ---

def shingles(text: str | None, size: int = SHINGLE) -> Iterator[bytes]:
    """Shingles in order, repeats included: slices of the words joined by blanks."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    data = b" ".join(words)
    if len(words) <= size:
        return iter([data] if words else [])
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *[e + 1 for e in ends]]
    return (data[a:b] for a, b in zip(starts, ends[size - 1:]))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash."""
    parts, digest = shingles(text, size), xxhash.xxh64_intdigest
    values, total = np.zeros((8, 256), np.int64), 0
    while some := [digest(s, SEED) for s in islice(parts, _SHINGLES_AT_ONCE)]:
        total += len(some)
        each = np.array(some, np.uint64).view(np.uint8).reshape(-1, 8) + _PLACES
        values += np.bincount(each.ravel(), minlength=2048).reshape(8, 256)
    counts = (values @ _BITS).ravel()
    return int((np.uint64(1) << np.flatnonzero(2 * counts > total).astype(np.uint64)).sum(dtype=np.uint64)) if total else 0


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, size) for t in batch.column("t").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(prints.view(np.int64))],
                                             names=["id", "tie", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(id, tie, fp)``: a hash of the text to tell rows of one identifier apart, and the fingerprint, as signed longs."""
    ship_package(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("t")
                       ).mapInArrow(_fingerprints(shingle), "id long, tie long, fp long")


# --- the Golay code ---

def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GOLAY << (bit - 11)), rest)
    return rest


@cache
def _corrections() -> np.ndarray:
    """The error pattern of at most three bits that has each of the 2,048 syndromes."""
    patterns = [0]
    patterns += [1 << a for a in range(23)]
    patterns += [1 << a | 1 << b for a in range(23) for b in range(a)]
    patterns += [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
    table = np.zeros(2048, np.int64)
    table[_syndromes(np.array(patterns))] = patterns
    return table


@cache
def _of_bits() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits: the code is linear."""
    return _syndromes(np.arange(1 << 12)), _syndromes(np.arange(1 << 11) << 12)


def codeword_index(words: np.ndarray) -> np.ndarray:
    """Index (the 12 message bits) of the codeword within three bits of each word."""
    low, high = _of_bits()
    syndrome = low[words & 0xFFF] ^ high[words >> 12]
    return (words ^ _corrections()[syndrome]) >> 11


def nearby_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``words``, index) of all distinct indices within one error of each."""
    own = codeword_index(words)
    flipped = codeword_index(words[:, None] ^ (1 << np.arange(23))[None, :])
    every = np.sort(np.concatenate([own[:, None], flipped], axis=1), axis=1)
    fresh = np.concatenate([np.ones((len(words), 1), bool), every[:, 1:] != every[:, :-1]], axis=1)
    at = np.nonzero(fresh)
    return at[0], every[at]


# --- keys ---

def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``prints``, key) of all keys; a key names its family in the top bits."""
    unsigned = prints.view(np.uint64)
    parts = [((unsigned >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    own, places, keys = [codeword_index(p) for p in parts], [], []
    near = [nearby_indices(p) for p in parts]
    everyone = np.arange(len(prints))
    for s in range(3):
        places.append(everyone)
        keys.append(s << 40 | parts[s])
    for family, (a, b) in enumerate(((0, 1), (0, 2), (1, 2)), start=3):
        at, index = near[a]
        places.append(at)
        keys.append(family << 40 | index << 12 | own[b][at])
        at, index = near[b]
        places.append(at)
        keys.append(family << 40 | own[a][at] << 12 | index)
    place, key = np.concatenate(places), np.concatenate(keys)
    both = np.unique(np.stack([place, key], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy(zero_copy_only=False)
        for k in range(0, len(prints), 4096):
            some = prints[k:k + 4096]
            place, key = keys_of(some)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(some[place])], names=["key", "fp"])


# --- links ---

def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def spanning_links(prints: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """A spanning forest of the links within a group of distinct fingerprints:
    whatever is reached leaves the rest, so each is compared once with those still out."""
    links, rest = [], prints
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            close = _distance(rest, np.array([at], np.int64)) <= max_bits
            if close.any():
                reached = rest[close]
                links += [(int(at), int(x)) for x in reached]
                front += list(reached)
                rest = rest[~close]
    return links


def _group_links(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of complete groups; rows are sorted by key."""
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    size = ends - starts
    left, right = [], []
    # Small groups at once: each row with the one so many places on, if that is in its group.
    some = np.repeat(size, size)
    for step in range(1, SMALL_GROUP):
        at = np.flatnonzero((some[step:] > step) & (some[step:] <= SMALL_GROUP) & (keys[step:] == keys[:-step]))
        x, y = prints[at], prints[at + step]
        close = (_distance(x, y) <= max_bits) & (x != y)
        left.append(x[close])
        right.append(y[close])
    for a, b in zip(starts[size > SMALL_GROUP], ends[size > SMALL_GROUP]):
        found = spanning_links(np.unique(prints[a:b]), max_bits)
        if found:
            pair = np.array(found, np.int64)
            left.append(pair[:, 0])
            right.append(pair[:, 1])
    return np.concatenate(left), np.concatenate(right)


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        held: list[np.ndarray] = []

        def out(rows: list[np.ndarray]) -> pa.RecordBatch:
            *group, prints = rows
            # Groups are numbered: a key may have several block pairs.
            changed = np.zeros(len(prints), bool)
            for g in group:
                changed[1:] |= g[1:] != g[:-1]
            a, b = _group_links(np.cumsum(changed), prints, max_bits)
            a, b = np.maximum(a, b), np.minimum(a, b)
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

        for batch in batches:
            names = names or batch.schema.names
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows)]
            # The last group may go on in the next batch.
            same = np.ones(len(rows[0]), bool)
            for g in rows[:-1]:
                same &= g == g[-1]
            cut = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0
            if cut:
                yield out([r[:cut] for r in rows])
            held = [r[cut:] for r in rows]
        if held and len(held[0]):
            yield out(held)
    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Spanning links ``(u, v)``, u > v, between the distinct fingerprints of ``prints (fp)``."""
    rows = prints.select("fp").mapInArrow(_key_rows, "key long, fp long")
    # One row per group over the limit: few, so what joins them follows the table's size.
    large = materialise(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP_LIMIT), "large-groups")
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(GROUP_LIMIT)).cast("int")
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = rows.join(large, "key", "left").withColumn("blocks", blocks).withColumn("mine", mine)
    # A group within the limit is one block; else each row goes to all pairs of its block.
    spread = placed.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "mine", "fp").select(
        "key", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "fp")
    return spread.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two").mapInArrow(
        _links(max_bits), "u long, v long").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(u, v)``: the smallest node
    it is connected with. Alternating large-star and small-star."""
    edges = materialise(pairs, "links")
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
        edges = materialise(small, "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``(id, tie, fp, first)``: first is the component's first row, as a struct."""
    prints = materialise(fingerprints(docs, id_col, text_col, shingle), "prints")
    # One row per distinct fingerprint, with the first row that has it.
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "tie")
    folded = materialise(prints.groupBy("fp").agg(F.min(row).alias("least")), "folded")
    roots = components(links(folded, max_bits))
    named = folded.join(roots, folded["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    first = named.groupBy("root").agg(F.min("least").alias("first"))
    return prints.join(named.join(first, "root").select("fp", "first"), "fp")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``(<id>, fingerprint, component_id)``, one row per document."""
    return _grouped(docs, id_col, text_col, shingle, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns as they were."""
    kept = (_grouped(docs, id_col, text_col, shingle, max_bits)
            .where(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tie") == F.col("first.tie")))
            .select(F.col("id").alias("kept_id"), F.col("tie").alias("kept_tie")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tie"))
    return rows.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("tie") == F.col("kept_tie")),
                     "left_semi").select("row.*")
