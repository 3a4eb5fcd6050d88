"""Substring dedup: words covered by a window of ``WINDOW`` words that also starts
earlier in the corpus are removed, found with suffix automata.

The reference of a document is all that stands before it, so the whole corpus is
reference. It is cut in shards by content: each window belongs to the shard of
its least ``GRAM``-word hash (a minimizer), equal windows therefore to one shard,
and only the parts of documents that can match in a shard are sent there. (Sent to
every document, as a broadcast, the shards would make the work grow with the
square of the corpus and the broadcast with the corpus.)

1. Each document gives the minimizers of its windows; they are range-partitioned
   and those seen twice stay. A hot one spreads over several partitions.
2. Documents with repeated minimizers give their segments: runs of windows with
   one minimizer, 13 windows at most. Equal segments are folded in each task
   before the shuffle, with the first place where they stand. Segments of a
   minimizer that has over ``HOT`` of them, in however many documents, are cut into
   single windows first, and each window's content makes a shard of its own.
3. In a shard, segments are streamed in corpus order through a suffix automaton
   that grows with them: after each word, the length of the state's suffix link
   is the matching statistic, the longest part before that occurred earlier. A
   window is new where it is under ``WINDOW``.
4. New windows go back to their documents: of the candidate windows, all others
   have an earlier copy, and the maximal spans they cover are removed.

Hashes only select; words themselves are compared in the automaton. Every
shuffle but one carries hashes or short segments; the documents' own text is
shuffled once.

Defined results: a null or empty text has no words; texts with fewer words than a
window keep all; documents are in the order of their identifiers (null last; of
rows that share one, by a hash of the text; rows that repeat both count as one
document); words are separated by blank and U+0009 to U+000D; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import materialise
from logtally.session import ship_package

WINDOW, GRAM = 20, 8
# Windows that one minimizer can serve.
REACH = WINDOW - GRAM + 1
HOT = 2000
# Bytes of text hashed at once, and of segments folded before they are given out.
BLOCK, FOLDED = 1 << 20, 1 << 24

# Fixed odd multipliers of the hashes.
_BASE, _STEP, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD
_NULL_ID = (1 << 63) - 1


# --- hashing ---

class _Powers:
    def __init__(self) -> None:
        self.n = 0

    def need(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(self.n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))      # modulo 2**64
        return self.up, self.down


_POWERS = _Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word from prefix sums over the bytes, block by block."""
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        stop = max(k + 1, int(np.searchsorted(ends, starts[k] + BLOCK, "right")))
        a, b = int(starts[k]), int(ends[stop - 1])
        up, down = _POWERS.need(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[:b - a], out=sums[1:])
        first = starts[k:stop] - a
        out[k:stop] = (sums[ends[k:stop] - a] - sums[first]) * down[first]
        k = stop
    return _mixed(out)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each ``n`` neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (n - width)], x[n - width:]) if n > width else x


class Layout(NamedTuple):
    """Words and windows of several documents laid out one after another."""
    data: bytes            # the words of all documents, joined by blanks
    starts: np.ndarray     # of words, in bytes
    ends: np.ndarray
    first: np.ndarray      # first word of each document, and the end
    minimizer: np.ndarray  # of the window that begins at each word; valid where ``whole``
    whole: np.ndarray      # whether the window lies in one document
    echo: np.ndarray       # running count of gram hashes that come again within ``REACH`` words


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def lay_out(documents: list[list[bytes]]) -> Layout:
    counts = np.fromiter(map(len, documents), np.int64, len(documents))
    words = [w for d in documents for w in d]
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    first = np.concatenate([[0], np.cumsum(counts)])
    n = max(0, len(words) - WINDOW + 1)
    if not n:
        return Layout(data, starts, ends, first, np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(1, np.int64))
    hashes = _word_hashes(np.frombuffer(data, np.uint8), starts, ends)
    grams = hashes[:len(hashes) - GRAM + 1]
    for k in range(1, GRAM):
        grams = grams * np.uint64(_STEP) + hashes[k:len(hashes) - GRAM + 1 + k]
    of = np.repeat(np.arange(len(documents)), counts)
    echo = np.zeros(len(grams) + 1, bool)
    for k in range(1, min(REACH, len(grams))):
        echo[1:-k] |= grams[k:] == grams[:-k]
    return Layout(data, starts, ends, first, _least(_mixed(grams), REACH), of[:n] == of[WINDOW - 1:], np.cumsum(echo))


def segments(layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """(first window, number of windows) of runs of one minimizer within a
    document, cut after ``REACH`` windows from their start."""
    h, whole = layout.minimizer, layout.whole
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | ~whole[:-1] | ~whole[1:]
    at = np.arange(len(h))
    begun = np.maximum.accumulate(np.where(fresh, at, 0))
    starts = np.flatnonzero((at - begun) % REACH == 0)
    sizes = np.diff(np.concatenate([starts, [len(h)]]))
    inside = whole[starts]
    return starts[inside], sizes[inside]


def _document_groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of each document) of about ``BLOCK`` bytes at a time."""
    held: list[list[bytes]] = []
    size = start = 0
    for k, text in enumerate(batch.column("t").to_pylist()):
        held.append(words_of(text))
        size += len(text or "")
        if size >= BLOCK:
            yield start, held
            held, size, start = [], 0, k + 1
    if held:
        yield start, held


# --- step 1: minimizers ---

def _minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct minimizers per document; ``n``: in how many of its segments;
    ``twice``: in two, or of a segment that may repeat a window in itself."""
    for batch in batches:
        did, tie = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tie"))
        for row, documents in _document_groups(batch):
            layout = lay_out(documents)
            at, size = segments(layout)
            if not len(at):
                continue
            doc = np.searchsorted(layout.first, at, "right") - 1 + row
            h = layout.minimizer[at].view(np.int64)
            order = np.lexsort((h, doc))
            doc, h = doc[order], h[order]
            begins = np.ones(len(h), bool)
            begins[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            begins = np.flatnonzero(begins)
            n = np.diff(np.concatenate([begins, [len(h)]]))
            many = n > 1
            echoes = layout.echo[at + size + REACH - 1] > layout.echo[at]
            many |= np.logical_or.reduceat(echoes[order], begins)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[begins]), pa.array(did[doc[begins]]), pa.array(tie[doc[begins]]), pa.array(n), pa.array(many)],
                names=["h", "did", "tie", "n", "twice"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by minimizer, those whose minimizer is there twice. The
    first and the last row of a partition stay, as their like may be next door."""
    held: tuple | None = None           # the last row so far: h, did, tie, n, stays
    for batch in batches:
        h, did, tie, n, stays = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("h", "did", "tie", "n", "twice"))
        if not len(h):
            continue
        stays = stays.copy()
        if held is None:
            stays[0] = True
        else:
            h, did, tie, n, stays = (np.concatenate([[x], y]) for x, y in zip(held, (h, did, tie, n, stays)))
        same = h[1:] == h[:-1]
        stays[1:] |= same
        stays[:-1] |= same
        held = (h[-1], did[-1], tie[-1], n[-1], stays[-1])
        keep = np.flatnonzero(stays[:-1])
        if len(keep):
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (h, did, tie, n)], names=["h", "did", "tie", "n"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in held[:4]], names=["h", "did", "tie", "n"])


# --- step 2: segments ---

def _chosen(layout: Layout, wanted: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first window, number of windows) of segments with a wanted minimizer."""
    at, size = segments(layout)
    doc = np.searchsorted(layout.first, at, "right") - 1
    h = layout.minimizer[at].view(np.int64)
    keep = np.zeros(len(at), bool)
    cuts = np.searchsorted(doc, np.arange(len(wanted) + 1))
    for k, own in enumerate(wanted):
        if own is not None and len(own):
            keep[cuts[k]:cuts[k + 1]] = np.isin(h[cuts[k]:cuts[k + 1]], own)
    return doc[keep], at[keep], size[keep]


def _lists(column: pa.Array) -> list:
    """One numpy array per row, None for null."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist())]


class _Folded:
    """Segments of a task with the first place of each, by shard."""

    def __init__(self) -> None:
        self.first: dict[tuple[int, int, bytes], tuple[int, int, int]] = {}
        self.size = 0

    def add(self, h: int, part: int, segment: bytes, place: tuple[int, int, int]) -> None:
        key = (h, part, segment)
        known = self.first.get(key)
        if known is None:
            self.first[key] = place
            self.size += len(segment)
        elif place < known:
            self.first[key] = place

    def batch(self) -> pa.RecordBatch:
        h, part, segment = zip(*self.first)
        did, tie, start = zip(*self.first.values())
        self.first, self.size = {}, 0
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(part, pa.int64()), pa.array(did, pa.int64()), pa.array(tie, pa.int64()),
             pa.array(start, pa.int64()), pa.array(segment, pa.binary())],
            names=["h", "part", "did", "tie", "start", "segment"])


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    folded = _Folded()
    for batch in batches:
        did, tie = (batch.column(c).to_pylist() for c in ("did", "tie"))
        wanted, hot = _lists(batch.column("wanted")), [set(x or ()) for x in batch.column("hot").to_pylist()]
        for row, documents in _document_groups(batch):
            layout = lay_out(documents)
            doc, at, size = _chosen(layout, wanted[row:row + len(documents)])
            data, starts, ends = layout.data, layout.starts, layout.ends
            offsets = at - layout.first[doc]
            for d, first, n, h, start in zip((doc + row).tolist(), at.tolist(), size.tolist(),
                                             layout.minimizer[at].view(np.int64).tolist(), offsets.tolist()):
                if h in hot[d]:
                    for k in range(n):
                        window = data[starts[first + k]:ends[first + k + WINDOW - 1]]
                        part = xxhash.xxh64_intdigest(window)
                        folded.add(h, part - (1 << 63), window, (did[d], tie[d], start + k))
                else:
                    folded.add(h, 0, data[starts[first]:ends[first + n + WINDOW - 2]], (did[d], tie[d], start))
                if folded.size >= FOLDED:
                    yield folded.batch()
    if folded.first:
        yield folded.batch()


# --- step 3: automata ---

class SuffixAutomaton:
    """Of a growing sequence; ``extend`` gives the matching statistic of the new
    end: the longest part up to it that also ended earlier."""

    def __init__(self) -> None:
        self.steps: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def extend(self, symbol) -> int:
        steps, link, length = self.steps, self.link, self.length
        now, p = len(steps), self.last
        steps.append({})
        length.append(length[p] + 1)
        link.append(0)
        self.last = now
        while p >= 0 and symbol not in steps[p]:
            steps[p][symbol] = now
            p = link[p]
        if p < 0:
            return 0
        q = steps[p][symbol]
        if length[q] != length[p] + 1:
            copy = len(steps)
            steps.append(steps[q].copy())
            length.append(length[p] + 1)
            link.append(link[q])
            while p >= 0 and steps[p].get(symbol) == q:
                steps[p][symbol] = copy
                p = link[p]
            link[q] = copy
            q = copy
        link[now] = q
        return length[q]


def new_windows(shard: list[list[bytes]]) -> list[list[int]]:
    """For each segment, in corpus order: the windows that stand nowhere earlier in the shard."""
    if len(shard) == 1 and len(set(shard[0])) > len(shard[0]) - WINDOW:
        # Alone, and too many distinct words to hold a window twice.
        return [list(range(len(shard[0]) - WINDOW + 1))]
    automaton, out = SuffixAutomaton(), []
    for k, words in enumerate(shard):
        seen = [automaton.extend(w) for w in words]
        out.append([i for i, m in enumerate(seen[WINDOW - 1:]) if m < WINDOW])
        automaton.extend(k)              # a number is no word: nothing matches across segments
    return out


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and place -> runs of new windows by document."""
    shard, places = None, []
    texts: dict[bytes, None] = {}
    out: dict[str, list[int]] = {"did": [], "tie": [], "start": [], "n": []}

    def close() -> None:
        for (did, tie, start), new in zip(places, new_windows([t.split(b" ") for t in texts])):
            k = 0
            while k < len(new):
                end = k
                while end + 1 < len(new) and new[end + 1] == new[end] + 1:
                    end += 1
                for name, value in (("did", did), ("tie", tie), ("start", start + new[k]), ("n", end + 1 - k)):
                    out[name].append(value)
                k = end + 1

    def full() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})
        for v in out.values():
            v.clear()
        return batch

    for batch in batches:
        for h, part, did, tie, start, text in zip(*(batch.column(c).to_pylist() for c in (
                "h", "part", "did", "tie", "start", "segment"))):
            if (h, part) != shard:
                if texts:
                    close()
                shard, places, texts = (h, part), [], {}
            if text not in texts:          # an equal segment came before: nothing of it is new
                texts[text] = None
                places.append((did, tie, start))
        if out["n"]:
            yield full()
    if texts:
        close()
    if out["n"]:
        yield full()


# --- step 4: removal ---

def removed_words(layout: Layout, doc: int, candidates: list[tuple[int, int]], new: list[int]) -> np.ndarray:
    """Mask of a document's words that a repeated window covers."""
    n = int(layout.first[doc + 1] - layout.first[doc])
    window = np.zeros(n + 1, np.int64)
    for start, size in candidates:
        window[start] += 1
        window[start + size] -= 1
    repeated = np.cumsum(window)[:-1] > 0
    for run in new:
        start, size = run >> 32, run & (1 << 32) - 1
        repeated[start:start + size] = False
    cover = np.zeros(n + WINDOW + 1, np.int64)
    hit = np.flatnonzero(repeated)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + WINDOW, -1)
    return np.cumsum(cover)[:n] > 0


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wanted, new = _lists(batch.column("wanted")), batch.column("new").to_pylist()
        words, removed, kept, spans = [], [], [], []
        for row, documents in _document_groups(batch):
            layout = lay_out(documents)
            doc, at, size = _chosen(layout, wanted[row:row + len(documents)])
            cuts = np.searchsorted(doc, np.arange(len(documents) + 1))
            for k, own in enumerate(documents):
                some = slice(cuts[k], cuts[k + 1])
                candidates = list(zip((at[some] - layout.first[k]).tolist(), size[some].tolist()))
                words.append(len(own))
                if not candidates:
                    removed.append(0)
                    kept.append(b" ".join(own))
                    spans.append([])
                    continue
                gone = removed_words(layout, k, candidates, new[row + k] or [])
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(own, gone.tolist()) if not g]))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(words, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["id", "n_words", "n_removed", "kept", "spans"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, n_words, n_removed, kept, spans)`` per document: the kept words
    joined by blanks, and the removed spans in words, end exclusive."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("did"),
        F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("t"))
    doc = ["did", "tie"]
    found = rows.select("did", "tie", "t").mapInArrow(_minimizers, "h long, did long, tie long, n long, twice boolean")
    repeated = materialise(found.repartitionByRange("h", "did").sortWithinPartitions("h").mapInArrow(
        _repeated, "h long, did long, tie long, n long"), "minimizers")
    # One row per minimizer of over HOT segments.
    hot = repeated.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > HOT).select("h", F.col("h").alias("hot"))
    wanted = repeated.join(hot, "h", "left").groupBy(*doc).agg(
        F.collect_set("h").alias("wanted"), F.collect_set("hot").alias("hot"))
    # Both joins below take the documents from this one shuffle; the small side is hashed, texts are not sorted.
    placed = rows.join(wanted.hint("shuffle_hash"), doc, "left")
    # (The same columns on both sides, or there would be two shuffles.)
    segment = placed.where("wanted is not null").select("id", "did", "tie", "t", "wanted", "hot").mapInArrow(
        _segment_rows, "h long, part long, did long, tie long, start long, segment binary")
    new = segment.repartition("h", "part").sortWithinPartitions("h", "part", "did", "tie", "start").mapInArrow(
        _streamed, "did long, tie long, start long, n long")
    new = new.groupBy(*doc).agg(F.collect_list(F.col("start") * F.lit(1 << 32) + F.col("n")).alias("new"))
    out = placed.join(new.hint("shuffle_hash"), doc, "left").select("id", "t", "wanted", "new").mapInArrow(
        _removed, "id long, n_words long, n_removed long, kept string, spans array<struct<start: long, `end`: long>>")
    return out.withColumnRenamed("id", id_col)
