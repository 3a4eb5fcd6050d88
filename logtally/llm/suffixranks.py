"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that starts
twice or more in the corpus are removed, found by distributed prefix doubling.

A position is repeated if its rank among all prefixes of ``LENGTH`` bytes is shared.
Spark sorts position-rank pairs at growing offsets: ranks of ``FIRST`` bytes are paired
at offset ``FIRST``, ranks of twice as many at twice the offset, up to ``LENGTH``.
After each sort, positions whose rank nobody shares drop out (unique), so do those
whose shared rank reaches past the threshold (repeated); only the others are sorted
again.

A rank is a hashed name, and neighbouring positions are sorted together: of the
windows of ``LENGTH`` bytes that begin at consecutive positions, those with the same
least rank inside make a run, and one row of the sort. Equal windows hold the same
ranks, hence meet under the same least one. The row carries that rank, the core of
the run, and the name of all its bytes, the cover. A core of its own makes every
position of the run unique; a cover that stands elsewhere makes all repeated. Else
the run, mostly at the edge of a repeated passage, is cut anew by the ranks of the
doubled length, and one copy of each cover goes along to be met.

1. All documents give runs by ranks of ``FIRST`` bytes (two numbers, no text);
   range partitioning and a sort within them settle most.
2. The runs left over come back to their texts, are cut by ranks of twice the bytes
   and sorted with their bytes. A core's runs are finished at ``LENGTH`` where they
   meet, window by window. A core with more than ``LIMIT`` runs is dealt over tasks by
   its covers; what is left of it is cut and sorted again by ever longer ranks
   (``LONGER``), until Spark counts the few windows that are left.
3. What is repeated goes back to the documents, whose text is shuffled once.

A row is told apart by two independent 64-bit names. No row needs more of another
than its names, so a passage in a third of all documents is sorted like any other.

Defined results: a null or empty text has no bytes; a text of fewer than ``LENGTH``
bytes keeps all; matches within a document, overlapping ones too, count like those
between documents; rows that share an identifier, or have none, are documents of
their own, and so are rows that repeat; an empty table gives an empty table. A text
is cut in blocks; a task holds some 60 bytes per byte of a block, and one row's text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtally.llm.common import materialise
from logtally.session import ship_package

LENGTH, FIRST = 200, 50
# Bytes of the ranks by which the runs of a core too large for a task are cut again, and again.
LONGER = (150, 190)
# Runs of one core that a task finishes itself.
LIMIT = 8192
# Windows looked at together.
BLOCK = 1 << 19

# Fixed odd multipliers of the names.
_BASE, _STEP, _MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD
_NULL_ID = (1 << 63) - 1
_LOW = np.uint64((1 << 21) - 1)          # of a place in a block

SETTLED, OPEN, MET = 0, 1, 2             # repeated; to be sorted again; goes along to be met


# --- names and runs ---

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(29))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` powers of the base and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps))
    return out[0], out[1]


def names(data: np.ndarray, length: int) -> np.ndarray:
    """The name of the ``length`` bytes that begin at each place: of ``FIRST`` bytes
    by prefix sums, of more by pairing names at growing offsets."""
    up, down = _powers(1 << max(21, len(data).bit_length()))
    n = len(data) - FIRST + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    x = _mixed((sums[FIRST:] - sums[:n]) * down[:n])
    have = FIRST
    while have < length:
        offset = min(have, length - have)
        x = _mixed(x[:len(x) - offset] * np.uint64(_STEP) + x[offset:])
        have += offset
    return x


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each ``n`` neighbours."""
    width = 1
    while 2 * width <= n:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (n - width)], x[n - width:]) if n > width else x


def _laid(pieces: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces joined: (bytes, where each begins, the piece of each window, whether it lies in one piece)."""
    data = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(pieces)), sizes)
    n = max(0, len(data) - LENGTH + 1)
    return data, starts, of[:n], of[:n] == of[LENGTH - 1:]


def runs(pieces: list[bytes], length: int):
    """(piece, first window in it, number of windows, core, cover, bytes) of each run,
    by ranks of ``length`` bytes."""
    data, starts, of, whole = _laid(pieces)
    if not whole.any():
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty, []
    ranks = names(np.frombuffer(data, np.uint8), length)
    # The least rank of each window; of equal ones the leftmost.
    least = _least(ranks & ~_LOW | np.arange(len(ranks), dtype=np.uint64), LENGTH - length + 1)
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (of[1:] != of[:-1]) | (whole[1:] != whole[:-1])
    at = np.flatnonzero(fresh)
    size = np.diff(np.append(at, len(least)))
    at, size = at[whole[at]], size[whole[at]]
    covers = [data[a:a + n + LENGTH - 1] for a, n in zip(at.tolist(), size.tolist())]
    core = ranks[(least[at] & _LOW).astype(np.int64)].view(np.int64)
    cover = np.fromiter(map(xxhash.xxh3_64_intdigest, covers), np.uint64, len(covers)).view(np.int64)
    return of[at], at - starts[of[at]], size, core, cover, covers


def _blocks(texts: list[bytes | None]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in pieces of at most ``BLOCK`` windows: (rows, offsets, pieces) of about as many in all."""
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in enumerate(texts):
        text = text or b""
        for offset in range(0, len(text) - LENGTH + 1, BLOCK):
            piece = text[offset:offset + BLOCK + LENGTH - 1]
            rows.append(row)
            offsets.append(offset)
            pieces.append(piece)
            size += len(piece)
            if size >= BLOCK:
                yield rows, offsets, pieces
                rows, offsets, pieces, size = [], [], [], 0
    if pieces:
        yield rows, offsets, pieces


def _place(start: np.ndarray, size) -> np.ndarray:
    """First window and number of windows in one number (a run has at most ``LENGTH - FIRST + 1``)."""
    return start * 256 + size


# --- step 1: runs of all documents, by ranks of FIRST bytes ---

def _first_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        did, tie = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tie"))
        for rows, offsets, pieces in _blocks(batch.column("t").to_pylist()):
            piece, first, size, core, cover, _ = runs(pieces, FIRST)
            if len(piece):
                row = np.array(rows)[piece]
                place = _place(first + np.array(offsets)[piece], size)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (core, cover, did[row], tie[row], place)],
                                                 names=["core", "cover", "did", "tie", "place"])


def settle(core: np.ndarray, cover: np.ndarray, border: np.ndarray):
    """Of rows sorted by core and cover: (repeated, open, first of its cover and going along).
    ``border``: the core may have more rows elsewhere."""
    new_core = np.ones(len(core), bool)
    new_core[1:] = core[1:] != core[:-1]
    new_cover = new_core.copy()
    new_cover[1:] |= cover[1:] != cover[:-1]
    of_cover, of_core = np.cumsum(new_cover) - 1, np.cumsum(new_core) - 1
    shared = np.bincount(of_cover)[of_cover] > 1
    undecided = (np.bincount(of_core[new_cover])[of_core] > 1) | border
    return shared, ~shared & undecided, shared & undecided & new_cover


def _by_core(batches: Iterator[pa.RecordBatch], limit: int, whole: bool = False) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows sorted by core, some whole cores at a time: (rows, border, unbroken). The first and
    the last core of a partition are at a border, so is one of over ``limit`` rows, which comes in parts.
    ``whole``: a partition's cores are all whole, but for those marked ``hot``, of which it has some covers."""
    held: pa.Table | None = None
    edge: int | None = None            # the core of which some rows were given out

    def given(rows: pa.Table, cut: bool) -> tuple[pa.Table, np.ndarray]:
        nonlocal edge
        core = rows.column("core").to_numpy()
        if whole:
            return rows, rows.column("hot").to_numpy()
        border = core == (core[0] if edge is None else edge)
        if cut:
            border |= core == core[-1]
        edge = int(core[-1]) if cut else (edge if edge is not None else int(core[0]))
        return rows, border

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        core = rows.column("core").to_numpy()
        last = int(np.flatnonzero(core != core[-1])[-1]) + 1 if core[0] != core[-1] else 0
        if last:
            yield given(rows.slice(0, last), False)
        held = rows.slice(last)
        if held.num_rows > limit and not (whole and not held.column("hot")[0].as_py()):
            yield given(held, True)
            held = None
    if held is not None:
        yield given(held, True)


def _first_settled(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, border in _by_core(batches, limit):
            core, cover, did, tie, place = (rows.column(c).to_numpy() for c in ("core", "cover", "did", "tie", "place"))
            repeated, undecided, met = settle(core, cover, border)
            which = np.concatenate([np.flatnonzero(x) for x in (repeated, undecided, met)])
            kind = np.repeat(np.array([SETTLED, OPEN, MET], np.int8), [x.sum() for x in (repeated, undecided, met)])
            if len(which):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (did[which], tie[which], place[which], kind)],
                                                 names=["did", "tie", "place", "kind"])
    return run


# --- step 2: what is open, by ranks of the doubled length, then of LENGTH ---

def _lists(column: pa.Array) -> list:
    """One numpy array per row, empty for null."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    none = values[:0]
    return [values[a:b] if ok else none for a, b, ok in zip(ends[:-1], ends[1:], column.is_valid().to_pylist())]


def _open_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of a document that are open, or go along, cut by the doubled length."""
    for batch in batches:
        did, tie = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("did", "tie"))
        open_, met = _lists(batch.column("open")), _lists(batch.column("met"))
        rows, starts, ask, pieces, size = [], [], [], [], 0

        def cut() -> pa.RecordBatch:
            piece, first, n, core, cover, covers = runs(pieces, 2 * FIRST)
            row = np.array(rows)[piece]
            return pa.RecordBatch.from_arrays(
                [pa.array(core), pa.array(cover), pa.array(did[row]), pa.array(tie[row]),
                 pa.array(_place(first + np.array(starts)[piece], n)), pa.array(np.array(ask)[piece]),
                 pa.array(covers, pa.binary())], names=["core", "cover", "did", "tie", "place", "asks", "bytes"])

        for row, text in enumerate(batch.column("t").to_pylist()):
            for places, asks in ((open_[row], True), (met[row], False)):
                for place in places.tolist():
                    start, n = place >> 8, place & 255
                    pieces.append(text[start:start + n + LENGTH - 1])
                    rows.append(row)
                    starts.append(start)
                    ask.append(asks)
                    size += len(pieces[-1])
                    if size >= BLOCK:
                        yield cut()
                        rows, starts, ask, pieces, size = [], [], [], [], 0
        if pieces:
            yield cut()


def shared_windows(groups: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows have an equal one in their group, and which are the first of their kind."""
    order = np.lexsort((windows, groups))
    g, w = groups[order], windows[order]
    same = (g[1:] == g[:-1]) & (w[1:] == w[:-1])
    shared, first = np.zeros(len(order), bool), np.ones(len(order), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    first[order[1:][same]] = False
    return shared, first


def _cut(part: np.ndarray, core: np.ndarray | None, limit: int) -> list[np.ndarray]:
    """``part`` in pieces of about ``limit``, between cores if they are given."""
    ends = np.arange(limit, len(part), limit)
    if core is not None and len(ends):
        begins = np.flatnonzero(core[1:] != core[:-1]) + 1
        ends = np.unique(np.append(begins, len(part))[np.searchsorted(begins, ends)])
    return [x for x in np.split(part, ends) if len(x)]


def _windows(rows: pa.Table, some: np.ndarray, core: np.ndarray, place: np.ndarray):
    """Of the windows of some rows: (row, first byte, name, has an equal one of its core, first of its kind, bytes)."""
    data, starts, of, whole = _laid(rows.column("bytes").take(pa.array(some)).to_pylist())
    window = np.flatnonzero(whole)
    row = some[of[window]]
    name = names(np.frombuffer(data, np.uint8), LENGTH)[window].view(np.int64)
    shared, first = shared_windows(core[row], name)
    return row, (place[row] >> 8) + window - starts[of[window]], name, shared, first, lambda k: data[window[k]:window[k] + LENGTH]


def _columns(rows: pa.Table) -> list[np.ndarray]:
    return [rows.column(c).to_numpy() for c in ("core", "cover", "did", "tie", "place", "asks")]


def _found(limit: int, last: bool, whole: bool):
    """Places of rows sorted by core and cover that are repeated as seen here: covers that come twice, and
    windows of cores that are whole here (``last``: of parts of the others, too)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(*columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["did", "tie", "place"])

        for rows, border in _by_core(batches, limit, whole):
            core, cover, did, tie, place, asks = _columns(rows)
            repeated, undecided, met = settle(core, cover, border)
            if (repeated & asks).any():
                k = repeated & asks
                yield batch(did[k], tie[k], place[k])
            inner = np.flatnonzero((undecided | met) & ~border)
            parts = _cut(inner, core[inner], limit)
            if last:
                parts += _cut(np.flatnonzero((undecided | met) & border), None, limit)
            for some in parts:
                row, start, _, shared, _, _ = _windows(rows, some, core, place)
                hit = np.flatnonzero(shared & (undecided & asks)[row])
                if len(hit):
                    # Neighbouring windows of one run go together.
                    fresh = np.ones(len(hit), bool)
                    fresh[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
                    begin = hit[fresh]
                    n = np.diff(np.append(np.flatnonzero(fresh), len(hit)))
                    yield batch(did[row[begin]], tie[row[begin]], _place(start[begin], n))
    return run


_RUNS = "core long, cover long, did long, tie long, place long, asks boolean, bytes binary"


def _longer(length: int, limit: int, whole: bool):
    """What is left of cores that are not whole here, cut anew by ranks of ``length`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, border in _by_core(batches, limit, whole):
            core, cover, did, tie, place, asks = _columns(rows)
            _, undecided, met = settle(core, cover, border)
            for some in _cut(np.flatnonzero((undecided | met) & border), None, limit):
                piece, first, n, core_, cover_, covers = runs(rows.column("bytes").take(pa.array(some)).to_pylist(), length)
                row = some[piece]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(core_), pa.array(cover_), pa.array(did[row]), pa.array(tie[row]),
                     pa.array(_place((place[row] >> 8) + first, n)), pa.array((undecided & asks)[row]), pa.array(covers, pa.binary())],
                    names=["core", "cover", "did", "tie", "place", "asks", "bytes"])
    return run


def _to_count(limit: int):
    """The windows of cores that are not whole here, one of each kind, with two names for Spark to count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, border in _by_core(batches, limit):
            core, cover, did, tie, place, asks = _columns(rows)
            _, undecided, met = settle(core, cover, border)
            for some in _cut(np.flatnonzero((undecided | met) & border), None, limit):
                row, start, name, shared, first, text = _windows(rows, some, core, place)
                go = np.flatnonzero(first)
                other = np.fromiter((xxhash.xxh3_64_intdigest(text(k)) for k in go.tolist()), np.uint64, len(go)).view(np.int64)
                row = row[go]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (did[row], tie[row], _place(start[go], 1), (undecided & asks)[row] & ~shared[go], name[go], other)],
                    names=["did", "tie", "place", "asks", "one", "other"])
    return run


# --- step 3: removal ---

def removed_spans(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the maximal byte runs that repeated windows cover."""
    start = places >> 8
    end = start + (places & 255) + LENGTH - 1
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] > end[:-1]
    begins = np.flatnonzero(fresh)
    return start[begins], end[np.append(begins[1:], len(start)) - 1]


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, gone, kept, spans = [], [], [], []
        for text, first, later in zip(batch.column("t").to_pylist(), _lists(batch.column("settled")), _lists(batch.column("new"))):
            text = text or b""
            places = np.concatenate([first, later])
            begins, ends = removed_spans(places) if len(places) else (places, places)
            edges = [0, *np.stack([begins, ends], 1).ravel().tolist(), len(text)]
            sizes.append(len(text))
            gone.append(int((ends - begins).sum()))
            spans.append([{"start": a, "end": b} for a, b in zip(edges[1:-1:2], edges[2:-1:2])])
            kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2])]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(kept, pa.binary())], names=["id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          limit: int = LIMIT) -> DataFrame:
    """``(<id>, n_bytes, n_removed, spans, kept)`` per document: the removed
    spans in bytes, end exclusive, and the bytes that remain (binary: a span may begin within
    a character)."""
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("did"),
        F.xxhash64(text_col).alias("tie"), F.col(text_col).cast("binary").alias("t"))
    doc = ["did", "tie"]
    first = rows.select("did", "tie", "t").mapInArrow(_first_runs, "core long, cover long, did long, tie long, place long")
    first = materialise(first.repartitionByRange("core", "cover", "did", "place").sortWithinPartitions("core", "cover").mapInArrow(
        _first_settled(limit), "did long, tie long, place long, kind byte"), "suffix-ranks")

    def of(kind: int):
        return F.collect_set(F.when(F.col("kind") == kind, F.col("place")))

    # Rows that repeat, however often, share a key and its places: each is held once.
    found = first.groupBy(*doc).agg(of(SETTLED).alias("settled"), of(OPEN).alias("open"), of(MET).alias("met"))
    # Both uses below take the documents from this one shuffle; the small side is hashed, texts are not sorted.
    placed = rows.join(found.hint("shuffle_hash"), doc, "left")
    left = placed.where("size(open) > 0 or size(met) > 0").select("id", "did", "tie", "t", "settled", "open", "met").mapInArrow(
        _open_runs, _RUNS)
    # A core of more than LIMIT rows is dealt by its covers; every other one comes to one task whole.
    hot = left.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("core", F.lit(True).alias("hot"))
    left = left.join(hot, "core", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    left = left.repartition("core", F.when(F.col("hot"), F.col("cover"))).sortWithinPartitions("core", "cover")
    new = left.mapInArrow(_found(limit, False, True), "did long, tie long, place long")
    for length in LONGER:
        left = left.mapInArrow(_longer(length, limit, length == LONGER[0]), _RUNS)
        left = left.repartitionByRange("core", "cover", "did", "place").sortWithinPartitions("core", "cover")
        new = new.unionByName(left.mapInArrow(_found(limit, length == LONGER[-1], False), "did long, tie long, place long"))
    windows = left.mapInArrow(_to_count(limit), "did long, tie long, place long, asks boolean, one long, other long")
    counts = windows.groupBy("one", "other").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    new = new.unionByName(windows.where("asks").join(counts, ["one", "other"]).select(*doc, "place"))
    new = new.groupBy(*doc).agg(F.collect_set("place").alias("new"))
    out = placed.join(new.hint("shuffle_hash"), doc, "left").select("id", "t", "settled", "new").mapInArrow(
        _removed, "id long, n_bytes long, n_removed long, spans array<struct<start: long, `end`: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
