"""Rare keys found by digests of a fixed size, for keys that are long texts.

``rare_keys`` groups by the key itself, so every distinct text of a task goes through
the shuffle. Here 128-bit digests are counted first. A digest seen once proves that its
key occurs once, whatever else the digest may collide with; only keys whose digest is
shared are counted in full. Rows are told apart by a join with the smaller of the two
sets of digests, proven or open, broadcast after its size was counted: texts that occur
once stay in the task that read them. Where neither set is small enough, a join would
shuffle the texts as well, and with copies of hot ones in full; then ``rare_keys`` does
it, whose map-side counts merge those. The rows are the same on every way, under any
digest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtally.operators.counts import rare_keys
from logtally.session import ensure_checkpoint_dir

# A digest in a broadcast relation: two longs and what a hash table adds to a row.
DIGEST_BYTES = 64
BROADCAST_BYTES = 64 << 20


def digest_128(key: Column) -> list[Column]:
    """Two 64-bit hashes of different seeds."""
    return [F.xxhash64(key), F.xxhash64(F.lit(1), key)]


def rare_keys_by_digest(df: DataFrame, key: str, n: int = 1, counter: str = "counter", limit: int | None = None,
                        digest: Callable[[Column], list[Column]] = digest_128,
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``rare_keys`` with digests counted first: ``(key, counter)`` of the keys that occur exactly ``n`` times.

    Counts digests when called (they are written under ``spark.checkpoint.dir``); ``df`` is read
    again by the result, so it must give the same rows each time. The NULL key reports 0 as there.
    With ``limit`` and ``n == 1`` only so many digests are looked up.
    """
    if n < 1:
        return rare_keys(df, key, n, counter, limit)
    ensure_checkpoint_dir(df.sparkSession)
    parts = [f"_d{i}" for i in range(len(digest(F.col(key))))]
    keyed = df.select(key).where(F.col(key).isNotNull()).select(
        key, *[c.alias(p) for p, c in zip(parts, digest(F.col(key)))])
    counted = keyed.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    # A key occurs at most as often as its digest does.
    proven, open_ = F.lit(n == 1) & (F.col("_n") == 1), F.col("_n") >= max(n, 2)
    n_proven, n_open = counted.agg(F.count_if(proven), F.count_if(open_)).first()
    most = broadcast_bytes // DIGEST_BYTES

    def those(condition: Column) -> DataFrame:
        return F.broadcast(counted.where(condition).select(*parts))

    def once(rows: DataFrame) -> DataFrame:
        return rows.select(key, F.lit(1).cast("long").alias(counter))

    def settled(rows: DataFrame) -> DataFrame:
        return rare_keys(rows, key, n, counter)

    if n == 1 and limit is not None and limit <= min(n_proven, most):
        some = F.broadcast(counted.where(proven).select(*parts).limit(limit))
        return once(keyed.join(some, parts, "left_semi"))
    if n_open <= most:
        out = settled(keyed.join(those(open_), parts, "left_semi"))
        if n == 1:
            out = once(keyed.join(those(open_), parts, "left_anti")).unionByName(out)
    elif n == 1 and n_proven <= most:
        out = once(keyed.join(those(proven), parts, "left_semi")).unionByName(
            settled(keyed.join(those(proven), parts, "left_anti")))
    else:
        out = rare_keys(df, key, n, counter)
    return out.limit(limit) if limit is not None else out
