"""Which keys occur in more than one place, and which are common?  Answers of bounded size for map tasks.

Tasks send each of their keys once (sorted arrays of 48 bits, dealt by the top bits), so a key
that stands everywhere arrives once per task and flush, not once per row.  The keys that
arrive twice become a bitmap of ``BITS_PER_KEY`` bits per key, at most ``MAX_BITS``
(128 MB), which is broadcast.  A set bit may be another key's: the bitmap only spares
work, whoever uses it must still compare.  Keys that a task meets ``COMMON_LOCAL`` times or more are
counted as well, and the most common are returned with their counts (at most ``COMMON`` of them).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .common import arrow_map, staged

BITS_PER_KEY = 32
MAX_BITS = 1 << 30
FLUSH_KEYS = 1 << 20
COMMON = 1 << 17
COMMON_LOCAL = 4
LOW = ~np.uint64(0xFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts (sorting whole words is faster than ``np.unique``)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def packed(keys: np.ndarray) -> bytes:
    """The upper 48 bits of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def repeated_keys(df: DataFrame, keys: Callable, least: int = 2) -> tuple[Broadcast, tuple[np.ndarray, np.ndarray]]:
    """``keys(batch)`` yields uint64 arrays (well mixed; none twice in an array where counts matter).
    Returns the broadcast bitmap of the keys that occur twice (``least`` 1: of all keys), and the
    common keys (low 16 bits clear, sorted) with their counts."""
    spark = df.sparkSession
    bits = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length())
    shift = np.uint64(64 - bits)

    def deal(batches):
        held, size = [], 0

        def flush():
            k, n = distinct(np.concatenate(held) & LOW)
            cut = np.searchsorted(k >> shift, np.arange((1 << bits) + 1, dtype=np.uint64))
            own = [(i, k[a:b], n[a:b]) for i, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
            return {"bucket": [i for i, _, _ in own], "keys": [packed(x) for _, x, _ in own], "again": [packed(x[y > 1]) for _, x, y in own],
                    "common": [packed(x[y >= COMMON_LOCAL]) for _, x, y in own],
                    "counts": [y[y >= COMMON_LOCAL].astype("<u4").tobytes() for _, _, y in own]}

        for b in batches:
            for k in keys(b):
                if len(k):
                    held.append(k)
                    size += len(k)
                    if size >= FLUSH_KEYS:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    def gather(batches):
        by: dict[int, tuple[list, list, list, list]] = {}
        for b in batches:
            for i, k, a, c, n in zip(*(c.to_pylist() for c in b.columns)):
                x = by.setdefault(i, ([], [], [], []))
                for to, part in zip(x, (unpacked(k), unpacked(a), unpacked(c), np.frombuffer(n, "<u4"))):
                    to.append(part)
        for i, (k, a, c, n) in by.items():
            k, arrived = distinct(np.concatenate(k))
            twice = np.union1d(k[arrived >= least], np.concatenate(a))
            c, inverse = np.unique(np.concatenate(c), return_inverse=True)
            total = np.bincount(inverse, np.concatenate(n), len(c)).astype(np.int64)
            top = np.sort(np.lexsort((c, -total))[:COMMON >> bits])
            yield {"bucket": [i], "n": [len(twice)], "keys": [packed(twice)], "common": [packed(c[top])], "counts": [total[top].tobytes()]}

    dealt = arrow_map(df, deal, "bucket int, keys binary, again binary, common binary, counts binary").repartition(1 << bits, "bucket")
    found = staged(arrow_map(dealt, gather, "bucket int, n long, keys binary, common binary, counts binary"), spark)
    total = found.groupBy().sum("n").first()[0] or 0
    m = max(bits + 3, min(MAX_BITS.bit_length() - 1, int(total * BITS_PER_KEY).bit_length()))

    def slices(batches):
        for b in batches:
            for i, k in zip(*(c.to_pylist() for c in b.columns)):
                at = (unpacked(k) >> np.uint64(64 - m)) & np.uint64((1 << (m - bits)) - 1)
                flags = np.zeros(1 << (m - bits), bool)
                flags[at.astype(np.int64)] = True
                yield {"bucket": [i], "bitmap": [zlib.compress(np.packbits(flags).tobytes(), 1)]}

    bitmap = np.zeros(1 << (m - 3), np.uint8)
    width = 1 << (m - bits - 3)
    for r in arrow_map(found.select("bucket", "keys"), slices, "bucket int, bitmap binary").collect():  # MAX_BITS at most
        bitmap[r["bucket"] * width:(r["bucket"] + 1) * width] = np.frombuffer(zlib.decompress(r["bitmap"]), np.uint8)
    common = sorted((r["bucket"], unpacked(r["common"]), np.frombuffer(r["counts"], np.int64))
                    for r in found.select("bucket", "common", "counts").collect())  # COMMON at most
    none = np.zeros(0, np.uint64)
    return spark.sparkContext.broadcast((m, bitmap)), (
        np.concatenate([none, *(k for _, k, _ in common)]), np.concatenate([none.astype(np.int64), *(n for _, _, n in common)]))


def maybe_repeated(keys: np.ndarray, held: tuple[int, np.ndarray]) -> np.ndarray:
    m, bitmap = held
    at = (keys >> np.uint64(64 - m)).astype(np.int64)
    return (bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
