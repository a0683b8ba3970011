"""Operator 9, suffix-array dedup: maximal repeats of at least ``LENGTH`` bytes, removed but for
their first occurrence.

A byte goes if a ``LENGTH``-byte string that covers it also starts earlier in the corpus
(smaller id, or the same document further left); strings are those of the input.

1. Sampling.  Each ``LENGTH``-byte window names the ``SEED``-byte string in it with the
   smallest hash (leftmost of equal ones) as its anchor: equal windows have equal anchors at
   equal places.  Windows in a row with the same anchor form a segment, so each window
   belongs to one segment and only windows under equal anchors need comparing.
2. Segments whose anchor stands once in the corpus are done (``keyset``: a bounded bitmap).
3. Equal segments under one anchor: all but the first are repeats as a whole (a
   pre-aggregated minimum joined back; Spark's skew join splits hot ones).
4. The first ones of different segments under one anchor: their windows, the suffixes of the
   segments cut at ``LENGTH``, are sorted into a suffix array with the common prefixes of
   neighbours; scanning it gives the intervals with a common prefix of ``LENGTH``: all
   occurrences of one window.  An interval is kept as a maximal repeat if its left extensions
   differ; one whose occurrences all extend to the left alike only lengthens the interval
   it extends to.  All occurrences but the first are repeats.
   Anchors with over ``HOT`` different segments are not held in one task: their windows are
   aggregated by content hash (128 bits) instead.

Defined results: a null text is empty and loses nothing; texts shorter than ``LENGTH`` lose
nothing and repeat nothing; a null id counts as smaller than all others; rows with equal id
and equal text are the same document and remove nothing from each other; rows with equal id
and different texts are different documents of which neither is earlier at the same offset.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, semi_join_ids, staged
from .keyset import maybe_repeated, mix, repeated_keys

LENGTH = 100
SEED = 32
HOT = 4096
BLOCK_BITS = 20
NO_ID = -(1 << 63)
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)


def segments(texts: list[bytes], length: int = LENGTH):
    """Yields, for blocks of texts, arrays ``(text index, start, size, anchor hash)`` of all segments."""
    size = 1 << BLOCK_BITS
    held: list[tuple[int, int, bytes]] = []
    total = 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), size - length + 1):  # pieces share length - 1 bytes
            piece = t[at:at + size]
            if len(piece) < length:
                continue
            if total + len(piece) > size:
                yield block_segments(held, length)
                held, total = [], 0
            held.append((i, at, piece))
            total += len(piece)
    if held:
        yield block_segments(held, length)


def block_segments(pieces: list[tuple[int, int, bytes]], length: int):
    data = np.frombuffer(b"".join(p for _, _, p in pieces), np.uint8)
    h = BYTE_HASH[data]
    s = 1
    for c in STEPS:  # hashes of 2, 4, ... SEED bytes
        h = h[:-s] * np.uint64(c) + h[s:]
        s *= 2
    h = mix(h)
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    least = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    width, s = length - SEED + 1, 1
    while 2 * s <= width:
        least = np.minimum(least[:-s], least[s:])
        s *= 2
    if width > s:
        least = np.minimum(least[:s - width], least[width - s:])
    anchor = (least & mask).astype(np.int64)
    sizes = np.array([len(p) for _, _, p in pieces])
    begins = np.cumsum(sizes) - sizes
    starts = np.repeat(begins, sizes - length + 1) + np.arange((sizes - length + 1).sum()) - np.repeat(
        np.cumsum(sizes - length + 1) - (sizes - length + 1), sizes - length + 1)
    a = anchor[starts]
    cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    last = np.concatenate([cut[1:], [len(a)]]) - 1
    own = np.searchsorted(begins, starts[cut], "right") - 1
    index, offset = np.array([i for i, _, _ in pieces]), np.array([o for _, o, _ in pieces])
    return index[own], starts[cut] - begins[own] + offset[own], starts[last] - starts[cut] + length, h[a[cut]]


def encoded(column) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]


def place_hash(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return mix(mix(mix(ids.astype(np.uint64)) + keys.astype(np.uint64)) + starts.astype(np.uint64))


def first_of(df: DataFrame, by: list[str]) -> DataFrame:
    """Per ``by``: ``first``, the smallest ``struct(id, start, key)``, and the number of rows ``n``;
    staged, so that Spark can split the keys that are hot when it is joined back."""
    return staged(df.groupBy(*by).agg(F.min(F.struct("id", "start", "key")).alias("first"), F.count("*").alias("n")))


def later(df: DataFrame, firsts: DataFrame, by: list[str]) -> DataFrame:
    """The rows of ``df`` that stand behind the first one with equal ``by``."""
    return df.join(firsts.where("n > 1").drop("n"), by).where("first.id < id or (first.id = id and first.start < start)")


def intervals(texts: list[bytes], groups: np.ndarray, length: int = LENGTH):
    """The maximal repeats among segments: ``groups`` says which texts may be compared.

    Returns arrays ``(repeat, text index, offset, size)``, one row per occurrence.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = sizes - length + 1
    text = np.repeat(np.arange(len(texts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(sizes) - sizes)[text] + offset
    keyed = np.empty((len(at), 4 + length), np.uint8)  # the group in front keeps groups apart
    keyed[:, :4] = groups[text].astype(">u4").view(np.uint8).reshape(-1, 4)
    keyed[:, 4:] = np.lib.stride_tricks.sliding_window_view(data, length)[at]
    order = np.argsort(keyed.view(f"S{4 + length}").ravel(), kind="stable")  # the suffix array
    keyed = keyed[order]
    same = np.concatenate([[False], (keyed[1:] == keyed[:-1]).all(axis=1)])  # common prefix of length with the one before
    number = np.cumsum(~same) - 1  # the interval of each suffix
    interval = np.empty(len(at), np.int64)
    interval[order] = number
    n = np.bincount(number)
    # left extensions: the intervals of the windows one byte further left in the same segment
    left = np.where(offset > 0, np.concatenate([[-1], interval[:-1]]), -1)
    low, high = np.full(len(n), len(n)), np.full(len(n), -2)
    np.minimum.at(low, interval, left)
    np.maximum.at(high, interval, left)
    extends = (low == high) & (low >= 0) & (n[np.maximum(low, 0)] == n)
    # windows in a row whose intervals extend each other are one repeat
    goes_on = extends[interval]
    head = np.flatnonzero(~goes_on)
    run = np.diff(np.concatenate([head, [len(at)]]))
    keep = n[interval[head]] > 1
    head, run = head[keep], run[keep]
    return interval[head], text[head], offset[head], run + length - 1


def repeat_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """``(documents with id, key, t; spans with id, key, start, stop)``: what repeats something
    earlier.  Spans of a document may overlap."""
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(text_col, F.lit("")).alias("t"))
    # the key tells documents with equal ids apart; where ids are unique it has nothing to tell
    unique = docs.count() == docs.select("id").distinct().count()
    docs = docs.withColumn("key", F.lit(0).cast("long") if unique else F.xxhash64("t")).select("id", "key", "t")
    long_ = docs.where(F.octet_length("t") >= length)

    def anchors(b):
        for _, _, _, h in segments(encoded(b.column(0)), length):
            yield h

    bitmap, _ = repeated_keys(long_.select("t"), anchors)

    def repeated(batches):
        for b in batches:
            ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = encoded(b.column(2))
            for i, start, size, h in segments(texts, length):
                keep = maybe_repeated(h, bitmap.value)
                i, start, size, h = i[keep], start[keep], size[keep], h[keep]
                body = np.fromiter((xxhash.xxh3_64_intdigest(texts[x][a:a + n]) for x, a, n in zip(i, start, size)), np.uint64, len(i))
                yield {"h": h.astype(np.int64), "body": body.astype(np.int64), "id": ids[i], "key": keys[i],
                       "start": start.astype(np.int32), "size": size.astype(np.int32)}

    found = staged(arrow_map(long_, repeated, "h long, body long, id long, key long, start int, size int"), spark)
    bodies_of = first_of(found, ["h", "body", "size"])
    whole = later(found, bodies_of, ["h", "body", "size"]).select("id", "key", "start", (F.col("start") + F.col("size")).alias("stop"))

    # anchors under which different segments stand, and the first of each of these
    firsts = bodies_of.select("h", "first.*")
    several = firsts.groupBy("h").agg(F.count("*").alias("segments")).where("segments > 1")
    chosen = staged(firsts.join(several, "h"), spark)

    def places(b):
        yield place_hash(*(c.to_numpy() for c in b.columns))

    wanted, _ = repeated_keys(chosen.select("id", "key", "start"), places, least=1)

    def bodies(batches):
        for b in batches:
            ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = encoded(b.column(2))
            for i, start, size, h in segments(texts, length):
                keep = maybe_repeated(place_hash(ids[i], keys[i], start), wanted.value)
                i, start, size, h = i[keep], start[keep], size[keep], h[keep]
                yield {"h": h.astype(np.int64), "id": ids[i], "key": keys[i], "start": start.astype(np.int32),
                       "body": [texts[x][a:a + n] for x, a, n in zip(i, start, size)]}

    parts = arrow_map(long_, bodies, "h long, id long, key long, start int, body binary")
    hot = staged(several.where(F.col("segments") > HOT).select("h"), spark)
    parts = staged(parts, spark)
    cool = parts.join(hot, "h", "left_anti").repartition("h").sortWithinPartitions("h")

    def compare(batches):
        rows, last = [], None

        def close():
            ids, keys, starts = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
            h = np.array([r[0] for r in rows], np.int64)
            groups = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
            rep, text, offset, size = intervals([r[4] for r in rows], groups, length)
            begin = starts[text] + offset
            order = np.lexsort((begin, ids[text], rep))
            rep, text, begin, size = rep[order], text[order], begin[order], size[order]
            first = np.concatenate([[True], rep[1:] != rep[:-1]]) if len(rep) else np.zeros(0, bool)
            lead = np.maximum.accumulate(np.where(first, np.arange(len(rep)), 0)) if len(rep) else rep
            later = (ids[text] != ids[text[lead]]) | (begin != begin[lead])
            text, begin, size = text[later], begin[later], size[later]
            return {"id": ids[text], "key": keys[text], "start": begin.astype(np.int32), "stop": (begin + size).astype(np.int32)}

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if r[0] != last and len(rows) >= HOT:
                    yield close()
                    rows = []
                last = r[0]
                rows.append(r)
        if rows:
            yield close()

    near = arrow_map(cool, compare, "id long, key long, start int, stop int")

    def windows(batches):
        for b in batches:
            for _, i, k, s, body in zip(*(c.to_pylist() for c in b.columns)):
                n = len(body) - length + 1
                d = [xxhash.xxh3_128_digest(body[o:o + length]) for o in range(n)]
                yield {"w": d, "id": [i] * n, "key": [k] * n, "start": list(range(s, s + n))}

    hot_windows = staged(arrow_map(parts.join(hot, "h", "left_semi"), windows, "w binary, id long, key long, start int"), spark)
    common = later(hot_windows, first_of(hot_windows, ["w"]), ["w"]).select("id", "key", "start", (F.col("start") + length).alias("stop"))
    return docs, whole.unionByName(near).unionByName(common)


def merged(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, stops)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per document: id, ``n_bytes, n_removed, n_spans, kept_sha256`` and ``spans``, the
    maximal removed runs (bytes, ends exclusive)."""
    docs, spans = repeat_spans(docs, id_col, text_col, length)
    spans = staged(spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "stop")).alias("found")))
    schema = f"id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"

    def cut(batches):
        for b in batches:
            out: dict = {k: [] for k in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")}
            for i, t, found in zip(*(c.to_pylist() for c in b.columns)):
                data, runs = t.encode("utf-8", "surrogatepass"), merged([f["start"] for f in found], [f["stop"] for f in found])
                digest, at = hashlib.sha256(), 0
                for a, e in runs:
                    digest.update(data[at:a])
                    at = e
                digest.update(data[at:])
                for k, v in zip(out, (i, len(data), sum(e - a for a, e in runs), len(runs), digest.hexdigest(),
                                      [{"start": a, "stop": e} for a, e in runs])):
                    out[k].append(v)
            yield out

    owners = spans.select("id", "key")
    some = semi_join_ids(docs, owners, ["id", "key"]).join(spans, ["id", "key"])
    changed = arrow_map(some.select("id", "t", "found"), cut, schema)
    rest = semi_join_ids(docs, owners, ["id", "key"], "left_anti").select(
        "id", F.octet_length("t").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2("t", 256).alias("kept_sha256"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))
    return changed.unionByName(rest).withColumn("id", F.when(F.col("id") != NO_ID, F.col("id"))).withColumnRenamed("id", id_col)
