"""Operator 5, language ID: rank-order profiles (out-of-place distance).

A profile is the list of the most frequent character n-grams (1 to 3 letters, words padded
with a space), the rank standing for the frequency; ties are ordered by code points.  A
document's profile is compared to each language's: per n-gram of the document the
difference of the two ranks, or ``PROFILE`` where the language lacks it.  The language with
the smallest sum wins, ties go to the smaller name.

Learning takes a bounded sample: per language at most about ``MAX_TRAIN`` documents, dealt
by a hash of the id; their n-grams are counted by Spark and only the ``PROFILE`` most
frequent per language reach the driver.  Prediction reads whole texts, and nothing but text.

Defined results: null text or no letter -> ``und`` with score 0; without anything learned
``und`` everywhere; every row gives one row; other columns are not read.
``score`` is 1 - distance / greatest possible distance.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, per_worker

PROFILE = 300
MAX_TRAIN = 4000
LETTER_BITS = 21
BLOCK_CHARS = 1 << 20


def letters() -> np.ndarray:
    """Per code point: is it a letter?"""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams of the padded, lower-cased words, as packed code points, and counts."""
    low = text.lower()
    keys, counts = [], []
    for at in range(0, len(low), BLOCK_CHARS):  # n-grams that end in the block, begun up to 2 before
        cut = low[max(0, at - 2):at + BLOCK_CHARS]
        own = min(at, 2)
        c = np.frombuffer(cut.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = at + BLOCK_CHARS >= len(low)
        c = np.concatenate([[32] * (at == 0), c, [32] * ends]).astype(np.int64)
        own += at == 0
        good = is_letter[c]
        c = np.where(good, c, 32)
        one = c[own:][good[own:]]
        two = (c[:-1] << LETTER_BITS | c[1:])[good[:-1] | good[1:]] if own < 2 else \
            (c[own - 1:-1] << LETTER_BITS | c[own:])[good[own - 1:-1] | good[own:]]
        lo = max(own - 2, 0)
        three = (c[lo:-2] << 2 * LETTER_BITS | c[lo + 1:-1] << LETTER_BITS | c[lo + 2:])[good[lo + 1:-1]]
        k, n = np.unique(np.concatenate([one, two, three]), return_counts=True)
        keys.append(k)
        counts.append(n)
    if len(keys) == 1:
        return keys[0], counts[0]
    k, inverse = np.unique(np.concatenate(keys), return_inverse=True) if keys else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return k, np.bincount(inverse, np.concatenate(counts) if counts else None, len(k)).astype(np.int64)


def top(keys: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent keys in order of rank."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:size]


def fit_profiles(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 size: int = PROFILE, max_train: int = MAX_TRAIN) -> dict[str, list[int]]:
    """Language -> packed n-grams by rank.  Rows with a null language or text teach nothing."""
    train = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("i"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    sizes = train.groupBy("lang").count().withColumn("part", F.least(F.lit(1.0), F.lit(float(max_train)) / F.col("count")))
    some = train.join(F.broadcast(sizes.drop("count")), "lang").where(
        F.pmod(F.xxhash64(F.lit("langid"), F.col("i")), F.lit(1 << 20)) < F.col("part") * (1 << 20)).select("lang", "t")

    def count(batches):
        is_letter = per_worker("letters", letters)
        held: dict[str, list] = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(grams(t, is_letter))
            for lang, parts in held.items():
                k, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                held[lang] = [(k, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64))]
        for lang, ((k, n),) in held.items():
            yield {"lang": [lang] * len(k), "gram": k, "n": n}

    total = arrow_map(some, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")  # a language's distinct n-grams: bounded by its letters
    out: dict[str, list[int]] = {}
    for r in total.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def predict_language(df: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id", text_col: str = "text",
                     size: int = PROFILE) -> DataFrame:
    """One row per input row: the id, ``lang_pred`` and ``score``."""
    langs = sorted(profiles)
    table = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    ranks = np.full((len(langs), len(table)), -1, np.int64)
    for i, lang in enumerate(langs):
        ranks[i, np.searchsorted(table, profiles[lang])] = np.arange(len(profiles[lang]))
    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, lang_pred string, score double"

    def one(text: str | None, is_letter) -> tuple[str, float]:
        if not text or not langs:
            return "und", 0.0
        own = top(*grams(text, is_letter), size)
        if not len(own):
            return "und", 0.0
        at = np.minimum(np.searchsorted(table, own), len(table) - 1)
        r = np.where(table[at] == own, ranks[:, at], -1)
        d = np.where(r < 0, size, np.abs(r - np.arange(len(own)))).sum(axis=1)
        i = int(np.argmin(d))
        return langs[i], 1.0 - float(d[i]) / (size * len(own))

    def run(batches):
        is_letter = per_worker("letters", letters)
        for b in batches:
            got = [one(t, is_letter) for t in b.column(1).to_pylist()]
            yield {id_col: b.column(0), "lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    return arrow_map(df.select(id_col, text_col), run, schema)
