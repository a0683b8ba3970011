"""Operator 8, benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Words are lower-cased runs of letters, digits and underscores.  Each test item's ``SEED``-word
n-grams are counted over all training documents; its seeds are those in at most ``RARE`` of
the documents, and at least its rarest half.  A document that holds a seed is aligned with the
item, over the stretch of the document that the item would cover (and a margin for inserted words):
match +1, mismatch and gap -0.5 a word.  An item is found where score >= ``MIN_SCORE`` * words of
the item - whole copies score 1, a copy with one word in ten replaced 0.85.  A word that
occurs in no test item can match none and is not looked at further.

The items are worked through in blocks of at most ``ITEM_BYTES`` of text, each broadcast (usually one block);
each block reads the documents twice, and nothing of the documents is shuffled but the counts of seeds.

Defined results: null or empty texts hold nothing; items without words are never found; items
of fewer than ``MIN_WORDS`` words are found only as whole documents; equal items are found
each; every document row is examined by itself, also with equal or null ids; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

SEED = 3
RARE = 1e-4
MIN_SCORE = 0.6
MIN_WORDS = 8
MISS = 0.5
ITEM_BYTES = 16 << 20
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def align(doc: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two arrays of word numbers: ``(score, start, end)`` in ``doc``.

    One row per item word; the gaps along a row are a running maximum, so a row takes a few array
    operations.  The start of each cell's alignment is carried along.
    """
    n = len(doc)
    drop = np.arange(n + 1) * MISS
    score, start = np.zeros(n + 1), np.arange(n + 1)
    best = (0.0, 0, 0)
    for w in item:
        diagonal = score[:-1] + np.where((doc == w) & (w >= 0), 1.0, -MISS)
        up = score[1:] - MISS
        new, begin = np.zeros(n + 1), np.arange(n + 1)
        take = diagonal >= up
        value, origin = np.where(take, diagonal, up), np.where(take, start[:-1], start[1:])
        alive = value > 0
        new[1:], begin[1:] = np.where(alive, value, 0.0), np.where(alive, origin, begin[1:])
        # a gap in the item: best of earlier cells of the row less the words between
        raised = new + drop
        top = np.maximum.accumulate(raised)
        at = np.maximum.accumulate(np.where(raised >= top, np.arange(n + 1), 0))
        across = top - drop
        use = across > new
        new, begin = np.where(use, across, new), np.where(use, begin[at], begin)
        score, start = new, begin
        j = int(np.argmax(score))
        if score[j] > best[0]:
            best = (float(score[j]), int(start[j]), j)
    return best


class Items:
    """A block of test items as numbers: vocabulary, item words, n-grams and where they stand."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [i for i, _ in items]
        lists = [words_of(t) for _, t in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for x in lists for w in x}))}
        self.base = len(self.vocabulary) + 1
        self.words = [np.array([self.vocabulary[w] for w in x], np.int64) for x in lists]
        self.short = {}
        for k, x in enumerate(self.words):
            if 0 < len(x) < MIN_WORDS:
                self.short.setdefault(tuple(x.tolist()), []).append(k)
        rows = [(c, k, o) for k, x in enumerate(self.words) if len(x) >= MIN_WORDS for o, c in enumerate(self.codes(x).tolist())]
        rows.sort()
        self.code = np.array([r[0] for r in rows], np.int64)
        self.item = np.array([r[1] for r in rows], np.int64)
        self.offset = np.array([r[2] for r in rows], np.int64)
        self.distinct = np.unique(self.code)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The n-grams of word numbers, -1 where one holds an unknown word."""
        if len(x) < SEED:
            return np.zeros(0, np.int64)
        parts = [x[i:len(x) - SEED + 1 + i] for i in range(SEED)]
        code, good = np.zeros(len(parts[0]), np.int64), np.ones(len(parts[0]), bool)
        for p in parts:
            code, good = code * self.base + p, good & (p >= 0)
        return np.where(good, code, -1)

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        found = words_of(text)
        return np.fromiter((get(w, -1) for w in found), np.int64, len(found))

    def known(self, codes: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Places in ``codes`` that hold one of the sorted codes ``among``."""
        if not len(among) or not len(codes):
            return np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(among, codes), len(among) - 1)
        return np.flatnonzero((among[at] == codes) & (codes >= 0))

    def use(self, counts: dict[int, int], documents: int) -> None:
        """Chooses the seeds: rare n-grams, and the rarest half of each item's."""
        n = np.array([counts.get(c, 0) for c in self.code.tolist()], np.int64)
        keep = n <= max(1, RARE * documents)
        order = np.lexsort((self.code, n, self.item))
        sizes = np.bincount(self.item, minlength=len(self.words))
        rank = np.arange(len(order)) - (np.cumsum(sizes) - sizes)[self.item[order]]
        keep[order[rank * 2 <= sizes[self.item[order]]]] = True
        self.code, self.item, self.offset = self.code[keep], self.item[keep], self.offset[keep]
        self.distinct = np.unique(self.code)

    def matches(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """``(item, score 0..1, first word, end word)`` of every item found in the text."""
        x = self.numbers(text)
        out = [(k, 1.0, 0, len(x)) for k in self.short.get(tuple(x.tolist()), [])] if 0 < len(x) < MIN_WORDS else []
        codes = self.codes(x)
        spots: dict[int, list[int]] = {}
        for p in self.known(codes, self.distinct).tolist():
            for r in range(*np.searchsorted(self.code, [codes[p], codes[p] + 1])):
                spots.setdefault(int(self.item[r]), []).append(p - int(self.offset[r]))
        for k, begins in sorted(spots.items()):
            item = self.words[k]
            m, margin = len(item), len(item) // 4 + SEED
            need, best, end = MIN_SCORE * m, None, -1
            windows: list[list[int]] = []
            for b in sorted(set(begins)):
                lo, hi = max(0, b - margin), min(len(x), b + m + margin)
                if windows and lo <= windows[-1][1]:
                    windows[-1][1] = max(hi, windows[-1][1])
                else:
                    windows.append([lo, hi])
            for lo, hi in windows:
                part = x[lo:hi]
                if np.isin(item, part).sum() < need:  # more words cannot match
                    continue
                score, a, e = align(part, item)
                if score >= need and (best is None or score > best[1] * m):
                    best = (k, score / m, lo + a, lo + e)
            if best:
                out.append(best)
        return out


def item_blocks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, doc_text: str):
    """Yields broadcast blocks of items with their seeds chosen over all of ``docs``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size, documents = items.select(F.sum(F.octet_length("t"))).first()[0] or 0, docs.count()
    blocks = max(1, -(-size // ITEM_BYTES))
    for k in range(blocks):
        mine = items if blocks == 1 else items.where(F.pmod(F.xxhash64("t"), F.lit(blocks)) == k)
        rows = sorted(((r["i"], r["t"]) for r in mine.collect()), key=lambda r: (r[0] is None, r))
        plain = spark.sparkContext.broadcast(rows)

        def count(batches):
            held = Items(plain.value)
            n = np.zeros(len(held.distinct), np.int64)
            for b in batches:
                for t in b.column(0).to_pylist():
                    codes = held.codes(held.numbers(t))
                    hit = codes[held.known(codes, held.distinct)]
                    n[np.searchsorted(held.distinct, np.unique(hit))] += 1
            some = np.flatnonzero(n)
            yield {"code": held.distinct[some], "n": n[some]}

        counts = arrow_map(docs.select(doc_text), count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
        yield plain, spark.sparkContext.broadcast({r["code"]: r["n"] for r in counts.collect()}), documents  # n-grams of one block


def prepared(block) -> Items:
    plain, counts, documents = block
    items = Items(plain.value)
    items.use(counts.value, documents)
    return items


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item found in it: ``id, item, score, start_word, end_word``."""
    out = None
    schema = f"{id_col} {docs.schema[id_col].dataType.simpleString()}, {item_col} {benchmark.schema[item_col].dataType.simpleString()}, " \
             "score double, start_word long, end_word long"
    for block in item_blocks(docs, benchmark, item_col, item_text, text_col):
        def find(batches, block=block):
            items = prepared(block)
            for b in batches:
                rows = [(i, items.ids[k], s, a, e) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                        for k, s, a, e in items.matches(t)]
                yield {name: [r[c] for r in rows] for c, name in enumerate((id_col, item_col, "score", "start_word", "end_word"))}

        part = arrow_map(docs.select(id_col, text_col), find, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text: str = "text") -> DataFrame:
    """All columns of ``docs``, without the rows that hold a test item."""
    i = docs.columns.index(text_col)
    out = docs
    for block in item_blocks(docs, benchmark, item_col, item_text, text_col):
        def clean(batches, block=block):
            items = prepared(block)
            for b in batches:
                yield b.filter(pa.array([not items.matches(t) for t in b.column(i).to_pylist()], pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out
