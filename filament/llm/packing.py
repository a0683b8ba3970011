"""Operator 4, lexical retrieval packing into windows of at most ``WINDOW`` tokens.

A document's tokens are the ids of a byte-level BPE tokenizer file, then id 0.  Document frequencies
and the mean length are those of all documents.  Documents are sorted by content - by a min-hash of their
``SALIENT`` terms of highest BM25 weight, see ``sketches`` - and the sorted row is cut into shards of at most
about ``SHARD_BYTES`` of text.  So documents meet the likelier the more salient terms they share, at any
size; a term that fills more than a shard is cut by the next one, in the end by a hash of the row.
Each shard holds an inverted index with BM25 weights over its documents' whole texts:
1. a document's whole windows stand alone; what is left of it (under a window) is an entry;
2. the longest unused entry seeds a window; its terms (token ids, however common: their idf weighs
   them; only the closing 0, which all hold, is none) retrieve the unused entries that are lexically nearest;
3. these fill the window greedily, whole ones first by score, then the nearest is cut to fill the
   window exactly; what is left of it stays in the index;
4. the last window of a shard, which nothing can fill, is cut into sequences whose lengths are
   powers of two, so nothing is padded.
Shards are bounded, so is every task; tokens are staged and move once, two bytes each.

Defined results: a null or empty text is the one token 0; rows with equal ids are packed each; an
empty table gives no rows; other columns are not read.  Texts may be of any length.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, arrow_map, forget, give_back, per_worker, staged

WINDOW = 1024
SHARD_BYTES = 16 << 20
K1, B = 1.2, 0.75
DENSE = 1 / 8  # terms in more of the entries stand in a matrix
DENSE_CELLS = 16 << 20  # its size at most; what has no room there stays in posting lists
AHEAD = 32  # seeds that are scored together
END = 0
# fixed value: how byte-level BPE of this family cuts texts
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# fixed values: white space as the pattern knows it; a space that stands inside a stretch of it, where a cut before spaces is not the pattern's
SPACES = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = r"^$|^\n|\n$|\n\n|[" + SPACES.replace(r"\t-\r", r"\t\x0b-\r") + "]"
UNEVEN = rf"[{SPACES}] ([{SPACES}]|\z)"
TEXT_BYTES = 8 << 20  # texts whose words are encoded together
KNOWN = 300_000  # words whose ids a worker keeps
WORDS_TOGETHER = 1 << 15  # new words that are encoded as one text


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the rest follows from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def has_long_run(text: str, size: int = 1000) -> bool:
    """Is there a stretch without a change between words and white space?  True for runs of
    2 * ``size`` characters, false for runs under ``size``."""
    return any(len(text[a:a + size].split(None, 1)) < 2 for a in range(0, len(text) - size + 1, size))


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``start, start + 1, ...``, ``size`` of them each."""
    behind = np.cumsum(size)
    return np.repeat(start - behind + size, size) + np.arange(behind[-1] if len(behind) else 0)


def counted(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids of each document (none is empty), ascending, how often each stands there, and where a document's end."""
    flat, bounds = np.concatenate([np.sort(x) for x in docs]), np.cumsum([len(x) for x in docs])
    new = np.append(True, flat[1:] != flat[:-1])
    new[bounds[:-1]] = True
    at = np.flatnonzero(new)
    return flat[at], np.diff(at, append=len(flat)), np.searchsorted(at, bounds)


class Tokens:
    """Ids of a byte-level BPE tokenizer file (JSON).  Where its merges rank like its ids, the ids
    come from the same vocabulary as ranks, which is several times faster; texts with very
    long runs, and files of another kind, go through the tokenizer itself."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(content)
        spec = json.loads(content)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"].get("merges", [])]
        at = [vocab.get(m.replace(" ", "", 1), -1) for m in merges]
        self.fast = None
        if spec["model"].get("type") == "BPE" and all(a < b for a, b in zip(at, at[1:])) and \
                json.dumps(spec.get("pre_tokenizer") or {}).count('"ByteLevel"') == 1 and not spec.get("normalizer"):
            import tiktoken

            ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
            self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        gap = self.fast.encode_ordinary("\t") if self.fast else []
        self.gap = gap[0] if len(gap) == 1 else None
        self.known, self.known_ids, self.known_sizes = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def ids(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.fast is None or has_long_run(text):
            return self.slow.encode(text, add_special_tokens=False).ids
        if self.cut is None or not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return [i for part in self.cut.split(text) for i in
                ([self.special[part]] if part in self.special else self.fast.encode_ordinary(part))]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        return list(self.each(texts))

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """``ids`` of each text.  Texts are cut before spaces, and each distinct word is encoded once; words that
        came more than once are kept, ``KNOWN`` at most."""
        texts = pc.fill_null(texts, "")
        whole = np.array(pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False), bool)
        for a in range(0, len(texts), SLICE_ROWS):
            for i, t in enumerate(texts.slice(a, SLICE_ROWS).to_pylist(), a):
                if self.gap is None or has_long_run(t) or any(s in t for s in self.special):
                    whole[i] = True
        rest = np.flatnonzero(~whole)
        if len(rest):
            at, firsts, ends, tokens, start, sizes = self.by_words(texts.take(pa.array(rest)))
        for a in range(0, len(texts), SLICE_ROWS):
            b = min(len(texts), a + SLICE_ROWS)
            lo, hi = np.searchsorted(rest, (a, b)).tolist()
            ids: list[np.ndarray] = []
            if lo < hi:
                some = at[firsts[lo]:ends[hi - 1]]
                cuts = np.cumsum(sizes[some])[ends[lo:hi] - firsts[lo] - 1]
                ids = np.split(tokens[runs(start[some], sizes[some])], cuts[:-1])
            there = iter(ids)
            for i in range(a, b):
                yield np.array(self.ids(texts[i].as_py()), np.uint32) if whole[i] else next(there)

    def by_words(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """The words of texts, one after the other, as places; where each text's words start and end; ids, and which are a place's."""
        words = pc.split_pattern(texts, " ")
        ends = np.asarray(words.offsets)[1:] - words.offsets[0].as_py()
        firsts = np.append(0, ends[:-1])  # the only words that no space stands before
        coded = words.flatten().dictionary_encode()
        del words
        at, coded = np.array(coded.indices), coded.dictionary
        lead, place = np.unique(at[firsts], return_inverse=True)
        at[firsts] = place + len(coded)
        held = pc.index_in(coded, self.known.cast(coded.type))
        new = held.is_null().to_numpy(zero_copy_only=False)
        fresh = coded.filter(pa.array(new))
        more, sizes = self.words(fresh)
        bare = [self.fast.encode_ordinary(w) for w in coded.take(pa.array(lead)).to_pylist()]
        tokens = np.concatenate([self.known_ids, more, np.array([k for x in bare for k in x], np.uint32)])
        sizes = np.concatenate([self.known_sizes, sizes, np.array([len(x) for x in bare], np.int64)])
        start = np.cumsum(sizes) - sizes
        place = pc.fill_null(held, 0).to_numpy().astype(np.int64)  # of each word of the batch: where its ids are
        place[new] = len(self.known) + np.arange(len(fresh))
        place = np.append(place, len(self.known) + len(fresh) + np.arange(len(lead)))
        start, sizes = start[place], sizes[place]
        keep = np.flatnonzero((np.bincount(at, minlength=len(place))[:len(new)] > 1) & new)[:KNOWN - len(self.known)]
        if len(keep):
            self.known_ids = np.append(self.known_ids, tokens[runs(start[keep], sizes[keep])])
            self.known_sizes = np.append(self.known_sizes, sizes[keep])
            self.known = pa.concat_arrays([self.known, coded.take(pa.array(keep)).cast(self.known.type)])
        return at, firsts, ends, tokens, start, sizes

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, each with a space in front, and how many ids each has.  Words without white space but single
        line ends inside are encoded together, parted by tabs, which no id of theirs holds."""
        odd = pc.match_substring_regex(words, ODD).to_numpy(zero_copy_only=False)
        ids, sizes = np.zeros(0, np.uint32), np.zeros(len(words), np.int64)
        plain = words.filter(pa.array(~odd))
        parts = []
        for a in range(0, len(plain), WORDS_TOGETHER):  # a list of ids takes ten times their room
            part = plain.slice(a, WORDS_TOGETHER)
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(part)], pa.int64()), part), "\t ")[0].as_py()
            ids = np.frombuffer(array("I", self.fast.encode_ordinary(" " + joined)), np.uint32)
            gaps = np.flatnonzero(ids == self.gap)
            parts.append((np.delete(ids, gaps), np.diff(gaps, prepend=-1, append=len(ids)) - 1))
        if parts:
            ids, sizes[~odd] = map(np.concatenate, zip(*parts))
        at = np.cumsum(sizes)
        single = [self.fast.encode_ordinary(" " + w) for w in words.filter(pa.array(odd)).to_pylist()]
        if single:
            sizes[odd] = n = [len(x) for x in single]
            ids = np.insert(ids, np.repeat(at[odd], n), [k for x in single for k in x])
        return ids, sizes


class Corpus:
    """What all documents share: how many hold each term, their number and mean length."""

    def __init__(self, df: np.ndarray, n: int, mean: float):
        self.df, self.n, self.mean = df, n, mean
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))

    @classmethod
    def of(cls, docs: list[np.ndarray]) -> Corpus:
        df = np.bincount(np.concatenate([np.unique(d) for d in docs]).astype(np.int64))
        return cls(df, len(docs), float(np.mean([len(d) for d in docs])))

    def weights(self, term: np.ndarray, tf: np.ndarray, length) -> np.ndarray:
        return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / max(self.mean, 1))) * self.idf[term]


# fixed value: how ``sketches`` lays out its key, three terms and a hash
TERM_BITS = (16, 16, 14)
HASH_BITS = 16
KEY_BITS = sum(TERM_BITS) + HASH_BITS
SALIENT = 12
MIX = np.uint64(0x9E3779B97F4A7C15)  # fixed value: multiplicative hash, wraps around


def sketches(docs: list[np.ndarray], corpus: Corpus, least: float, salts: list[bytes]) -> list[int]:
    """The places of documents in the order by content.  Of a document's heaviest terms (those that at least ``least``
    documents hold come first, as rarer ones would not bring a shard together; those that stand once are none)
    the three that are first by a hash of the term; then a hash of the row, which cuts what is still too large."""
    term, tf, ends = counted(docs)
    starts = np.append(0, ends[:-1])
    df = corpus.df[term]
    weight = corpus.weights(term, tf, np.repeat([len(x) for x in docs], ends - starts))
    mixed = term.astype(np.uint64) * MIX
    fit = np.flatnonzero((df >= max(least, 2)) & (term != END))
    keys, fits = [], np.searchsorted(fit, np.append(starts, ends[-1])).tolist()
    fit_weight = weight[fit]
    for x, salt, i, j, a, b in zip(docs, salts, starts.tolist(), ends.tolist(), fits, fits[1:]):
        if b - a > SALIENT:  # the others come behind these
            heavy = fit_weight[a:b]
            at = fit[a:b][heavy >= np.partition(heavy, -SALIENT)[-SALIENT]]
            if len(at) > SALIENT:
                at = at[np.lexsort((term[at], -weight[at]))][:SALIENT]
        else:
            at = np.arange(i, j)[term[i:j] != END]
            at = at[np.lexsort((term[at], -weight[at], df[at] < least, df[at] < 2))][:SALIENT]
            at = at[df[at] > 1]
        top = term[at[np.argsort(mixed[at], kind="stable")[:len(TERM_BITS)]]].tolist()
        key = 0
        for bits, t in zip(TERM_BITS, top + [0] * len(TERM_BITS)):
            key = key << bits | t & (1 << bits) - 1
        keys.append(key << HASH_BITS | xxhash.xxh3_64_intdigest(salt + x.tobytes()) & (1 << HASH_BITS) - 1)
    return keys


def shard_starts(keys: DataFrame) -> list[int]:
    """First keys of shards of at most about ``SHARD_BYTES``, from ``(key, bytes)`` of all documents: sums by
    prefix, longer ones only where a prefix holds over a quarter of a shard (so at most 256 rows for each)."""
    leaves, hot, shift = [], None, KEY_BITS - TERM_BITS[0]
    while True:
        prefixed = keys.withColumn("p", F.shiftright("key", shift))
        if hot is not None:
            wide = keys.sparkSession.createDataFrame([(h,) for h in hot], "h long")
            prefixed = prefixed.join(F.broadcast(wide), F.shiftright("key", last) == F.col("h"))
        sums = [(t["p"], t["b"]) for t in prefixed.groupBy("p").agg(F.sum("bytes").alias("b")).collect()]
        hot = [p for p, b in sums if b > SHARD_BYTES // 4] if shift else []
        leaves += [(p << shift, b) for p, b in sums if not shift or b <= SHARD_BYTES // 4]
        if not hot:
            break
        last, shift = shift, max(0, shift - 8)
    starts, held = [], 0
    for key, b in sorted(leaves):
        if not starts or held + b > SHARD_BYTES:
            starts.append(key)
            held = 0
        held += b
    return starts


class Index:
    """BM25 over the entries of one shard; terms are token ids.  Entries of equal tokens form a class,
    which is scored once.  Weights of common terms stand in a matrix, the others' in posting lists."""

    def __init__(self, entries: list[np.ndarray], corpus: Corpus | None = None):
        corpus = corpus or Corpus.of(entries)
        classes: dict = {}
        self.of = np.array([classes.setdefault(np.sort(e).tobytes(), len(classes)) for e in entries])
        _, first, many = np.unique(self.of, return_index=True, return_counts=True)
        lengths = np.array([len(e) for e in entries])
        self.n = len(first)
        term, tf, ends = counted([entries[k] for k in first])
        doc = np.repeat(np.arange(self.n), np.diff(ends, prepend=0))
        some = term != END
        term, tf, doc = term[some].astype(np.int32), tf[some].astype(np.int32), doc[some].astype(np.int32)
        df = np.bincount(term, many[doc])  # here
        weight = corpus.weights(term, tf, lengths[first][doc])
        held = np.bincount(term, minlength=len(df))  # classes
        common = np.argsort(-held, kind="stable")[:DENSE_CELLS // self.n]
        common = common[held[common] > max(2, DENSE * self.n)]
        column = np.full(len(df), -1, np.int32)
        column[common] = np.arange(len(common))
        self.matrix = np.zeros((len(common), self.n), np.float32)
        at = column[term]
        dense = at >= 0
        self.matrix[at[dense], doc[dense]] = weight[dense]
        rare = np.flatnonzero(~dense)
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.doc, self.weight = doc[rare].astype(np.int64), weight[rare]
        first = np.searchsorted(term[rare], np.arange(len(df) + 1))
        # by class, of its terms that others hold too: rows of the matrix, and posting lists
        useful, cuts = (df > 1)[term], np.arange(1, self.n)
        asks, seeks = useful & dense, useful & ~dense
        self.rows = np.split(at[asks], np.searchsorted(doc[asks], cuts))
        self.ends = np.searchsorted(doc[seeks], np.arange(self.n + 1))
        self.lists = first[term[seeks]], first[term[seeks] + 1]
        self.held: dict[int, np.ndarray] = {}  # by class, what the matrix adds
        self.scored, self.at = np.arange(self.n), self.of  # classes that are scored, and where an entry's stands among them

    def narrow(self, unused: np.ndarray):
        """Leaves out classes without ``unused`` entries, whose scores are 0 from now on, once they are a quarter of those scored."""
        keep = (np.bincount(self.of, unused, self.n) > 0)[self.scored]
        if 4 * np.count_nonzero(keep) > 3 * len(keep):
            return
        self.scored, place = self.scored[keep], np.cumsum(keep) - 1
        at = np.full(self.n, len(self.scored))
        at[self.scored] = np.arange(len(self.scored))
        self.at = at[self.of]
        self.matrix, self.held = self.matrix.compress(keep, 1), {c: x[keep] for c, x in self.held.items()}
        some = keep[self.doc]
        before = np.append(0, np.cumsum(some))
        self.doc, self.weight, self.lists = place[self.doc[some]], self.weight[some], tuple(before[x] for x in self.lists)

    def common_scores(self, classes: list[int]) -> np.ndarray:
        """What the matrix adds to the scores of each class; one product for several is faster than one for each."""
        asked = np.zeros((len(classes), len(self.matrix)), np.float32)
        for row, c in zip(asked, classes):
            row[self.rows[c]] = 1
        return asked @ self.matrix

    def scores(self, entry: int, ahead: Callable = list, unused: Callable | None = None) -> np.ndarray:
        """Scores of all entries; ``ahead`` names entries that are likely to be asked for next, ``unused`` marks
        those that may have a score other than 0."""
        own = int(self.of[entry])
        if own not in self.held:
            if unused:
                self.narrow(unused())
            classes = dict.fromkeys([own, *(int(self.of[k]) for k in ahead())])
            new = [c for c in classes if c not in self.held]  # a seed that was cut comes between those made before
            self.held = {c: self.held[c] for c in classes if c in self.held} | dict(zip(new, map(np.copy, self.common_scores(new))))
        out = np.append(self.held[own], 0.0).astype(float)
        at = slice(self.ends[own], self.ends[own + 1])
        spans = [slice(a, b) for a, b in zip(*(x[at].tolist() for x in self.lists))]
        if spans:
            out += np.bincount(np.concatenate([self.doc[x] for x in spans]), np.concatenate([self.weight[x] for x in spans]), len(out))
        return out[self.at]


def pack(lengths: list[int], tails: list[np.ndarray], window: int = WINDOW, texts: list[np.ndarray] | None = None,
         corpus: Corpus | None = None):
    """Yields sequences, lists of ``(document, start, length)``.

    ``lengths`` are whole documents', ``tails`` the tokens that their whole windows leave (maybe none), ``texts``
    the tokens that a document is found by (its tail if not given); ``corpus`` defaults to these entries.
    """
    for d, n in enumerate(lengths):
        for s in range(0, n // window * window, window):
            yield [(d, s, window)]
    entries = [d for d, t in enumerate(tails) if len(t)]
    if not entries:
        return
    index = Index([(texts or tails)[d] for d in entries], corpus)
    left = np.array([len(tails[d]) for d in entries])
    start = np.array([lengths[d] for d in entries]) - left
    total = int(left.sum())
    heap = [(-int(n), k) for k, n in enumerate(left)]
    heapq.heapify(heap)

    def longest() -> int:
        while left[heap[0][1]] != -heap[0][0]:
            n, k = heapq.heappop(heap)
            if left[k]:
                heapq.heappush(heap, (-int(left[k]), k))
        return heap[0][1]

    def ahead() -> list[int]:
        return [k for n, k in heapq.nsmallest(AHEAD, heap) if left[k] == -n]

    def take(k: int, n: int) -> tuple[int, int, int]:
        piece = (entries[k], int(start[k]), n)
        start[k] += n
        left[k] -= n
        return piece

    while total >= window:
        seed = longest()
        score = index.scores(seed, ahead, lambda: left > 0)
        pieces = [take(seed, int(left[seed]))]
        room = window - pieces[0][2]
        if room:
            score[left == 0] = 0.0
            while room:  # whole ones first, the nearest that fits
                k = int(np.argmax(np.where(left <= room, score, 0.0)))
                if left[k] > room or score[k] <= 0:
                    break
                pieces.append(take(k, int(left[k])))
                score[k] = 0.0
                room -= pieces[-1][2]
            while room:  # then the nearest is cut
                k = int(np.argmax(score))
                k = k if score[k] > 0 else longest()
                pieces.append(take(k, min(room, int(left[k]))))
                score[k] *= left[k] > 0
                room -= pieces[-1][2]
        total -= window
        yield pieces
    sizes = [1 << b for b in reversed(range(window.bit_length())) if total >> b & 1]
    for size in sizes:
        pieces, room = [], size
        while room:
            k = longest()
            pieces.append(take(k, min(room, int(left[k]))))
            room -= pieces[-1][2]
        yield pieces


def grouped(batches):
    """Batches together that hold about ``TEXT_BYTES`` of text (by their third column)."""
    group, held = [], 0
    for b in batches:
        group.append(b)
        held += pc.sum(b.column(2)).as_py() or 0
        if held >= TEXT_BYTES:
            full, group, held, b = group, [], 0, None
            yield full
            del full
    if group:
        yield group


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``start, length, ids_crc32, doc_tokens, sequence_id, offset`` and,
    with ``with_ids``, the piece's ``ids``.  The tokenizer file is read on the driver and broadcast."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = spark.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    own = ("bpe", tokenizer_path)

    def tokenize(batches):
        tokens = per_worker(own, lambda: Tokens(content.value))
        df, n, total = np.zeros(1 << 16, np.int64), 0, 0
        for group in grouped(batches):
            ids = tokens.each(pa.concat_arrays([b.column(1) for b in group]))
            group = [b.select(["id", "bytes"]) for b in group]  # their texts aren't held twice
            for b in group:
                rows = b.num_rows
                part = [np.append(next(ids), np.uint32(END)) for _ in range(rows)]
                wide = [bool(x.max() > 0xFFFF) for x in part]
                part = [x.astype("<u4" if w else "<u2") for x, w in zip(part, wide)]
                held = np.bincount(counted(part)[0], minlength=len(df))
                df = np.append(df, np.zeros(len(held) - len(df), np.int64)) + held
                n, total = n + rows, total + sum(map(len, part))
                yield {"id": b.column("id"), "wide": wide, "bytes": b.column("bytes"), "ids": [x.tobytes() for x in part],
                       "terms": [None] * rows, "counts": [None] * rows}
            give_back()  # a group takes as much again as a worker keeps
        held = np.flatnonzero(df)  # one row a task, not a document
        yield {"id": [None], "wide": [None], "bytes": [None], "ids": [None],
               "terms": [[*held.tolist(), -1, -2]], "counts": [[*df[held].tolist(), n, total]]}

    def arrays(b):
        return [np.frombuffer(x, "<u4" if wide else "<u2") for x, wide in zip(b.column("ids").to_pylist(), b.column("wide").to_pylist())]

    docs = docs.select("id", "t", F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("bytes"))
    docs = staged(arrow_map(docs, tokenize, f"id {kind}, wide boolean, bytes long, ids binary, terms array<int>, counts array<long>"), spark)
    held = docs.where("terms is not null").select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    held = {t["term"]: t["n"] for t in held.groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.counts").alias("n")).collect()}  # vocabulary
    docs = docs.where("terms is null").select("id", "wide", "bytes", "ids")
    n, total = held.pop(-1, 0), held.pop(-2, 0)
    df = np.zeros(max(held, default=0) + 1, np.int64)
    df[list(held)] = list(held.values())
    shared = spark.sparkContext.broadcast((df, n, total / max(n, 1)))
    size = docs.select(F.sum("bytes")).first()[0] or 0
    least = max(2, n / max(1, size / SHARD_BYTES) / 16)

    def keys_of(b, corpus):
        return sketches(arrays(b), corpus, least, [repr(i).encode() for i in b.column("id").to_pylist()])

    def key(batches):
        corpus = Corpus(*shared.value)
        for b in batches:
            yield {"key": keys_of(b, corpus), "bytes": b.column("bytes")}

    starts = shard_starts(staged(arrow_map(docs, key, "key long, bytes long"), spark)) if size > SHARD_BYTES else [0]
    cuts = spark.sparkContext.broadcast(np.array(starts[1:], np.int64))

    def deal(batches):
        corpus = Corpus(*shared.value)
        for b in batches:
            shard = np.searchsorted(cuts.value, keys_of(b, corpus), "right") if len(cuts.value) else np.zeros(b.num_rows, int)
            yield {"shard": shard, "id": b.column("id"), "wide": b.column("wide"), "ids": b.column("ids")}

    def pack_shard(t: pa.Table) -> pa.Table:
        forget(own)  # no more texts to encode: an executor has its memory for the indexes
        rows = sorted(zip(*(t.column(c).to_pylist() for c in ("id", "ids", "wide"))), key=lambda r: (r[0] is None, r[0], r[1]))
        ids = [np.frombuffer(x, "<u4" if wide else "<u2") for _, x, wide in rows]
        shard = t.column("shard")[0].as_py()
        out: dict = {k: [] for k in names}
        for q, pieces in enumerate(pack([len(x) for x in ids], [x[len(x) // window * window:] for x in ids], window,
                                        ids, Corpus(*shared.value))):
            offset = 0
            for d, s, n in pieces:
                part = ids[d][s:s + n].astype("<u4")
                for k, v in zip(names, (rows[d][0], s, n, zlib.crc32(part.tobytes()), len(ids[d]), (shard << 32) + q, offset, part)):
                    out[k].append(v)
                offset += n
        return pa.table({k: pa.array(v, type=f.type) for (k, v), f in zip(out.items(), arrow)})

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + \
             (", ids array<int>" if with_ids else "")
    arrow = to_arrow_schema(_parse_datatype_string(schema))
    names = list(arrow.names)
    return arrow_map(docs, deal, f"shard int, id {kind}, wide boolean, ids binary").groupBy("shard").applyInArrow(pack_shard, schema)
