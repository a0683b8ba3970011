"""Operator 11, alignment of two tokenizers: which tokens cover the same bytes, and how often each id pair meets.

Each text is encoded by tokenizer A (byte-level BPE, of space + text) and by B (a sentencepiece model, which
adds the space); both cover the same bytes, or the row has no tokens.  Byte offsets where tokens of both end
cut the row into groups; an A and a B token whose byte ranges overlap are linked.

Where neither tokenizer has tokens across it, a text is cut at single spaces between words (``Aligner.pieces``): a
word's tokens and links are those of the word as a text of its own, so distinct words are aligned once; a worker
keeps those that come again (``Words``).

1. First pass: the tasks align texts and stage their distinct id pairs, each once with its count (at most
   ``FLUSH_KEYS`` pairs a row).  Beside them they stage the texts, ``SLICE_ROWS`` a row, as places in a list of their
   distinct words with the words' ids.
2. The pairs are dealt to buckets by hash.  Each bucket gets a minimal perfect hash (``PerfectHash``) of its
   distinct pairs: about four bits a pair, no pair stored in it.
3. Counts become dense vectors indexed by that hash.  ``FAN`` staged rows make one vector, ``FAN`` vectors one
   more, until a bucket has one: no task adds more than that, however many tasks counted a pair.  The pairs
   stand beside the counts in the order of the hash and verify each look-up.
4. Second pass: the staged words' links are looked up and added up for each text; no text is read or encoded again.

Up to ``BROADCAST_PAIRS`` pairs (about 17 bytes each) the table is broadcast.  Beyond it the second pass aligns the texts
again, deals its distinct pairs to (bucket, salt) and meets the bucket's part of the table there; ``FAN`` slices of
``SLICE_ROWS`` rows share a salt, so a task's share is bounded and the results are equal.

Defined results: null and empty texts, and texts whose tokens' bytes differ from space + text (U+2581 in the
text), have zeros and an empty ``groups_sha256``; special tokens' strings are plain text; rows with equal or
null ids stand each for itself; an empty table gives no rows; other columns, whatever their names, are not
read.  Whole texts are aligned.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_map, forget, per_worker, staged
from .keyset import distinct, mix
from .packing import Tokens, byte_letters, has_long_run, runs

FLUSH_KEYS = 1 << 20
#: pairs a bucket should hold, and the most of all buckets that are broadcast
BUCKET_PAIRS = 1 << 18
BROADCAST_PAIRS = 1 << 22
#: rows that one task adds up
FAN = 64
#: words, and characters of words, that a task or worker remembers
WORDS = 1 << 18
WORD_CHARS = 1 << 25
#: words are encoded as one text of about this size; longer words alone
RUN_CHARS = 1 << 16
LONG_WORD = 256
#: not between words: spaces at an end, white space side by side
RAGGED = re.compile(r"^ | $|\s\s")
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: white space of ASCII as spaces
SPACES = bytes(32 if chr(i).isspace() else i for i in range(128)) + bytes(range(128, 256))
#: how other white space begins
WIDE_SPACES = sorted({chr(i).encode()[:2] for i in range(128, 0x110000) if chr(i).isspace()})
GAMMA = 2
ONE = np.uint64(1)
PAIRS = ("n", "keys", "counts")
CODED = ("words", "at", "a", "n_a", "b", "n_b")
COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def ragged(text: str) -> bool:
    """Does ``RAGGED`` match?  Bytes tell that several times faster where only ASCII has white space."""
    data = text.encode()
    if not text.isascii() and any(x in data for x in WIDE_SPACES):
        return RAGGED.search(text) is not None
    return data[:1] == b" " or data[-1:] == b" " or b"  " in data.translate(SPACES)


class Aligner:
    """Ids, byte lengths and names of both tokenizers."""

    def __init__(self, a_content: str, b_model: bytes):
        import sentencepiece

        self.a = Tokens(a_content)
        self.a.slow.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = byte_letters()
        spec = json.loads(a_content)
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        self.a_bytes = [bytes(letters[c] for c in names.get(i, "") if c in letters) for i in range(max(names) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.id_type = "<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4"
        # B has no piece with a space behind another character, and A's way of cutting texts is known
        self.by_words = self.a.fast is not None and not any(b" " in x.lstrip(b" ") for x in self.b_bytes)
        self.sizes = [np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes)]
        # a token's text with what stands before it: a comma, or ; (A) and | (B) at the start of a group
        self.written = [f"{c}{i}" for n, first in ((len(self.a_bytes), ";"), (len(self.b_bytes), "|")) for i in range(n) for c in (",", first)]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both, none if their bytes are not those of space + text."""
        if not text:
            return [], []
        spaced = " " + text
        a = self.a.slow.encode(spaced, add_special_tokens=False).ids if self.a.fast is None or has_long_run(spaced) else \
            self.a.fast.encode_ordinary(spaced)
        b = self.b.encode(text)
        whole = spaced.encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return [], []
        return a, b

    def pieces(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not self.by_words:
            return [text]
        return BETWEEN.split(text) if ragged(text) else text.split(" ")

    def cut(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """``pieces`` of texts: the distinct ones, where each piece stands among them, and the texts they are of, one
        after the other, with the number of their pieces; texts without pieces are left out."""
        listed = texts.to_pylist()
        plain = [k for k, t in enumerate(listed) if t and self.by_words and not ragged(t)]
        alone = set(plain)
        rest = [k for k, t in enumerate(listed) if t and k not in alone]
        others = [self.pieces(listed[k]) for k in rest]
        split = pc.split_pattern(texts.take(pa.array(plain, pa.int64())), " ")
        n = np.append(pc.list_value_length(split).to_numpy(), [len(p) for p in others]).astype(np.int64)
        coded = pa.concat_arrays([split.flatten(), pa.array(chain.from_iterable(others), texts.type)]).dictionary_encode()
        return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64), np.array(plain + rest, np.int64), n

    def encode_words(self, words: list[str]) -> tuple[list, list, np.ndarray, np.ndarray]:
        """Ids of both over all words (from ``pieces``), and how many each word has; words are encoded as one text, which
        is cut where they end, long ones and those around a misfit by themselves."""
        if len(words) == 1 or not self.by_words:
            pairs = [self.encode(w) for w in words]
            return ([i for a, _ in pairs for i in a], [i for _, b in pairs for i in b],
                    np.array([len(a) for a, _ in pairs], np.int64), np.array([len(b) for _, b in pairs], np.int64))
        whole = " ".join(words)
        a, b = self.encode(whole)
        if not a:  # halves, down to the misfit
            x, y = self.encode_words(words[:len(words) // 2]), self.encode_words(words[len(words) // 2:])
            return x[0] + y[0], x[1] + y[1], np.append(x[2], y[2]), np.append(x[3], y[3])
        bounds = np.cumsum(pc.binary_length(pa.array(words, pa.large_string())).to_numpy() + 1)
        n = []
        for side, ids in enumerate((a, b)):
            upto = np.searchsorted(np.cumsum(self.sizes[side][ids]), bounds, "right")
            n.append(np.diff(upto, prepend=0))
        return a, b, *n

    def encoded(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides, and how many each word has; ``RUN_CHARS`` of them at a time, long words and those with white space at an end alone."""
        ids, n = ([], []), ([], [])
        size = np.fromiter(map(len, words), np.int64, len(words))
        alone = (size >= LONG_WORD) | np.fromiter((w != w.strip() for w in words), bool, len(words))
        before = np.append(0, np.cumsum(size))
        part = np.cumsum(alone) + np.append(False, alone[:-1]).cumsum() if len(words) else alone  # changes before and behind a word alone
        run = (before[:-1] - np.maximum.accumulate(np.where(np.diff(part, prepend=-1) != 0, before[:-1], 0))) // RUN_CHARS
        cuts = np.flatnonzero((np.diff(part, prepend=-1) != 0) | (np.diff(run, prepend=-1) != 0)).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(words)]):
            for k, x in enumerate(self.encode_words(words[a:b])):
                (ids if k < 2 else n)[k % 2].append(np.asarray(x, np.int64))
        none = np.zeros(0, np.int64)
        return [np.concatenate([none, *x]) for x in ids], [np.concatenate([none, *x]) for x in n]

    def tokens(self, texts: list[str | None], words: bool = False) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides over all texts (or ``words`` from ``pieces``), one after the other, and how many each has."""
        if words:
            return self.encoded(texts)
        pairs = [self.encode(t) for t in texts]
        n = [np.array([len(p[side]) for p in pairs], np.int64) for side in (0, 1)]
        return [np.fromiter((i for p in pairs for i in p[side]), np.int64, int(n[side].sum())) for side in (0, 1)], n

    def align(self, texts: list[str | None], written: bool, words: bool = False) -> dict:
        return self.link(*self.tokens(texts, words), written)

    def link(self, ids: list[np.ndarray], per_row: list[np.ndarray], written: bool) -> dict:
        """From ``tokens``, all on one byte axis: ``row`` and ``keys`` (A id << 32 | B id) of each link and the counts
        of each text, if ``written`` also its ``groups`` as text."""
        n_rows = len(per_row[0])
        ends = [np.cumsum(self.sizes[side][ids[side]]) for side in (0, 1)]
        a_end, b_end = ends
        a_row = np.repeat(np.arange(n_rows), per_row[0])
        at = np.searchsorted(b_end, a_end)
        both = a_end[b_end[np.minimum(at, len(b_end) - 1)] == a_end] if len(b_end) else a_end
        group = [np.searchsorted(both, e) for e in ends]
        low = np.searchsorted(b_end, a_end - self.sizes[0][ids[0]], "right")
        high = np.searchsorted(b_end - self.sizes[1][ids[1]], a_end)
        n = high - low
        b_at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        keys = np.repeat(ids[0], n).astype(np.uint64) << np.uint64(32) | ids[1][b_at].astype(np.uint64)
        out = {"row": np.repeat(a_row, n), "keys": keys, "n_a": per_row[0], "n_b": per_row[1],
               "n_groups": np.bincount(a_row[np.diff(group[0], prepend=-1) > 0], minlength=n_rows)}
        if written:
            code = np.zeros(len(a_end) + len(b_end), np.int64)
            for side, base in ((0, 0), (1, 2 * len(self.a_bytes))):
                other = np.searchsorted(group[1 - side], group[side], "right" if side else "left")
                code[np.arange(len(other)) + other] = base + 2 * ids[side] + (np.diff(group[side], prepend=-1) > 0)
            cut = np.append(0, np.cumsum(per_row[0] + per_row[1])).tolist()
            tokens = [self.written[c] for c in code.tolist()]
            out["groups"] = ["".join(tokens[a:b])[1:] for a, b in zip(cut, cut[1:])]
        return out


class PerfectHash:
    """A minimal perfect hash in levels: a key that has its place of a level's bitmap to itself sets the bit,
    the others go on to the next level; a key's index is the number of bits set before its own.  Keys outside
    the set get some index, or -1; whoever looks up must verify."""

    def __init__(self, words: np.ndarray, sizes: list[int]):
        self.words, self.sizes = words, sizes
        self.before = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct."""
        words, sizes, rest = [np.zeros(0, np.uint64)], [], keys
        while len(rest):
            size = -(-GAMMA * len(rest) // 64) * 64
            at = cls.place(rest, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64))
            sizes.append(size)
            rest = rest[~alone[at]]
        return cls(np.concatenate(words), sizes)

    def index(self, keys: np.ndarray) -> np.ndarray:
        out, open_, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = base + self.place(keys[open_], level, size)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit & ONE) == ONE
            out[open_[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(word[hit] & ((ONE << bit[hit]) - ONE))
            open_ = open_[~hit]
            base += size
        return out


class Table:
    """One bucket: hash, pairs in its order, their counts, and whether a count is its B id's highest."""

    def __init__(self, row: dict):
        self.hash = PerfectHash(np.frombuffer(row["words"], "<u8"), row["sizes"])
        self.pairs = np.frombuffer(row["pairs"], "<u8")
        self.counts = np.frombuffer(row["counts"], "<i8")
        self.best = np.unpackbits(np.frombuffer(row["best"], np.uint8), count=len(self.pairs)).astype(bool)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, and whether they are the best; -1 for pairs that aren't in the table."""
        at = self.hash.index(keys)
        held = (at >= 0) & (self.pairs[at] == keys)
        return np.where(held, self.counts[at], -1), self.best[at] & held


def unmet():
    raise ValueError("the second pass met a pair that the first did not: texts changed between the passes")


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def by_bucket(keys: np.ndarray, bits: int):
    """``(bucket, positions)`` of the buckets that hold keys."""
    b = bucket_of(keys, bits)
    order = np.argsort(b.astype(np.uint16) if bits <= 16 else b, kind="stable")  # radix where it can
    cut = [*np.flatnonzero(np.diff(b[order], prepend=-1)), len(b)]
    return [(int(b[order[x]]), order[x:y]) for x, y in zip(cut, cut[1:])]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(counts[order], first) if len(k) else counts


def count_pairs(docs: DataFrame, first) -> DataFrame:
    """First pass: rows of distinct ``keys`` with ``counts``, and of texts in terms of their words (``Words.count``).
    ``first`` gives the worker's ``Words``."""

    def run(batches):
        held: list = []
        size = 0
        words = first()
        words.n[:] = 0  # what a task that was stopped left
        for b in batches:
            ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column("id"))
            yield dict.fromkeys(PAIRS, [None]) | {"ids": ids} | {c: [x] for c, x in words.count(b.column("t")).items()}
            if not words.full():
                continue
            held.append(words.flush())
            words.shrink()
            size += len(held[-1][0])
            if size >= 2 * FLUSH_KEYS:
                held = [summed(*map(np.concatenate, zip(*held)))]
                size = len(held[0][0])
                if size >= FLUSH_KEYS:
                    yield row(*held[0])
                    held, size = [], 0
        held.append(words.flush())
        yield row(*summed(*map(np.concatenate, zip(*held))))

    def row(keys, counts):
        return {"n": [len(keys)], "keys": [bytes_of(keys, "<u8")], "counts": [bytes_of(counts, "<i8")]} | dict.fromkeys(("ids", *CODED), [None])

    kind = docs.schema["id"].dataType.simpleString()
    return arrow_map(docs, run, f"n long, keys binary, counts binary, ids array<{kind}>, " + ", ".join(c + " binary" for c in CODED))


class Words:
    """Distinct words that a worker knows: their tokens, their links and how often each occurred in a task.  Once they are
    ``WORDS``, or ``WORD_CHARS`` long, only those seen most often stay."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.known: dict[str, int] = {}
        self.seen, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.unfit = np.zeros(0, bool)
        self.chars = 0
        self.links = Lists(np.uint64)
        self.ids = Lists(aligner.id_type), Lists(aligner.id_type)

    def add(self, new: list[str], words: bool = True):
        """``new`` are distinct and not known."""
        ids, sizes = self.aligner.tokens(new, words)
        x = self.aligner.link(ids, sizes, False)
        self.links.add(x["keys"], np.bincount(x["row"], minlength=len(new)))
        for held, i, n in zip(self.ids, ids, sizes):
            held.add(i, n)
        self.unfit = np.append(self.unfit, sizes[0] == 0)
        self.seen, self.n = (np.append(v, np.zeros(len(new), np.int64)) for v in (self.seen, self.n))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.chars += sum(map(len, new))

    def meet(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words of texts (their places), which texts these are, and the number of their words.  A text with an unfit
        word is one word, as a whole, as the definition has it."""
        names, at, rows, n = self.aligner.cut(texts)
        place = np.fromiter((self.known.get(w, -1) for w in names), np.int64, len(names))
        new = np.flatnonzero(place < 0)
        place[new] = np.arange(len(self.known), len(self.known) + len(new))
        self.add([names[k] for k in new.tolist()])
        at = place[at]
        if (bad := self.unfit[at]).any():
            row = np.repeat(np.arange(len(rows)), n)
            whole = np.zeros(len(rows), bool)
            whole[row[bad]] = True
            listed = texts.take(pa.array(rows[whole])).to_pylist()
            self.add([t for t in dict.fromkeys(listed) if t not in self.known], words=False)
            at = np.append(at[~whole[row]], np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed)))
            rows, n = np.append(rows[~whole], rows[whole]), np.append(n[~whole], np.ones(len(listed), np.int64))
        return at, rows, n

    def full(self) -> bool:
        return len(self.known) >= WORDS or self.chars >= WORD_CHARS

    def shrink(self):
        """Keeps words that came again, the most frequent ones and up to half of the room."""
        words = list(self.known)
        size = np.fromiter(map(len, words), np.int64, len(words))
        best = np.argsort(-self.seen, kind="stable")[:WORDS // 2]
        best = np.sort(best[(self.seen[best] > 1) & (np.cumsum(size[best]) <= WORD_CHARS // 2)])
        self.known = {words[k]: i for i, k in enumerate(best.tolist())}
        self.seen, self.n, self.unfit, self.chars = self.seen[best] // 2, self.n[best], self.unfit[best], int(size[best].sum())
        for held in (self.links, *self.ids):
            held.set(*held.take(best))

    def count(self, texts: pa.Array) -> dict:
        """Counts the words of texts; gives these in terms of their distinct words: how many words a text has, where they
        stand, and the tokens of each."""
        at, rows, n = self.meet(texts)
        self.n += np.bincount(at, minlength=len(self.n))
        some, place = np.unique(at, return_inverse=True)
        order = np.argsort(rows, kind="stable")  # texts in their order
        many = np.zeros(len(texts), np.int64)
        many[rows] = n
        out = {"words": bytes_of(many, "<u4"), "at": bytes_of(place[runs((np.cumsum(n) - n)[order], n[order])], "<u4")}
        for name, held in zip("ab", self.ids):
            ids, sizes = held.take(some)
            out |= {name: bytes_of(ids, self.aligner.id_type), "n_" + name: bytes_of(sizes, "<u4")}
        return out

    def flush(self) -> tuple[np.ndarray, np.ndarray]:
        """Links and how often each occurred since the last time."""
        some = np.flatnonzero(self.n)
        keys, sizes = self.links.take(some)
        out = summed(keys, np.repeat(self.n[some], sizes))
        self.seen += self.n
        self.n[:] = 0
        return out


class Lists:
    """Lists of numbers, one after the other."""

    def __init__(self, kind):
        self.set(np.zeros(0, kind), np.zeros(0, np.int64))

    def set(self, flat: np.ndarray, size: np.ndarray):
        self.flat, self.size, self.more = flat, size, []

    def add(self, flat: np.ndarray, size: np.ndarray):
        self.more.append((flat.astype(self.flat.dtype), size))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists ``at``, one after the other, and their sizes."""
        if self.more:
            self.set(*map(np.concatenate, zip((self.flat, self.size), *self.more)))
        start = np.cumsum(self.size) - self.size
        return self.flat[runs(start[at], self.size[at])], self.size[at]


def bytes_of(x: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def one_row(schema: str, combine):
    """``applyInArrow`` body: the rows of a group, then those of its partner if cogrouped, as dicts -> one row.
    Groups are of bounded size: ``FAN`` rows, or one row of the table."""
    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def one(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        return pa.Table.from_pylist([combine(rows) | {"bucket": rows[0]["bucket"], "salt": rows[0]["salt"]}], schema=arrow)

    return one


def tree(df: DataFrame, n_salts: int, schema: str, combine) -> DataFrame:
    """Combines the rows of each bucket into one, about ``FAN`` at a time."""
    while True:
        df = df.groupBy("bucket", "salt").applyInArrow(one_row(schema, combine), schema)
        if n_salts == 1:
            return df
        n_salts = -(-n_salts // FAN)
        df = df.withColumn("salt", F.pmod("salt", F.lit(n_salts)))


def salt_of(src, n_salts: int):
    return F.pmod(F.xxhash64(src), F.lit(n_salts)).cast("int")


def every_salt(df: DataFrame, n_salts: int) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1))))


def bits_for(counted: DataFrame) -> int:
    """Buckets (as a power of two) for about ``BUCKET_PAIRS`` distinct pairs each, estimated from the pairs
    whose hash starts with ten zero bits; decides no result."""

    def sample(batches):
        for b in batches:
            for x in b.column(0).to_pylist():
                k = np.frombuffer(x, "<u8")
                yield {"k": k[mix(k) >> np.uint64(54) == 0].astype(np.int64)}

    n = arrow_map(counted.select("keys"), sample, "k long").select(F.countDistinct("k")).first()[0]
    return max(0, (n * 1024 // BUCKET_PAIRS).bit_length())


def pair_table(counted: DataFrame, bits: int) -> DataFrame:
    """One row per bucket: ``bucket, n, words, sizes, pairs, counts, best``; pairs and counts stand in the order of the hash."""
    spark = counted.sparkSession
    n_salts = max(1, -(-counted.count() // FAN))

    def deal(batches):
        for b in batches:
            for src, keys, counts in zip(*(b.column(c).to_pylist() for c in ("src", "keys", "counts"))):
                keys, counts = np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<i8")
                own = by_bucket(keys, bits)
                yield {"bucket": [k for k, _ in own], "src": [src] * len(own),
                       "keys": [bytes_of(keys[at], "<u8") for _, at in own], "counts": [bytes_of(counts[at], "<i8") for _, at in own]}

    dealt = arrow_map(counted.select(F.monotonically_increasing_id().alias("src"), "keys", "counts"), deal,
                      "bucket int, src long, keys binary, counts binary")
    dealt = staged(dealt.select("bucket", salt_of("src", n_salts).alias("salt"), "keys", "counts"), spark)

    def union(rows):
        return {"keys": bytes_of(distinct(np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows]))[0], "<u8")}

    def hashed(batches):
        for b in batches:
            for k, x in zip(b.column("bucket").to_pylist(), b.column("keys").to_pylist()):
                keys = np.frombuffer(x, "<u8")
                h = PerfectHash.of(keys)
                pairs = np.empty_like(keys)
                pairs[h.index(keys)] = keys
                yield {"bucket": [k], "n": [len(keys)], "words": [bytes_of(h.words, "<u8")], "sizes": [h.sizes], "pairs": [bytes_of(pairs, "<u8")]}

    made = "bucket int, n long, words binary, sizes array<int>, pairs binary"
    hashes = staged(arrow_map(tree(dealt.drop("counts"), n_salts, "bucket int, salt int, keys binary", union), hashed, made), spark)

    vector = "bucket int, salt int, counts binary"
    arrow = to_arrow_schema(_parse_datatype_string(vector))

    def counts_by_hash(rows: pa.Table, held: pa.Table) -> pa.Table:
        held = held.to_pylist()[0]
        h = PerfectHash(np.frombuffer(held["words"], "<u8"), held["sizes"])
        out = np.zeros(held["n"], np.int64)
        for r in rows.to_pylist():  # a row's keys are distinct
            out[h.index(np.frombuffer(r["keys"], "<u8"))] += np.frombuffer(r["counts"], "<i8")
        return pa.Table.from_pylist([{"bucket": held["bucket"], "salt": held["salt"], "counts": bytes_of(out, "<i8")}] if len(rows) else [], schema=arrow)

    dense = dealt.groupBy("bucket", "salt").cogroup(
        every_salt(hashes.drop("pairs"), n_salts).groupBy("bucket", "salt")).applyInArrow(counts_by_hash, vector)

    def total(rows):
        return {"counts": bytes_of(sum(np.frombuffer(r["counts"], "<i8") for r in rows), "<i8")}

    if n_salts > 1:
        left = -(-n_salts // FAN)
        dense = tree(dense.withColumn("salt", F.pmod("salt", F.lit(left))), left, vector, total)
    held = staged(hashes.join(dense.drop("salt"), "bucket"), spark)

    def highest(batches):
        for b in batches:
            for pairs, counts in zip(b.column("pairs").to_pylist(), b.column("counts").to_pylist()):
                side = np.frombuffer(pairs, "<u8") & np.uint64(0xFFFFFFFF)
                order = np.lexsort((np.frombuffer(counts, "<i8"), side))
                last = np.flatnonzero(np.diff(side[order].astype(np.int64), append=-1))
                yield {"b": side[order][last].astype(np.int64), "top": np.frombuffer(counts, "<i8")[order][last]}

    tops = arrow_map(held.select("pairs", "counts"), highest, "b long, top long").groupBy("b").agg(F.max("top").alias("top")).collect()  # vocabulary
    top = np.zeros(max((r["b"] for r in tops), default=0) + 1, np.int64)
    top[[r["b"] for r in tops]] = [r["top"] for r in tops]
    top = spark.sparkContext.broadcast(top)

    def flag(batches):
        for b in batches:
            best = [np.packbits(np.frombuffer(c, "<i8") == top.value[(np.frombuffer(p, "<u8") & np.uint64(0xFFFFFFFF)).astype(np.int64)]).tobytes()
                    for p, c in zip(b.column("pairs").to_pylist(), b.column("counts").to_pylist())]
            yield {c: b.column(c) for c in b.schema.names} | {"best": best}

    return staged(arrow_map(held, flag, made + ", counts binary, best binary"), spark)


def per_row(row: np.ndarray, n: int, values: np.ndarray) -> np.ndarray:
    """Whole-number sums of ``values`` by ``row`` (ascending)."""
    total = np.append(0, np.cumsum(values))
    return np.diff(total[np.searchsorted(row, np.arange(n + 1))])


def of_texts(x: dict, count: np.ndarray, best: np.ndarray, many: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """``COUNTS`` and groups of texts of ``many`` words each, which stand ``at`` places of the aligned ones in ``x``."""
    n = len(x["n_a"])
    words = np.array([x["n_a"], x["n_b"], x["n_groups"], np.bincount(x["row"], minlength=n), per_row(x["row"], n, best), per_row(x["row"], n, count)], np.int64)
    ends = np.cumsum(many)
    total = np.append(np.zeros((len(words), 1), np.int64), np.cumsum(words[:, at], axis=1), axis=1)
    names = list(map(x["groups"].__getitem__, at.tolist()))
    return total[:, ends] - total[:, ends - many], [";".join(names[a:b]) for a, b in zip((ends - many).tolist(), ends.tolist())]


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
                     broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per input row: the id, ``COUNTS`` and ``groups_sha256``.  ``a_path`` is a byte-level BPE tokenizer
    file (JSON), ``b_path`` a sentencepiece model; both are read on the driver and broadcast."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = spark.sparkContext.broadcast((f.read(), g.read()))
    kind = docs.schema[id_col].dataType.simpleString()
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def aligner() -> Aligner:
        return per_worker(("aligner", a_path, b_path), lambda: Aligner(*files.value))

    first_words = ("words", a_path, b_path)
    first = staged(count_pairs(docs, lambda: per_worker(first_words, lambda: Words(aligner()))), spark)
    counted = first.where("n IS NOT NULL").select(*PAIRS)
    bits = bits_for(counted)
    table = pair_table(counted, bits)
    counts = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"
    schema = f"{id_col} {kind}, {counts}, groups_sha256 string"

    def digest(groups: str) -> str:
        return hashlib.sha256(groups.encode()).hexdigest() if groups else ""

    if (table.agg(F.sum("n")).first()[0] or 0) <= broadcast_pairs:
        shared = spark.sparkContext.broadcast([r.asDict() for r in table.collect()])  # broadcast_pairs at most
        name = f"pairs {uuid.uuid4()}"

        def look_up(batches):
            forget(first_words)
            tables = per_worker(name, lambda: {r["bucket"]: Table(r) for r in shared.value})
            for b in batches:
                for k in range(b.num_rows):
                    coded = {c: np.frombuffer(b.column(c)[k].as_buffer(), aligner().id_type if c in "ab" else "<u4").astype(np.int64) for c in CODED}
                    x = aligner().link([coded["a"], coded["b"]], [coded["n_a"], coded["n_b"]], True)
                    count, best = np.zeros(len(x["keys"]), np.int64), np.zeros(len(x["keys"]), bool)
                    for bucket, at in by_bucket(x["keys"], bits):
                        count[at], best[at] = tables[bucket](x["keys"][at])
                    if (count < 0).any():
                        unmet()
                    values, groups = of_texts(x, count, best, coded["words"], coded["at"])
                    yield {id_col: b.column("ids")[k].values, "groups_sha256": list(map(digest, groups))} | dict(zip(COUNTS, values))

        return arrow_map(first.where("n IS NULL").select("ids", *CODED), look_up, schema)

    def ask(batches):
        """Rows of documents (bucket null) and the questions of each slice to each bucket."""
        from pyspark import TaskContext

        for k, b in enumerate(batches):
            n = b.num_rows
            src = (TaskContext.get().partitionId() << 32) + k
            x = aligner().align(b.column("t").to_pylist(), True)
            none = {c: [None] * n for c in ("bucket", "at", "keys", "n_best", "count_sum")}
            yield none | {"src": [src] * n, "nth": range(n), "id": b.column("id"), "n_links": np.bincount(x["row"], minlength=n),
                          "groups_sha256": list(map(digest, x["groups"]))} | {c: x[c] for c in ("n_a", "n_b", "n_groups")}
            own = by_bucket(x["keys"], bits)
            yield {c: [None] * len(own) for c in ("nth", "id", *COUNTS, "groups_sha256")} | {
                "src": [src] * len(own), "bucket": [i for i, _ in own],
                "at": [bytes_of(x["row"][at], "<i4") for _, at in own], "keys": [bytes_of(x["keys"][at], "<u8") for _, at in own]}

    asked = staged(arrow_map(docs, ask, f"src long, nth int, id {kind}, {counts}, groups_sha256 string, bucket int, at binary, keys binary"), spark)
    questions = asked.where("bucket IS NOT NULL").select("src", "bucket", "at", "keys")
    n_salts = max(1, -(-questions.select("src").distinct().count() // FAN))
    answer_schema = "src long, nth int, n_best long, count_sum long"
    answer = to_arrow_schema(_parse_datatype_string(answer_schema))

    def answers(rows: pa.Table, held: pa.Table) -> pa.Table:
        out = [np.zeros((4, 0), np.int64)]
        lookup = Table(held.to_pylist()[0]) if len(rows) else None
        for r in rows.to_pylist():
            at = np.frombuffer(r["at"], "<i4")
            count, best = lookup(np.frombuffer(r["keys"], "<u8"))
            if (count < 0).any():
                unmet()
            nth = distinct(at)[0]
            n = int(at[-1]) + 1
            out.append(np.array([np.full(len(nth), r["src"]), nth, per_row(at, n, best)[nth], per_row(at, n, count)[nth]]))
        return pa.table(dict(zip(answer.names, np.concatenate(out, axis=1)))).cast(answer)

    found = questions.withColumn("salt", salt_of("src", n_salts)).groupBy("bucket", "salt").cogroup(
        every_salt(table, n_salts).groupBy("bucket", "salt")).applyInArrow(answers, answer_schema)
    sums = found.groupBy("src", "nth").agg(F.sum("n_best").alias("best_"), F.sum("count_sum").alias("sum_"))
    return asked.where("bucket IS NULL").join(sums, ["src", "nth"], "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("best_", F.lit(0)).alias("n_best"),
        F.coalesce("sum_", F.lit(0)).alias("count_sum"), "groups_sha256")
