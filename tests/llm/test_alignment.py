"""Operator 11 against a brute-force alignment of the tokenizers' own output."""
import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from filament.llm import alignment, queries

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    letters = alignment.byte_letters()

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        e = a_side.encode(" " + text, add_special_tokens=False)
        out = []
        for pairs in ([(i, bytes(letters[c] for c in t)) for i, t in zip(e.ids, e.tokens)],
                      [(i, bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode())
                       for i in b_side.encode(text)]):
            if b"".join(x for _, x in pairs) != whole:
                return [], []
            at, spans = 0, []
            for i, x in pairs:
                spans.append((i, at, at + len(x)))
                at += len(x)
            out.append(spans)
        return out

    done, counts = [], Counter()
    for doc, text in rows:
        a, b = tokens(text)
        ends, starts = [v for *_, v in b], [u for _, u, _ in b]
        links = [(i, j) for i, s, e in a for j, *_ in b[bisect.bisect_right(ends, s):bisect.bisect_left(starts, e)]]
        counts.update(links)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([], []) for _ in cuts]
        for side, spans in enumerate((a, b)):
            for i, _, e in spans:
                groups[bisect.bisect_left(cuts, e)][side].append(str(i))
        written = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        done.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(written.encode()).hexdigest() if a else ""))
    top = Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    return [(d, na, nb, g, len(x), sum(counts[k] == top[k[1]] for k in x), sum(counts[k] for k in x), h) for d, na, nb, g, x, h in done]


def key(r):
    return tuple((x is not None, x) for x in r)


TEXTS = [None, "", "a", "a ▁ b", " <|endoftext|> <s> <0x41> x", "😀é\n\n  z \t", "ﬁ\u200b x", "word " * 50, "x" * 3000, "日本語 und Übergröße", "\x00\x1f", "a", "a"]


@pytest.fixture(scope="module")
def rows(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).collect()
    return [(r["doc_id"], (r["text"] or "")[:600]) for r in docs] + [(-1 - i if i != 3 else None, t) for i, t in enumerate(TEXTS)] + [(-1, "again")]


@pytest.mark.parametrize("bound", [alignment.BROADCAST_PAIRS, 0])  # table broadcast, or met by shuffle
def test_equals_brute_force(spark, rows, bound, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)  # several rounds of sums
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, t string, bucket int").repartition(7)
    got = alignment.align_tokenizers(docs, A, B, broadcast_pairs=bound)
    assert got.columns == ["doc_id", *alignment.COUNTS, "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


def test_many_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(alignment, "bits_for", lambda counted: 4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for bound in (0, 1 << 20):
        assert sorted(map(tuple, alignment.align_tokenizers(docs, A, B, broadcast_pairs=bound).collect()), key=key) == sorted(brute(rows), key=key)


def test_empty_tables(spark):
    for rows in ([], [(1, None), (2, "")]):
        for bound in (0, 10):
            got = alignment.align_tokenizers(spark.createDataFrame(rows, "doc_id long, text string"), A, B, broadcast_pairs=bound).collect()
            assert sorted(map(tuple, got)) == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


def test_registered_query(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_tokenizer_alignment(spark, sf_small).collect()
    assert sorted(map(tuple, got)) == sorted(brute(map(tuple, docs)))


def test_perfect_hash():
    rng = random.Random(4)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.array(rng.sample(range(1 << 47), n), np.uint64)
        h = alignment.PerfectHash.of(keys)
        assert sorted(h.index(keys).tolist()) == list(range(n))
        assert len(h.words) * 64 <= 8 * n + 640
        others = h.index(np.array(rng.sample(range(1 << 47, 1 << 48), 100), np.uint64))
        assert ((others >= -1) & (others < max(n, 1))).all()


def test_unknown_pair_is_told():
    keys = np.arange(100, dtype=np.uint64)
    h = alignment.PerfectHash.of(keys)
    pairs = np.empty_like(keys)
    pairs[h.index(keys)] = keys
    table = alignment.Table({"words": h.words.tobytes(), "sizes": h.sizes, "pairs": pairs.tobytes(), "counts": np.ones(100, "<i8").tobytes(), "best": b"\xff" * 13})
    assert (table(keys)[0] == 1).all() and table(np.array([500, 7], np.uint64))[0].tolist() == [-1, 1]


def test_words_alone_and_together():
    x = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    words = ["a", "ünd", "don't", "x" * 1000, "日本語", "▁", "1.\n2", "▁b", "end\n", "word ", " ", "  x", "😀"] * 3
    one, each = x.align(words, True, True), x.align(words, True)
    assert one.keys() == each.keys() and all(list(one[k]) == list(each[k]) for k in one)
    assert x.pieces("a b  c\nd \ne f") == ["a", "b  c\nd \ne", "f"] and x.pieces(" a") == [" a"] and x.pieces(None) == []


def test_ragged_is_the_pattern():
    rng = random.Random(4)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(9)))
             for letters in (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x00ab", " \n\x85\u3000\xa0é\x1ca") for _ in range(20_000)]
    assert [alignment.ragged(t) for t in texts] == [alignment.RAGGED.search(t) is not None for t in texts]


def test_texts_are_read_once(spark):
    """The second pass works with the words that the first staged: texts are neither read nor encoded again."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = [(i, t) for i, t in enumerate([*TEXTS, "a b a", "b a  b"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).mapInArrow(count, "doc_id long, text string")
    assert sorted(map(tuple, alignment.align_tokenizers(docs, A, B).collect())) == sorted(brute(rows))
    assert read.value == len(rows)


def test_words_that_come_again_stay(monkeypatch):
    """A full worker keeps its frequent words, and what it counts and codes is that of whole texts."""
    monkeypatch.setattr(alignment, "WORDS", 200)
    x = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    words, rng, want, got = alignment.Words(x), random.Random(4), Counter(), Counter()
    often = [f"often{i}" for i in range(20)]
    for _ in range(6):
        texts = [None, "", "▁ x", *(" ".join([*rng.choices(often, k=9), f"once{rng.random()}", *rng.choices(["", " \n", "日本"], k=1)]) for _ in range(60))]
        coded = words.count(pa.array(texts))
        c = {k: np.frombuffer(v, x.id_type if k in "ab" else "<u4").astype(np.int64) for k, v in coded.items()}
        linked, alone = x.link([c["a"], c["b"]], [c["n_a"], c["n_b"]], True), x.align(texts, True)
        none = np.zeros(len(linked["keys"]), np.int64)
        values, groups = alignment.of_texts(linked, none, none, c["words"], c["at"])
        assert groups == alone["groups"]
        assert all((v == w).all() for v, w in zip(values, (alone["n_a"], alone["n_b"], alone["n_groups"], np.bincount(alone["row"], minlength=len(texts)))))
        want.update(alone["keys"].tolist())
        if words.full():
            got.update(dict(zip(*(v.tolist() for v in words.flush()))))
            words.shrink()
            assert set(often) <= set(words.known) and len(words.known) <= 100
    got.update(dict(zip(*(v.tolist() for v in words.flush()))))
    assert got == want
