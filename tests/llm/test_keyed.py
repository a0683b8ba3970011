"""Operators that bring rows together: archives, joins, repeats, vectors, decontamination, packing."""
import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from filament.llm import common, decontaminate, embedding_dedup, ngram_join, packing, queries, repeats, warc

BPE = public_tokenizers.path("byte_bpe_50k.json")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


class Sets:
    """Union-find whose roots are the smallest members."""

    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def unite(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.unite(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = common.components(frame(spark, edges, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(x, sets.find(x)) for x in linked} and len(got) == len(linked)
    assert common.components(frame(spark, [], "u long, v long")).count() == 0


# -- 2: archives

def test_warc_frames():
    records = [warc.record_bytes(i, "http://x/\r\ny", (f"<p>{i} " + "some words again " * 20).encode(), "d", False, None) for i in range(300)]
    data = warc.archive_bytes(records)
    assert data[:4] == b"\x5d\x2a\x4d\x18" and list(warc.read_archive(data)) == records
    assert list(warc.read_archive(warc.archive_bytes([b"one"]))) == [b"one"]


def test_warc_query(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_small}/pages.parquet'")
    want = con.execute(queries.ORACLES["op2_warc_archive"]).fetchall()
    names = [d[0] for d in con.description]
    got = [tuple(r[n] for n in names) for r in queries.op2_warc_archive(spark, sf_small).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_warc_edges(spark):
    long_ = "é" * 60
    rows = [(3, "u", long_), (1, None, long_), (2, "u", None), (4, "u", "short"), (5, "u", "short"), (6, "u", "x\r\n\r\ny" * 30), (1, "again", long_), (7, "u", "\0" * 300_000)]
    df = frame(spark, [(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    got = warc.warc_roundtrip(df).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"] or 0, r["payload_bytes"]) for r in got) == [
        (1, "response", 0, 120), (1, "response", 0, 120), (2, "response", 0, 0), (3, "revisit", 1, 120), (4, "response", 0, 5),
        (5, "response", 0, 5), (6, "response", 0, 180), (7, "response", 0, 300_000)]
    for r in got:
        text = next(h for i, _, h in rows if i == r["page_id"]) or ""
        assert r["payload_digest"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["payload"] == (None if r["record_type"] == "revisit" else text.encode())
    assert warc.warc_roundtrip(df.limit(0)).count() == 0


# -- 10: n-gram Jaccard join

def shingles(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def jaccard_brute(rows, n=3, num=9, den=10):
    sets = [shingles(t, n) for _, t in rows]
    groups = Sets(range(len(rows)))
    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            at[g].append(i)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in at[g] if j < i)
        for j, o in shared.items():
            if den * o >= num * (len(s) + len(sets[j]) - o):
                groups.unite(i, j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[groups.find(i)] = min(d, least.get(groups.find(i), d))
    return collections.Counter((d, len(sets[i]), least.get(groups.find(i), d)) for i, (d, _) in enumerate(rows))


def near_copies(seed, vocabulary=400):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(vocabulary)}"
    rows, texts = [], []
    passage = [word() for _ in range(40)]
    for i in range(240):
        if texts and rng.random() < 0.6:
            t = list(rng.choice(texts))
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                t[rng.randrange(len(t))] = word()
        else:
            t = [word() for _ in range(rng.choice([1, 2, 3, 8, 40, 120]))]
            if rng.random() < 0.4:
                t += passage
        texts.append(t)
        rows.append((i * 7 % 241, " ".join(t)))
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard_brute(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(block) + [(500, None), (501, ""), (502, " \t"), (503, "A b"), (504, "a B"), (505, "a b c"), (None, "null id words here"),
                                 (506, "null id words here"), (None, None), (507, "x" * 100_000), (508, "x" * 100_000), (3, "w1 w2 w3 w4")]
    got = ngram_join.jaccard_components(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, sig int")).collect()
    assert collections.Counter(map(tuple, got)) == jaccard_brute(rows)


def test_jaccard_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, queries.op10_ngram_jaccard_join(spark, sf_small).collect())) == jaccard_brute(rows)


def test_trie_blocks():
    """A trie block links exactly what brute force links, whatever is known before."""
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 60, 60).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, rng.integers(1, 50))) for _ in range(60)]
    sets += [np.unique(np.concatenate([s[:-1], rng.choice(pool, 1)])) for s in sets[:40]]
    sets = [np.frombuffer(b, np.uint64) for b in {s.tobytes() for s in sets}]
    for num, den in ((9, 10), (1, 2), (4, 5)):
        want = Sets(range(len(sets)))
        for i, j in itertools.combinations(range(len(sets)), 2):
            o = len(np.intersect1d(sets[i], sets[j]))
            if den * o >= num * (len(sets[i]) + len(sets[j]) - o):
                want.unite(i, j)
        got = Sets(range(len(sets)))
        for a, b in ngram_join.join_block(list(range(len(sets))), sets, [None] * len(sets), num, den):
            got.unite(a, b)
        assert [want.find(i) for i in range(len(sets))] == [got.find(i) for i in range(len(sets))]


@pytest.mark.parametrize("num, den", [(9, 10), (4, 5)])
def test_parities_and_parts_lose_no_partner(num, den):
    """Linked sets pass by their parities and share a part; unrelated ones with common shingles are not sent to tries."""
    rng = np.random.default_rng(11)
    fresh = lambda n: np.unique(rng.integers(0, 1 << 58, n).astype(np.uint64))
    linked = 0
    for n in (1, 2, 5, 9, 20, 60, 150, 700) * 12:
        x = fresh(n)
        gone, new = rng.integers(0, max(1, n // 5) + 1, 2)
        y = np.unique(np.concatenate([rng.permutation(x)[gone:], fresh(int(new))]))
        o = len(np.intersect1d(x, y))
        if len(y) and den * o >= num * (len(x) + len(y) - o):
            linked += 1
            assert ngram_join.reaching([len(x), len(y)], [ngram_join.parity(x), ngram_join.parity(y)], [None, None], num, den).all()
            assert not ngram_join.reaching([len(x), len(y)], [ngram_join.parity(x), ngram_join.parity(y)], [b"a", b"a"], num, den).any()
            assert len(np.intersect1d(ngram_join.part_keys(x, num, den), ngram_join.part_keys(y, num, den)))
    assert linked > 20
    common = fresh(60)
    sets = [np.union1d(common, fresh(140)) for _ in range(40)]
    assert not ngram_join.reaching(list(map(len, sets)), list(map(ngram_join.parity, sets)), [None] * 40, num, den).any()


def test_sets_that_cannot_link_stay_away(spark):
    """Of a block only the sets that may link with another component's go to its trie; long ones in pieces."""
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 58, 300).astype(np.uint64)) for _ in range(6)]
    sets.append(np.append(sets[0][:-2], sets[0][-1:]))
    rows = [(bytes([i]), [5], None, len(s), ngram_join.parity(s)) for i, s in enumerate(sets)]
    df = frame(spark, rows, "sig binary, blocks array<bigint>, known binary, n long, parity binary")
    out = ngram_join.may_link(df.select("sig", "blocks", "known"), df.select("sig", "n", "parity"), 9, 10).collect()
    assert sorted(bytes(r["sig"]) for r in out) == [b"\x00", b"\x06"]
    assert len({b for r in out for b in r["blocks"]}) == 1


def test_keep_one(spark):
    base = " ".join(f"t{i}" for i in range(60))
    rows = [(5, base), (2, base + " more"), (9, "other words altogether here now"), (9, "other words altogether here now"), (None, base), (7, None), (8, "")]
    got = ngram_join.keep_one_of_each(frame(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["2", "7", "8", "9", "None"]
    assert ngram_join.keep_one_of_each(frame(spark, [])).count() == 0


# -- 9: repeats

def repeats_brute(rows, length=100):
    docs = sorted((d if d is not None else -1 << 63, (t or "").encode()) for d, t in rows)
    first, out = {}, collections.Counter()
    for d, b in docs:
        for a in range(len(b) - length + 1):
            first[b[a:a + length]] = min(first.get(b[a:a + length], (d, a)), (d, a))
    for d, b in docs:
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if first[b[a:a + length]] < (d, a):
                gone[a:a + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[(None if d == -1 << 63 else d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeats_brute(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rng = random.Random(hot)
    text = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passages = [text(n) for n in (99, 100, 101, 130, 400)]
    rows = []
    for i in range(80):
        parts = [rng.choice([text(rng.randrange(60)), rng.choice(passages), "ab" * rng.randrange(90)]) for _ in range(rng.randrange(6))]
        rows.append((i, "".join(parts)))
    rows += [(100 + i, rows[7][1] + "x" * i) for i in range(12)]
    rows += [(200, None), (201, ""), (202, "z" * 5000), (None, passages[4]), (203, "q" * 100), (204, "q" * 100), (204, "q" * 100), (205, "\0" * 150)]
    got = repeats.remove_repeats(frame(spark, [(*r, 1) for r in rows], "doc_id long, text string, id int")).drop("spans").collect()
    assert collections.Counter(map(tuple, got)) == repeats_brute(rows)


def test_repeats_long_text(spark, monkeypatch):
    """Texts longer than a block are cut into pieces without losing a window."""
    monkeypatch.setattr(repeats, "BLOCK_BITS", 9)
    rng = random.Random(1)
    body = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(1, body), (2, "x" + body[700:2600] + "y"), (3, body[100:] + body[:400])]
    got = repeats.remove_repeats(frame(spark, rows)).drop("spans").collect()
    assert collections.Counter(map(tuple, got)) == repeats_brute(rows)


def test_repeats_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    assert collections.Counter(map(tuple, queries.op9_suffix_dedup(spark, sf_small).collect())) == repeats_brute(rows)
    assert repeats.remove_repeats(frame(spark, [])).count() == 0


# -- 6: vectors

def vectors_brute(rows, threshold=0.95):
    good = [i for i, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 24]
    x = np.array([rows[i][1] for i in good], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    m = x @ x.T >= threshold
    sets, count = Sets(range(len(rows))), collections.Counter()
    for a, b in zip(*np.nonzero(m)):
        if a != b:
            count[good[a]] += 1
            sets.unite(good[a], good[b])
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[sets.find(i)] = min(d, least.get(sets.find(i), d))
    return collections.Counter((d, count[i], least.get(sets.find(i), d)) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("per_list,block", [(200, 1024), (20, 16)])
def test_vectors_brute(spark, monkeypatch, per_list, block):
    monkeypatch.setattr(embedding_dedup, "PER_LIST", per_list)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(12, 24))
    rows = []
    for i in range(500):
        v = centres[i % 12] + rng.normal(size=24) * rng.choice([0.05, 0.25, 0.6])
        rows.append((i * 3 % 503, [float(f) for f in (v * rng.choice([0.01, 5])).astype(np.float32)]))
    rows += [(1000 + i, rows[4][1]) for i in range(40)]
    rows += [(2000, None), (2001, [0.0] * 24), (2002, [None] + [1.0] * 23), (2003, [float("nan")] * 24), (2004, [1.0, 2.0]), (2005, []),
             (None, rows[4][1]), (2006, [float("inf")] * 24), (2004, [1.0, 2.0]), (2007, [1e30] * 24), (2008, [1e-30] * 24)]
    got = embedding_dedup.near_duplicates(frame(spark, [(*r, 0) for r in rows], "vec_id long, embedding array<float>, label int")).collect()
    want = vectors_brute(rows)
    assert sum(r["n_links"] for r in got) >= 0.999 * sum(n * k for (_, n, _), k in want.items())
    assert sum((collections.Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) & want).values()) >= 0.99 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_vectors_exact_with_all_probes(spark, monkeypatch, seed):
    """With probes out to r nothing is missed."""
    monkeypatch.setattr(embedding_dedup, "SIGMAS", 1e9)
    monkeypatch.setattr(embedding_dedup, "PER_LIST", 15)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 24))
    rows = [(i, [float(f) for f in centres[i % 20] + rng.normal(size=24) * 0.22]) for i in range(300)]
    got = embedding_dedup.near_duplicates(frame(spark, rows, "vec_id long, embedding array<double>")).collect()
    assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vectors_brute(rows)


@pytest.mark.parametrize("per_list,block", [(20, 16), (10, 64)])
def test_vectors_equal_brute_force(spark, monkeypatch, per_list, block):
    """No link is missed, also where near copies differ in two directions only; each length links among its own."""
    monkeypatch.setattr(embedding_dedup, "PER_LIST", per_list)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(5)
    middle, turn = rng.normal(size=24), rng.normal(size=(2, 24)) * 0.6
    x = [rng.normal(size=24) for _ in range(100)] + [middle + rng.normal(size=2) @ turn for _ in range(300)]
    short = [rng.normal(size=3) for _ in range(60)]
    rows, few = ([(i + at, [float(f) for f in v]) for i, v in enumerate(vs)] for at, vs in ((0, x), (1000, short)))
    got = embedding_dedup.near_duplicates(frame(spark, rows + few, "vec_id long, embedding array<double>")).collect()
    wide = [(d, v + [0.0] * 21) for d, v in few]
    assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vectors_brute(rows) + vectors_brute(wide)
    assert any(r["n_links"] for r in got if r["vec_id"] >= 1000)


def test_vectors_dealt_in_proportion(spark, monkeypatch):
    """Where all lists are near each other, four times the vectors are dealt to as many blocks each as before, and every link is found."""
    monkeypatch.setattr(embedding_dedup, "PER_LIST", 10)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    counts, real = [], embedding_dedup.arrow_map

    def counted(df, fn, schema):
        out = real(df, fn, schema)
        if schema.startswith("bin "):
            counts.append(out.count())
        return out

    monkeypatch.setattr(embedding_dedup, "arrow_map", counted)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2400, 24))
    x[1::5] = x[::5] + rng.normal(size=(480, 24)) * 0.25
    for n in (600, 2400):
        rows = [(i, [float(f) for f in v]) for i, v in enumerate(x[:n])]
        got = embedding_dedup.near_duplicates(frame(spark, rows, "vec_id long, embedding array<double>")).collect()
        assert collections.Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == vectors_brute(rows)
    assert counts[1] <= 6 * counts[0]


def test_vectors_blocks_meet_once():
    pairs = [(a, b) for a in range(20) for b in range(20) if a != b and embedding_dedup.travels(a, b)]
    assert sorted(map(sorted, pairs)) == [[a, b] for a in range(20) for b in range(a + 1, 20)]
    assert {sum(a == k for a, _ in pairs) for k in range(20)} <= {9, 10}


@pytest.mark.parametrize("spread", [0.02, 0.6])
def test_vectors_slices_miss_nothing(spread):
    """Products in single precision let no partner go, at the threshold itself either."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12, 40))[rng.integers(12, size=900)] + rng.normal(size=(900, 40)) * spread
    x /= np.linalg.norm(x, axis=1)[:, None]
    quant = embedding_dedup.Quantiser.fit(x, 30)
    own, codes, err = quant.encode(x)
    away = np.linalg.norm(x - quant.coarse[own], axis=1)
    radius = np.array([away[own == k].max(initial=-np.inf) for k in range(len(quant.coarse))])
    cosine = np.sort(np.triu(x @ x.T, 1).ravel())
    for threshold in (0.95, float(cosine[-200])):
        r = float(np.sqrt(2 - 2 * threshold))
        base = embedding_dedup.Base(x[400:], own[400:], codes[400:], err[400:], quant, r)
        rows, cols, links = embedding_dedup.link_block(base, x[:400], own[:400], quant, radius, r, threshold)
        got = np.zeros((400, 500), bool)
        got[np.ix_(rows, cols)] = links
        sure = np.abs(x[:400] @ x[400:].T - threshold) > 1e-13
        assert ((x[:400] @ x[400:].T >= threshold) == got)[sure].all() and got.any() == (x[:400] @ x[400:].T >= threshold + 1e-13).any()


def test_vectors_empty(spark):
    none = frame(spark, [], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(none).count() == 0
    got = embedding_dedup.near_duplicates(frame(spark, [(1, None), (2, [0.0])], "vec_id long, embedding array<float>")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, True), (2, 0, 2, True)]


# -- 8: decontamination

def align_brute(doc, item, miss=decontaminate.MISS):
    h = np.zeros((len(item) + 1, len(doc) + 1))
    for i in range(1, len(item) + 1):
        for j in range(1, len(doc) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (1 if item[i - 1] == doc[j - 1] else -miss), h[i - 1, j] - miss, h[i, j - 1] - miss)
    return h.max()


def test_alignment():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item = rng.integers(0, 8, rng.integers(1, 14))
        doc = rng.integers(0, 8, rng.integers(1, 25))
        score, a, e = decontaminate.align(doc, item)
        assert score == align_brute(doc, item)
        assert score == 0 or align_brute(doc[a:e], item) == score


def test_decontamination(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [(k, " ".join(word() for _ in range(rng.choice([9, 20, 50])))) for k in range(12)]
    docs, want = [], set()
    for i in range(150):
        body = [word() for _ in range(rng.choice([0, 30, 200]))]
        if i % 3 == 0:
            k = i // 3 % 12
            part = items[k][1].split()
            if i % 2:  # edited: one word in ten replaced, one inserted
                for at in range(4, len(part), 10):
                    part[at] = word()
                part.insert(len(part) // 2, word())
            body[len(body) // 2:len(body) // 2] = part if i % 9 else [w.upper() + "," for w in part]
            want.add((i, k))
        elif i % 3 == 1:  # a third of an item is no copy
            part = items[i % 12][1].split()
            body += part[:len(part) // 3]
        docs.append((i, " ".join(body)))
    docs += [(900, None), (901, ""), (902, "yes"), (903, "yes yes"), (None, items[3][1])]
    bench = frame(spark, [(*r, 0) for r in items + [(50, "Yes"), (51, None), (52, ""), (53, "...")]], "item_id long, text string, doc_id int")
    df = frame(spark, docs)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == want | {(902, 50), (None, 3)}
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0 and decontaminate.contaminated(df.limit(0), bench).count() == 0


def test_decontamination_blocks(spark, monkeypatch, sf_small):
    one = {tuple(r) for r in queries.op8_benchmark_decontamination(spark, sf_small).collect()}
    docs = dict(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    items = dict(spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect())
    whole = {(d, k) for d, t in docs.items() for k, s in items.items()
             if " ".join(decontaminate.words_of(s)) in " ".join(decontaminate.words_of(t)) and len(decontaminate.words_of(s)) >= 8}
    assert whole and whole <= {r[:2] for r in one}
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 3000)
    assert {tuple(r)[:2] for r in queries.op8_benchmark_decontamination(spark, sf_small).collect()} == {r[:2] for r in one}


# -- 4: packing

def check_packing(texts, got, window=1024):
    tok = Tokenizer.from_file(BPE)
    ids = {d: tok.encode(t or "", add_special_tokens=False).ids + [0] for d, t in texts.items()}
    at = collections.Counter()
    for r in sorted(got, key=lambda r: (r["doc_id"], r["start"])):
        x = ids[r["doc_id"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(x) and r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(x[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
        at[r["doc_id"]] += r["length"]
    assert {d: len(x) for d, x in ids.items()} == dict(at)
    size = collections.Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == size[r["sequence_id"]]
        size[r["sequence_id"]] += r["length"]
    assert all(n <= window for n in size.values())
    return sum(0 if n & (n - 1) == 0 else window - n for n in size.values())


def test_packing_query(spark, sf_small):
    texts = dict(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect())
    assert check_packing(texts, queries.op4_retrieval_packing(spark, sf_small).collect()) == 0


def test_packing_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_BYTES", 3000)
    texts = {1: None, 2: "", 3: "a" * 9000, 4: "x<|endoftext|>y", 5: "tabs\t\t  and \n\n lines  ", 6: "日本語 🙂 é", 7: "word " * 3000, 8: " " * 2500 + "z"}
    texts |= {i: f"topic{i % 5} " * (i % 60) for i in range(20, 90)}
    rows = [(i, t, 1) for i, t in texts.items()]
    got = packing.pack_documents(frame(spark, rows, "doc_id long, text string, shard int"), BPE, with_ids=True).collect()
    assert check_packing(texts, got) == 0
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    twice = packing.pack_documents(frame(spark, [(1, "same text here"), (1, "same text here"), (None, "x")]), BPE).collect()
    assert sorted(str(r["doc_id"]) for r in twice if r["start"] == 0) == ["1", "1", "None"]
    assert packing.pack_documents(frame(spark, []), BPE).count() == 0


class Counting:
    """A tokeniser that adds up the characters it is given."""

    def __init__(self, real):
        self.real, self.seen = real, 0

    def encode_ordinary(self, text):
        self.seen += len(text)
        return self.real.encode_ordinary(text)


@pytest.mark.parametrize("keep", [0, 40, 300_000])
def test_packing_ids_of_batches(monkeypatch, keep):
    """Ids of texts taken together are those of each text alone, and words that come again aren't encoded again."""
    monkeypatch.setattr(packing, "KNOWN", keep)
    with open(BPE, encoding="utf-8") as f:
        tokens = packing.Tokens(f.read())
    rng = random.Random(4)
    bits = ["a", "b", "it's", " ", " ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "\u180e", "\u3000", "é", "ß", "日本",
            "😀", "Ⅷ", "²", "1", "!", "?", "\ufeff", "<|endoftext|>"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(4000)]
    texts += [None, "", " ", "  ", "\n", " a", "a ", "a" * 5000, "b " * 3000, "\n \n", "x\ny z\n\nw", "def f():\n    return 1\n"]
    want = [tokens.slow.encode(t or "", add_special_tokens=False).ids for t in texts]
    for size in (len(texts), 700):
        got = [x.tolist() for a in range(0, len(texts), size) for x in tokens.batch(pa.array(texts[a:a + size], pa.string()))]
        assert got == want
    assert len(tokens.known) <= keep
    assert tokens.batch(pa.array([], pa.string())) == [] and [len(x) for x in tokens.batch(pa.array([None, ""], pa.string()))] == [0, 0]

    words = ["w" + "".join(rng.choices("abcdefgh", k=8)) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=100)) for _ in range(100)]
    tokens.fast = Counting(tokens.fast)
    assert [x.tolist() for x in tokens.batch(pa.array(texts))] == [tokens.fast.real.encode_ordinary(t) for t in texts]
    assert tokens.fast.seen < sum(map(len, texts)) / 10


def test_packing_places():
    """Places by content of documents taken together are those of each alone."""
    rng = np.random.default_rng(6)
    docs = [np.append(rng.integers(0, 70000 if i % 9 == 0 else 90, size=rng.integers(0, 60)), 0).astype("<u4" if i % 9 == 0 else "<u2") for i in range(300)]
    corpus = packing.Corpus.of(docs)
    salts = [repr(i).encode() for i in range(300)]
    for least in (2, 20, 1000):
        together = packing.sketches(docs, corpus, least, salts)
        assert together == [packing.sketches([d], corpus, least, [s])[0] for d, s in zip(docs, salts)] and len(set(together)) > 250
    term, tf, ends = packing.counted(docs)
    for d, t, n in zip(docs, np.split(term, ends[:-1]), np.split(tf, ends[:-1])):
        u, c = np.unique(d, return_counts=True)
        assert (u == t).all() and (c == n).all()


def test_packing_scores_ahead():
    """Scores of seeds that are made together are those of each alone, and are made once for many seeds."""
    rng = np.random.default_rng(2)
    docs = [np.append(rng.integers(1, 400, rng.integers(20, 300)), 0).astype("<u2") for _ in range(90)]
    alone, index, made = packing.Index(docs), packing.Index(docs), []
    products = index.common_scores
    index.common_scores = lambda classes: made.append(len(classes)) or products(classes)
    for k in range(90):
        assert np.allclose(index.scores(k, lambda: range(k, min(k + 30, 90))), alone.scores(k), rtol=1e-5)
    assert made == [30, 30, 30]


def test_packing_neighbours():
    """A seed's window is filled with the lexically nearest entries."""
    a, b = np.arange(10, 40), np.arange(50, 80)
    tails = [np.resize(a, 600), np.resize(b, 500), np.resize(a, 400), np.resize(b, 450), *(np.arange(100 + 9 * i, 109 + 9 * i) for i in range(9))]
    seqs = list(packing.pack([len(t) for t in tails], tails))
    assert [d for d, _, _ in seqs[0]][:2] == [0, 2]  # the rest of the window holds a cut piece
    assert [d for d, _, _ in seqs[1]][:2] in ([1, 3], [3, 1])


def test_packing_common_terms():
    """A group that holds a third of the entries finds its own members, though its terms are common."""
    rng = np.random.default_rng(3)
    group = np.arange(10, 210)
    tails = [np.append(rng.permutation(group), [5000 + i, 0]) if i % 3 == 0 else np.append(rng.integers(300, 4000, 201), 0) for i in range(300)]
    at = {d for d in range(300) if d % 3 == 0}
    seqs = list(packing.pack([len(t) for t in tails], tails))
    mixed = [s for s in seqs if {d for d, _, _ in s} & at and {d for d, _, _ in s} - at]
    assert len(mixed) <= 3
    score = packing.Index(tails).scores(0)
    assert score[list(at)].min() > score[[d for d in range(300) if d not in at]].max()


def test_packing_shards_by_content(spark, monkeypatch):
    """Documents of one topic, and a group larger than a shard, share windows however many shards there are."""
    monkeypatch.setattr(packing, "SHARD_BYTES", 40000)
    rng = random.Random(8)
    words = sorted(w[1:] for w in Tokenizer.from_file(BPE).get_vocab() if len(w) > 5 and w[0] == "Ġ" and w[1:].isascii() and w[1:].islower())
    rng.shuffle(words)
    common, topics = words[:300], [words[k:k + 10] for k in range(300, 600, 10)]
    topic = {i: i // 2 % 30 if i % 2 else 0 for i in range(300)}
    texts = {i: " ".join(rng.choice(topics[t] if rng.random() < 0.5 else common) for _ in range(200)) for i, t in topic.items()}
    got = packing.pack_documents(frame(spark, list(texts.items())), BPE).collect()
    assert check_packing(texts, got) == 0
    windows = collections.defaultdict(list)
    for r in got:
        windows[r["sequence_id"]].append(topic[r["doc_id"]])
    assert len({s >> 32 for s in windows}) > 5
    same = [a == b for w in windows.values() for a, b in itertools.combinations(w, 2) if a or b]  # the large group by itself is no feat
    assert sum(same) > 0.3 * len(same)  # dealt by a hash of the row: about 0.1


def test_packing_whole_text_and_corpus():
    """A long document is found by its whole text; weights follow all documents."""
    rng = np.random.default_rng(1)
    a, b = np.arange(10, 60), np.arange(100, 150)
    texts = [np.append(np.resize(head, 1024), rng.integers(1000, 9000, 400)) for head in (a, b, a, b)]
    seqs = list(packing.pack([len(t) for t in texts], [t[1024:] for t in texts], texts=texts))
    assert {d for d, _, _ in seqs[4][:2]} in ({0, 2}, {1, 3})
    df = np.ones(200, int)
    df[10:60] = 500  # common elsewhere
    index = packing.Index([np.array([10, 150]), np.array([10, 11]), np.array([12, 150])], packing.Corpus(df, 1000, 2.0))
    assert index.scores(0)[2] > index.scores(0)[1] > 0


def test_packing_used_entries():
    """Entries that are used up are left out of the scoring; the others' scores stay."""
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(1, 400, rng.integers(20, 300)), 0).astype("<u2") for _ in range(60)]
    docs += docs[:5]
    whole, index = packing.Index(docs), packing.Index(docs)
    for left in (np.arange(65) % 2 == 0, np.arange(65) % 8 == 0, np.arange(65) == 64):
        for k in np.flatnonzero(left).tolist():
            index.held.clear()
            score = index.scores(k, unused=lambda left=left: left)
            assert np.allclose(score[left], whole.scores(k)[left], rtol=1e-5)
    assert len(index.scored) == index.matrix.shape[1] == 1


# -- memory of the workers

def test_batches_of_staged_tables_are_small(spark):
    """Spark hands a bounded number of rows to Python at a time where tables are staged, whatever the session says."""
    before = spark.conf.get(common.BATCH_SETTING)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows], pa.int64())], names=["id"])

    counted = common.staged(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "id long")).agg({"id": "max"}).first()[0]
    assert counted <= common.BATCH_ROWS and spark.conf.get(common.BATCH_SETTING) == before


def test_worker_forgets():
    made = []
    for _ in range(2):
        assert common.per_worker("test", lambda: made.append(1) or "x") == "x"
    common.forget("test")
    common.forget("test")
    assert common.per_worker("test", lambda: made.append(1) or "y") == "y" and len(made) == 2
    common.forget("test")


# -- the pipeline

def test_pipeline(spark, sf_small):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "packing"]
    docs = common.table(spark, sf_small, "documents")
    columns = docs.columns
    held = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.staged(stage(spark, docs, sf_small))
        assert docs.columns == columns
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "ngram_jaccard_join":
            groups = jaccard_brute(sorted(held.items()), 5, 4, 5)
            assert set(now) == {d for d, _, c in groups if d == c}
        if name == "secret_scan":
            assert set(now) == set(held)
        elif name != "secret_scan":
            assert set(now) <= set(held)
        held = now
    assert check_packing(held, corpus_pipeline.STAGES[-1][1](spark, docs, sf_small).collect()) == 0
