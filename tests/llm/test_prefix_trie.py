"""Operator 12 against a dictionary of all prefixes."""
import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from filament.llm import common, prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    by, seqs, members, kids, out = defaultdict(list), {}, defaultdict(list), defaultdict(list), {}
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(x, key=lambda r: r[:2])] for c, x in by.items()}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        seqs[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + s[h:]
        for d in range(len(seqs[c]) + 1):
            members[tuple(seqs[c][:d])].append(c)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    for p in sorted(members, key=len, reverse=True):
        m, k = members[p], kids[p]
        leaves = sum(out[q][5] for q in k) if k else 1
        saved = (len(m) - 1) * (len(p[-1][1]) if p else 0) + sum(out[q][6] for q in k)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(seqs[c]) == len(p)))
        out[p] = (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(k), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return sorted(out.values(), key=str)


def nodes(df):
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(*prefix_trie.with_shared_heads(common.staged(prefix_trie.turn_rows(df)))).collect()), key=str)


def cases():
    rng = random.Random(1)
    mixed = [(c, t, rng.choice(["u", None, "a"]), rng.choice(["x", "y", "é", None]))
             for c in [*range(400), *range(1000, 1050), -5, -205] for t in range(rng.choice([1, 2, 3, 4, 8]))]
    mixed += [(5000 + c, t, "u", f"same{t}") for c in range(100) for t in range(9)]  # copies
    mixed += [(c * 100 + 7, t, "u", str(rng.random())) for c in range(100, 140) for t in range(30)]  # no donor, own turns only
    mixed += [(7777, None, None, None), (7778, None, None, None), (7778, 1, None, None), (None, 1, "u", "z")]
    return {
        "mixed": mixed,
        "one chain": [(c, t, "u", "a") for c in range(300) for t in range(c % 7 + 1)],
        "copies of one long conversation": [(c, t, "u", f"t{t}") for c in (3, 103, 203) for t in range(700)] + [(9, 0, "u", "x" * 100_000)],
        "one": [(3, 1, "u", "a")],
        "roles and texts that join alike": [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "", "abc"), (4, 0, "1:a", "bc")],
        "repeated rows": [(11, 4, "u", "a"), (11, 4, "u", "a"), (12, 4, "u", "a")],
        "empty": [],
    }


@pytest.mark.parametrize("case", cases())
def test_equals_brute_force(spark, case):
    rows = cases()[case]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", pos int, hash string")
    assert nodes(df) == brute(rows)


def test_groups_over_many_blocks(spark, monkeypatch):
    """A third of all conversations are equal, a third share all but the last turn: blocks of a few rows."""
    rng = random.Random(2)
    rows = [(c, t, "u", f"a{t}") for c in range(0, 300) for t in range(5)]
    rows += [(c, t, "u", f"a{t}" if t < 8 else str(c)) for c in range(1000, 1300) for t in range(9)]
    rows += [(c, t, "u", rng.choice("ab")) for c in range(2000, 2300) for t in range(8)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_extents():
    rng = random.Random(5)
    for n in (1, 2, 3, 17, 64):
        lcp = np.array([rng.randrange(4) for _ in range(n)])
        x = prefix_trie.Extents(lcp)
        for i in range(n):
            for d in range(5):
                a = b = i
                while a > 0 and lcp[a] >= d:
                    a -= 1
                while b + 1 < n and lcp[b + 1] >= d:
                    b += 1
                assert (x.left([i], np.array([d]))[0], x.right([i], np.array([d]))[0]) == (a, b)
                assert x.least(np.array([a]), np.array([b]))[0] == lcp[a:b + 1].min()


def test_query_equals_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_small}/conversations.parquet')")
    expected = con.sql(queries.ORACLES["op12_conversation_trie"])
    got = queries.op12_conversation_trie(spark, sf_small)
    assert sorted(got.columns) == sorted(expected.columns)
    assert sorted((tuple(r) for r in got.select(*expected.columns).collect()), key=str) == sorted(expected.fetchall(), key=str)
