"""Quote-aware split and the IP range lookup against small Python models."""
import bisect
import random

from pyspark.sql import functions as F

from filament.functions.ip import u32_to_dotted
from filament.operators.iplookup import bucketed_ranges, ip_enrich, lookup
from filament.operators.split import positional_fields, split_literal, split_quoted

WS = " \t"


def split_model(line: str, d: str) -> list[str]:
    """Python model of the one-byte quote-aware split."""
    fields, start, quote = [], 0, None
    for i, c in enumerate(line):
        if quote:
            if c == quote:
                quote = None
        elif c in "\"'":
            quote = c
        elif c == d:
            fields.append(line[start:i])
            start = i + 1
    fields.append(line[start:])
    out = []
    for f in fields:
        f = f.strip(WS)
        if len(f) >= 2 and f[0] == f[-1] and f[0] in "\"'":
            f = f[1:-1]
        out.append(f.strip(WS))
    return out


def test_split_quoted_random(spark):
    rnd = random.Random(7)
    alphabet = ["a", "b", " ", "|", '"', "'", "x", "\t", ","]
    lines = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    lines += ['a|"x|y"|it\'s|b', "|", "'a|b'|c", '"unclosed|rest', "a" * 250000 + "|b"]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    got = df.select("i", split_quoted(F.col("l"), "|").alias("p")).orderBy("i").collect()
    for r, line in zip(got, lines):
        assert list(r.p) == split_model(line, "|"), repr(line[:80])
    # the lambda-free path gives the same first fields
    n = 4
    got2 = positional_fields(df, F.col("l"), [f"f{j}" for j in range(n)], "|").orderBy("i").collect()
    for r, line in zip(got2, lines):
        m = split_model(line, "|")
        assert [r[f"f{j}"] for j in range(n)] == [m[j] if j < len(m) else "" for j in range(n)]


def test_split_literal(spark):
    df = spark.createDataFrame([("x|++|y",), (' "q" |++| z |++|',), ("a，b",)], "l string")
    got = [list(r.p) for r in df.select(split_literal(F.col("l"), "|++|").alias("p")).collect()]
    assert got[:2] == [["x", "y"], ['"q"', "z", ""]]
    assert [list(r.p) for r in df.select(split_literal(F.col("l"), "，").alias("p")).collect()][2] == ["a", "b"]


def predecessor_model(ranges, ip):
    """Last range in (start, file order) with start <= ip, accepted iff ip <= end."""
    srt = sorted(ranges, key=lambda r: (r[0], r[3]))
    starts = [r[0] for r in srt]
    k = bisect.bisect_right(starts, ip) - 1
    if k < 0:
        return None
    s, e, attr, _ = srt[k]
    return attr if ip <= e else None


def test_lookup_random_overlaps(spark):
    rnd = random.Random(11)
    ranges = []
    for o in range(400):
        s = rnd.randint(0, 2 ** 32 - 1) if o % 10 else ranges[-1][0] if ranges else 5   # equal starts
        e = s + rnd.randint(-5, 5_000_000) if o % 17 else s - 1                           # inverted ranges
        ranges.append((s, min(e, 2 ** 32 - 1), f"r{o}", o))
    probes = [rnd.randint(0, 2 ** 32 - 1) for _ in range(8000)] + [r[0] for r in ranges] + [r[1] for r in ranges]
    rdf = spark.createDataFrame(ranges, "start long, end long, a string, _order long")
    table = bucketed_ranges(rdf).cache()
    pdf = spark.createDataFrame([(i, p) for i, p in enumerate(probes)], "i long, ip long")
    j = lookup(pdf, F.col("ip"), table, ["a"], "", table.count())
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    got = {r.i: r._m_a for r in j.select("i", "_m_a").collect()}
    assert len(got) == len(probes)
    for i, p in enumerate(probes):
        assert got[i] == predecessor_model(ranges, p), (i, p)


def test_ip_enrich_overwrite_and_absent(spark):
    ranges = spark.createDataFrame([(10, 20, "A", 1), (100, 200, "B", 2)], "start long, end long, geo string, _order long")
    table = bucketed_ranges(ranges)
    df = spark.createDataFrame([
        ("0.0.0.15", "0.0.0.150", None), ("0.0.0.15", "9.9.9.9", "keep"), ("", "0.0.0.150", None), (" 0.0.0.15 ", None, None),
    ], "a string, b string, lbl_geo string")
    out = ip_enrich(df, ["a", "b"], ["lbl", "lbl"], table, ["geo"], 2).select("a", "b", "lbl_geo").collect()
    assert [r.lbl_geo for r in out] == ["B", "A", "B", "A"]
    # no matching field at all: existing value kept
    out2 = ip_enrich(df.filter(F.col("lbl_geo") == "keep"), ["b"], ["lbl"], table, ["geo"], 2).collect()
    assert out2[0].lbl_geo == "keep"
