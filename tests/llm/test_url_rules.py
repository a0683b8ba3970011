"""Operator 13 against every rule tried on every url."""
import random
import re

import duckdb
import pytest

from filament.llm import queries, url_rules


def parts(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    tail = rest[len(host):]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return host, re.match(r"[^?#]*", tail)[0], tail


def fits(pattern, text):
    """Steps through the pattern and the text, from each place that may be its start."""
    starts = range(len(text) + 1)
    if pattern.startswith("||"):
        end = min((k for k in range(2, len(text)) if text[k] in "/?#"), default=len(text))
        starts, pattern = [2, *(k + 1 for k in range(2, end) if text[k] == ".")], pattern[2:]
    elif pattern.startswith("|"):
        starts, pattern = [0], pattern[1:]
    closed = pattern.endswith("|")
    pattern = pattern[:-1] if closed else pattern
    word = re.compile("[A-Za-z0-9]").match

    def go(p, t):
        if p == len(pattern):
            return not closed or t == len(text)
        c = pattern[p]
        if c == "*":
            return any(go(p + 1, k) for k in range(t, len(text) + 1))
        if c == "^":
            return (t in (0, len(text)) and go(p + 1, t)) or (t < len(text) and not word(text[t]) and go(p + 1, t + 1))
        return t < len(text) and text[t] == c and go(p + 1, t + 1)

    return any(go(0, t) for t in starts)


def judge(url, host_rules, patterns):
    host, path, tail = parts(url)
    found = [(len(h) + len(p), i, h + p, v) for i, (v, h, p) in enumerate(host_rules)
             if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    if found:
        return host, path, max(found)[2], max(found)[3]
    text = "//" + host + tail
    if any(fits(p[2:], text) for p in patterns if p.startswith("@@")):
        return host, path, None, "allow"
    return host, path, None, "block" if any(fits(p, text) for p in patterns if not p.startswith("@@")) else "allow"


URLS = [None, "", "no scheme.com/en/", "http://", "https://example.com/en/x", "http://WWW.Example.COM/en/?q", "http://www.example.com/EN/", "x://a.www.example.com/en/a#b",
        "http://notexample.com/en/", "http://com", "http://com/", "http://com?/", "http://a.net/es/", "http://a.net/es", "http://a.net?x=/es/", "ftp://net/fr/#", "://net/es/",
        "http://x.org/a://net/es/", "http://xn--é.org/CASINO", "http://a.org/casino", "http://a.org/casinos", "http://casino", "http://a.org/?casino=1", "http://a.org/ads.txt",
        "http://ads.org/ads.txt", "http://ads.org/x", "http://my.doubleclick.net", "http://mydoubleclick.net", "http://a.doubleclick.net:80/x", "http://track.a.org/pixel", "http://a.org/track./pixel",
        "http://a.org/x?affid=3&b", "http://a.org/wp-login.php", "http://a.org/wp-login.php?x", "http://adult-education.org/adult", "http://a.org/adult-education.", "http://a.org/x\ny/casino\n",
        "http://" + "sub." * 3000 + "example.com/en/", "http://a.org/" + "casino" * 20000, "http://é.example.com/en/"]
EXTRA = ["a*b|", "|//sub", "*", "(x)[y]+{z}\\d", "x.y", "^|", "", "@@safe", "é^", "b**c"]


def run(spark, urls, host_rules, patterns):
    df = spark.createDataFrame([(i % 7 or None, u, "h", "r", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, row int")
    out = url_rules.judge_urls(df, url_rules.rule_table(spark, host_rules, patterns))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def expected(urls, host_rules, patterns):
    return sorted(((i % 7 or None, *judge(u, host_rules, patterns)) for i, u in enumerate(urls)), key=str)


def test_registered_rules(spark):
    args = URLS + URLS[:9], url_rules.HOST_RULES, url_rules.PATTERNS
    assert run(spark, *args) == expected(*args)


@pytest.mark.parametrize("small", [True, False])  # rules broadcast, or joined by shuffle
def test_other_rules(spark, small, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_RULE_BYTES", (1 << 20) if small else 0)
    rng = random.Random(3)
    urls = [u for u in URLS if not u or len(u) < 200] + ["http://" + "".join(rng.choice("ab.xy/?-é") for _ in range(rng.randrange(14))) for _ in range(150)]
    hosts = [("block", "X.y", "/"), ("allow", "y", "/a"), ("block", "a", "/"), ("allow", "b.a", "/"), ("allow", "example.com", "/en/"), ("block", "example.com", "/en/")]
    for patterns in (["^a^", "x.y/", "a*b|", "@@^b-", "é^"], ["^ab", "b**x", "(x)[y]+", "x\\y", "|//y", "||y.", "^|"]):
        assert run(spark, urls, hosts, patterns) == expected(urls, hosts, patterns)


def test_rules_without_token_and_no_rules(spark):
    assert run(spark, URLS[:20], [], ["*"]) == expected(URLS[:20], [], ["*"])
    assert run(spark, URLS[:20], [], EXTRA) == expected(URLS[:20], [], EXTRA)
    assert run(spark, URLS[:20], [], []) == expected(URLS[:20], [], [])
    assert run(spark, [], url_rules.HOST_RULES, EXTRA) == []


def test_filed_under_the_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://a.com/p{i}",) for i in range(9)] + [("http://b.com/x",), ("http://b.org/x",)], "url string")
    rules = url_rules.compiled(url_rules.rule_table(spark, [("block", "b.com", "/x/"), ("block", "com", "/")], ["^a^com^", "*a*", "^new^com^"]))
    full = urls.selectExpr("concat('//', substr(url, 8)) AS full")
    got = {r["rule_id"]: r["token"] for r in url_rules.rarest_token(rules, full, True).collect()}
    assert got == {0: "b", 1: "com", 2: "a", 3: "", 4: "new"}
    text = url_rules.judge_urls(urls.selectExpr("1L AS page_id", "url"), url_rules.rule_table(spark, url_rules.HOST_RULES, url_rules.PATTERNS))._jdf.queryExecution().toString()
    assert "Python" not in text and "InArrow" not in text and "InPandas" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_query_equals_sql(spark, sf_small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_small}/pages.parquet')")
    want = con.sql(queries.ORACLES["op13_url_filter"])
    got = queries.op13_url_filter(spark, sf_small)
    assert sorted(map(str, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
