r"""Operator 13, URL filters: pattern rules indexed by their rarest literal token.  DataFrame functions only.

Two kinds of rules, in one table of ``rule_id, kind, verdict, host, path, pattern``:

* ``host``: fits ``host`` and its subdomains where the url's path starts with ``path``; the longest
  (host and path together) that fits decides;
* ``pattern``: decides where no host rule fits; an allowing one wins over blocking ones.  ``*`` stands for any
  run of characters, ``^`` for one that is no ASCII letter or digit or for an end, ``||`` at the start for the
  start of the host or of one of its labels, ``|`` for the start or end; all else is literal.

Among rules of one kind, verdict and length the larger ``rule_id`` (unique, below 2**38) wins.

1. A token is a run of ASCII letters and digits.  Tokens of a rule that stand alone in each url it fits (both
   neighbours are literal, an anchor or ``^``) may index it.  How many urls hold each of these tokens is counted
   over all rows, and each rule is filed under its rarest one; a rule without any is filed under the empty token.
2. A url's distinct tokens, and the empty one, fetch the rules filed under them; only those run their regular
   expression on it.  The best one that fits is a maximum of whole numbers, so the rows of a url meet in
   one partial aggregate before they are shuffled.

Rules are broadcast up to ``BROADCAST_RULE_BYTES`` of text, else joined by shuffle (Spark splits hot tokens).

Defined results: host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
path goes on up to ``?``, ``#`` or the end; a null url or one without ``://`` has both empty.  Where nothing fits, the verdict is
``allow`` and rule null.  Rows with equal or null ids or urls are judged each for itself; an empty table gives
no rows; without rules all are allowed; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_RULE_BYTES = 32 << 20

# fixed values: rules (host, path) of the registered query
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: patterns of the registered query; @@ marks an allowing one
PATTERNS = [
    "^adult^", "^porn^", "^xxx^", "^casino^", "^bets^", "^betting^", "^pills^", "^viagra^", "^spam^", "^phishing^",
    "^malware^", "^warez^", "^ads^", "^adserver^", "^popup^", "||doubleclick.net^", "||track.*/pixel", "^affid=*&",
    "/wp-login.php|", "@@/ads.txt|", "@@||adult-education.",
]

TOKEN = "[A-Za-z0-9]+"
SITE_START = "^//(?:[^/?#]*\\.)?"


def sql_text(s: str | None) -> str:
    return "cast(null as string)" if s is None else "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_table(spark: SparkSession, host_rules: list[tuple[str, str, str]], patterns: list[str]) -> DataFrame:
    """The rules as a table, from ``(verdict, host, path)`` and patterns (``@@``: allow)."""
    rows = [(v, h, p, None) for v, h, p in host_rules] + [
        ("allow" if p.startswith("@@") else "block", None, None, p.removeprefix("@@")) for p in patterns]
    if not rows:
        return rule_table(spark, [("allow", "", "")], []).where("false")
    values = ", ".join(f"({i}L, '{'pattern' if h is None else 'host'}', {sql_text(v)}, {sql_text(h)}, {sql_text(p)}, {sql_text(t)})"
                       for i, (v, h, p, t) in enumerate(rows))
    return spark.sql(f"SELECT * FROM VALUES {values} AS rules(rule_id, kind, verdict, host, path, pattern)")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> dict[str, Column]:
    """``host``, ``path`` and what else of the url follows the host (``tail``, path included)."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = rest.substr(F.length(host) + 1, F.length(rest) + 1)
    return {"host": lower_ascii(host), "path": F.regexp_extract(tail, "^[^?#]*", 0), "tail": tail}


def literal(c: Column) -> Column:
    """A regular expression for the text itself."""
    return F.regexp_replace(c, "([^A-Za-z0-9\\x{80}-\\x{10FFFF}])", "\\\\$1")


def compiled(rules: DataFrame) -> DataFrame:
    """``rule_id, verdict, kind, rule, regex, tokens, weight``; the regex is for // + host + path (``host``) or
    // + host + tail (``pattern``), the weight orders rules that fit one url."""
    site = F.concat(lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit("")))
    is_host = F.col("kind") == "host"
    pattern = F.coalesce("pattern", F.lit(""))
    body = F.regexp_replace(F.regexp_replace(pattern, "^\\|\\|?", ""), "\\|$", "")
    body = F.replace(F.replace(literal(body), F.lit("\\*"), F.lit("[\\s\\S]*")), F.lit("\\^"), F.lit("(?:[^A-Za-z0-9]|^|\\z)"))
    start = F.when(pattern.startswith("||"), F.lit(SITE_START)).when(pattern.startswith("|"), F.lit("^")).otherwise(F.lit(""))
    regex = F.when(is_host, F.concat(F.lit(SITE_START), literal(site))).otherwise(
        F.concat(start, body, F.when(pattern.endswith("|"), F.lit("\\z")).otherwise(F.lit(""))))
    # a star stands at each end that is open
    shown = F.when(is_host, F.concat(F.lit("|"), site, F.lit("*"))).otherwise(F.concat(
        F.when(pattern.startswith("|"), F.lit("")).otherwise(F.lit("*")), pattern, F.when(pattern.endswith("|"), F.lit("")).otherwise(F.lit("*"))))
    tokens = F.array_distinct(F.regexp_extract_all(shown, F.lit(f"(?<![A-Za-z0-9*]){TOKEN}(?![A-Za-z0-9*])"), F.lit(0)))
    level = F.when(is_host, 3).when(F.col("verdict") == "allow", 2).otherwise(1)
    size = F.when(is_host, F.least(F.length(site), F.lit((1 << 20) - 1))).otherwise(F.lit(0))
    weight = F.shiftleft(level.cast("long"), 60) + F.shiftleft(size.cast("long"), 38) + F.col("rule_id")
    return rules.select("rule_id", "verdict", "kind", F.when(is_host, site).alias("rule"), regex.alias("regex"), tokens.alias("tokens"), weight.alias("weight"))


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.split(text, "[^A-Za-z0-9]+"))


def sized(rules: DataFrame) -> bool:
    """Is the text of the rules within the broadcast bound?"""
    n = rules.agg(F.sum(F.octet_length("regex") + F.coalesce(F.octet_length("rule"), F.lit(0)) + 64)).first()[0]
    return (n or 0) <= BROADCAST_RULE_BYTES


def rarest_token(rules: DataFrame, urls: DataFrame, small: bool) -> DataFrame:
    """``rule_id, token``: the token of each rule that fewest of ``urls(full)`` hold (ties: by text), else ''."""
    own = rules.select("rule_id", F.explode("tokens").alias("token"))
    asked = own.select("token").distinct()
    held = urls.select(F.explode(tokens_of(F.col("full"))).alias("token")).join(F.broadcast(asked) if small else asked, "token", "left_semi")
    counts = held.groupBy("token").agg(F.count("*").alias("n"))  # one row for each token of a rule
    least = own.join(F.broadcast(counts) if small else counts, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    return rules.select("rule_id").join(least, "rule_id", "left").select("rule_id", F.coalesce("token", F.lit("")).alias("token"))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: its id, ``host, path, rule, verdict``."""
    parts = url_parts(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), *(c.alias(k) for k, c in parts.items()), F.monotonically_increasing_id().alias("row"))
    urls = urls.withColumn("full", F.concat(F.lit("//"), "host", "tail"))
    rules = compiled(rules)
    small = sized(rules)
    index = rules.join(rarest_token(rules, urls, small), "rule_id").select("token", "weight", "regex", "kind")
    asked = urls.select("id", "host", "path", "full", "row", F.explode(F.array_distinct(F.concat(tokens_of(F.col("full")), F.array(F.lit(""))))).alias("token"))
    subject = F.when(F.col("kind") == "host", F.concat(F.lit("//"), "host", "path")).otherwise(F.col("full"))
    fits = F.coalesce(F.rlike(subject, F.col("regex")), F.lit(False))
    met = asked.join(F.broadcast(index) if small else index, "token", "left").withColumn("fit", F.when(fits, F.col("weight")))
    best = met.where((F.col("token") == "") | F.col("fit").isNotNull()).groupBy("row", "id", "host", "path").agg(F.max("fit").alias("weight"))
    named = rules.select("weight", "rule", "verdict")
    return best.join(F.broadcast(named) if small else named, "weight", "left").select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
