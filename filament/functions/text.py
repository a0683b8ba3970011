"""String helpers shared by all operators (JVM-side column expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space removed by the reference's line and field trimming
# (Unicode White_Space: tab, LF, VT, FF, CR, space, U+0085, U+00A0, U+1680,
# U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000).
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def col(name: str) -> Column:
    """Column by exact name (dots and other characters are not parsed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def go_trim(c: Column) -> Column:
    """Trim Unicode white space from both ends (``trim`` alone strips U+0020 only).  It copies each character of its
    input: texts that are known to be trimmed should not pass through it again (see ``chain.trimmed_after``)."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def trim_column(c: Column) -> Column:
    """``go_trim`` of a plain column: the copy is made only where the first or last byte isn't a visible ASCII
    character.  (An expression would be evaluated once for each of its uses here.)"""
    last = F.substring(c.cast("binary"), -1, 1)
    visible = F.ascii(c).between(33, 126) & last.between(F.lit(b"!"), F.lit(b"~"))
    return F.when(visible, c).otherwise(go_trim(c))


def strip_cr(c: Column) -> Column:
    """Drop one trailing carriage return, as line scanning does for CRLF input.  Works on
    the bytes: text that is not UTF-8 keeps every other byte (a regex would replace it)."""
    b = c.cast("binary")
    return F.when(c.endswith("\r"), F.substring(b, F.lit(1), F.length(b) - 1).cast("string")).otherwise(c)


def base_name(path: Column) -> Column:
    """Last element of a slash-separated path."""
    return F.substring_index(F.regexp_replace(path, "/+\\z", ""), "/", -1)


def regex_literal(text: str) -> str:
    """Java-regex literal for ``text`` that is also valid inside a character class."""
    return "".join("\\x{%x}" % ord(ch) for ch in text)


def decode_file_uri(uri: Column) -> Column:
    """Plain path of a file URI as reported by ``_metadata.file_path`` (percent-encoded,
    ``file:`` scheme for local files).  ``+`` is literal in those URIs."""
    no_scheme = F.regexp_replace(uri, "^file:(//)?(?=/)", "")
    return F.url_decode(F.replace(no_scheme, F.lit("+"), F.lit("%2B")))


def sanitize_name(c: Column) -> Column:
    """Metric-name sanitising: every byte outside ``[A-Za-z0-9_]`` becomes ``_`` (so a
    non-ASCII character becomes one ``_`` per UTF-8 byte); an empty name is ``default``."""
    out = F.regexp_replace(c, "[\\x{10000}-\\x{10FFFF}]", "____")
    out = F.regexp_replace(out, "[\\x{800}-\\x{FFFF}]", "___")
    out = F.regexp_replace(out, "[\\x{80}-\\x{7FF}]", "__")
    out = F.regexp_replace(out, "[^A-Za-z0-9_]", "_")
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit("default")).otherwise(out)

