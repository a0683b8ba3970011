"""IP address expressions: validation (IPv4 / IPv6 text) and IPv4 → 32-bit integer.

All JVM-side: regular expressions plus array arithmetic, no Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Dotted quad: four decimal octets 0..255, no leading zeros.
IPV4_RE = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_H = r"[0-9A-Fa-f]{1,4}"


def _groups(k: int) -> str:
    if k == 0:
        return ""
    return _H + (rf"(?::{_H}){{{k - 1}}}" if k > 1 else "")


def _ipv6_alternatives() -> list[str]:
    """IPv6 text forms, generated by rule: eight groups, six groups plus a dotted
    tail, or a ``::`` standing for at least one zero group between k left and m right
    groups (the dotted tail counts as two groups)."""
    alts = [rf"{_groups(8)}", rf"{_groups(6)}:{IPV4_RE}"]
    for k in range(0, 8):
        for m in range(0, 8 - k):
            alts.append(f"{_groups(k)}::{_groups(m)}")
    for k in range(0, 6):
        for m in range(0, 6 - k):
            right = f"{_groups(m)}:" if m else ""
            alts.append(f"{_groups(k)}::{right}{IPV4_RE}")
    return alts


IPV6_RE = "(?:" + "|".join(_ipv6_alternatives()) + ")"


def is_ipv4(c: Column) -> Column:
    return c.rlike(rf"^{IPV4_RE}\z")


def is_ipv6(c: Column) -> Column:
    return c.rlike(rf"^{IPV6_RE}\z")


def is_ip(c: Column) -> Column:
    """True for text a standard IP parser accepts (dotted IPv4 or IPv6, no zone)."""
    # IPv6 text is rare in these feeds: its long regex runs only when a ':' is present.
    return F.when(c.contains(":"), is_ipv6(c)).otherwise(is_ipv4(c))


def _mapped_alternatives() -> list[str]:
    """Spellings of an IPv4-mapped IPv6 prefix (five zero groups then ``ffff:``), by
    rule: a ``::`` standing for at least one of the zero groups, with a left and b
    right explicit zero groups (a + b <= 4), or all five written out."""
    z = "0{1,4}"
    alts = [f"(?:{z}:){{5}}ffff:"]
    for a in range(0, 5):
        left = f"(?:{z}:){{{a}}}" if a else ""
        alts.append(f"{left}:(?:{z}:){{0,{4 - a}}}ffff:" if a else f"::(?:{z}:){{0,4}}ffff:")
    return alts


_HEX = "[0-9a-f]{1,4}"
# Tail after the mapped prefix: dotted quad or two hex groups; with all five zero
# groups written out, the tail itself may be compressed (``ffff::``, ``ffff::H``, ``ffff:H::``).
MAPPED_RE = ("(?i)^(?:(?:" + "|".join(_mapped_alternatives()) + f")(?:{IPV4_RE}|{_HEX}:{_HEX})"
             + f"|(?:0{{1,4}}:){{5}}ffff(?:::|::{_HEX}|:{_HEX}::))\\z")


def _octet(c: Column, i: int) -> Column:
    """i-th (1-based) dot-separated part of a validated dotted quad."""
    return F.substring_index(F.substring_index(c, ".", i), ".", -1)


def _dotted_to_long(c: Column) -> Column:
    return reduce(lambda acc, i: acc * 256 + _octet(c, i + 1).cast("long"), range(1, 4), _octet(c, 1).cast("long"))


def _hex(c: Column) -> Column:
    return F.conv(c, 16, 10).cast("long")


def _mapped_value(t: Column) -> Column:
    """IPv4 value of a text that matches ``MAPPED_RE``."""
    low = F.lower(t)
    tail = F.regexp_extract(low, "ffff:(:?[0-9a-f.:]*)\\z", 1)
    h2 = F.regexp_extract(tail, f"^({_HEX}):({_HEX})\\z", 1)
    h2b = F.regexp_extract(tail, f"^({_HEX}):({_HEX})\\z", 2)
    return (F.when(tail.rlike(f"^{IPV4_RE}\\z"), _dotted_to_long(tail))
             .when(h2 != "", _hex(h2) * 65536 + _hex(h2b))
             .when(tail == ":", F.lit(0).cast("long"))
             .when(tail.rlike(f"^:{_HEX}\\z"), _hex(F.substring(tail, 2, 4)))
             .when(tail.rlike(f"^{_HEX}::\\z"), _hex(F.regexp_extract(tail, f"^({_HEX})", 1)) * 65536))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a one-element array.  Higher-order functions aren't
    inlined in generated code, so a long expression for a rare case adds nothing to it."""
    return F.get(F.transform(F.array(value), body), 0)


def _shorten(full: Column) -> Column:
    """``:g1:...:g8`` without leading zeros -> canonical text: ``::`` for the longest run of two or
    more zero groups (the first of equal ones)."""
    out = F.substring(full, 2, 100)
    for k in range(2, 9):  # the last that matches wins: the longest run
        run = f"^(.*?)(?::0){{{k}}}(?::(.*))?\\z"
        short = F.concat(F.regexp_replace(F.regexp_extract(full, run, 1), "^:", ""), F.lit("::"), F.regexp_extract(full, run, 2))
        out = F.when(full.rlike(run), short).otherwise(out)
    return out


def _expand(t: Column) -> Column:
    """A valid lower-case IPv6 text without a dotted tail -> ``:g1:...:g8`` without leading zeros."""
    def part(side: Column) -> Column:
        return F.when(side == "", F.lit("")).otherwise(F.concat(F.lit(":"), side))

    left, right = part(F.substring_index(t, "::", 1)), part(F.substring_index(t, "::", -1))
    both = F.concat(left, right)
    given = F.length(both) - F.length(F.replace(both, F.lit(":"), F.lit("")))
    full = F.when(t.contains("::"), F.concat(left, F.repeat(F.lit(":0"), (F.lit(8) - given).cast("int")), right)
                  ).otherwise(F.concat(F.lit(":"), t))
    return F.regexp_replace(full, ":0{1,3}(?=[0-9a-f])", ":")


def _hex_tail(t: Column) -> Column:
    """A dotted tail written as two groups."""
    v = _dotted_to_long(F.regexp_extract(t, "([0-9.]+)\\z", 1))
    hexed = F.concat(F.regexp_replace(t, "[0-9.]+\\z", ""), F.lower(F.hex(F.shiftright(v, 16))), F.lit(":"),
                     F.lower(F.hex(v.bitwiseAND(F.lit(65535)))))
    return F.when(t.contains("."), hexed).otherwise(t)


def canonical_ip(c: Column) -> Column:
    """The address in its usual spelling (NULL if it is none): dotted IPv4, also for IPv4-mapped
    IPv6 addresses, else lower-case compressed IPv6."""
    def v6(x: Column) -> Column:
        text = _bound(_expand(_bound(F.lower(x), _hex_tail)), _shorten)
        return F.when(x.rlike(MAPPED_RE), u32_to_dotted(_mapped_value(x))).when(is_ipv6(x), text)

    return F.when(c.contains(":"), _bound(c, v6)).when(is_ipv4(c), c)


def ip_to_u32(c: Column) -> Column:
    """IPv4 value of a trimmed text: dotted quad, an IPv4-mapped IPv6 address in any
    spelling, or a decimal integer 0..2^32-1.  NULL when none applies (no error).  The rare spellings
    stand in a bound expression: inlined, they make the generated method of a projection too long to be compiled."""
    def quad(parts: Column) -> Column:
        return reduce(lambda acc, i: acc * 256 + F.get(parts, i).cast("long"), range(1, 4), F.get(parts, 0).cast("long"))

    def rare(x: Column) -> Column:
        digits = F.regexp_replace(x, "^0+(?=[0-9])", "")
        dec = F.when(x.rlike(r"^[0-9]+\z") & (F.length(digits) <= 10), digits.cast("decimal(20,0)"))
        return F.when(x.rlike(MAPPED_RE), _mapped_value(x)).when(dec <= F.lit(4294967295), dec.cast("long"))

    return F.when(is_ipv4(c), _bound(F.split(c, r"\."), quad)).when(c != "", _bound(c, rare))


def u32_to_dotted(c: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(c, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
