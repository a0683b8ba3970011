"""Typed conversion of text fields: ``cast_field(raw, FieldSpec) -> (value, error)``.

Order per field: trim the row's text (absent = empty) → empty takes the declared
default → still empty and nullable → NULL → convert by base type.  Every conversion
is guarded by the exact accepted grammar before a ``try_*`` cast, so ANSI mode never
raises and lax Spark casts (``'5.7'`` → 6, ``'1d'`` → 1.0, ``'yes'`` → true) never pass.
The error column is NULL for good values, else a message naming the field.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from filament.functions.ip import canonical_ip
from filament.functions.text import go_trim
from filament.spec import (DEFAULT_TIME_LAYOUTS, FLOAT_BITS, INT_BITS, IP_TYPES, STRING_TYPES,
                           TIME_TYPES, UINT_BITS, FieldSpec, fraction_rule, go_layout_to_pattern, spark_type)

# The spellings a boolean field accepts.
TRUE_WORDS = ["1", "t", "T", "TRUE", "true", "True"]
FALSE_WORDS = ["0", "f", "F", "FALSE", "false", "False"]
# Zero time used for an empty time field: 0001-01-01 00:00:00 UTC, in epoch seconds.
ZERO_TIME_EPOCH_S = -62135596800

_FLOAT_RE = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z"
_HEX_FLOAT_RE = r"^[+-]?0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+\z"
# Underscores stand between digits, or between a digit and the hex prefix.
_UNDERSCORE_RE = r"^[^_]*(?:(?<=[0-9a-fA-FxX])_(?=[0-9a-fA-F])[^_]*)+\z"
_INF_RE = r"(?i)^[+-]?inf(?:inity)?\z"
_NAN_RE = r"(?i)^nan\z"


# Error codes carried per row; messages are built only for the rows that report them.
SYNTAX, RANGE, INVALID = 1, 2, 3


def parsed_integer(raw: Column, signed: bool) -> Column:
    """The 64-bit value of a text of the exact grammar (no sign for unsigned), else NULL.  A strict cast that
    fails builds an error, so it is tried on texts that can't fail; longer ones are rare."""
    sign = "[+-]?" if signed else ""
    return (F.when(raw.rlike(rf"^{sign}[0-9]{{1,18}}\z"), raw.try_cast("long"))
             .when((F.octet_length(raw) > 18) & raw.rlike(rf"^{sign}[0-9]+\z"), raw.try_cast("long")))


def _integer(raw: Column, bits: int, signed: bool, parsed: Column | None = None) -> tuple[Column, Column]:
    """Base-10 integer, empty = 0.  ``parsed`` is ``parsed_integer`` of the text as a column: value and code read it
    several times."""
    lo = -(2 ** (bits - 1)) if signed else 0
    hi = 2 ** (bits - 1) - 1 if signed else 2 ** bits - 1
    target = spark_type(("int" if signed else "uint") + str(bits))
    v = parsed_integer(raw, signed) if parsed is None else parsed
    grammar = raw.rlike(r"^[+-]?[0-9]+\z" if signed else r"^[0-9]+\z")
    if hi >= 2 ** 63:
        v = F.coalesce(v.cast("decimal(20,0)"), F.when((F.octet_length(raw) > 18) & grammar, raw.try_cast("decimal(20,0)")))
        fits = v.isNotNull() & (v <= F.lit(str(hi)).cast("decimal(20,0)"))
    else:
        fits = v.isNotNull() & v.between(F.lit(lo), F.lit(hi)) if bits < 64 else v.isNotNull()
    value = F.when(fits, v.cast(target)).when(raw == "", F.lit(0).cast(target))
    return value, F.when(~fits & (raw != ""), F.when(grammar, F.lit(RANGE)).otherwise(F.lit(SYNTAX)))


def _float(raw: Column, bits: int) -> tuple[Column, Column]:
    target, java = ("float", "Float") if bits == 32 else ("double", "Double")
    inf = float("inf")
    # rare spellings, looked at only where the plain grammar fails
    bare = F.when(raw.contains("_") & raw.rlike(_UNDERSCORE_RE), F.replace(raw, F.lit("_"), F.lit(""))).otherwise(raw)
    hexed = F.when(bare.rlike(_HEX_FLOAT_RE), F.try_reflect(F.lit(f"java.lang.{java}"), F.lit(f"parse{java}"), bare).cast(target))
    grammar = raw.rlike(_FLOAT_RE)
    signed_inf = F.when(raw.startswith("-"), F.lit(-inf)).otherwise(F.lit(inf)).cast(target)
    rare = (F.when(raw.rlike(_INF_RE), F.struct(signed_inf.alias("v"), F.lit(False).alias("finite")))
             .when(raw.rlike(_NAN_RE), F.struct(F.lit(float("nan")).cast(target).alias("v"), F.lit(False).alias("finite")))
             .when(bare.rlike(_FLOAT_RE), F.struct(bare.try_cast(target).alias("v"), F.lit(True).alias("finite")))
             .when(hexed.isNotNull(), F.struct(hexed.alias("v"), F.lit(True).alias("finite"))))
    got = F.when(grammar, F.struct(raw.try_cast(target).alias("v"), F.lit(True).alias("finite"))).otherwise(rare)
    v = got["v"]
    over = got["finite"] & (F.abs(v) == F.lit(inf).cast(target))
    return F.when(~over, v), F.when(got.isNull(), F.lit(SYNTAX)).when(over, F.lit(RANGE))


def _parsed(raw: Column, layout: str) -> Column:
    rule = fraction_rule(layout)
    text = F.when(raw.rlike("[.,][0-9]"), F.regexp_replace(raw, *rule)).otherwise(raw) if rule else raw
    ts = F.try_to_timestamp(text, F.lit(go_layout_to_pattern(layout)))
    counted = re.search(r"[.,](0+)(?![0-9])", layout)
    # the parser takes fewer fraction digits than the layout counts; the layout does not
    return F.when(text.rlike(rf"[.,][0-9]{{{len(counted[1])}}}(?![0-9])"), ts) if counted else ts


def _time(raw: Column, base: str, layout: str) -> tuple[Column, Column]:
    """Parsed once per value.  Without a layout the shape of the text says which of the default
    layouts can apply: with ``T``, a date alone, or date and time."""
    if layout:
        parsed = _parsed(raw, layout)
    else:
        zoned, _, clock, _, day = DEFAULT_TIME_LAYOUTS  # the second and fourth accept nothing that these don't
        parsed = (F.when(raw.contains("T"), _parsed(raw, zoned)).when(F.length(raw) <= 10, _parsed(raw, day))
                   .otherwise(_parsed(raw, clock)))
    ts = F.when(raw == "", F.timestamp_seconds(F.lit(ZERO_TIME_EPOCH_S))).otherwise(parsed)
    value = F.date_trunc("second", ts) if base == "datetime" else ts.cast("date") if base == "date" else ts
    return value, F.when(ts.isNull(), F.lit(INVALID))


def convert_code(raw: Column, base: str, layout: str = "", parsed: Column | None = None) -> tuple[Column, Column]:
    """Convert non-null trimmed text by base type → (value, error code or NULL).  ``parsed``: see ``_integer``."""
    none = F.lit(None).cast("int")
    if base in STRING_TYPES:
        return raw, none
    if base == "bool":
        value = (F.when(raw == "", F.lit(False))
                 .when(raw.isin(TRUE_WORDS), F.lit(True))
                 .when(raw.isin(FALSE_WORDS), F.lit(False)))
        return value, F.when(value.isNull(), F.lit(SYNTAX))
    if base in UINT_BITS:
        return _integer(raw, UINT_BITS[base], False, parsed)
    if base in INT_BITS:
        return _integer(raw, INT_BITS[base], True, parsed)
    if base in FLOAT_BITS:
        return _float(raw, FLOAT_BITS[base])
    if base in TIME_TYPES:
        return _time(raw, base, layout)
    if base in IP_TYPES:
        ip = canonical_ip(raw)
        return ip, F.when(ip.isNull(), F.lit(INVALID))
    return raw, none


def error_message(f: FieldSpec, code: Column, text: Column) -> Column:
    """The message of a conversion error of field ``f`` (``code`` non-null)."""
    base = f.base_type
    if base == "bool":
        body = F.concat(F.lit('strconv.ParseBool: parsing "'), text, F.lit('": invalid syntax'))
    elif base in UINT_BITS or base in INT_BITS or base in FLOAT_BITS:
        func = "ParseUint" if base in UINT_BITS else "ParseInt" if base in INT_BITS else "ParseFloat"
        shown = F.when(text == "", F.lit("0")).otherwise(text) if func != "ParseFloat" else text
        kind = F.when(code == SYNTAX, F.lit("invalid syntax")).otherwise(F.lit("value out of range"))
        body = F.concat(F.lit(f'strconv.{func}: parsing "'), shown, F.lit('": '), kind)
    elif base in TIME_TYPES:
        body = (F.concat(F.lit('parsing time "'), text, F.lit(f'" as "{f.layout}": cannot parse')) if f.layout
                else F.concat(F.lit('invalid time "'), text, F.lit('"')))
    elif base in IP_TYPES:
        body = F.concat(F.lit('invalid IP "'), text, F.lit('"'))
    else:
        body = F.lit("conversion error")
    return F.concat(F.lit(f'field "{f.name}": '), body)


def prepared_text(text: Column, f: FieldSpec, trimmed: bool = False) -> Column:
    """Trimmed text with the declared default applied (the converter's input).  ``trimmed``: it is already."""
    raw = F.coalesce(text, F.lit("")) if trimmed else go_trim(F.coalesce(text, F.lit("")))
    return F.when(raw == "", F.lit(f.default)).otherwise(raw) if f.default else raw


def cast_code(text: Column, f: FieldSpec, parsed: Column | None = None) -> tuple[Column, Column]:
    """(typed value, error code) for prepared text (see ``prepared_text``)."""
    value, code = convert_code(text, f.base_type, f.layout, parsed)
    dtype = spark_type(f.base_type)
    if f.nullable:
        empty = text == ""
        value = F.when(empty, F.lit(None).cast(dtype)).otherwise(value)
        code = F.when(empty, F.lit(None).cast("int")).otherwise(code)
    return value.cast(dtype), code


def cast_field(text: Column, f: FieldSpec, trimmed: bool = False) -> tuple[Column, Column]:
    """(typed value, error message or NULL) for one declared field read from ``text``."""
    raw = prepared_text(text, f, trimmed)
    value, code = cast_code(raw, f)
    return value, F.when(code.isNotNull(), error_message(f, code, raw))
