"""Field splitting (P1–P3): quote-aware one-byte delimiter, literal multi-byte
delimiter, and positional naming of the parts.  JVM-side regex/array functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filament.functions.text import WHITE_SPACE, go_trim, regex_literal, trim_column


def is_single_byte(delimiter: str) -> bool:
    return len(delimiter.encode("utf-8")) == 1


def quoted_tokenizer(delimiter: str) -> str:
    """Regex whose group 1 captures each field of ``delimiter + line``.

    Each field is preceded by exactly one delimiter; inside a field a ``"`` or ``'``
    opens a quote that runs to the same character or to the end of the line, and the
    delimiter inside a quote does not split.  Possessive quantifiers keep the matcher
    from backtracking (no stack growth on long lines)."""
    d = regex_literal(delimiter)
    return rf"{d}((?:[^{d}\"']++|\"[^\"]*+(?:\"|\z)|'[^']*+(?:'|\z))*+)"


_WS_CLASS = "[" + regex_literal(WHITE_SPACE) + "]"
_UNQUOTE = r"(?s)^([\"'])(.*)\1\z"


def _strip_quotes(trimmed: Column) -> Column:
    """Strip one matching pair of outer quotes and trim again; the regex runs only where a quote comes first."""
    quoted = trimmed.startswith("\"") | trimmed.startswith("'")
    return F.when(quoted, go_trim(F.regexp_replace(trimmed, _UNQUOTE, "$2"))).otherwise(trimmed)


def _unquote(part: Column) -> Column:
    """Trim, strip one matching pair of outer quotes, trim again."""
    return go_trim(F.regexp_replace(go_trim(part), _UNQUOTE, "$2"))


def quoted_parts(line: Column, delimiter: str) -> Column:
    """Raw (untrimmed, still quoted) fields of a one-byte-delimited line."""
    if delimiter in ("\"", "'"):
        # The delimiter itself opens a quote, so it never splits.
        return F.array(line)
    return F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(quoted_tokenizer(delimiter)), 1)


def split_quoted(line: Column, delimiter: str) -> Column:
    """P1 as an array of cleaned fields (uses a lambda; the row path is
    ``positional_fields``, which stays inside whole-stage code generation)."""
    return F.transform(quoted_parts(line, delimiter), _unquote)


def split_literal(line: Column, delimiter: str) -> Column:
    """Array of fields split on a literal (multi-byte) delimiter; quotes are kept."""
    return F.transform(F.split(line, regex_literal(delimiter), -1), go_trim)


def split_line(line: Column, delimiter: str) -> Column:
    """Choose P1 or P2 at plan time from the delimiter's byte length."""
    return split_quoted(line, delimiter) if is_single_byte(delimiter) else split_literal(line, delimiter)


def raw_parts(line: Column, delimiter: str) -> Column:
    return quoted_parts(line, delimiter) if is_single_byte(delimiter) else F.split(line, regex_literal(delimiter), -1)


def positional_fields(df: DataFrame, line: Column, names: list[str], delimiter: str = "|") -> DataFrame:
    """I-th part → i-th name (cleaned); missing parts → ``""``; extra parts dropped.
    A repeated name takes its last position (the later assignment wins)."""
    last_pos = {n: i for i, n in enumerate(names)}
    arr = "_parts"
    df = df.withColumn(arr, raw_parts(line, delimiter))
    # one plain expression a field, no lambda: the projection stays code-generated; trimmed texts stand in a projection
    # of their own, as each is read more than once
    held = {n: f"{arr}{i}" for n, i in last_pos.items()}
    df = df.withColumns({held[n]: F.coalesce(F.get(F.col(arr), i), F.lit("")) for n, i in last_pos.items()})
    df = df.withColumns({h: trim_column(F.col(h)) for h in held.values()})
    clean = _strip_quotes if is_single_byte(delimiter) else (lambda c: c)
    return df.withColumns({n: clean(F.col(h)) for n, h in held.items()}).drop(arr, *held.values())
