"""Header and static merges.

Header metadata is the first non-blank line of each file, split with the row rule
and named positionally (missing → ``""``).  With
``max_header_bytes`` a first line of that size or more yields no metadata (the line is still
skipped).  Every header key overwrites the row's
value (header wins).  A static merge fills only absent keys (row wins; ``""`` counts
as present).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filament.functions.text import col
from filament.operators.split import split_line


def header_columns(head_line: Column, head_raw: Column, delimiter: str, names: list[str],
                   max_header_bytes: int | None = None) -> dict[str, Column]:
    """Header key → value columns computed from the file's first non-blank line.
    NULL (no metadata) when the file has no such line or it exceeds the limit."""
    usable = head_line.isNotNull()
    if max_header_bytes:
        usable = usable & (F.octet_length(head_raw) < F.lit(max_header_bytes))
    parts = split_line(head_line, delimiter)
    out: dict[str, Column] = {}
    for i, n in enumerate(names):
        out[n] = F.when(usable, F.coalesce(F.get(parts, i), F.lit("")))
    return out


def header_merge(df: DataFrame, header: dict[str, Column]) -> DataFrame:
    """Header values overwrite row keys (only where the file has metadata)."""
    updates = {}
    for k, v in header.items():
        existing = col(k) if k in df.columns else F.lit(None).cast("string")
        updates[k] = F.coalesce(v, existing)
    return df.withColumns(updates) if updates else df


def static_merge(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Constants fill absent keys only."""
    updates = {k: F.coalesce(col(k), F.lit(v)) if k in df.columns else F.lit(v) for k, v in values.items()}
    return df.withColumns(updates) if updates else df
