"""Row provenance (P4–P6): raw-line hash, stable record id and the provenance keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filament.functions.text import base_name
from filament.spec import DedupSpec

NUL = "\u0000"


def row_hash(raw: Column) -> Column:
    """Hex SHA-1 of the untrimmed line (trailing CR already removed)."""
    return F.sha1(raw.cast("binary"))


def record_id(path: Column, line_no_text: Column, hash_hex: Column) -> Column:
    """P5: hex SHA-1 over path, line number text and row hash, each followed by NUL."""
    return F.sha1(F.concat(path, F.lit(NUL), line_no_text, F.lit(NUL), hash_hex, F.lit(NUL)).cast("binary"))


def add_provenance(df: DataFrame, dedup: DedupSpec, path: str = "_file", line_no: str = "_line_no",
                   raw: str = "_raw") -> DataFrame:
    """When enabled, set base name, line number (text), hash and record id under
    the configured keys.  Rows are never dropped."""
    if not dedup.enabled:
        return df
    h = row_hash(F.col(raw))
    ln = F.col(line_no).cast("string")
    return df.withColumns({
        dedup.source_file_field: base_name(F.col(path)),
        dedup.line_number_field: ln,
        dedup.row_hash_field: h,
        dedup.record_id_field: record_id(F.col(path), ln, h),
    })
