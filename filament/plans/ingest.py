"""Lines frame → typed rows for one pipeline spec (parse, header, provenance, chain,
typed projection).  Works on scanned lines (``sources.lines.scan_lines``) and on lines
derived from tables (``sources.lines.lines_from_frame``) alike.

Plan shape: line numbering (and its one small aggregate) is built only when the spec
needs it (header metadata, skipped lines or provenance); otherwise the plan is a pure
map over the scan.  The IP and dictionary steps are broadcast hash joins on bounded
dimension tables.  No Python UDF anywhere.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filament.operators.chain import TRANSFORM_ERROR, ChainContext, apply_chain, trimmed_after_chain
from filament.operators.merge import header_columns, header_merge
from filament.operators.provenance import add_provenance
from filament.operators.split import positional_fields
from filament.operators.typed import ERR_FIELD, ERR_KIND, ERR_TEXT, ERROR, message_column, typed_codes
from filament.sources.lines import number_by_key, number_scanned, order_columns
from filament.spec import PipelineSpec

TOO_LONG_ERROR = "scan file: bufio.Scanner: token too long"


@dataclass
class Parsed:
    rows: DataFrame          # row-keyed frame after the chain (one column per key)
    order: list[str]         # columns ordering the rows within a file
    trimmed: frozenset = frozenset()   # keys whose texts have no outer white space

HDR = "_hdr_"


def _parsed_heads(spec: PipelineSpec):
    """Header metadata parsed once per file (on the small heads table)."""
    names = [h.name for h in spec.header_fields]

    def fn(heads: DataFrame) -> DataFrame:
        cols = header_columns(F.col("_head_line"), F.col("_head_raw"), spec.delimiter, names, spec.max_header_bytes)
        return heads.select("_file", *[c.alias(HDR + n) for n, c in cols.items()])
    return fn


def number(lines: DataFrame, spec: PipelineSpec, index_bytes: int | None = None, heads: DataFrame | None = None,
           heads_bytes: int | None = None) -> DataFrame:
    if not spec.needs_line_numbers:
        return lines
    head_fn = _parsed_heads(spec) if spec.has_header_meta else None
    if "_block" in lines.columns:
        return number_scanned(lines, index_bytes, with_head=spec.has_header_meta, head_fn=head_fn, heads=heads, heads_bytes=heads_bytes)
    return number_by_key(lines, index_bytes=index_bytes, with_head=spec.has_header_meta, head_fn=head_fn)


def parse(lines: DataFrame, spec: PipelineSpec, ctx: ChainContext, index_bytes: int | None = None,
          heads: DataFrame | None = None, heads_bytes: int | None = None) -> Parsed:
    """Row-keyed frame: split + positional names, header merge, provenance, chain.  ``heads`` (scanned lines):
    the files' first lines (``lines.file_heads``) and their counted bytes, else they are looked up in a scan of their own."""
    df = number(lines, spec, index_bytes, heads, heads_bytes)
    if spec.skip_lines:
        df = df.filter((F.col("_line_no") > F.lit(spec.skip_lines)) | F.col("_too_long"))
    df = positional_fields(df, F.col("_line"), spec.input_names, spec.delimiter)
    if spec.has_header_meta:
        names = [h.name for h in spec.header_fields]
        df = header_merge(df, {n: F.col(HDR + n) for n in names}).drop(*[HDR + n for n in names])
    df = add_provenance(df, spec.dedup)
    # split and header fields come trimmed
    ctx = replace(ctx, trimmed=frozenset(spec.input_names) | {h.name for h in spec.header_fields if spec.has_header_meta})
    trimmed = trimmed_after_chain(spec.transformers, ctx, df.columns)
    df = apply_chain(df, spec.transformers, ctx)
    return Parsed(df, order_columns(df), trimmed)


def typed_rows(parsed: Parsed, spec: PipelineSpec) -> DataFrame:
    """``_file``, the order columns, ``_terr``, the declared output columns and the
    error codes of the row's first failing field (``_err_field`` = -1 for a line over
    the scanner limit).  Rows dropped by a failing transform keep ``_terr`` so they can
    be counted; they carry no conversion error."""
    df = parsed.rows.withColumn("_terr", F.col(TRANSFORM_ERROR))
    keep = ["_file", *parsed.order, "_terr", "_too_long"] + (["_line_no"] if "_line_no" in df.columns else [])
    typed = typed_codes(df, spec.output_fields, keep, parsed.trimmed)
    dropped = F.col("_terr").isNotNull()
    return typed.withColumns({
        ERR_FIELD: F.when(F.col("_too_long"), F.lit(-1)).when(~dropped, F.col(ERR_FIELD)),
        ERR_KIND: F.when(~dropped, F.col(ERR_KIND)),
        ERR_TEXT: F.when(~dropped, F.col(ERR_TEXT)),
    }).drop("_too_long")


def error_message(spec: PipelineSpec):
    """Message column for typed rows (reads the error codes)."""
    return F.when(F.col(ERR_FIELD) == -1, F.lit(TOO_LONG_ERROR)).otherwise(message_column(spec.output_fields))


def with_messages(typed: DataFrame, spec: PipelineSpec) -> DataFrame:
    return typed.withColumn(ERROR, error_message(spec))


def output_only(typed: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Declared output columns of rows that passed the chain."""
    return typed.filter(F.col("_terr").isNull()).select(*[f.name for f in spec.output_fields])
