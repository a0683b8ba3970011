"""Pipeline specifications: declared fields, transforms, readiness and retry policy.

A ``PipelineSpec`` is an input to the operators (never data): one watched directory
feeding one output table.  Validation rules and defaults live in ``__post_init__``.
Plan-time helpers also live here: type-name normalisation, Go time layouts →
Spark datetime patterns, and file globs → anchored regular expressions.
"""

from __future__ import annotations

import posixpath
import re
import warnings
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


class SpecError(ValueError):
    """Invalid pipeline specification."""


# ---------------------------------------------------------------------------
# Type names
# ---------------------------------------------------------------------------

STRING_TYPES = {"", "string", "fixedstring", "enum8", "enum16", "uuid"}
UINT_BITS = {"uint8": 8, "uint16": 16, "uint32": 32, "uint64": 64}
INT_BITS = {"int8": 8, "int16": 16, "int32": 32, "int64": 64, "int": 64}
FLOAT_BITS = {"float32": 32, "float64": 64, "float": 64}
TIME_TYPES = {"date", "datetime", "datetime64"}
IP_TYPES = {"ipv4", "ipv6"}


# Type wrappers that say nothing about conversion.
WRAPPERS = {"nullable", "lowcardinality"}
_CALL = re.compile(r"([^(]+)\((.*)\)", re.S)


def normalize_type(type_name: str) -> str:
    """Base type of a declared column type, read as ``name(arguments)``: a wrapper stands for its
    argument, any other name loses its arguments.  ``LowCardinality(Nullable(UInt8))`` is ``uint8``,
    ``DateTime64(3)`` is ``datetime64``."""
    text = type_name.strip().lower()
    call = _CALL.fullmatch(text)
    if call and call[1] in WRAPPERS:
        return normalize_type(call[2]) if call[2].strip() == call[2] else call[2].partition("(")[0]
    head, bracket, _ = text.partition("(")
    return head if head or not bracket else text


def spark_type(base: str) -> T.DataType:
    """Spark type holding the converted value of a base type (unsigned types widen)."""
    if base == "bool":
        return T.BooleanType()
    if base in UINT_BITS:
        return {8: T.ShortType(), 16: T.IntegerType(), 32: T.LongType(), 64: T.DecimalType(20, 0)}[UINT_BITS[base]]
    if base in INT_BITS:
        return {8: T.ByteType(), 16: T.ShortType(), 32: T.IntegerType(), 64: T.LongType()}[INT_BITS[base]]
    if base in FLOAT_BITS:
        return T.FloatType() if FLOAT_BITS[base] == 32 else T.DoubleType()
    if base == "date":
        return T.DateType()
    if base in ("datetime", "datetime64"):
        return T.TimestampType()
    return T.StringType()


# ---------------------------------------------------------------------------
# Go time layouts → Spark datetime patterns
# ---------------------------------------------------------------------------

# Go layout reference tokens and the Spark pattern each one maps to,
# longest tokens first (Go recognises e.g. "January" before "Jan", "2006" before "2").
_GO_TOKENS = [
    ("Z07:00:00", "XXXXX"), ("-07:00:00", "xxxxx"), ("Z070000", "XXXX"), ("-070000", "xxxx"),
    ("Z07:00", "XXX"), ("-07:00", "xxx"), ("Z0700", "XX"), ("-0700", "xx"), ("Z07", "X"), ("-07", "x"),
    ("January", "MMMM"), ("Monday", "EEEE"), ("2006", "yyyy"), ("Jan", "MMM"), ("Mon", "EEE"),
    ("MST", "z"), ("002", "DDD"), ("15", "H"), ("01", "MM"), ("02", "dd"), ("03", "hh"), ("04", "mm"),
    ("05", "ss"), ("06", "yy"), ("PM", "a"), ("pm", "a"), ("1", "M"), ("2", "d"), ("3", "h"),
    ("4", "m"), ("5", "s"),
]
_FRACTION = re.compile(r"^[.,](0+|9+)(?![0-9])")
# Tokens whose digits may touch those of a neighbour in a compact layout.
_NUMERIC = {"2006", "01", "02", "03", "04", "05", "06", "15", "002"}
# Default layouts tried in order when a time field has none (RFC3339Nano, RFC3339,
# "2006-01-02 15:04:05", "2006-01-02 15:04:05.999", "2006-01-02").
DEFAULT_TIME_LAYOUTS = [
    "2006-01-02T15:04:05.999999999Z07:00",
    "2006-01-02T15:04:05Z07:00",
    "2006-01-02 15:04:05",
    "2006-01-02 15:04:05.999",
    "2006-01-02",
]


def _quote_literal(text: str) -> str:
    out = []
    for ch in text:
        if ch.isalpha():
            out.append("'" + ch + "'" if ch != "'" else "''")
        elif ch == "'":
            out.append("''")
        else:
            out.append(ch)
    return "".join(out)


def go_layout_to_pattern(layout: str) -> str:
    """Translate a Go reference layout into a Spark ``to_timestamp`` pattern.

    Go also accepts a fractional second right after the seconds field when the layout
    has none, so ``ss`` is followed by an optional variable-length fraction (see
    ``fraction_rule`` for what a pattern cannot say).  The hour ``15`` may have one digit,
    unless other digits touch it."""
    i, out, before = 0, [], ""
    while i < len(layout):
        rest = layout[i:]
        if rest.startswith("_2"):
            raise SpecError(f"layout token '_2' (space-padded day) is not supported: {layout!r}")
        m = _FRACTION.match(rest)
        if m:
            digits = len(m.group(1))
            if m.group(1)[0] == "0":
                out.append("." + "S" * digits)
            else:
                out.append("[." + "S" * 9 + "]")
            i += len(m.group(0))
            before = ""
            continue
        for tok, pat in _GO_TOKENS:
            if rest.startswith(tok):
                i += len(tok)
                if tok == "15" and (before in _NUMERIC or any(layout.startswith(t, i) for t in _NUMERIC)):
                    pat = "HH"
                out.append(pat)
                before = tok
                if tok == "05" and not _FRACTION.match(layout[i:]):
                    out.append("[.SSSSSSSSS]")
                break
        else:
            out.append(_quote_literal(rest[0]))
            i += 1
            before = ""
    return "".join(out)


def fraction_rule(layout: str) -> tuple[str, str] | None:
    """What to replace in a text before its pattern is applied (regex, replacement): a fraction may
    follow a comma, and digits beyond nine are cut off, unless the layout counts them (``.000``).
    None where the layout has dots or commas of its own elsewhere, or no seconds."""
    plain = re.sub(r"[.,](?:0+|9+)(?![0-9])", "", layout)
    if "05" not in layout or "." in plain or "," in plain:
        return None
    if re.search(r"[.,]0+(?![0-9])", layout):
        return ",([0-9])", ".$1"
    return "[.,]([0-9]{1,9})[0-9]*", ".$1"


# ---------------------------------------------------------------------------
# File-name globs
# ---------------------------------------------------------------------------

def glob_to_regex(pattern: str) -> str:
    """Anchored Java regex equal to a shell-style base-name glob: ``*`` any run of
    non-separators, ``?`` one non-separator, ``[..]`` classes with ranges and ``^``
    negation, ``\\`` escapes.  A malformed glob raises SpecError (it matches nothing)."""
    out, i, n = ["^"], 0, len(pattern)

    def lit(ch: str) -> str:
        return "\\x{%x}" % ord(ch)

    while i < n:
        ch = pattern[i]
        if ch == "*":
            out.append("[^/]*")
            i += 1
        elif ch == "?":
            out.append("[^/]")
            i += 1
        elif ch == "\\":
            if i + 1 >= n:
                raise SpecError(f"bad glob {pattern!r}")
            out.append(lit(pattern[i + 1]))
            i += 2
        elif ch == "[":
            i += 1
            neg = i < n and pattern[i] == "^"
            if neg:
                i += 1
            parts, first = [], True
            while True:
                if i >= n:
                    raise SpecError(f"bad glob {pattern!r}")
                if pattern[i] == "]" and not first:
                    i += 1
                    break
                first = False
                lo = pattern[i]
                if lo == "\\":
                    if i + 1 >= n:
                        raise SpecError(f"bad glob {pattern!r}")
                    lo = pattern[i + 1]
                    i += 1
                elif lo in "-]":
                    raise SpecError(f"bad glob {pattern!r}")
                i += 1
                if i < n and pattern[i] == "-":
                    i += 1
                    if i >= n:
                        raise SpecError(f"bad glob {pattern!r}")
                    hi = pattern[i]
                    if hi == "\\":
                        if i + 1 >= n:
                            raise SpecError(f"bad glob {pattern!r}")
                        hi = pattern[i + 1]
                        i += 1
                    elif hi in "-]":
                        raise SpecError(f"bad glob {pattern!r}")
                    i += 1
                    parts.append(lit(lo) + "-" + lit(hi))
                else:
                    parts.append(lit(lo))
            out.append("[" + ("^" if neg else "") + "".join(parts) + "]")
        else:
            out.append(lit(ch))
            i += 1
    out.append("\\z")
    return "(?s)" + "".join(out)


def clean_path(p: str) -> str:
    """Lexical clean of a configured path (``a//b/./c/`` → ``a/b/c``), as joins of the
    watched directory with a base name produce it."""
    if "://" in p:
        scheme, rest = p.split("://", 1)
        return scheme + "://" + posixpath.normpath(rest) if rest else p
    return posixpath.normpath(p) if p else "."


def join_path(directory: str, name: str) -> str:
    return clean_path(directory.rstrip("/") + "/" + name) if directory else name


# ---------------------------------------------------------------------------
# Specs
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "String"
    source: str = ""
    layout: str = ""
    default: str = ""
    nullable: bool = False
    generated: bool = False
    comment: str = ""

    @property
    def base_type(self) -> str:
        return normalize_type(self.type)

    @property
    def input_name(self) -> str:
        """Row key the field reads from (its source if set)."""
        return self.source or self.name

    def struct_field(self) -> T.StructField:
        meta = {"comment": self.comment} if self.comment else {}
        return T.StructField(self.name, spark_type(self.base_type), True, meta)


@dataclass(frozen=True)
class DedupSpec:
    enabled: bool = False
    record_id_field: str = "_etl_record_id"
    source_file_field: str = "_etl_source_file"
    line_number_field: str = "_etl_line_number"
    row_hash_field: str = "_etl_row_hash"


@dataclass(frozen=True)
class TransformSpec:
    """One chain step.  ``type`` is ``ip_matcher``, ``dict_mapper`` or a name registered
    with ``filament.operators.chain.register``."""
    type: str
    fields: tuple[str, ...] = ()
    label_fields: tuple[str, ...] = ()
    field: str = ""
    dict: dict[str, str] | None = None
    dict_file: str = ""
    target: str = ""
    default: str = ""
    config: dict[str, Any] | None = None


READY_STRATEGIES = ("atomic_rename", "marker", "stable_size")


@dataclass
class PipelineSpec:
    name: str
    watch_dir: str
    table: str
    fields: list[FieldSpec]
    file_pattern: str = "*"
    ready_strategy: str = "atomic_rename"
    temp_suffixes: tuple[str, ...] = (".tmp", ".writing")
    marker_suffix: str = ".ok"
    stable_delay_s: float = 10.0
    delimiter: str = "|"
    has_header_meta: bool = False
    header_fields: list[FieldSpec] = field(default_factory=list)
    skip_header_lines: int = 0
    transformers: list[TransformSpec] = field(default_factory=list)
    retry_failed: bool = False
    max_retries: int = 3
    retry_interval_s: float = 60.0
    dead_letter_dir: str = ""
    archive_dir: str = ""
    cleanup_marker: bool = False
    dedup: DedupSpec = field(default_factory=DedupSpec)
    # Spark-side options (no counterpart in the reference)
    event_time_field: str = ""          # month partition column source (K2)
    sort_fields: tuple[str, ...] = ()   # storage ordering within files (O2)
    max_line_bytes: int | None = None   # a longer line fails its file; off by default
    max_header_bytes: int | None = None  # a longer first line gives no metadata; off by default

    def __post_init__(self) -> None:
        self.fields = [f if isinstance(f, FieldSpec) else FieldSpec(**f) for f in self.fields]
        self.header_fields = [f if isinstance(f, FieldSpec) else FieldSpec(**f) for f in self.header_fields]
        self.transformers = [t if isinstance(t, TransformSpec) else TransformSpec(**t) for t in self.transformers]
        if isinstance(self.dedup, dict):
            self.dedup = DedupSpec(**self.dedup)
        if self.max_retries == 0:
            self.max_retries = 3
        if not self.file_pattern:
            self.file_pattern = "*"
        if not self.delimiter:
            self.delimiter = "|"
        if not self.ready_strategy:
            self.ready_strategy = "atomic_rename"
        if not self.marker_suffix:
            self.marker_suffix = ".ok"
        if not self.temp_suffixes:
            self.temp_suffixes = (".tmp", ".writing")
        self.temp_suffixes = tuple(self.temp_suffixes)
        self.skip_header_lines = max(0, int(self.skip_header_lines))
        self.validate()

    def validate(self) -> None:
        if not self.name:
            raise SpecError("pipeline name is required")
        if not self.watch_dir:
            raise SpecError(f"pipeline {self.name}: watch_dir is required")
        if not self.table:
            raise SpecError(f"pipeline {self.name}: table is required")
        if not self.fields:
            raise SpecError(f"pipeline {self.name}: at least one field is required")
        for f in list(self.header_fields) + list(self.fields):
            if not f.name:
                raise SpecError(f"pipeline {self.name}: field name is required")
            if not f.type:
                raise SpecError(f"pipeline {self.name}: field {f.name} type is required")
        if self.has_header_meta and not self.header_fields:
            raise SpecError(f"pipeline {self.name}: header_fields required when has_header_meta is set")
        if self.max_retries < 0:
            raise SpecError(f"pipeline {self.name}: max_retries must be >= 0")
        if self.retry_interval_s < 0:
            raise SpecError(f"pipeline {self.name}: retry_interval must be >= 0")
        if self.ready_strategy not in READY_STRATEGIES:
            raise SpecError(f"pipeline {self.name}: unknown ready_strategy {self.ready_strategy!r}")
        glob_to_regex(self.file_pattern)
        for f in list(self.header_fields) + list(self.fields):
            if f.base_type in TIME_TYPES and f.layout:
                go_layout_to_pattern(f.layout)
        if self.ready_strategy != "marker" and self.cleanup_marker:
            warnings.warn(f"pipeline {self.name}: cleanup_marker has no effect without the marker strategy")
        if self.file_pattern == "*" and self.ready_strategy == "atomic_rename":
            warnings.warn(f"pipeline {self.name}: pattern '*' also ingests marker files as data")
        if self.has_header_meta and self.skip_header_lines > 0:
            warnings.warn(f"pipeline {self.name}: the header line is already skipped; skip_header_lines "
                          f"={self.skip_header_lines} drops that many further lines")

    # -- derived names (§ schema rules) --------------------------------------
    @property
    def input_names(self) -> list[str]:
        """Positional names of the split parts: non-generated fields, by source if set."""
        return [f.input_name for f in self.fields if not f.generated]

    @property
    def output_fields(self) -> list[FieldSpec]:
        return list(self.header_fields) + list(self.fields)

    @property
    def skip_lines(self) -> int:
        return self.skip_header_lines + (1 if self.has_header_meta else 0)

    @property
    def watch_dir_clean(self) -> str:
        return clean_path(self.watch_dir)

    @property
    def needs_line_numbers(self) -> bool:
        return self.skip_lines > 0 or self.dedup.enabled

    def output_schema(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.output_fields])
