"""Registered queries: one per operator of the inventory, each with a DuckDB oracle.

Every query reads the driver tables (``events``, ``customer``, ``orders``,
``lineitem``, ``nation``, ``documents``) through ``filament.plans.derived`` and runs
the real operator on Spark; the oracle recomputes the expected rows in plain SQL.
Time columns leave as ``TIMESTAMP_NTZ`` (wall clock in the session zone) so both
engines compare the same values.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filament.functions.casts import cast_field
from filament.functions.ip import ip_to_u32, u32_to_dotted
from filament.functions.text import WHITE_SPACE, go_trim
from filament.operators import ledger as L
from filament.operators.chain import ChainContext, TRANSFORM_ERROR, apply_chain, register
from filament.operators.dedup import dedup_rows
from filament.operators.dictmap import dict_map
from filament.operators.iplookup import bucketed_ranges, ip_enrich, lookup
from filament.operators.merge import header_columns, header_merge, static_merge
from filament.operators.provenance import add_provenance, record_id, row_hash
from filament.operators.ready import ready_files
from filament.operators.report import agg_count, agg_extent, counters_from_ledger, throughput_from_ledger
from filament.operators.size import frame_bytes
from filament.operators.split import positional_fields, split_line, split_literal, split_quoted
from filament.operators.typed import typed_projection, typed_with_errors
from filament.operators.verdict import file_verdict, verdict_for_files
from filament.plans import derived as D
from filament.plans.ingest import error_message, parse, typed_rows, with_messages
from filament.sinks.table import MONTH_COL, read_table, write_run
from filament.session import shared_dir
from filament.sources.dictionary import dict_from_lines
from filament.sources.ipdb import ranges_from_lines
from filament.sources.lines import lines_from_frame, number_by_key, number_scanned
from filament.spec import DedupSpec, FieldSpec, PipelineSpec, TransformSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


#: file names (about 100 bytes each) that a query broadcasts at most
BROADCAST_FILES = 100_000


def prep(spark: SparkSession) -> None:
    # Wall-clock semantics of the derived text: parse and print in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (DuckDB TIMESTAMP) for comparison."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# SQL building blocks (DuckDB)
# ---------------------------------------------------------------------------

WS = "(" + "||".join(f"chr({ord(c)})" for c in WHITE_SPACE) + ")"


def TRIM(x: str) -> str:
    return f"trim({x}, {WS})"


def DOTTED(n: str) -> str:
    return " || '.' || ".join(f"(({n} >> {s}) & 255)::VARCHAR" for s in (24, 16, 8, 0))


def IPINT(t: str) -> str:
    """Dotted text → integer (inputs are valid dotted quads)."""
    return " + ".join(f"split_part({t}, '.', {i + 1})::BIGINT * {256 ** (3 - i)}" for i in range(4))


EV = f"""
ev AS (
  SELECT event_id, user_id,
         '/in/f' || (event_id % 20)::VARCHAR || '.log' AS path,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
         (event_id % 1000003) * 2246822519 % 4294967296 AS src_n,
         (user_id % 1000003) * 2654435761 % 4294967296 AS dst_n,
         event_type,
         ((event_id % 7) + 1)::VARCHAR AS code,
         (event_id % 600)::VARCHAR AS status
  FROM events),
evt AS (
  SELECT *, {DOTTED('src_n')} AS src, {DOTTED('dst_n')} AS dst FROM ev),
hdr_lines AS (
  SELECT DISTINCT '/in/f' || (event_id % 20)::VARCHAR || '.log' AS path, -1::BIGINT AS ord,
         'probe-' || lpad((event_id % 20)::VARCHAR, 3, '0') || '|' ||
         (['south', 'east', 'north', 'west'])[((event_id % 20) % 4 + 1)::INTEGER] AS line
  FROM events),
feed AS (
  SELECT path, event_id AS ord, ts_text || '|' || src || '|' || dst || '|' || event_type || '|' || code || '|' || status AS line
  FROM evt
  UNION ALL SELECT path, ord, line FROM hdr_lines),
num AS (
  SELECT path, ord, line, row_number() OVER (PARTITION BY path ORDER BY ord) AS line_no FROM feed)"""

RANGES = """
rng AS (
  SELECT (c_custkey % 1000003) * 2654435761 % 4294967296 AS rs,
         least((c_custkey % 1000003) * 2654435761 % 4294967296 + (c_custkey % 7) * 1000000, 4294967295) AS re,
         c_mktsegment AS segment, c_nationkey::VARCHAR AS nation
  FROM customer)"""


def _ranges_ctx(spark: SparkSession, sf_dir: str) -> ChainContext:
    """The customer-derived IP table, bucketed (a dimension table, counted before it is
    broadcast)."""
    table = bucketed_ranges(D.customer_ranges(spark, sf_dir))
    return ChainContext(ip_table=table, ip_attrs=list(D.RANGE_ATTRS), ip_table_bytes=frame_bytes(table))


# ---------------------------------------------------------------------------
# Flagship: the whole chain over the derived feed
# ---------------------------------------------------------------------------

def publishable(typed: DataFrame) -> DataFrame:
    """Rows of files without any error (all-or-nothing per file).  The bad files are counted, and
    broadcast unless there are very many, so the rows aren't shuffled on a few file names."""
    bad = typed.filter(F.col("_err_field").isNotNull()).select("_file").distinct()
    return typed.join(F.broadcast(bad) if bad.count() <= BROADCAST_FILES else bad, "_file", "left_anti")


def ingest_events_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: the whole chain over the derived feed.  The typed rows are staged
    once in the shared checkpoint folder (as ``run_once`` does), so the per-file
    all-or-nothing filter reads staged columns instead of re-running the chain."""
    import uuid
    prep(spark)
    spec = D.events_spec()
    parsed = parse(D.event_feed(spark, sf_dir), spec, _ranges_ctx(spark, sf_dir))
    stage = shared_dir(spark, f"query-stage/ingest-events-{uuid.uuid4().hex[:12]}")
    typed_rows(parsed, spec).write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    good = publishable(staged).filter(F.col("_terr").isNull())
    return ntz(good.select(*[f.name for f in spec.output_fields]))


INGEST_SQL = f"""
WITH {EV}, {RANGES},
hdr AS (SELECT path, split_part(line, '|', 1) AS probe_id, split_part(line, '|', 2) AS region FROM num WHERE line_no = 1),
r0 AS (
  SELECT n.path, n.line_no, n.line, h.probe_id, h.region,
         split_part(n.line, '|', 1) AS ts_t, split_part(n.line, '|', 2) AS src_t, split_part(n.line, '|', 3) AS dst_t,
         split_part(n.line, '|', 4) AS event_type, split_part(n.line, '|', 5) AS code, split_part(n.line, '|', 6) AS status
  FROM num n JOIN hdr h USING (path) WHERE n.line_no > 1),
r1 AS (SELECT *, {IPINT('src_t')} AS src_n, {IPINT('dst_t')} AS dst_n FROM r0),
s AS (SELECT r1.*, CASE WHEN r1.src_n <= sr.re THEN sr.segment END AS sseg, CASE WHEN r1.src_n <= sr.re THEN sr.nation END AS snat
      FROM r1 ASOF LEFT JOIN rng sr ON r1.src_n >= sr.rs),
d AS (SELECT s.*, CASE WHEN s.dst_n <= dr.re THEN dr.segment END AS dseg, CASE WHEN s.dst_n <= dr.re THEN dr.nation END AS dnat
      FROM s ASOF LEFT JOIN rng dr ON s.dst_n >= dr.rs)
SELECT probe_id, region, strptime(ts_t, '%Y-%m-%d %H:%M:%S')::TIMESTAMP AS event_time,
       src_t AS src_ip, dst_t AS dst_ip, event_type,
       CASE code WHEN '1' THEN 'A' WHEN '2' THEN 'NS' WHEN '3' THEN 'CNAME' WHEN '4' THEN 'MX' WHEN '5' THEN 'AAAA' ELSE code END AS dns_type,
       status::INTEGER AS response_code,
       coalesce(sseg, '') AS src_geo_segment, coalesce(snat, '') AS src_geo_nation,
       coalesce(dseg, '') AS dst_geo_segment, coalesce(dnat, '') AS dst_geo_nation,
       line_no::BIGINT AS _etl_line_number,
       sha1(path || chr(0) || line_no::VARCHAR || chr(0) || sha1(line) || chr(0)) AS _etl_record_id
FROM d"""

query("ingest_events", INGEST_SQL)(ingest_events_df)


# ---------------------------------------------------------------------------
# Real text scan of the document files
# ---------------------------------------------------------------------------

DOCS = f"""
dl AS (
  SELECT doc_id % 64 AS file_key, doc_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS raw
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
dl2 AS (
  SELECT file_key, doc_id, pos, regexp_replace(raw, '\\r$', '') AS raw FROM dl),
dl3 AS (
  SELECT file_key, doc_id, pos, raw, {TRIM('raw')} AS line FROM dl2 WHERE {TRIM('raw')} <> ''),
dn AS (
  SELECT file_key, raw, line, row_number() OVER (PARTITION BY file_key ORDER BY doc_id, pos) AS line_no FROM dl3)"""


@query("scan_lines", f"WITH {DOCS} SELECT file_key, line FROM dn")
def q_scan_lines(spark, sf_dir):
    prep(spark)
    return D.document_lines(spark, sf_dir).select("file_key", F.col("_line").alias("line"))


@query("line_numbers", f"WITH {DOCS} SELECT file_key, line_no, line, sha1(raw) AS raw_hash FROM dn")
def q_line_numbers(spark, sf_dir):
    prep(spark)
    n = number_scanned(D.document_lines(spark, sf_dir))
    return n.select("file_key", F.col("_line_no").alias("line_no"), F.col("_line").alias("line"),
                    row_hash(F.col("_raw")).alias("raw_hash"))


@query("skip_lines", f"WITH {DOCS} SELECT file_key, line_no, line FROM dn WHERE line_no > 5")
def q_skip_lines(spark, sf_dir):
    prep(spark)
    n = number_scanned(D.document_lines(spark, sf_dir))
    return n.filter(F.col("_line_no") > 5).select("file_key", F.col("_line_no").alias("line_no"),
                                                   F.col("_line").alias("line"))


# S1, P4 over lines that are not UTF-8: hashes are those of the bytes in the file.
@query("row_hash_bytes", """
SELECT event_id % 64 AS file_key, row_number() OVER (PARTITION BY event_id % 64 ORDER BY event_id) AS line_no,
       sha1(encode(event_id::VARCHAR || '|' || event_type) || unhex('D6') || unhex(printf('%02X', event_id % 100 + 128))) AS row_hash
FROM events""")
def q_row_hash_bytes(spark, sf_dir):
    prep(spark)
    n = number_scanned(D.byte_lines(spark, sf_dir), with_head=False)
    return n.select(F.col("file_key").cast("long").alias("file_key"), F.col("_line_no").alias("line_no"), row_hash(F.col("_raw")).alias("row_hash"))


# A3: rows per file, left-joined from the file list (files with an odd number have no data
# lines, and every file's first line is skipped as a header).
ROWS_PER_FILE_SQL = """
WITH files AS (SELECT DISTINCT '/in/g' || (event_id % 48)::VARCHAR || '.log' AS file_path FROM events),
l AS (SELECT '/in/g' || (event_id % 24 * 2)::VARCHAR || '.log' AS file_path,
             row_number() OVER (PARTITION BY event_id % 24 ORDER BY event_id) AS line_no
      FROM events)
SELECT f.file_path, count(l.line_no) FILTER (WHERE l.line_no > 1)::BIGINT AS rows
FROM files f LEFT JOIN l USING (file_path) GROUP BY f.file_path"""


@query("rows_per_file", ROWS_PER_FILE_SQL)
def q_rows_per_file(spark, sf_dir):
    prep(spark)
    ev = D.table(spark, sf_dir, "events")
    path = lambda n: F.concat(F.lit("/in/g"), n.cast("string"), F.lit(".log"))
    files = ev.select(path(F.col("event_id") % 48).alias("_file")).distinct()
    lines = lines_from_frame(ev, path(F.col("event_id") % 24 * 2), F.col("event_type"), F.col("event_id"))
    n = number_by_key(lines)
    counts = n.filter(F.col("_line_no") > 1).groupBy("_file").agg(F.count(F.lit(1)).alias("rows"))
    return verdict_for_files(files, counts).select(F.col("_file").alias("file_path"), "rows")


# ---------------------------------------------------------------------------
# splitting
# ---------------------------------------------------------------------------

# Lines: ts | "type|x" | props (JSON with quotes) | 'user id' | code, and for event_id
# % 11 = 0 a trailing unquoted it's|x|y whose apostrophe swallows the rest of the line.
SPLIT_SQL = f"""
WITH b AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, event_type, props, user_id
  FROM events)
SELECT event_id,
       t AS f1, event_type || '|x' AS f2, props AS f3,
       'u ' || user_id::VARCHAR AS f4,
       CASE WHEN event_id % 11 = 0 THEN 'it''s|x|y' ELSE ((event_id % 7) + 1)::VARCHAR END AS f5,
       CASE WHEN event_id % 11 = 0 THEN 5 ELSE 5 END::INTEGER AS n_parts
FROM b"""


def _split_lines(spark, sf_dir):
    ev = D.table(spark, sf_dir, "events")
    code = ((F.col("event_id") % 7) + 1).cast("string")
    last = F.when(F.col("event_id") % 11 == 0, F.lit("it's|x|y")).otherwise(code)
    line = F.concat_ws("|", D.ts_text(F.col("ts")), F.concat(F.lit('"'), F.col("event_type"), F.lit('|x"')),
                       F.col("props"), F.concat(F.lit("' u "), F.col("user_id").cast("string"), F.lit(" '")), last)
    return ev.select("event_id", "user_id", line.alias("line"))


@query("split_quoted", SPLIT_SQL)
def q_split_quoted(spark, sf_dir):
    prep(spark)
    df = _split_lines(spark, sf_dir).withColumn("p", split_quoted(F.col("line"), "|"))
    return df.select("event_id", *[F.get("p", i).alias(f"f{i + 1}") for i in range(3)],
                     F.get("p", 3).alias("f4"), F.get("p", 4).alias("f5"), F.size("p").alias("n_parts"))


SPLIT_LITERAL_SQL = f"""
WITH {EV}
SELECT event_id, ts_text AS a, src AS b, dst AS c, event_type AS d, code AS e, status AS f,
       '"' || event_type || '"' AS g, 7::INTEGER AS n_parts
FROM evt"""


@query("split_literal", SPLIT_LITERAL_SQL)
def q_split_literal(spark, sf_dir):
    prep(spark)
    f = D.event_fields(D.table(spark, sf_dir, "events"))
    line = F.concat_ws("|++|", "ts_text", "src", "dst", "event_type", "code", "status",
                       F.concat(F.lit(' "'), F.col("event_type"), F.lit('" ')))
    p = split_literal(line, "|++|")
    return f.select("event_id", *[F.get(p, i).alias(n) for i, n in enumerate("abcdefg")],
                    F.size(p).alias("n_parts"))


POSITIONAL_SQL = f"""
WITH {EV}
SELECT event_id, ts_text AS t, src AS s, dst AS d, '' AS extra1, '' AS extra2,
       ts_text AS t2, src AS s2
FROM evt"""


@query("positional_fields", POSITIONAL_SQL)
def q_positional(spark, sf_dir):
    prep(spark)
    f = D.event_fields(D.table(spark, sf_dir, "events"))
    short = F.concat_ws("|", "ts_text", "src", "dst")
    full = F.concat_ws("|", "ts_text", "src", "dst", "event_type", "code")
    a = positional_fields(f.select("event_id", short.alias("l1"), full.alias("l2")),
                          F.col("l1"), ["t", "s", "d", "extra1", "extra2"], "|")
    b = positional_fields(a, F.col("l2"), ["t2", "s2"], "|")
    return b.select("event_id", "t", "s", "d", "extra1", "extra2", "t2", "s2")


# ---------------------------------------------------------------------------
# Header metadata and merges
# ---------------------------------------------------------------------------

HEADER_SQL = f"""
WITH {EV},
hdr AS (SELECT path, split_part(line, '|', 1) AS h1, split_part(line, '|', 2) AS h2, split_part(line, '|', 3) AS h3
        FROM num WHERE line_no = 1)
SELECT n.path AS file_path, n.line_no, h.h1 AS ts, h.h2 AS region, h.h3 AS missing,
       split_part(n.line, '|', 2) AS src
FROM num n JOIN hdr h USING (path) WHERE n.line_no > 1"""


@query("header_merge", HEADER_SQL)
def q_header_merge(spark, sf_dir):
    prep(spark)
    n = number_by_key(D.event_feed(spark, sf_dir))
    rows = positional_fields(n.filter(F.col("_line_no") > 1), F.col("_line"), ["ts", "src"], "|")
    hdr = header_columns(F.col("_head_line"), F.col("_head_raw"), "|", ["ts", "region", "missing"])
    out = header_merge(rows, hdr)
    return out.select(F.col("_file").alias("file_path"), F.col("_line_no").alias("line_no"),
                      "ts", "region", "missing", "src")


STATIC_SQL = f"""
WITH {EV}
SELECT event_id, ts_text AS ts, 'dc-1' AS site, CASE WHEN event_id % 2 = 0 THEN '' ELSE 'k' END AS opt
FROM evt"""


@query("static_merge", STATIC_SQL)
def q_static_merge(spark, sf_dir):
    prep(spark)
    f = D.event_fields(D.table(spark, sf_dir, "events"))
    df = f.select("event_id", F.col("ts_text").alias("ts"),
                  F.when(F.col("event_id") % 2 == 0, F.lit("")).otherwise(F.lit(None)).alias("opt"))
    return static_merge(df, {"ts": "never", "site": "dc-1", "opt": "k"}).select("event_id", "ts", "site", "opt")


# ---------------------------------------------------------------------------
# Provenance and de-duplication
# ---------------------------------------------------------------------------

@query("row_hash", f"WITH {EV} SELECT path AS file_path, line_no, sha1(line || chr(13)) AS row_hash, sha1(line) AS hash_no_cr FROM num")
def q_row_hash(spark, sf_dir):
    prep(spark)
    ev = D.table(spark, sf_dir, "events")
    texts = D.event_lines_text(D.event_fields(ev)).unionByName(D.header_texts(ev))
    # CRLF lines: the trailing CR leaves the line before hashing; a second CR stays.
    crlf = texts.withColumn("text", F.concat("text", F.lit("\r\r")))
    n = number_by_key(lines_from_frame(crlf, F.col("path"), F.col("text"), F.col("event_id")))
    return n.select(F.col("_file").alias("file_path"), F.col("_line_no").alias("line_no"),
                    row_hash(F.col("_raw")).alias("row_hash"),
                    row_hash(F.regexp_replace("_raw", "\r\\z", "")).alias("hash_no_cr"))


RECORD_SQL = f"""
WITH {EV}
SELECT path AS file_path, line_no,
       sha1(path || chr(0) || line_no::VARCHAR || chr(0) || sha1(line) || chr(0)) AS record_id
FROM num"""


@query("record_id", RECORD_SQL)
def q_record_id(spark, sf_dir):
    prep(spark)
    n = number_by_key(D.event_feed(spark, sf_dir))
    return n.select(F.col("_file").alias("file_path"), F.col("_line_no").alias("line_no"),
                    record_id(F.col("_file"), F.col("_line_no").cast("string"), row_hash(F.col("_raw"))).alias("record_id"))


PROV_SQL = f"""
WITH {EV}
SELECT regexp_extract(path, '[^/]*$') AS _etl_source_file, line_no::VARCHAR AS _etl_line_number,
       sha1(line) AS _etl_row_hash,
       sha1(path || chr(0) || line_no::VARCHAR || chr(0) || sha1(line) || chr(0)) AS _etl_record_id
FROM num"""


@query("provenance", PROV_SQL)
def q_provenance(spark, sf_dir):
    prep(spark)
    n = number_by_key(D.event_feed(spark, sf_dir))
    p = add_provenance(n, DedupSpec(enabled=True))
    return p.select("_etl_source_file", "_etl_line_number", "_etl_row_hash", "_etl_record_id")


DEDUP_SQL = f"""
WITH {EV}
SELECT DISTINCT path AS file_path, line_no,
       sha1(path || chr(0) || line_no::VARCHAR || chr(0) || sha1(line) || chr(0)) AS record_id
FROM num"""


@query("dedup_rows", DEDUP_SQL)
def q_dedup_rows(spark, sf_dir):
    prep(spark)
    n = number_by_key(D.event_feed(spark, sf_dir))
    p = add_provenance(n, DedupSpec(enabled=True, record_id_field="record_id"))
    twice = p.unionByName(p)            # the same file ingested twice (a retried file)
    return dedup_rows(twice, "record_id").select(F.col("_file").alias("file_path"),
                                                F.col("_line_no").alias("line_no"), "record_id")


# ---------------------------------------------------------------------------
# Typed conversion
# ---------------------------------------------------------------------------

def _sql_int_check(t: str, signed: bool, lo: int, hi: int, sql_type: str, name: str) -> tuple[str, str]:
    func = "ParseInt" if signed else "ParseUint"
    grammar = "[+-]?[0-9]+" if signed else "[0-9]+"
    v = f"(CASE WHEN {t} = '' THEN '0' ELSE {t} END)"
    ok = f"regexp_full_match({v}, '{grammar}')"
    num = f"TRY_CAST({v} AS HUGEINT)"
    inr = f"({num} BETWEEN {lo} AND {hi})"
    val = f"CASE WHEN {ok} AND {inr} THEN {num}::{sql_type} END"
    err = (f"CASE WHEN NOT {ok} THEN 'field \"{name}\": strconv.{func}: parsing \"' || {v} || '\": invalid syntax' "
           f"WHEN NOT coalesce({inr}, false) THEN 'field \"{name}\": strconv.{func}: parsing \"' || {v} || '\": value out of range' END")
    return val, err


_INT_TYPES = [("u8", "UInt8", False, 0, 255, "SMALLINT"), ("i8", "Int8", True, -128, 127, "TINYINT"),
              ("u16", "UInt16", False, 0, 65535, "INTEGER"), ("i16", "Int16", True, -32768, 32767, "SMALLINT"),
              ("u32", "UInt32", False, 0, 4294967295, "BIGINT"), ("i32", "Int32", True, -2147483648, 2147483647, "INTEGER"),
              ("u64", "UInt64", False, 0, 18446744073709551615, "DECIMAL(20,0)"),
              ("i64", "Int64", True, -9223372036854775808, 9223372036854775807, "BIGINT")]

# Integer text from lineitem with injected forms: out of range, signs, spaces,
# exponent, leading zeros, empty, 20+ digit values.
INT_TEXT_SQL = """
CASE WHEN l_orderkey % 97 = 0 THEN '300'
     WHEN l_orderkey % 89 = 0 THEN '-5'
     WHEN l_orderkey % 83 = 0 THEN '+7'
     WHEN l_orderkey % 79 = 0 THEN ' 42 '
     WHEN l_orderkey % 73 = 0 THEN '1e3'
     WHEN l_orderkey % 71 = 0 THEN '007'
     WHEN l_orderkey % 67 = 0 THEN ''
     WHEN l_orderkey % 61 = 0 THEN '18446744073709551615'
     WHEN l_orderkey % 59 = 0 THEN '-9223372036854775809'
     WHEN l_orderkey % 53 = 0 THEN '000000000000000000000000000012'
     WHEN l_orderkey % 47 = 0 THEN (l_orderkey * 1000003)::VARCHAR
     ELSE (l_orderkey % 300 - 40)::VARCHAR END"""


def _int_text(c):
    k = F.col("l_orderkey")
    return (F.when(k % 97 == 0, "300").when(k % 89 == 0, "-5").when(k % 83 == 0, "+7").when(k % 79 == 0, " 42 ")
             .when(k % 73 == 0, "1e3").when(k % 71 == 0, "007").when(k % 67 == 0, "")
             .when(k % 61 == 0, "18446744073709551615").when(k % 59 == 0, "-9223372036854775809")
             .when(k % 53 == 0, "000000000000000000000000000012")
             .when(k % 47 == 0, (k * 1000003).cast("string"))
             .otherwise((k % 300 - 40).cast("string")))


def _cast_ints_sql() -> str:
    cols = []
    for short, typ, signed, lo, hi, st in _INT_TYPES:
        v, e = _sql_int_check("t", signed, lo, hi, st, short)
        cols += [f"{v} AS {short}", f"{e} AS {short}_err"]
    return (f"WITH b AS (SELECT l_orderkey, l_linenumber, {TRIM(INT_TEXT_SQL)} AS t FROM lineitem) "
            f"SELECT l_orderkey, l_linenumber, " + ", ".join(cols) + " FROM b")


@query("cast_ints", _cast_ints_sql())
def q_cast_ints(spark, sf_dir):
    prep(spark)
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _int_text(None).alias("t"))
    return typed_with_errors(li, [FieldSpec(short, typ, source="t") for short, typ, *_ in _INT_TYPES],
                             ["l_orderkey", "l_linenumber"])


FLOAT_TEXT_SQL = """
CASE WHEN l_orderkey % 97 = 0 THEN '1e400'
     WHEN l_orderkey % 89 = 0 THEN 'inf'
     WHEN l_orderkey % 83 = 0 THEN '-Infinity'
     WHEN l_orderkey % 79 = 0 THEN '1d'
     WHEN l_orderkey % 73 = 0 THEN '.5'
     WHEN l_orderkey % 71 = 0 THEN '5.'
     WHEN l_orderkey % 67 = 0 THEN ''
     WHEN l_orderkey % 61 = 0 THEN '0x1p-2'
     WHEN l_orderkey % 43 = 0 THEN '1_0.5e1_0'
     WHEN l_orderkey % 41 = 0 THEN '1__0'
     WHEN l_orderkey % 59 = 0 THEN '1e39'
     WHEN l_orderkey % 53 = 0 THEN '-2.5E-3'
     ELSE l_orderkey::VARCHAR || '.' || lpad((l_linenumber * 7 % 100)::VARCHAR, 2, '0') END"""


def _float_text():
    k = F.col("l_orderkey")
    return (F.when(k % 97 == 0, "1e400").when(k % 89 == 0, "inf").when(k % 83 == 0, "-Infinity")
             .when(k % 79 == 0, "1d").when(k % 73 == 0, ".5").when(k % 71 == 0, "5.").when(k % 67 == 0, "")
             .when(k % 61 == 0, "0x1p-2").when(k % 43 == 0, "1_0.5e1_0").when(k % 41 == 0, "1__0").when(k % 59 == 0, "1e39").when(k % 53 == 0, "-2.5E-3")
             .otherwise(F.concat(k.cast("string"), F.lit("."), F.lpad((F.col("l_linenumber") * 7 % 100).cast("string"), 2, "0"))))


def _float_sql(t: str, sql_type: str, name: str, max_abs: str) -> tuple[str, str]:
    dec = f"regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
    inf = f"regexp_full_match(lower({t}), '[+-]?inf(inity)?')"
    parsed = f"TRY_CAST({t} AS DOUBLE)"
    ok_range = f"(abs({parsed}) <= {max_abs})"
    odd = f"{t} IN ('0x1p-2', '1_0.5e1_0')"
    val = (f"CASE WHEN {t} = '0x1p-2' THEN 0.25 WHEN {t} = '1_0.5e1_0' THEN 10.5e10::{sql_type} WHEN {inf} THEN (CASE WHEN {t} LIKE '-%' THEN '-inf' ELSE 'inf' END)::{sql_type} "
           f"WHEN {dec} AND {ok_range} THEN TRY_CAST({t} AS {sql_type}) END")
    err = (f"CASE WHEN {odd} THEN NULL WHEN NOT ({dec} OR {inf}) THEN 'field \"{name}\": strconv.ParseFloat: parsing \"' || {t} || '\": invalid syntax' "
           f"WHEN {dec} AND NOT {ok_range} THEN 'field \"{name}\": strconv.ParseFloat: parsing \"' || {t} || '\": value out of range' END")
    return val, err


def _cast_floats_sql() -> str:
    v64, e64 = _float_sql("t", "DOUBLE", "f64", "1.7976931348623157e308")
    v32, e32 = _float_sql("t", "FLOAT", "f32", "3.4028235677973366e38")
    return (f"WITH b AS (SELECT l_orderkey, l_linenumber, {TRIM(FLOAT_TEXT_SQL)} AS t FROM lineitem) "
            f"SELECT l_orderkey, l_linenumber, {v64} AS f64, {e64} AS f64_err, {v32} AS f32, {e32} AS f32_err FROM b")


@query("cast_floats", _cast_floats_sql())
def q_cast_floats(spark, sf_dir):
    prep(spark)
    li = D.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _float_text().alias("t"))
    return typed_with_errors(li, [FieldSpec("f64", "Float64", source="t"), FieldSpec("f32", "Float32", source="t")],
                             ["l_orderkey", "l_linenumber"])


BOOL_SQL = f"""
WITH b AS (
  SELECT o_orderkey,
         {TRIM('''CASE WHEN o_orderkey % 7 = 0 THEN 'True' WHEN o_orderkey % 11 = 0 THEN 'tRUE'
                   WHEN o_orderkey % 13 = 0 THEN ' 1 ' WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN 'yes'
                   WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'true' ELSE 'f' END''')} AS t
  FROM orders)
SELECT o_orderkey,
       CASE WHEN t = '' THEN false WHEN t IN ('1','t','T','TRUE','true','True') THEN true
            WHEN t IN ('0','f','F','FALSE','false','False') THEN false END AS ok,
       CASE WHEN t NOT IN ('', '1','t','T','TRUE','true','True','0','f','F','FALSE','false','False')
            THEN 'field "ok": strconv.ParseBool: parsing "' || t || '": invalid syntax' END AS ok_err
FROM b"""


@query("cast_bool", BOOL_SQL)
def q_cast_bool(spark, sf_dir):
    prep(spark)
    o = D.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    t = (F.when(k % 7 == 0, "True").when(k % 11 == 0, "tRUE").when(k % 13 == 0, " 1 ").when(k % 17 == 0, "")
          .when(k % 19 == 0, "yes").when(F.col("o_orderstatus") == "F", "F")
          .when(F.col("o_orderstatus") == "O", "true").otherwise("f"))
    v, e = cast_field(t, FieldSpec("ok", "Bool"))
    return o.select("o_orderkey", v.alias("ok"), e.alias("ok_err"))


TIME_TEXT_SQL = """
CASE WHEN o_orderkey % 97 = 0 THEN '1995-02-30 10:00:00'
     WHEN o_orderkey % 89 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 9:05:01'
     WHEN o_orderkey % 83 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.25'
     WHEN o_orderkey % 79 = 0 THEN ''
     WHEN o_orderkey % 73 = 0 THEN 'not a time'
     WHEN o_orderkey % 71 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
     WHEN o_orderkey % 67 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:11:12Z'
     WHEN o_orderkey % 61 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T10:11:12.123456+02:00'
     WHEN o_orderkey % 59 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ',5'
     WHEN o_orderkey % 53 = 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123456789123'
     ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') END"""


def _time_text():
    k = F.col("o_orderkey")
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    full = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    shifted = F.date_format(F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86400).cast("decimal(18,6)")),
                            "yyyy-MM-dd HH:mm:ss")
    return (F.when(k % 97 == 0, "1995-02-30 10:00:00").when(k % 89 == 0, F.concat(d, F.lit(" 9:05:01")))
             .when(k % 83 == 0, F.concat(full, F.lit(".25"))).when(k % 79 == 0, "").when(k % 73 == 0, "not a time")
             .when(k % 71 == 0, d).when(k % 67 == 0, F.concat(d, F.lit("T10:11:12Z")))
             .when(k % 61 == 0, F.concat(d, F.lit("T10:11:12.123456+02:00"))).when(k % 59 == 0, F.concat(full, F.lit(",5")))
             .when(k % 53 == 0, F.concat(full, F.lit(".123456789123"))).otherwise(shifted))


def _cast_times_sql() -> str:
    plain = "regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{1,2}:[0-9]{2}:[0-9]{2}([.,][0-9]+)?')"
    padded = "regexp_replace(regexp_replace(t, ' ([0-9]):', ' 0\\1:'), '[.,]([0-9]{1,6})[0-9]*$', '.\\1')"
    with_layout = f"CASE WHEN t = '' THEN TIMESTAMP '0001-01-01 00:00:00' WHEN {plain} THEN TRY_CAST({padded} AS TIMESTAMP) END"
    rfc = "regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{1,2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})')"
    date_only = "regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
    local = "TRY_CAST(replace(regexp_extract(t, '^(.*?)(Z|[+-][0-9]{2}:[0-9]{2})$', 1), 'T', ' ') AS TIMESTAMP)"
    off = "regexp_extract(t, '(Z|[+-][0-9]{2}:[0-9]{2})$', 1)"
    off_s = (f"(CASE WHEN {off} = 'Z' THEN 0 ELSE (CASE WHEN {off} LIKE '-%' THEN -1 ELSE 1 END) * "
             f"(substr({off}, 2, 2)::INTEGER * 3600 + substr({off}, 5, 2)::INTEGER * 60) END)")
    rfc_val = f"({local} - to_seconds({off_s}))"
    no_layout = (f"CASE WHEN t = '' THEN TIMESTAMP '0001-01-01 00:00:00' WHEN {rfc} THEN {rfc_val} "
                 f"WHEN {plain} THEN TRY_CAST({padded} AS TIMESTAMP) WHEN {date_only} THEN TRY_CAST(t AS TIMESTAMP) END")
    return f"""
WITH b AS (SELECT o_orderkey, date_trunc('day', o_orderdate) + to_seconds(o_orderkey % 86400) AS compact, {TRIM(TIME_TEXT_SQL)} AS t FROM orders),
c AS (SELECT o_orderkey, t, compact, {with_layout} AS a, {no_layout} AS b FROM b)
SELECT o_orderkey, compact AS dt_compact,
       date_trunc('second', a) AS dt_layout,
       CASE WHEN a IS NULL THEN 'field "dt_layout": parsing time "' || t || '" as "2006-01-02 15:04:05": cannot parse' END AS dt_layout_err,
       b AS dt64_auto,
       CASE WHEN b IS NULL THEN 'field "dt64_auto": invalid time "' || t || '"' END AS dt64_auto_err,
       b::DATE AS d_auto
FROM c"""


@query("cast_times", _cast_times_sql())
def q_cast_times(spark, sf_dir):
    prep(spark)
    at = F.date_trunc("day", "o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))
    o = D.table(spark, sf_dir, "orders").select("o_orderkey", _time_text().alias("t"), F.date_format(at, "yyyyMMddHHmmss").alias("c"))
    t = typed_with_errors(o, [FieldSpec("dt_compact", "DateTime", layout="20060102150405", source="c"), FieldSpec("dt_layout", "DateTime", layout="2006-01-02 15:04:05", source="t"),
                              FieldSpec("dt64_auto", "DateTime64(6)", source="t"), FieldSpec("d_auto", "Date", source="t")],
                          ["o_orderkey"])
    return ntz(t.drop("d_auto_err", "dt_compact_err"))


IP_TEXT_SQL = f"""
CASE WHEN o_orderkey % 13 = 0 THEN '0' || {DOTTED('(o_orderkey * 2654435761) % 4294967296')}
     WHEN o_orderkey % 11 = 0 THEN '::ffff:' || {DOTTED('(o_orderkey * 2654435761) % 4294967296')}
     WHEN o_orderkey % 7 = 0 AND o_orderkey % 3 = 0 THEN '2001:db8::' || lower(printf('%x', o_orderkey % 65536))
     WHEN o_orderkey % 7 = 0 AND o_orderkey % 3 = 1 THEN '2001:DB8:0:00:000:0000:0:' || upper(printf('%x', o_orderkey % 65536))
     WHEN o_orderkey % 7 = 0 THEN '0:0:1::' || lower(printf('%x', o_orderkey % 65536)) || ':0:0'
     WHEN o_orderkey % 5 = 0 THEN (o_orderkey * 2654435761 % 4294967296)::VARCHAR
     WHEN o_orderkey % 17 = 0 THEN '256.1.2.3'
     WHEN o_orderkey % 19 = 0 THEN ''
     ELSE {DOTTED('(o_orderkey * 2654435761) % 4294967296')} END"""


def _ip_text():
    k = F.col("o_orderkey")
    n = (k * 2654435761) % 4294967296
    dotted = u32_to_dotted(n)
    return (F.when(k % 13 == 0, F.concat(F.lit("0"), dotted)).when(k % 11 == 0, F.concat(F.lit("::ffff:"), dotted))
             .when((k % 7 == 0) & (k % 3 == 0), F.concat(F.lit("2001:db8::"), F.lower(F.hex(k % 65536))))
             .when((k % 7 == 0) & (k % 3 == 1), F.concat(F.lit("2001:DB8:0:00:000:0000:0:"), F.hex(k % 65536)))
             .when(k % 7 == 0, F.concat(F.lit("0:0:1::"), F.lower(F.hex(k % 65536)), F.lit(":0:0")))
             .when(k % 5 == 0, n.cast("string")).when(k % 17 == 0, "256.1.2.3").when(k % 19 == 0, "")
             .otherwise(dotted))


# What each form of IP_TEXT_SQL must become, stated form by form.
CAST_IP_SQL = f"""
WITH b AS (SELECT o_orderkey AS k, {IP_TEXT_SQL} AS t, lower(printf('%x', o_orderkey % 65536)) AS h,
                  {DOTTED('(o_orderkey * 2654435761) % 4294967296')} AS dotted FROM orders),
c AS (SELECT k, t, CASE
        WHEN k % 13 = 0 THEN NULL
        WHEN k % 11 = 0 THEN dotted
        WHEN k % 7 = 0 AND k % 3 < 2 THEN '2001:db8::' || CASE WHEN h = '0' THEN '' ELSE h END
        WHEN k % 7 = 0 AND h = '0' THEN '0:0:1::'
        WHEN k % 7 = 0 THEN '::1:0:0:' || h || ':0:0'
        WHEN k % 5 = 0 OR k % 17 = 0 OR k % 19 = 0 THEN NULL
        ELSE dotted END AS ip FROM b)
SELECT k AS o_orderkey, ip, CASE WHEN ip IS NULL THEN 'field "ip": invalid IP "' || t || '"' END AS ip_err
FROM c"""


@query("cast_ip", CAST_IP_SQL)
def q_cast_ip(spark, sf_dir):
    prep(spark)
    o = D.table(spark, sf_dir, "orders").select("o_orderkey", _ip_text().alias("t"))
    v, e = cast_field(F.col("t"), FieldSpec("ip", "IPv4"))
    return o.select("o_orderkey", v.alias("ip"), e.alias("ip_err"))


IP_TO_INT_SQL = """
WITH b AS (SELECT o_orderkey AS k, (o_orderkey * 2654435761) % 4294967296 AS n FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN n WHEN k % 7 = 0 THEN NULL WHEN k % 5 = 0 THEN n
                             WHEN k % 17 = 0 OR k % 19 = 0 THEN NULL ELSE n END::BIGINT AS ip_int
FROM b"""


@query("ip_to_int", IP_TO_INT_SQL)
def q_ip_to_int(spark, sf_dir):
    prep(spark)
    o = D.table(spark, sf_dir, "orders").select("o_orderkey", _ip_text().alias("t"))
    return o.select("o_orderkey", ip_to_u32(go_trim(F.col("t"))).alias("ip_int"))


# P9 + P10 + P11: declared output order, source rename, defaults and nullable.
TYPED_SQL = """
WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
         CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE (o_custkey % 1000)::VARCHAR END AS qty_t,
         CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d_t
  FROM orders)
SELECT 'orders' AS src_table,
       o_orderkey::BIGINT AS order_key,
       o_orderstatus AS status,
       CASE WHEN qty_t = '' THEN 7 ELSE qty_t::INTEGER END AS qty_default,
       CASE WHEN qty_t = '' THEN NULL ELSE qty_t::INTEGER END AS qty_nullable,
       CASE WHEN d_t = '' THEN NULL ELSE d_t::TIMESTAMP END AS when_nullable,
       CASE WHEN d_t = '' THEN TIMESTAMP '0001-01-01 00:00:00' ELSE d_t::TIMESTAMP END AS when_zero,
       o_orderpriority AS priority,
       '' AS absent_text,
       0::BIGINT AS absent_int
FROM b"""


def _typed_spec() -> list[FieldSpec]:
    return [FieldSpec("src_table", "String", default="orders"),
            FieldSpec("order_key", "UInt32", source="k"),
            FieldSpec("status", "FixedString(1)", source="st"),
            FieldSpec("qty_default", "Int32", source="qty", default="7"),
            FieldSpec("qty_nullable", "Nullable(Int32)", source="qty", nullable=True),
            FieldSpec("when_nullable", "Nullable(DateTime)", source="d", nullable=True),
            FieldSpec("when_zero", "DateTime", source="d"),
            FieldSpec("priority", "LowCardinality(String)", source="prio"),
            FieldSpec("absent_text", "String", source="nope"),
            FieldSpec("absent_int", "Int64", source="nope2")]


def _typed_input(spark, sf_dir):
    o = D.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("k"), F.col("o_orderstatus").alias("st"),
        F.when(k % 5 == 0, F.lit(" ")).otherwise((F.col("o_custkey") % 1000).cast("string")).alias("qty"),
        F.when(k % 3 == 0, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("d"),
        F.col("o_orderpriority").alias("prio"))


@query("typed_projection", TYPED_SQL)
def q_typed_projection(spark, sf_dir):
    prep(spark)
    t = typed_projection(_typed_input(spark, sf_dir), _typed_spec())
    return ntz(t.drop("_error"))


DEFAULTS_SQL = """
WITH b AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE (o_orderkey % 50)::VARCHAR END AS t FROM orders)
SELECT o_orderkey,
       CASE WHEN t = '' THEN 7 ELSE t::INTEGER END AS with_default,
       CASE WHEN t = '' THEN NULL ELSE t::INTEGER END AS nullable_int,
       CASE WHEN t = '' THEN 'n/a' ELSE t END AS text_default,
       CASE WHEN t = '' THEN NULL ELSE t::DOUBLE END AS nullable_float,
       CASE WHEN t = '' THEN 'field "plain_float": strconv.ParseFloat: parsing "": invalid syntax' END AS _error
FROM b"""


@query("defaults_nullable", DEFAULTS_SQL)
def q_defaults_nullable(spark, sf_dir):
    prep(spark)
    o = D.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    df = o.select("o_orderkey", F.when(k % 4 == 0, F.lit("")).otherwise((k % 50).cast("string")).alias("t"))
    fields = [FieldSpec("with_default", "Int32", source="t", default="7"),
              FieldSpec("nullable_int", "Nullable(Int32)", source="t", nullable=True),
              FieldSpec("text_default", "String", source="t", default="n/a"),
              FieldSpec("nullable_float", "Float64", source="t", nullable=True),
              FieldSpec("plain_float", "Float64", source="t")]
    return typed_projection(df, fields, keep=["o_orderkey"]).drop("plain_float")


# Row errors and the per-file verdict over the derived feed with every
# 97th row corrupt (status text not a number).
BAD_EV = EV.replace("(event_id % 600)::VARCHAR AS status",
                    "CASE WHEN event_id % 97 = 13 THEN 'bad' || (event_id % 3)::VARCHAR ELSE (event_id % 600)::VARCHAR END AS status")

BAD_ROWS_SQL = f"""
WITH {BAD_EV}
SELECT path AS file_path, line_no,
       'field "response_code": strconv.ParseUint: parsing "' || split_part(line, '|', 6) || '": invalid syntax' AS error
FROM num WHERE line_no > 1 AND NOT regexp_full_match(split_part(line, '|', 6), '[0-9]+')"""


def _bad_status(few: bool = False):
    k = F.col("event_id")
    bad = (k % 97 == 13) & (k % 20 < 5) if few else (k % 97 == 13)
    return F.when(bad, F.concat(F.lit("bad"), (k % 3).cast("string"))).otherwise((k % 600).cast("string"))


def _bad_typed(spark, sf_dir, few: bool = False):
    """The feed with corrupt rows (in every file, or ``few``: only files 0-4), parsed
    and converted once and staged in the shared checkpoint folder (verdict, error rows,
    dead letters and archive all read it)."""
    import uuid
    spec = D.events_spec(dedup=False)
    status = _bad_status(few)
    ctx = _ranges_ctx(spark, sf_dir)
    parsed = parse(D.event_feed(spark, sf_dir, status=status), spec, ctx)
    stage = shared_dir(spark, f"query-stage/bad-feed-{uuid.uuid4().hex[:12]}")
    typed_rows(parsed, spec).write.mode("overwrite").parquet(stage)
    return parsed, spark.read.parquet(stage)


@query("bad_rows", BAD_ROWS_SQL)
def q_bad_rows(spark, sf_dir):
    prep(spark)
    _, typed = _bad_typed(spark, sf_dir)
    typed = with_messages(typed, D.events_spec(dedup=False))
    return typed.filter(F.col("_error").isNotNull()).select(
        F.col("_file").alias("file_path"), F.col("_line_no").alias("line_no"), F.col("_error").alias("error"))


FILE_VERDICT_SQL = f"""
WITH {BAD_EV},
r AS (SELECT path, line_no, split_part(line, '|', 6) AS st FROM num WHERE line_no > 1),
e AS (SELECT path, line_no,
             CASE WHEN NOT regexp_full_match(st, '[0-9]+') THEN
               'field "response_code": strconv.ParseUint: parsing "' || st || '": invalid syntax' END AS err FROM r)
SELECT path AS file_path, count(*)::BIGINT AS rows, arg_min(err, line_no) FILTER (WHERE err IS NOT NULL) AS first_error,
       CASE WHEN count(err) > 0 THEN 'failed' ELSE 'done' END AS status,
       CASE WHEN count(err) > 0 THEN 0 ELSE count(*) END::BIGINT AS rows_written
FROM e GROUP BY path"""


@query("file_verdict", FILE_VERDICT_SQL)
def q_file_verdict(spark, sf_dir):
    prep(spark)
    _, typed = _bad_typed(spark, sf_dir)
    v = file_verdict(typed, error_message(D.events_spec(dedup=False)))
    failed = F.col("first_error").isNotNull()
    return v.select(F.col("_file").alias("file_path"), "rows", "first_error",
                    F.when(failed, F.lit("failed")).otherwise(F.lit("done")).alias("status"),
                    F.when(failed, F.lit(0)).otherwise(F.col("rows")).cast("long").alias("rows_written"))


# ---------------------------------------------------------------------------
# IP table and lookups
# ---------------------------------------------------------------------------

IP_RANGES_SQL = f"""
WITH {RANGES}
SELECT rs AS start, re AS "end", segment, nation,
       CASE WHEN rs % 3 = 0 THEN NULL ELSE 'x' END AS extra
FROM rng"""


def _ip_table_lines(spark, sf_dir):
    """IP table text from customer: header line, comments, blank lines, rows with a
    missing third attribute (every third), a line with one part (ignored)."""
    c = D.table(spark, sf_dir, "customer")
    r = D.customer_ranges(spark, sf_dir)
    body = F.concat_ws(",", u32_to_dotted(F.col("start")), F.col("end").cast("string"), "segment", "nation",
                       F.when(F.col("start") % 3 != 0, F.lit(" x ")))
    rows = r.select(body.alias("text"), (F.col("_order") * 4 + 10).alias("o"))
    extras = c.select(F.when(F.col("c_custkey") % 2 == 0, F.lit("# comment ") ).otherwise(F.lit("   ")).alias("text"),
                      (F.col("c_custkey") * 4 + 11).alias("o"))
    single = c.filter(F.col("c_custkey") % 5 == 0).select(F.lit("lonely").alias("text"), (F.col("c_custkey") * 4 + 12).alias("o"))
    head = c.filter(F.col("c_custkey") == F.lit(0)).select(F.lit("start_ip,end_ip,segment,nation,extra").alias("text"),
                                                          F.lit(0).cast("long").alias("o"))
    t = rows.unionByName(extras).unionByName(single).unionByName(head)
    lines = lines_from_frame(t.withColumn("p", F.lit("/ip/table.csv")), F.col("p"), F.col("text"), F.col("o"))
    return lines


@query("ip_ranges", IP_RANGES_SQL)
def q_ip_ranges(spark, sf_dir):
    prep(spark)
    lines = _ip_table_lines(spark, sf_dir)
    num = number_by_key(lines)
    num = num.withColumn("_phys", F.col("_line_no")).withColumn("_order", F.col("_line_no"))
    r = ranges_from_lines(num, ["segment", "nation", "extra"])
    return r.select("start", "end", "segment", "nation", "extra")


IP_LOOKUP_SQL = f"""
WITH {EV}, {RANGES}
SELECT e.event_id, e.src AS ip,
       CASE WHEN e.src_n <= r.re THEN r.segment END AS segment,
       CASE WHEN e.src_n <= r.re THEN r.nation END AS nation
FROM evt e ASOF LEFT JOIN rng r ON e.src_n >= r.rs"""


@query("ip_lookup", IP_LOOKUP_SQL)
def q_ip_lookup(spark, sf_dir):
    prep(spark)
    f = D.event_fields(D.table(spark, sf_dir, "events")).select("event_id", F.col("src").alias("ip"))
    table = bucketed_ranges(D.customer_ranges(spark, sf_dir))
    j = lookup(f, ip_to_u32(F.col("ip")), table, D.RANGE_ATTRS, "", table.count())
    return j.select("event_id", "ip", F.col("_m_segment").alias("segment"), F.col("_m_nation").alias("nation"))


# Overlapping ranges with equal starts (keys sharing c_custkey % 500) and inverted
# ranges (end < start for keys % 11 = 0): of equal starts the last in file order
# (highest key) wins, and an inverted winner matches nothing.
OVERLAP_RANGES_SQL = """
rng2 AS (
  SELECT (c_custkey % 500) * 8589934 AS rs,
         CASE WHEN c_custkey % 11 = 0 THEN (c_custkey % 500) * 8589934 - 1
              ELSE (c_custkey % 500) * 8589934 + (c_custkey % 9) * 3000000 END AS re,
         c_mktsegment AS segment, c_custkey AS o
  FROM customer),
win AS (SELECT rs, arg_max(re, o) AS re, arg_max(segment, o) AS segment FROM rng2 GROUP BY rs)"""

IP_OVERLAP_SQL = f"""
WITH {EV}, {OVERLAP_RANGES_SQL}
SELECT e.event_id, CASE WHEN e.src_n <= w.re THEN w.segment END AS segment
FROM evt e ASOF LEFT JOIN win w ON e.src_n >= w.rs"""


@query("ip_lookup_overlap", IP_OVERLAP_SQL)
def q_ip_lookup_overlap(spark, sf_dir):
    prep(spark)
    c = D.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    start = (k % 500) * 8589934
    end = F.when(k % 11 == 0, start - 1).otherwise(start + (k % 9) * 3000000)
    ranges = c.select(start.alias("start"), end.alias("end"), F.col("c_mktsegment").alias("segment"), k.alias("_order"))
    table = bucketed_ranges(ranges)
    f = D.event_fields(D.table(spark, sf_dir, "events")).select("event_id", "src")
    j = lookup(f, ip_to_u32(F.col("src")), table, ["segment"], "", table.count())
    return j.select("event_id", F.col("_m_segment").alias("segment"))


IP_ENRICH_SQL = f"""
WITH {EV}, {RANGES},
s AS (SELECT e.*, CASE WHEN e.src_n <= r.re THEN r.segment END AS sseg, CASE WHEN e.src_n <= r.re THEN r.nation END AS snat
      FROM evt e ASOF LEFT JOIN rng r ON e.src_n >= r.rs),
d AS (SELECT s.*, CASE WHEN s.dst_n <= r.re THEN r.segment END AS dseg, CASE WHEN s.dst_n <= r.re THEN r.nation END AS dnat
      FROM s ASOF LEFT JOIN rng r ON s.dst_n >= r.rs)
SELECT event_id,
       coalesce(CASE WHEN event_id % 3 <> 0 THEN dseg END, sseg) AS geo_segment,
       coalesce(CASE WHEN event_id % 3 <> 0 THEN dnat END, snat, 'preset') AS geo_nation,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'kept' END AS other
FROM d"""


@query("ip_enrich", IP_ENRICH_SQL)
def q_ip_enrich(spark, sf_dir):
    prep(spark)
    f = D.event_fields(D.table(spark, sf_dir, "events"))
    df = f.select("event_id", F.col("src").alias("a"),
                  F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("dst")).alias("b"),
                  F.lit("preset").alias("geo_nation"),
                  F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.lit("kept")).alias("other"))
    # both fields write under the same label: the second (b) overwrites on a match
    ctx = _ranges_ctx(spark, sf_dir)
    out = ip_enrich(df, ["a", "b"], ["geo", "geo"], ctx.ip_table, ctx.ip_attrs, ctx.ip_table_bytes)
    # b is NULL (absent) for event_id % 3 = 0 → skipped; the oracle mirrors that below
    return out.select("event_id", "geo_segment", "geo_nation", "other")


# ---------------------------------------------------------------------------
# dictionaries
# ---------------------------------------------------------------------------

DICT_FILE_SQL = """
WITH d AS (
  SELECT n_nationkey::VARCHAR AS key, n_name AS value, n_nationkey * 2 AS o FROM nation
  UNION ALL SELECT (n_nationkey % 5)::VARCHAR, 'LATE_' || n_name, 100 + n_nationkey FROM nation WHERE n_nationkey >= 20)
SELECT key, arg_max(value, o) AS value FROM d GROUP BY key"""


@query("dict_file", DICT_FILE_SQL)
def q_dict_file(spark, sf_dir):
    prep(spark)
    n = D.table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    body = n.select(F.concat(F.lit(" "), k.cast("string"), F.lit(" , "), F.col("n_name"), F.lit(" ")).alias("text"),
                    (k * 2).cast("long").alias("o"))
    noise = n.select(F.when(k % 2 == 0, F.lit("# a comment")).otherwise(F.lit("no comma here")).alias("text"),
                     (k * 2 + 1).cast("long").alias("o"))
    late = n.filter(k >= 20).select(F.concat((k % 5).cast("string"), F.lit(",LATE_"), F.col("n_name")).alias("text"),
                                    (k + 100).cast("long").alias("o"))
    t = body.unionByName(noise).unionByName(late).withColumn("p", F.lit("/dict/nation.csv"))
    lines = lines_from_frame(t, F.col("p"), F.col("text"), F.col("o")).withColumn("_o", F.struct("_ord", "_pos"))
    return dict_from_lines(lines)


DICT_MAP_SQL = """
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'V' WHEN 'click' THEN 'C' WHEN 'purchase' THEN '' ELSE event_type END AS event_type
FROM events"""


@query("dict_map", DICT_MAP_SQL)
def q_dict_map(spark, sf_dir):
    prep(spark)
    ev = D.table(spark, sf_dir, "events").select("event_id", "event_type")
    return dict_map(ev, "event_type", {"view": "V", "click": "C", "purchase": ""}).select("event_id", "event_type")


DICT_DEFAULT_SQL = """
SELECT o_orderkey, o_orderpriority,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' ELSE 'OTHER' END AS prio_code
FROM orders"""


@query("dict_default_target", DICT_DEFAULT_SQL)
def q_dict_default_target(spark, sf_dir):
    prep(spark)
    o = D.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return dict_map(o, "o_orderpriority", {"1-URGENT": "U", "2-HIGH": "H"}, target="prio_code", default="OTHER") \
        .select("o_orderkey", "o_orderpriority", "prio_code")


# Ordered chain — dictionary then dictionary on its output, then a
# registered transform that rejects rows (dropped and counted, never written).
def _reject_big(df: DataFrame, step: TransformSpec, ctx: ChainContext) -> DataFrame:
    limit = float((step.config or {}).get("max_value", 0))
    bad = F.col("value").cast("double") > F.lit(limit)
    return df.withColumn(TRANSFORM_ERROR, F.when(bad, F.lit("value above limit")).otherwise(F.col(TRANSFORM_ERROR)))


register("reject_big_values", _reject_big)

CHAIN_SQL = """
SELECT event_id,
       CASE CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'tap' ELSE event_type END
            WHEN 'seen' THEN 'S' WHEN 'signup' THEN 'N' ELSE
            CASE event_type WHEN 'view' THEN 'seen' WHEN 'click' THEN 'tap' ELSE event_type END END AS kind
FROM events WHERE NOT coalesce(value > 90, false)"""


@query("chain_order", CHAIN_SQL)
def q_chain_order(spark, sf_dir):
    prep(spark)
    ev = D.table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"),
                                                 F.col("value").cast("string").alias("value"))
    steps = [TransformSpec("dict_mapper", field="kind", dict={"view": "seen", "click": "tap"}),
             TransformSpec("dict_mapper", field="kind", dict={"seen": "S", "signup": "N"}),
             TransformSpec("reject_big_values", config={"max_value": 90})]
    out = apply_chain(ev, steps, ChainContext())
    return out.filter(F.col(TRANSFORM_ERROR).isNull()).select("event_id", "kind")


# ---------------------------------------------------------------------------
# Listing, readiness, enqueue
# ---------------------------------------------------------------------------

LISTING_SQL = """
data AS (
  SELECT '/in/' || name AS path, name, o_orderkey % 17 = 0 AS is_dir, o_orderdate AS mtime, o_orderkey
  FROM (SELECT *, 'o' || o_orderkey::VARCHAR || '.cdr' || CASE WHEN o_orderkey % 13 = 0 THEN '.tmp' ELSE '' END AS name
        FROM orders))"""

READY_SQL = f"""
WITH {LISTING_SQL}
SELECT path, name FROM data
WHERE NOT is_dir AND name LIKE '%.cdr' AND NOT name LIKE '%.tmp'
  AND mtime <= TIMESTAMP '1999-01-01 00:00:00' - INTERVAL 30 DAY"""


def _listing(spark, sf_dir):
    return D.order_listing(spark, sf_dir)


@query("ready_files", READY_SQL)
def q_ready_files(spark, sf_dir):
    prep(spark)
    spec = PipelineSpec(name="p0", watch_dir="/in", table="t", fields=[FieldSpec("a")], file_pattern="o*.cdr",
                        ready_strategy="stable_size", stable_delay_s=30 * 86400)
    return ready_files(_listing(spark, sf_dir), spec, D.NOW).select("path", "name")


READY_MARKER_SQL = f"""
WITH {LISTING_SQL}
SELECT path, name FROM data
WHERE NOT is_dir AND name LIKE '%.cdr' AND o_orderkey % 2 = 0"""


@query("ready_marker", READY_MARKER_SQL)
def q_ready_marker(spark, sf_dir):
    prep(spark)
    spec = PipelineSpec(name="p0", watch_dir="/in", table="t", fields=[FieldSpec("a")], file_pattern="*.cdr",
                        ready_strategy="marker")
    return ready_files(_listing(spark, sf_dir), spec, D.NOW).select("path", "name")


LEDGER_SQL = """
lg AS (
  SELECT 'p' || (o_custkey % 3)::VARCHAR AS pipeline,
         '/in/o' || ((o_orderkey // 3) * 3)::VARCHAR || '.cdr' AS file_path,
         (o_totalprice * 10)::BIGINT AS file_size, o_orderdate AS file_mod_time,
         CASE WHEN o_orderkey % 10 = 1 THEN 'processing' WHEN o_orderstatus = 'F' THEN 'done'
              WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'failed' END AS status,
         (o_orderkey % 1000)::BIGINT AS rows, (o_custkey % 4)::INTEGER AS attempts, o_orderdate AS processed_at,
         CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 1500 DAY END AS next_retry_at,
         o_orderkey AS seq
  FROM orders),
cur AS (
  SELECT pipeline, file_path, status, attempts, rows, next_retry_at, seq, file_size
  FROM lg QUALIFY row_number() OVER (PARTITION BY pipeline, file_path ORDER BY seq DESC) = 1)"""


@query("enqueue_files", f"""
WITH {LISTING_SQL}, {LEDGER_SQL},
ready AS (SELECT path FROM data WHERE NOT is_dir AND name LIKE '%.cdr' AND NOT name LIKE '%.tmp')
SELECT r.path AS file_path, coalesce(c.attempts, 0) AS attempts, 'pending' AS status
FROM ready r LEFT JOIN cur c ON c.file_path = r.path AND c.pipeline = 'p1'
WHERE c.status IS NULL OR c.status IN ('unknown', 'pending')""")
def q_enqueue_files(spark, sf_dir):
    prep(spark)
    spec = PipelineSpec(name="p1", watch_dir="/in", table="t", fields=[FieldSpec("a")], file_pattern="*.cdr")
    ready = ready_files(_listing(spark, sf_dir), spec, D.NOW)
    cur = L.latest(D.order_ledger(spark, sf_dir))
    return L.enqueue(cur, ready, "p1", D.NOW, 10**9).select("file_path", "attempts", "status")


@query("ledger_latest", f"WITH {LEDGER_SQL} SELECT pipeline, file_path, status, attempts, rows, seq FROM cur")
def q_ledger_latest(spark, sf_dir):
    prep(spark)
    return L.latest(D.order_ledger(spark, sf_dir)).select("pipeline", "file_path", "status", "attempts", "rows", "seq")


@query("ledger_claim", f"""WITH {LEDGER_SQL}
SELECT pipeline, file_path, 'processing' AS status, attempts FROM cur WHERE pipeline = 'p2' AND status = 'pending'""")
def q_ledger_claim(spark, sf_dir):
    prep(spark)
    cur = L.latest(D.order_ledger(spark, sf_dir))
    return L.claim(cur, "p2", D.NOW, 10**9).select("pipeline", "file_path", "status", "attempts")


@query("ledger_recover", f"""WITH {LEDGER_SQL}
SELECT pipeline, file_path, 'pending' AS status, attempts FROM cur WHERE pipeline = 'p0' AND status = 'processing'""")
def q_ledger_recover(spark, sf_dir):
    prep(spark)
    cur = L.latest(D.order_ledger(spark, sf_dir))
    return L.recover(cur, "p0", D.NOW, 10**9).select("pipeline", "file_path", "status", "attempts")


@query("ledger_fail", f"""WITH {LEDGER_SQL}
SELECT file_path, CASE WHEN attempts + 1 >= 3 THEN 'dead' ELSE 'failed' END AS status, attempts + 1 AS attempts,
       CASE WHEN attempts + 1 >= 3 THEN NULL ELSE TIMESTAMP '1999-01-01 00:01:00' END AS next_retry_at,
       CASE WHEN attempts + 1 >= 3 THEN '/dead/' || regexp_extract(file_path, '[^/]*$') ELSE '' END AS dead_letter_to,
       'boom ' || seq::VARCHAR AS error
FROM cur WHERE pipeline = 'p1' AND status = 'processing'""")
def q_ledger_fail(spark, sf_dir):
    prep(spark)
    cur = L.latest(D.order_ledger(spark, sf_dir))
    claimed = cur.filter((F.col("pipeline") == "p1") & (F.col("status") == "processing"))
    errors = claimed.select("file_path", F.concat(F.lit("boom "), F.col("seq").cast("string")).alias("error"))
    out = L.fail(claimed, errors, D.NOW, 10**9, True, 60, 3, "/dead")
    return ntz(out.select("file_path", "status", "attempts", "next_retry_at", "dead_letter_to", "error"))


@query("ledger_retry", f"""WITH {LEDGER_SQL}
SELECT pipeline, file_path, 'pending' AS status, attempts FROM cur
WHERE status = 'failed' AND attempts < 3 AND (next_retry_at IS NULL OR TIMESTAMP '1999-01-01 00:00:00' >= next_retry_at)""")
def q_ledger_retry(spark, sf_dir):
    prep(spark)
    cur = L.latest(D.order_ledger(spark, sf_dir))
    outs = [L.retry(cur, p, 3, D.NOW, 10**9) for p in ("p0", "p1", "p2")]
    return outs[0].unionByName(outs[1]).unionByName(outs[2]).select("pipeline", "file_path", "status", "attempts")


@query("ledger_status", f"""WITH {LEDGER_SQL}
SELECT pipeline, status, count(*)::BIGINT AS files FROM cur GROUP BY pipeline, status""")
def q_ledger_status(spark, sf_dir):
    prep(spark)
    return L.status_counts(L.latest(D.order_ledger(spark, sf_dir)))


# K5 + L7: dead files of the bad feed (every file with a corrupt row, at its last
# attempt) and their raw lines with the reason.
DEAD_SQL = f"""
WITH {BAD_EV},
r AS (SELECT path, line_no, split_part(line, '|', 6) AS st FROM num WHERE line_no > 1),
e AS (SELECT path, arg_min(
         'field "response_code": strconv.ParseUint: parsing "' || st || '": invalid syntax', line_no)
         FILTER (WHERE NOT regexp_full_match(st, '[0-9]+')) AS err FROM r GROUP BY path)
SELECT 'events_cdr' AS pipeline, n.path AS file_path, n.line AS line, e.err AS reason
FROM num n JOIN e USING (path) WHERE e.err IS NOT NULL"""


@query("dead_letter", DEAD_SQL)
def q_dead_letter(spark, sf_dir):
    prep(spark)
    from filament.sinks.files import dead_letter_rows
    parsed, typed = _bad_typed(spark, sf_dir)
    v = file_verdict(typed, error_message(D.events_spec(dedup=False))).filter(F.col("first_error").isNotNull())
    claimed = v.select(F.lit("events_cdr").alias("pipeline"), F.col("_file").alias("file_path"),
                       F.lit(1).alias("attempts"), F.lit("processing").alias("status"))
    for c, t in L.LEDGER_COLUMNS:
        if c not in claimed.columns:
            claimed = claimed.withColumn(c, F.lit(None).cast(t))
    failed = L.fail(claimed, v.select(F.col("_file").alias("file_path"), F.col("first_error").alias("error")),
                    D.NOW, 10**9, True, 5, 2)
    dead = failed.filter(F.col("status") == "dead").select("file_path", "error")
    lines = D.event_feed(spark, sf_dir, status=F.when(F.col("event_id") % 97 == 13, F.concat(
        F.lit("bad"), (F.col("event_id") % 3).cast("string"))).otherwise((F.col("event_id") % 600).cast("string")))
    return dead_letter_rows(lines, dead, "events_cdr", n_dead=dead.count())


# ---------------------------------------------------------------------------
# Reports over ingested rows and the sink
# ---------------------------------------------------------------------------

@query("agg_count", f"WITH {EV} SELECT count(*)::BIGINT AS n FROM num WHERE line_no > 1")
def q_agg_count(spark, sf_dir):
    return agg_count(ingest_events_df(spark, sf_dir))


@query("agg_extent", f"""WITH {EV}
SELECT min(strptime(split_part(line, '|', 1), '%Y-%m-%d %H:%M:%S')) AS min_time,
       max(strptime(split_part(line, '|', 1), '%Y-%m-%d %H:%M:%S')) AS max_time,
       count(*)::BIGINT AS n,
       strftime(min(strptime(split_part(line, '|', 1), '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') || ' -> ' ||
       strftime(max(strptime(split_part(line, '|', 1), '%Y-%m-%d %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS extent
FROM num WHERE line_no > 1""")
def q_agg_extent(spark, sf_dir):
    return ntz(agg_extent(ingest_events_df(spark, sf_dir), "event_time"))


COUNTERS_SQL = f"""
WITH {LEDGER_SQL},
x AS (SELECT *, lag(status) OVER w AS before, lag(processed_at) OVER w AS since, row_number() OVER w AS nth
      FROM (SELECT lg.*, rows + seq % 7 AS rows_read FROM lg) WINDOW w AS (PARTITION BY pipeline, file_path ORDER BY seq)),
c AS (SELECT pipeline,
             (count(*) FILTER (WHERE nth = 1))::BIGINT AS files_seen_total,
             (count(*) FILTER (WHERE status = 'processing'))::BIGINT AS files_processing_total,
             (count(*) FILTER (WHERE status = 'done'))::BIGINT AS files_done_total,
             (count(*) FILTER (WHERE status IN ('failed', 'dead')))::BIGINT AS files_failed_total,
             (count(*) FILTER (WHERE status = 'dead'))::BIGINT AS files_dead_total,
             (count(*) FILTER (WHERE status = 'failed' AND next_retry_at IS NOT NULL))::BIGINT AS files_scheduled_retry_total,
             (count(*) FILTER (WHERE status = 'failed' AND next_retry_at IS NULL))::BIGINT AS files_failed_no_retry_total,
             coalesce(sum(rows_read) FILTER (WHERE status = 'done'), 0)::BIGINT AS rows_read_total,
             coalesce(sum(rows) FILTER (WHERE status = 'done'), 0)::BIGINT AS rows_written_total,
             coalesce(sum(rows_read - rows) FILTER (WHERE status = 'done'), 0)::BIGINT AS transform_errors_total,
             coalesce(sum(epoch_ms(processed_at) - epoch_ms(since)) FILTER (WHERE before = 'processing' AND status IN ('done', 'failed', 'dead')), 0)::BIGINT
               AS file_process_ms_total
      FROM x GROUP BY pipeline)
UNPIVOT c ON COLUMNS(* EXCLUDE (pipeline)) INTO NAME metric VALUE value"""


@query("counters", COUNTERS_SQL)
def q_counters(spark, sf_dir):
    prep(spark)
    return counters_from_ledger(D.order_ledger(spark, sf_dir))


THROUGHPUT_SQL = f"""
WITH {LEDGER_SQL},
t AS (SELECT pipeline, coalesce(sum(rows) FILTER (WHERE status = 'done'), 0) AS rows,
             max(epoch_ms(processed_at)) FILTER (WHERE status IN ('done', 'failed', 'dead'))
             - min(epoch_ms(processed_at)) FILTER (WHERE status = 'processing') AS ms
      FROM lg GROUP BY pipeline)
SELECT pipeline, rows::BIGINT AS rows_written, ms::BIGINT AS elapsed_ms,
       (rows // greatest(ms // 1000, 1))::BIGINT AS rows_per_sec,
       rows::DOUBLE / (ms::DOUBLE / 1000.0) AS rows_per_sec_exact
FROM t"""


@query("throughput", THROUGHPUT_SQL)
def q_throughput(spark, sf_dir):
    prep(spark)
    return throughput_from_ledger(D.order_ledger(spark, sf_dir))


@query("verify_select", f"SELECT * FROM ({INGEST_SQL}) ORDER BY event_time, _etl_record_id")
def q_verify_select(spark, sf_dir):
    """Every published row and column, in order."""
    return ingest_events_df(spark, sf_dir).orderBy("event_time", "_etl_record_id")


@query("sink_layout", f"""WITH {EV}
SELECT strftime(strptime(split_part(line, '|', 1), '%Y-%m-%d %H:%M:%S'), '%Y%m') AS event_month,
       count(*)::BIGINT AS n, min(split_part(line, '|', 2)) AS min_src, 0::BIGINT AS out_of_order, 0::BIGINT AS without_ingest_time
FROM num WHERE line_no > 1 GROUP BY 1""")
def q_sink_layout(spark, sf_dir):
    """The published table read back: rows per month, rows that stand before a smaller one in
    their file, and rows without an ingest time."""
    import uuid
    df = ingest_events_df(spark, sf_dir).withColumn("event_time", F.col("event_time").cast("timestamp"))
    path = shared_dir(spark, f"sink-layout-{uuid.uuid4().hex[:12]}")
    write_run(df, path, "r1", "event_time", ("event_time", "src_ip"))
    back = read_table(spark, path, ["r1"])
    place = Window.partitionBy("_f", "_s").orderBy("_i")
    row = F.struct("event_time", "src_ip")
    seen = back.withColumns({"_f": F.col("_metadata.file_path"), "_s": F.col("_metadata.file_block_start"), "_i": F.monotonically_increasing_id()})
    seen = seen.withColumn("_before", F.lag(row).over(place))
    return seen.groupBy(F.col(MONTH_COL).cast("string").alias("event_month")).agg(
        F.count(F.lit(1)).alias("n"), F.min("src_ip").alias("min_src"),
        F.count(F.when(F.col("_before") > row, 1)).alias("out_of_order"),
        F.count(F.when(F.col("ingest_time").isNull(), 1)).alias("without_ingest_time"))


# K6: archive rows — the raw lines of every file that passed, set aside after success.
ARCHIVE_SQL = f"""
WITH {BAD_EV.replace("WHEN event_id % 97 = 13 THEN", "WHEN event_id % 97 = 13 AND event_id % 20 < 5 THEN")},
r AS (SELECT path, split_part(line, '|', 6) AS st FROM num WHERE line_no > 1),
bad AS (SELECT DISTINCT path FROM r WHERE NOT regexp_full_match(st, '[0-9]+'))
SELECT 'events_cdr' AS pipeline, n.path AS file_path, n.line AS line
FROM num n WHERE n.path NOT IN (SELECT path FROM bad)"""


@query("archive_lines", ARCHIVE_SQL)
def q_archive_lines(spark, sf_dir):
    prep(spark)
    from filament.sinks.files import archive_rows
    _, typed = _bad_typed(spark, sf_dir, few=True)
    v = file_verdict(typed, error_message(D.events_spec(dedup=False)))
    good = v.filter(F.col("first_error").isNull()).select(F.col("_file").alias("file_path"))
    return archive_rows(D.event_feed(spark, sf_dir, status=_bad_status(few=True)), good, "events_cdr", n_files=good.count())
