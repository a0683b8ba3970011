"""Inputs derived from the driver's tables, used by the registered queries.

The registered queries must read the given tables, so every operator input is built
from them with integer arithmetic that DuckDB reproduces exactly:

* **event feed** — one CDR line per ``events`` row, ``ts|src|dst|type|code|status``
  in file ``/in/f<event_id % 20>.log`` ordered by ``event_id``; every file starts with
  a header line ``probe-<k>|<region>`` (order -1).
* **customer ranges** — ``start = (c_custkey % 1000003) * 2654435761 % 2^32``,
  ``end = least(start + (c_custkey % 7) * 1000000, 2^32 - 1)``, attributes
  ``c_mktsegment`` and ``c_nationkey`` (distinct starts, overlapping widths).
* **listing / ledger** — file metadata rows derived from ``orders``.
* **document files** — ``documents.text`` written as text files (64 buckets by
  ``doc_id``), and **byte files**, event lines with bytes that are not UTF-8: the inputs that go
  through a real file scan.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.functions.ip import u32_to_dotted
from filament.session import shared_dir
from filament.sources.lines import lines_from_frame, scan_lines
from filament.spec import FieldSpec, PipelineSpec, TransformSpec

N_FILES = 20
# Region names cycled over the derived files, and the code dictionary.
REGIONS = ["south", "east", "north", "west"]
CODE_DICT = {"1": "A", "2": "NS", "3": "CNAME", "4": "MX", "5": "AAAA"}
RANGE_ATTRS = ["segment", "nation"]
# The fixed "now" of the control-plane queries.
NOW = dt.datetime(1999, 1, 1, tzinfo=dt.timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ip_text(n: Column) -> Column:
    return u32_to_dotted(n)


def src_int(event_id: Column) -> Column:
    return (event_id % 1000003) * 2246822519 % 4294967296


def dst_int(user_id: Column) -> Column:
    return (user_id % 1000003) * 2654435761 % 4294967296


def ts_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def event_fields(ev: DataFrame, status: Column | None = None) -> DataFrame:
    status = status if status is not None else (F.col("event_id") % 600).cast("string")
    return ev.select(
        "event_id", "user_id",
        F.concat(F.lit("/in/f"), (F.col("event_id") % N_FILES).cast("string"), F.lit(".log")).alias("path"),
        ts_text(F.col("ts")).alias("ts_text"),
        ip_text(src_int(F.col("event_id"))).alias("src"),
        ip_text(dst_int(F.col("user_id"))).alias("dst"),
        F.col("event_type"),
        ((F.col("event_id") % 7) + 1).cast("string").alias("code"),
        status.alias("status"),
    )


def event_lines_text(f: DataFrame) -> DataFrame:
    return f.select("path", "event_id",
                    F.concat_ws("|", "ts_text", "src", "dst", "event_type", "code", "status").alias("text"))


def header_texts(ev: DataFrame, n_files: int = N_FILES) -> DataFrame:
    """One header line per derived file present in ``events``."""
    k = F.col("event_id") % n_files
    files = ev.select(k.alias("k")).distinct()
    region = F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (F.col("k") % 4 + 1).cast("int"))
    return files.select(
        F.concat(F.lit("/in/f"), F.col("k").cast("string"), F.lit(".log")).alias("path"),
        F.lit(-1).cast("long").alias("event_id"),
        F.concat(F.lit("probe-"), F.lpad(F.col("k").cast("string"), 3, "0"), F.lit("|"), region).alias("text"))


def event_feed(spark: SparkSession, sf_dir: str, status: Column | None = None, with_header: bool = True) -> DataFrame:
    """Lines frame of the derived CDR files."""
    ev = table(spark, sf_dir, "events")
    texts = event_lines_text(event_fields(ev, status))
    if with_header:
        texts = texts.unionByName(header_texts(ev))
    return lines_from_frame(texts, F.col("path"), F.col("text"), F.col("event_id"))


def customer_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    start = (F.col("c_custkey") % 1000003) * 2654435761 % 4294967296
    end = F.least(start + (F.col("c_custkey") % 7) * 1000000, F.lit(4294967295))
    return c.select(start.alias("start"), end.alias("end"), F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").cast("string").alias("nation"), F.col("c_custkey").alias("_order"))


def events_spec(dedup: bool = True) -> PipelineSpec:
    """The flagship pipeline over the derived feed: header metadata, IP enrichment of
    both addresses, a code dictionary, provenance, typed output."""
    fields = [
        FieldSpec("event_time", "DateTime", layout="2006-01-02 15:04:05"),
        FieldSpec("src_ip", "IPv4"), FieldSpec("dst_ip", "IPv4"),
        FieldSpec("event_type", "LowCardinality(String)"),
        FieldSpec("dns_type", "LowCardinality(String)", source="code"),
        FieldSpec("response_code", "UInt16", source="status"),
    ]
    fields += [FieldSpec(f"{p}_geo_{a}", "LowCardinality(String)", generated=True)
               for p in ("src", "dst") for a in RANGE_ATTRS]
    if dedup:
        fields += [FieldSpec("_etl_line_number", "UInt32", generated=True),
                   FieldSpec("_etl_record_id", "String", generated=True)]
    return PipelineSpec(
        name="events_cdr", watch_dir="/in", table="cdr.events", fields=fields, file_pattern="*.log",
        delimiter="|", has_header_meta=True,
        header_fields=[FieldSpec("probe_id", "LowCardinality(String)"), FieldSpec("region", "String")],
        transformers=[TransformSpec("ip_matcher", fields=("src_ip", "dst_ip"), label_fields=("src_geo", "dst_geo")),
                      TransformSpec("dict_mapper", field="code", dict=dict(CODE_DICT))],
        dedup={"enabled": dedup}, event_time_field="event_time", sort_fields=("event_time", "src_ip"))


# ---------------------------------------------------------------------------
# Documents written as files (the real text scan)
# ---------------------------------------------------------------------------

DOC_BUCKETS = 64


def _bucket_files(spark: SparkSession, df: DataFrame, key: str, text: str) -> str:
    """Text files under the shared folder, one per ``key % 64`` bucket in ``key`` order."""
    out = shared_dir(spark, f"derived-files-{uuid.uuid4().hex[:12]}")
    (df.select((F.col(key) % DOC_BUCKETS).cast("int").alias("bucket"), key, text)
       .repartition(DOC_BUCKETS, "bucket").sortWithinPartitions("bucket", key)
       .select("bucket", text)
       .write.mode("overwrite").option("lineSep", "\n").partitionBy("bucket").text(out))
    return out


def _bucket_lines(spark: SparkSession, root: str) -> DataFrame:
    lines = scan_lines(spark, root)
    return lines.withColumn("file_key", F.regexp_extract(F.col("_file"), "bucket=([0-9]+)", 1).cast("int"))


def byte_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned lines of event files whose lines end with two bytes that are no UTF-8 (0xD6 and
    one that varies, never a line end) and CRLF."""
    ev = table(spark, sf_dir, "events")
    odd = F.unhex(F.lpad(F.hex(F.col("event_id") % 100 + 128), 2, "0"))
    raw = F.concat(F.col("event_id").cast("string").cast("binary"), F.lit("|").cast("binary"), F.col("event_type").cast("binary"),
                   F.unhex(F.lit("D6")), odd, F.lit("\r").cast("binary"))
    return _bucket_lines(spark, _bucket_files(spark, ev.select("event_id", raw.cast("string").alias("line")), "event_id", "line"))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scanned lines of the document files with ``file_key`` = bucket number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _bucket_lines(spark, _bucket_files(spark, docs, "doc_id", "text"))


# ---------------------------------------------------------------------------
# Listing and ledger derived from orders
# ---------------------------------------------------------------------------

def order_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows: data file per order (``.tmp`` suffix for keys % 13 = 0, a
    directory for keys % 17 = 0), plus a ``.ok`` marker for even keys."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("o"), k.cast("string"), F.lit(".cdr"),
                    F.when(k % 13 == 0, F.lit(".tmp")).otherwise(F.lit("")))
    data = o.select(F.concat(F.lit("/in/"), name).alias("path"), name.alias("name"), (k % 17 == 0).alias("is_dir"),
                    (F.col("o_totalprice") * 10).cast("long").alias("size"),
                    F.col("o_orderdate").cast("timestamp").alias("mtime"), F.lit("").alias("uri"))
    markers = (data.filter(k_even(data))
               .select(F.concat("path", F.lit(".ok")).alias("path"), F.concat("name", F.lit(".ok")).alias("name"),
                       F.lit(False).alias("is_dir"), F.lit(0).cast("long").alias("size"), "mtime", "uri"))
    return data.unionByName(markers)


def k_even(df: DataFrame) -> Column:
    return F.regexp_extract(F.col("name"), "^o([0-9]+)", 1).cast("long") % 2 == 0


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger log: three orders per file key (``o_orderkey / 3``), seq = order key,
    state from ``o_orderstatus`` (and key % 10), attempts ``o_custkey % 4``."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = (F.when(k % 10 == 1, F.lit("processing"))
               .when(F.col("o_orderstatus") == "F", F.lit("done"))
               .when(F.col("o_orderstatus") == "O", F.lit("pending"))
               .otherwise(F.lit("failed")))
    ts = F.col("o_orderdate").cast("timestamp")
    return o.select(
        F.concat(F.lit("p"), (F.col("o_custkey") % 3).cast("string")).alias("pipeline"),
        F.concat(F.lit("/in/o"), (F.floor(k / 3) * 3).cast("string"), F.lit(".cdr")).alias("file_path"),
        (F.col("o_totalprice") * 10).cast("long").alias("file_size"),
        ts.alias("file_mod_time"), status.alias("status"),
        (k % 1000).cast("long").alias("rows"), (F.col("o_custkey") % 4).cast("int").alias("attempts"),
        ts.alias("processed_at"),
        F.when(k % 4 == 0, ts + F.expr("INTERVAL 1500 DAYS")).alias("next_retry_at"),
        F.lit(None).cast("timestamp").alias("dead_letter_at"), F.lit("").alias("dead_letter_to"),
        F.when(status == "failed", F.concat(F.lit("err "), k.cast("string"))).otherwise(F.lit("")).alias("error"),
        k.alias("seq"), F.lit("r0").alias("run_id"), (k % 1000 + k % 7).cast("long").alias("rows_read"))


# ---------------------------------------------------------------------------
# Landing folders: derived feeds written as real files (bench and tests)
# ---------------------------------------------------------------------------

# Status codes cycled by the HTTP-like feed and the method dictionary.
HTTP_STATUS = [200, 200, 200, 204, 301, 404, 500]
METHODS = {"1": "GET", "2": "POST", "3": "HEAD", "4": "PUT", "5": "DELETE"}
N_HTTP_FILES = 40


def http_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP-like lines ``ts|++|client|++|server|++|method|++|url|++|status|++|bytes|++|probe|++|region``
    from ``lineitem``; file key ``l_orderkey % 40``, order by (order key, line number)."""
    li = table(spark, sf_dir, "lineitem")
    k, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ts = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(
        secs=((k * 7 + F.col("l_linenumber")) % 86400).cast("decimal(18,6)"))
    status = F.element_at(F.array(*[F.lit(str(x)) for x in HTTP_STATUS]), (k % 7 + 1).cast("int"))
    region = F.element_at(F.array(*[F.lit(r) for r in REGIONS]), (s % 4 + 1).cast("int"))
    text = F.concat_ws("|++|", ts_text(ts), ip_text(src_int(k)), ip_text(dst_int(s)),
                       ((F.col("l_linenumber") % 5) + 1).cast("string"),
                       F.concat(F.lit("/api/v1/resource/"), (p % 10000).cast("string")), status,
                       (F.lit(512) + p % 4096).cast("string"),
                       F.concat(F.lit("probe-http-"), F.lpad((s % 64).cast("string"), 3, "0")), region)
    return li.select((k % N_HTTP_FILES).alias("key"), (k * 8 + F.col("l_linenumber")).alias("ord"), text.alias("text"))


def dns_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed (with its header lines) keyed by file number."""
    ev = table(spark, sf_dir, "events")
    t = event_lines_text(event_fields(ev)).unionByName(header_texts(ev))
    return t.select(F.regexp_extract("path", "f([0-9]+)", 1).cast("long").alias("key"),
                    F.col("event_id").alias("ord"), "text")


def ip_table_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = customer_ranges(spark, sf_dir)
    body = r.select(F.lit(0).alias("key"), F.col("_order").alias("ord"),
                    F.concat_ws(",", ip_text(F.col("start")), ip_text(F.col("end")), "segment", "nation").alias("text"))
    head = spark.range(1).select(F.lit(0).alias("key"), F.lit(-1).cast("long").alias("ord"),
                                 F.lit("start_ip,end_ip,segment,nation").alias("text"))
    return body.unionByName(head)


def write_landing(spark: SparkSession, texts: DataFrame, root: str, name: str, n_keys: int) -> str:
    """Write ``key, ord, text`` rows as one file per key (lines in ``ord`` order) and
    move each into the flat folder ``root/landing`` as ``name.format(key)`` — the
    atomic rename a producer does when a file is complete."""
    staging = f"{root}/staging"
    (texts.repartition(n_keys, "key").sortWithinPartitions("key", "ord").select("key", "text")
          .write.mode("overwrite").option("lineSep", "\n").partitionBy("key").text(staging))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    landing = jvm.org.apache.hadoop.fs.Path(f"{root}/landing")
    fs = landing.getFileSystem(conf)
    fs.mkdirs(landing)
    for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(staging)):
        if not st.isDirectory() or "=" not in st.getPath().getName():
            continue
        key = st.getPath().getName().split("=", 1)[1]
        parts = [p for p in fs.listStatus(st.getPath()) if p.getPath().getName().startswith("part-")]
        for i, part in enumerate(sorted(parts, key=lambda x: x.getPath().getName())):
            suffix = "" if len(parts) == 1 else f".{i}"
            fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(f"{root}/landing/{name.format(key)}{suffix}"))
    return f"{root}/landing"


def http_spec(watch_dir: str, method_dict_file: str = "") -> PipelineSpec:
    fields = [FieldSpec("event_time", "DateTime", layout="2006-01-02 15:04:05"), FieldSpec("client_ip", "IPv4"),
              FieldSpec("server_ip", "IPv4"), FieldSpec("method", "LowCardinality(String)"), FieldSpec("url", "String"),
              FieldSpec("status_code", "UInt16"), FieldSpec("bytes_sent", "UInt64"),
              FieldSpec("probe_id", "LowCardinality(String)"), FieldSpec("region", "LowCardinality(String)")]
    fields += [FieldSpec(f"{p}_geo_{a}", "LowCardinality(String)", generated=True)
               for p in ("client", "server") for a in RANGE_ATTRS]
    dm = (TransformSpec("dict_mapper", field="method", dict_file=method_dict_file) if method_dict_file
          else TransformSpec("dict_mapper", field="method", dict=dict(METHODS)))
    return PipelineSpec(
        name="http_cdr", watch_dir=watch_dir, table="cdr.http", fields=fields, file_pattern="*.log",
        delimiter="|++|",
        transformers=[TransformSpec("ip_matcher", fields=("client_ip", "server_ip"), label_fields=("client_geo", "server_geo")),
                      dm],
        retry_failed=True, max_retries=2, retry_interval_s=5, event_time_field="event_time",
        sort_fields=("event_time", "client_ip", "status_code"))


def dns_spec(watch_dir: str) -> PipelineSpec:
    s = events_spec(dedup=True)
    s.watch_dir = watch_dir
    s.file_pattern = "*.cdr"
    s.retry_failed, s.max_retries, s.retry_interval_s = True, 2, 5
    return s
