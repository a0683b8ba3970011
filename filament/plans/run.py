"""One ingestion run for a pipeline (the whole file lifecycle as Spark jobs).

``list → ready → recover/retry → enqueue → claim → read claimed files → parse →
chain → typed projection → per-file verdict → publish good files → ledger
done/failed/dead (+ dead-letter rows)``.

Many files are handled by one set of jobs.  The driver holds the claimed paths (the reader
needs their names) and counts; records and verdicts stay DataFrames.  The data is read
three times at most (split index when numbering is needed, verdict, publication)
and never cached, so a lost executor only costs the recomputation of its tasks.
Publication is all-or-nothing per file: a bad file contributes no rows.  A file that
vanished or cannot be read fails by itself (and is retried like others); the rest publish.
Each attempt writes under a run id of its own, and the ledger append after the writes
is the commit point (crash in between → the files stay ``processing``, are recovered by the next
run or the stream's next batch, and the orphan folders are never read because no record names them).
"""

from __future__ import annotations

import datetime as dt
import math
import re
import time
import urllib.parse
import uuid
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from filament.operators import ledger as L
from filament.operators.chain import ChainContext
from filament.operators.iplookup import bucketed_ranges
from filament.operators.ready import ready_files
from filament.operators.size import ROW_BYTES, frame_bytes, row_bytes
from filament.operators.verdict import file_verdict
from filament.session import local_frame, shared_dir
from filament.plans.ingest import error_message, output_only, parse, typed_rows
from filament.sinks import ledger_store as store
from filament.sinks.files import archive_rows, dead_letter_rows, write_lines
from filament.sinks.table import write_run
from filament.sources.dictionary import load_dict_file
from filament.sources.ipdb import load_ip_table
from filament.sources.lines import file_heads, open_source, qualified, scan_lines
from filament.sources.listing import list_dir, list_entries
from filament.spec import PipelineSpec

#: failed files that are named in the filter of a publication; more are joined
LITERAL_FILES = 300
#: errors that a result shows; the ledger has them all
SHOWN_ERRORS = 1000
# fixed values: endings of compressed files that the text reader unpacks
COMPRESSED = ("gz", "bz2", "deflate", "zst", "snappy", "lz4")


def load_context(spark: SparkSession, specs: list[PipelineSpec], ip_path: str = "",
                 ip_columns: list[str] | None = None) -> ChainContext:
    """Dimension tables shared by all pipelines: the IP table (checked, bucketed, with
    its exploded size) and every dictionary file the specs name."""
    ctx = ChainContext()
    if ip_path:
        ranges = load_ip_table(spark, ip_path, list(ip_columns or []))
        table = bucketed_ranges(ranges).cache()
        ctx.held += [ranges, table]
        ctx.ip_table, ctx.ip_attrs, ctx.ip_table_bytes = table, list(ip_columns or []), frame_bytes(table)
        ctx.ip_attrs_trimmed = True             # by the loader
    for s in specs:
        for t in s.transformers:
            if t.type == "dict_mapper" and t.dict_file and t.dict_file not in ctx.dict_tables:
                d = load_dict_file(spark, t.dict_file).cache()
                ctx.held.append(d)
                ctx.dict_tables[t.dict_file] = (d, frame_bytes(d))
    return ctx


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All records of all pipelines."""
    return store.read_history(spark, path)


def append_ledger(df: DataFrame, path: str) -> None:
    """One batch of records, in a folder of its own (``store.batch_dir``)."""
    df.write.mode("overwrite").parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    """Drop a run's staging folder after the ledger commit."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p):
        fs.delete(p, True)


def missing_files(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Claimed paths that are not there (any more), with the error they fail with: one listing for each folder."""
    there = {e[0] for folder in {p.rpartition("/")[0] if "/" in p else "." for p in paths} for e in list_entries(spark, folder or "/")}
    return {p: f"open {p}: no such file or directory" for p in paths if p not in there}


#: kinds of failures that name the file they met
READ_ERRORS = ("FAILED_READ_FILE", "PATH_NOT_FOUND", "FileNotFoundException")
#: failed attempts after which the compressed files are probed together
PROBE_AFTER = 2


def named_files(error: Exception, paths: list[str]) -> list[str]:
    """Files among ``paths`` that a failed read names (none: it failed for another reason, like a lost executor)."""
    text = str(error)
    if not any(k in text for k in READ_ERRORS):
        return []
    text += urllib.parse.unquote(text)
    return [p for p in paths if re.search(re.escape(p.removeprefix("./")) + r"(?![^\s.,;:'\")\]]|[.][A-Za-z0-9])", text)]


def unreadable_files(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Reads the files to their end, a task each, and returns the errors of those that fail."""
    if not paths:
        return {}
    rows = list(zip(qualified(spark, paths), paths))

    def probe(batches):
        import pyarrow as pa

        for b in batches:
            failed, errors = [], []
            for where, path in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    source, name = open_source(where)
                    with source.open_input_stream(name) as stream:
                        while stream.read(8 << 20):
                            pass
                except Exception as e:  # whatever keeps this file from being read is its error
                    failed.append(path)
                    errors.append(f"read {path}: {e}")
            yield pa.RecordBatch.from_arrays([pa.array(failed, pa.string()), pa.array(errors, pa.string())], names=["path", "error"])

    files = local_frame(spark, rows, "qualified string, path string").repartition(max(1, min(len(rows), 1000)))
    return {r.path: r.error for r in files.mapInArrow(probe, "path string, error string").collect()}


def read_failures(spark: SparkSession, error: Exception, paths: list[str], attempt: int) -> dict[str, str]:
    """Which of ``paths`` a failed stage could not read.  Files that are gone, and those that the error names; from
    ``PROBE_AFTER`` attempts on also compressed ones that can't be read to their end (plain text can't be corrupt), so
    many bad files don't cost a stage each.  Nothing else is read again, whatever the failure."""
    named = named_files(error, paths)
    if not named and not any(k in str(error) for k in READ_ERRORS):
        return {}
    found = missing_files(spark, paths)
    left = [p for p in paths if p not in found]
    suspects = [p for p in left if p in named or attempt >= PROBE_AFTER and p.rsplit(".", 1)[-1].lower() in COMPRESSED]
    found |= unreadable_files(spark, suspects)
    reason = (str(error).strip().splitlines() or [""])[0][:500]
    return found | {p: f"read {p}: {reason}" for p in named if p not in found}


class _Phases:
    """Wall time per phase of a run (kept on the result for the bench report)."""

    def __init__(self) -> None:
        self.t = time.time()
        self.times: dict[str, float] = {}

    def mark(self, name: str) -> None:
        now = time.time()
        self.times[name] = round(self.times.get(name, 0.0) + now - self.t, 3)
        self.t = now


@dataclass
class RunResult:
    run_id: str
    files_claimed: int = 0
    files_done: int = 0
    files_failed: int = 0
    files_dead: int = 0
    rows_written: int = 0
    rows_read: int = 0
    transform_errors: int = 0
    seconds: float = 0.0
    errors: dict[str, str] = field(default_factory=dict)
    phases: dict[str, float] = field(default_factory=dict)


def _control_plane(spark: SparkSession, spec: PipelineSpec, ledger_path: str, now: dt.datetime, run_id: str,
                   ready: DataFrame, reclaim: str | None = None) -> tuple[DataFrame, int]:
    """Recover/retry, enqueue ``ready`` files and claim every pending file: one pass over the latest
    records, appended in one write.  Returns the claimed records.  With
    ``reclaim`` only interrupted files whose run id starts so are recovered (a stream takes back
    what its own crashed batches held)."""
    batch = store.next_batch(spark, ledger_path, spec.name)
    records = L.step(store.read_latest(spark, ledger_path, spec.name), ready, spec.name, now, batch * store.SEQS, run_id,
                     spec.retry_failed, spec.max_retries, reclaim)
    path = store.batch_dir(ledger_path, spec.name, batch)
    append_ledger(records, path)
    return L.conform(spark.read.parquet(path)).filter(F.col("status") == "processing"), (batch + 1) * store.SEQS


def run_once(spark: SparkSession, spec: PipelineSpec, ctx: ChainContext, ledger_path: str, table_path: str,
             now: dt.datetime | None = None, run_id: str | None = None, dead_letter_path: str = "") -> RunResult:
    """One batch run: list the watched folder, then ingest every claimed file."""
    now = now or dt.datetime.now(dt.timezone.utc)
    run_id = run_id or now.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    t0 = time.time()
    ready = ready_files(list_dir(spark, spec.watch_dir_clean), spec, now)
    claimed, seq = _control_plane(spark, spec, ledger_path, now, run_id, ready)
    control = time.time() - t0
    res = ingest_claimed(spark, spec, ctx, claimed, seq, ledger_path, table_path, now, run_id, dead_letter_path)
    res.phases = {"control_plane": round(control, 3), **res.phases}
    res.seconds = time.time() - t0
    return res


def run_files(spark: SparkSession, spec: PipelineSpec, ctx: ChainContext, files: list[tuple[str, int, dt.datetime]],
              ledger_path: str, table_path: str, owner: str, now: dt.datetime | None = None,
              dead_letter_path: str = "") -> RunResult:
    """Ingest a given set of files ``(path, size, mtime)`` (a streaming micro-batch): take back what
    an interrupted batch of the same ``owner`` still holds, retry what is due, enqueue the files,
    claim what is pending, ingest.  Files already done are skipped."""
    ready = local_frame(spark, [(p, sz, mt) for p, sz, mt in files], "path string, size long, mtime timestamp")
    return run_ready(spark, spec, ctx, ready, ledger_path, table_path, owner, now, dead_letter_path)


def run_ready(spark: SparkSession, spec: PipelineSpec, ctx: ChainContext, ready: DataFrame, ledger_path: str, table_path: str,
              owner: str, now: dt.datetime | None = None, dead_letter_path: str = "") -> RunResult:
    """``run_files`` for a frame of ready files (``path, size, mtime``)."""
    now = now or dt.datetime.now(dt.timezone.utc)
    run_id = f"{owner}-{now.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    t0 = time.time()
    claimed, seq = _control_plane(spark, spec, ledger_path, now, run_id, ready, reclaim=owner + "-")
    res = ingest_claimed(spark, spec, ctx, claimed, seq, ledger_path, table_path, now, run_id, dead_letter_path)
    res.seconds = time.time() - t0
    return res


def ingest_claimed(spark: SparkSession, spec: PipelineSpec, ctx: ChainContext, claimed: DataFrame, seq: int,
                   ledger_path: str, table_path: str, now: dt.datetime, run_id: str,
                   dead_letter_path: str = "") -> RunResult:
    """Read, parse, enrich, convert and publish the claimed files; append the verdicts.

    The driver holds the claimed paths and sizes (the reader needs their names), counts, and
    at most ``SHOWN_ERRORS`` errors; verdicts and records stay DataFrames."""
    res = RunResult(run_id)
    ph = _Phases()
    t0 = time.time()
    held = claimed.select("file_path", "file_size").toArrow()
    paths, lengths = held.column(0).to_pylist(), held.column(1).to_pylist()
    if not paths:
        return res
    res.files_claimed = len(paths)
    sizes = {p: n or 0 for p, n in zip(paths, lengths)}
    unread = missing_files(spark, paths)
    visible = [p for p in paths if p not in unread]

    lines = None
    stage_dir = shared_dir(spark, f"staging/{spec.name}/{run_id}")
    max_split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    attempt = 0
    while visible:
        # One pass over the expensive part (parse, enrich, convert): the typed rows are
        # staged in the shared folder — this also cuts the lineage, so a lost executor
        # never re-parses other tasks' input — and verdict and publication read the
        # staged columns.  If it fails, the files that cannot be read fail and the rest goes on.
        index_bytes = sum(max(1, math.ceil(sizes[p] / max_split)) * (3 * len(p) + ROW_BYTES) for p in visible)
        lines = scan_lines(spark, visible, spec.max_line_bytes, directory=spec.watch_dir_clean)
        try:
            heads, heads_bytes = file_heads(spark, visible, spec.max_line_bytes) if spec.has_header_meta else None, None
            if heads is not None:
                counted = Observation()
                heads.observe(counted, F.coalesce(F.sum(row_bytes(heads)), F.lit(0)).alias("n")).write.mode("overwrite").parquet(stage_dir + "/heads")
                heads, heads_bytes = spark.read.schema(heads.schema).parquet(stage_dir + "/heads"), counted.get["n"]
            typed_rows(parse(lines, spec, ctx, index_bytes, heads, heads_bytes), spec).write.mode("overwrite").parquet(stage_dir + "/rows")
            break
        except Exception as e:
            attempt += 1
            found = read_failures(spark, e, visible, attempt)
            if not found:
                raise
            unread |= found
            visible = [p for p in visible if p not in found]
    ph.mark("parse_convert_stage")

    # one row a file: rows, dropped rows, first error
    unread_df = local_frame(spark, list(unread.items()), "_file string, _unread string")
    staged = spark.read.parquet(stage_dir + "/rows") if visible else None
    outcome = claimed.select(F.col("file_path").alias("_file"))
    if visible:
        outcome = outcome.join(file_verdict(staged, error_message(spec)).select("_file", "rows", "dropped", "first_error"), "_file", "left")
    else:
        outcome = outcome.select("_file", F.lit(0).alias("rows"), F.lit(0).alias("dropped"), F.lit(None).cast("string").alias("first_error"))
    outcome = outcome.join(unread_df, "_file", "left").select(
        F.col("_file").alias("file_path"), F.coalesce("rows", F.lit(0)).cast("long").alias("rows_read"),
        F.coalesce("dropped", F.lit(0)).cast("long").alias("dropped"), F.coalesce("_unread", "first_error").alias("error"),
        F.col("_unread").isNotNull().alias("unread"))
    outcome.write.mode("overwrite").parquet(stage_dir + "/outcome")
    outcome = spark.read.parquet(stage_dir + "/outcome")
    good, bad = outcome.filter("error IS NULL"), outcome.filter("error IS NOT NULL")
    total = outcome.groupBy(F.col("error").isNull().alias("good"), "unread").agg(
        F.count("*").alias("n"), F.sum("rows_read").alias("r"), F.sum("dropped").alias("d")).collect()
    n_good = sum(t.n for t in total if t.good)
    n_bad = sum(t.n for t in total if not t.good)
    n_bad_read = sum(t.n for t in total if not t.good and not t.unread)
    ph.mark("verdict")

    if n_good and staged is not None:
        out = staged.filter(F.col("_terr").isNull())
        if n_bad_read:
            failed_files = bad.filter("NOT unread").select(F.col("file_path").alias("_file"))
            if n_bad_read <= LITERAL_FILES:
                out = out.filter(~F.col("_file").isin([r._file for r in failed_files.collect()]))
            else:
                out = out.join(failed_files, "_file", "left_anti")
        write_run(output_only(out, spec), table_path, run_id, spec.event_time_field, spec.sort_fields)
        ph.mark("publish")

    now_done = now + dt.timedelta(seconds=time.time() - t0)     # what the files really took
    records = L.done(claimed, good.select("file_path", (F.col("rows_read") - F.col("dropped")).alias("rows"), "rows_read"), now_done, seq, run_id)
    if n_bad:
        res.errors = {r.file_path: r.error for r in bad.orderBy("file_path").limit(SHOWN_ERRORS).collect()}
        records = records.unionByName(L.fail(claimed, bad.select("file_path", "error"), now_done, seq, spec.retry_failed, spec.retry_interval_s,
                                             spec.max_retries, spec.dead_letter_dir, run_id))
        records.write.mode("overwrite").parquet(stage_dir + "/records")
        records = spark.read.parquet(stage_dir + "/records")
        dead = records.filter("status = 'dead'").select("file_path", "error").join(outcome.select("file_path", "unread"), "file_path")
        res.files_dead = dead.count()
        res.files_failed = n_bad
        if res.files_dead and dead_letter_path:
            # of a file that can't be read, the reason alone is kept
            letters = dead.filter("unread").select(F.lit(spec.name).alias("pipeline"), "file_path", F.lit(None).cast("string").alias("line"), F.col("error").alias("reason"))
            if n_bad_read:
                letters = letters.unionByName(dead_letter_rows(lines, dead.filter("NOT unread"), spec.name, n_dead=res.files_dead))
            write_lines(letters, dead_letter_path, run_id)
    append_ledger(records, store.batch_dir(ledger_path, spec.name, seq // store.SEQS))            # commit point
    ph.mark("ledger_commit")
    if spec.archive_dir and n_good and lines is not None:
        # the files are done: an archive that fails takes nothing back
        try:
            write_lines(archive_rows(lines, good, spec.name, n_files=n_good), spec.archive_dir, run_id)
        except Exception as e:
            warnings.warn(f"pipeline {spec.name}: archive of run {run_id} failed: {e}")
        ph.mark("archive")
    _remove(spark, stage_dir)
    store.compact(spark, ledger_path, spec.name)
    res.phases = ph.times
    res.files_done = n_good
    res.rows_read = sum(t.r for t in total if t.good)
    res.transform_errors = sum(t.d for t in total if t.good)
    res.rows_written = res.rows_read - res.transform_errors
    return res


def committed_runs(spark: SparkSession, ledger_path: str, pipeline: str, status: str = "done") -> DataFrame:
    """Run ids holding published rows: runs named by a current ``done`` record (dead-letter
    rows: ``status="dead"``)."""
    cur = store.read_latest(spark, ledger_path, pipeline)
    return cur.filter(F.col("status") == status).select("run_id").distinct()
