"""File ledger as an append-only table.

Every state change is a new row; the current record of ``(pipeline, file_path)`` is
the row with the highest ``seq``.  Each transition is a pure function
``(latest, input, now, …) -> new rows`` that the caller appends; nothing mutates.
States: unknown, pending, processing, done, failed, dead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The file states.
STATES = ["unknown", "pending", "processing", "done", "failed", "dead"]

LEDGER_COLUMNS = [
    ("pipeline", "string"), ("file_path", "string"), ("file_size", "bigint"), ("file_mod_time", "timestamp"),
    ("status", "string"), ("rows", "bigint"), ("attempts", "int"), ("processed_at", "timestamp"),
    ("next_retry_at", "timestamp"), ("dead_letter_at", "timestamp"), ("dead_letter_to", "string"),
    ("error", "string"), ("seq", "bigint"), ("run_id", "string"), ("rows_read", "bigint"),
]
LEDGER_SCHEMA = ", ".join(f"{n} {t}" for n, t in LEDGER_COLUMNS)
KEY = ["pipeline", "file_path"]


def empty_ledger(spark: SparkSession) -> DataFrame:
    from filament.session import local_frame
    return local_frame(spark, [], LEDGER_SCHEMA)


def conform(df: DataFrame) -> DataFrame:
    """Ledger column order and types (columns that an older ledger lacks are NULL)."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in LEDGER_COLUMNS])


def latest(ledger: DataFrame) -> DataFrame:
    """The current record per key — the highest ``seq``, found with a hash
    aggregate (a struct-valued ``max_by`` would sort the whole ledger) and joined back
    on (key, seq); seq is unique per key."""
    top = ledger.groupBy(*KEY).agg(F.max("seq").alias("_top"))
    return (ledger.join(top, KEY).filter(F.col("seq") == F.col("_top"))
                  .select(*[n for n, _ in LEDGER_COLUMNS]))


def _ts(now: dt.datetime) -> Column:
    return F.lit(now).cast("timestamp")


def _rewrite(rec: DataFrame, seq: int, now: dt.datetime, **changes: Column) -> DataFrame:
    out = rec.withColumns({"processed_at": _ts(now), "seq": F.lit(seq).cast("bigint"), **changes})
    return conform(out)


def enqueue(latest_df: DataFrame, ready: DataFrame, pipeline: str, now: dt.datetime, seq: int,
            run_id: str = "") -> DataFrame:
    """L1 (J6): ready files with no record, or a ``pending``/``unknown`` one, become
    ``pending`` with size and mtime.  Attempts of an existing record are kept."""
    cur = latest_df.filter(F.col("pipeline") == pipeline)
    handled = cur.filter(~F.col("status").isin("unknown", "pending")).select("file_path")
    todo = ready.select(F.col("path").alias("file_path"), F.col("size").alias("file_size"),
                        F.col("mtime").alias("file_mod_time"))
    todo = todo.join(handled, "file_path", "left_anti")
    prev = cur.select("file_path", F.col("attempts").alias("_prev_attempts"))
    todo = todo.join(prev, "file_path", "left")
    return conform(todo.select(
        F.lit(pipeline).alias("pipeline"), "file_path", "file_size", "file_mod_time",
        F.lit("pending").alias("status"), F.lit(0).alias("rows"),
        F.coalesce(F.col("_prev_attempts"), F.lit(0)).alias("attempts"), _ts(now).alias("processed_at"),
        F.lit(None).alias("next_retry_at"), F.lit(None).alias("dead_letter_at"), F.lit("").alias("dead_letter_to"),
        F.lit("").alias("error"), F.lit(seq).alias("seq"), F.lit(run_id).alias("run_id")))


def claim(latest_df: DataFrame, pipeline: str, now: dt.datetime, seq: int, run_id: str = "",
          paths: DataFrame | None = None) -> DataFrame:
    """L2: ``pending`` → ``processing`` (other states are refused).  One claimer per run."""
    cur = latest_df.filter((F.col("pipeline") == pipeline) & (F.col("status") == "pending"))
    if paths is not None:
        cur = cur.join(paths.select("file_path"), "file_path", "left_semi")
    return _rewrite(cur, seq, now, status=F.lit("processing"), run_id=F.lit(run_id))


def recover(latest_df: DataFrame, pipeline: str, now: dt.datetime, seq: int) -> DataFrame:
    """L3: interrupted ``processing`` files go back to ``pending`` (at start)."""
    cur = latest_df.filter((F.col("pipeline") == pipeline) & (F.col("status") == "processing"))
    return _rewrite(cur, seq, now, status=F.lit("pending"))


def step(latest_df: DataFrame, ready: DataFrame, spec_name: str, now: dt.datetime, seq: int, run_id: str, retry_failed: bool,
         max_retries: int, reclaim: str | None = None) -> DataFrame:
    """L3, L6, L1 and L2 of a run in one pass: interrupted files (with ``reclaim`` those whose run id starts so) and
    failed ones that are due become ``pending``, ready files are enqueued, and all that is pending is claimed.
    One join of the latest records with the listing; up to three records a file, under ``seq`` to ``seq + 2``."""
    cur = latest_df.filter(F.col("pipeline") == spec_name)
    new = ready.select(F.col("path").alias("_path"), F.col("size").alias("_size"), F.col("mtime").alias("_mtime"))
    both = cur.join(new, F.col("file_path") == F.col("_path"), "full_outer")
    status, listed = F.coalesce("status", F.lit("unknown")), F.col("_path").isNotNull()
    stuck = status == "processing"
    if reclaim is not None:
        stuck = stuck & F.coalesce(F.col("run_id").startswith(reclaim), F.lit(False))
    due = (status == "failed") & F.lit(retry_failed) & (F.lit(max_retries < 0) | (F.col("attempts") < max_retries)) & (
        F.col("next_retry_at").isNull() | (_ts(now) >= F.col("next_retry_at")))
    both = both.withColumns({"_moved": stuck | due, "_due": due, "_known": F.col("file_path").isNotNull()})
    both = both.withColumn("_new", listed & (F.col("_moved") | status.isin("unknown", "pending")))
    both = both.withColumn("_claim", F.col("_new") | F.col("_moved") | (status == "pending")).filter("_claim")
    none = {n: F.lit(None).cast(t) for n, t in LEDGER_COLUMNS}
    held = {n: F.col(n) for n, _ in LEDGER_COLUMNS}
    moved = held | {"processed_at": _ts(now), "seq": F.lit(seq).cast("bigint"), "status": F.lit("pending"),
                    "next_retry_at": F.when(F.col("_due"), none["next_retry_at"]).otherwise(F.col("next_retry_at"))}
    queued = none | {"pipeline": F.lit(spec_name), "file_path": F.col("_path"), "file_size": F.col("_size"), "file_mod_time": F.col("_mtime"),
                     "status": F.lit("pending"), "rows": F.lit(0).cast("bigint"), "attempts": F.coalesce("attempts", F.lit(0)),
                     "processed_at": _ts(now), "dead_letter_to": F.lit(""), "error": F.lit(""), "seq": F.lit(seq + 1).cast("bigint"), "run_id": F.lit(run_id)}
    claimed = {n: F.when(F.col("_new"), queued[n]).otherwise(moved[n] if n == "next_retry_at" else held[n]) for n, _ in LEDGER_COLUMNS} | {
        "processed_at": _ts(now), "seq": F.lit(seq + 2).cast("bigint"), "status": F.lit("processing"), "run_id": F.lit(run_id)}

    def record(values: dict, when) -> Column:
        return F.when(when, F.struct(*[values[n].cast(t).alias(n) for n, t in LEDGER_COLUMNS]))

    rows = F.array(record(moved, F.col("_moved")), record(queued, F.col("_new")), record(claimed, F.lit(True)))
    return both.select(F.explode(F.array_compact(rows)).alias("r")).select("r.*")


def done(claimed: DataFrame, verdict: DataFrame, now: dt.datetime, seq: int, run_id: str) -> DataFrame:
    """L4: rows set, error cleared, attempts kept.  ``verdict``: ``file_path, rows`` and, where
    rows were dropped on the way, ``rows_read``."""
    read = F.col("rows_read") if "rows_read" in verdict.columns else F.col("rows")
    j = claimed.drop("rows", "rows_read").join(verdict.select("file_path", "rows", read.alias("rows_read")), "file_path")
    return _rewrite(j, seq, now, status=F.lit("done"), error=F.lit(""), run_id=F.lit(run_id))


def fail(claimed: DataFrame, errors: DataFrame, now: dt.datetime, seq: int, retry_failed: bool,
         retry_interval_s: float, max_retries: int, dead_letter_dir: str = "", run_id: str = "") -> DataFrame:
    """L5 then L7: ``failed`` with ``attempts+1`` and the next retry time (only when
    retrying with a positive interval); with retries, ``attempts >= max_retries`` makes
    the file ``dead`` (target in the dead-letter folder, or ``""`` without one)."""
    j = claimed.drop("error").join(errors.select("file_path", "error"), "file_path")
    attempts = F.col("attempts") + 1
    if retry_failed and retry_interval_s > 0:
        nxt = _ts(now) + F.expr(f"make_dt_interval(0, 0, 0, {float(retry_interval_s)})")
    else:
        nxt = F.lit(None).cast("timestamp")
    failed = j.withColumns({"attempts": attempts, "status": F.lit("failed"), "next_retry_at": nxt,
                            "run_id": F.lit(run_id)})
    if retry_failed:
        target = F.lit("") if not dead_letter_dir else F.concat(
            F.lit(dead_letter_dir.rstrip("/") + "/"), F.substring_index(F.col("file_path"), "/", -1))
        is_dead = F.col("attempts") >= F.lit(max_retries)
        failed = failed.withColumns({
            "status": F.when(is_dead, F.lit("dead")).otherwise(F.col("status")),
            "dead_letter_at": F.when(is_dead, _ts(now)),
            "dead_letter_to": F.when(is_dead, target).otherwise(F.coalesce(F.col("dead_letter_to"), F.lit(""))),
            "next_retry_at": F.when(is_dead, F.lit(None).cast("timestamp")).otherwise(F.col("next_retry_at")),
        })
    return _rewrite(failed, seq, now)


def retry_eligible(latest_df: DataFrame, pipeline: str, max_retries: int, now: dt.datetime) -> DataFrame:
    """L6 predicate: failed, attempts below the limit (or no limit), retry time reached."""
    return latest_df.filter(
        (F.col("pipeline") == pipeline) & (F.col("status") == "failed")
        & ((F.lit(max_retries) < 0) | (F.col("attempts") < F.lit(max_retries)))
        & (F.col("next_retry_at").isNull() | (_ts(now) >= F.col("next_retry_at"))))


def retry(latest_df: DataFrame, pipeline: str, max_retries: int, now: dt.datetime, seq: int) -> DataFrame:
    """Eligible failed files → ``pending`` with the retry time cleared."""
    return _rewrite(retry_eligible(latest_df, pipeline, max_retries, now), seq, now,
                    status=F.lit("pending"), next_retry_at=F.lit(None).cast("timestamp"))


def status_counts(latest_df: DataFrame) -> DataFrame:
    """Files per pipeline and status."""
    return latest_df.groupBy("pipeline", "status").agg(F.count(F.lit(1)).alias("files"))
