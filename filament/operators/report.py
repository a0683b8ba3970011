"""Reports over published rows and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filament.functions.text import sanitize_name

# The counters kept per pipeline.
LEDGER_METRICS = ["files_seen_total", "files_processing_total", "files_done_total", "files_failed_total", "files_dead_total",
                  "files_scheduled_retry_total", "files_failed_no_retry_total", "rows_read_total", "rows_written_total",
                  "transform_errors_total", "file_process_ms_total"]
ENDED = ("done", "failed", "dead")


def agg_count(df: DataFrame) -> DataFrame:
    """A1: row count of a table."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def agg_extent(df: DataFrame, time_col: str) -> DataFrame:
    """A2: min, max and count of the event time, and the ``min -> max`` text."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    a = df.agg(F.min(time_col).alias("min_time"), F.max(time_col).alias("max_time"), F.count(F.lit(1)).alias("n"))
    return a.withColumn("extent", F.concat(F.date_format("min_time", fmt), F.lit(" -> "), F.date_format("max_time", fmt)))


def counters_from_ledger(ledger: DataFrame) -> DataFrame:
    """A5: ``pipeline, metric, value`` (long form) over the whole ledger: every record counts, so a
    file that failed twice and then passed has two failures.  Processing time runs from a file's
    claim to the record that ends it.  Pipeline names are sanitized as metric names are."""
    w = Window.partitionBy("pipeline", "file_path").orderBy("seq")
    s, before = F.col("status"), F.lag(F.struct("status", "processed_at")).over(w)
    rec = ledger.withColumn("_before", before).withColumn("_first", (F.row_number().over(w) == 1).cast("long"))
    took = F.when(s.isin(*ENDED) & (F.col("_before.status") == "processing"),
                  F.unix_millis("processed_at") - F.unix_millis("_before.processed_at"))
    final = s.isin("failed", "dead")
    count = lambda c: F.count(F.when(c, 1))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    done_rows, read = F.when(s == "done", F.col("rows")), F.when(s == "done", F.coalesce("rows_read", "rows"))
    wide = rec.groupBy(sanitize_name(F.col("pipeline")).alias("pipeline")).agg(
        F.sum("_first").alias("files_seen_total"), count(s == "processing").alias("files_processing_total"),
        count(s == "done").alias("files_done_total"), count(final).alias("files_failed_total"), count(s == "dead").alias("files_dead_total"),
        count((s == "failed") & F.col("next_retry_at").isNotNull()).alias("files_scheduled_retry_total"),
        count((s == "failed") & F.col("next_retry_at").isNull()).alias("files_failed_no_retry_total"),
        total(read).alias("rows_read_total"), total(done_rows).alias("rows_written_total"),
        total(read - done_rows).alias("transform_errors_total"), total(took).alias("file_process_ms_total"))
    stack = ", ".join(f"'{m}', {m}" for m in LEDGER_METRICS)
    return wide.selectExpr("pipeline", f"stack({len(LEDGER_METRICS)}, {stack}) AS (metric, value)")


def throughput_from_ledger(ledger: DataFrame) -> DataFrame:
    """A6 per pipeline: rows of done files over the time from the first claim to the last end."""
    s = F.col("status")
    t = ledger.groupBy("pipeline").agg(
        F.coalesce(F.sum(F.when(s == "done", F.col("rows"))), F.lit(0)).alias("rows_written"),
        (F.max(F.when(s.isin(*ENDED), F.unix_millis("processed_at"))) - F.min(F.when(s == "processing", F.unix_millis("processed_at")))).alias("elapsed_ms"))
    return throughput(t, "rows_written", "elapsed_ms")


def throughput(df: DataFrame, rows_col: str, ms_col: str) -> DataFrame:
    """Rows per second — integer (floor 1 s) and exact."""
    rows, ms = F.col(rows_col).cast("long"), F.col(ms_col).cast("long")
    return df.select(
        "pipeline", rows.alias("rows_written"), ms.alias("elapsed_ms"),
        F.floor(rows / F.greatest(F.floor(ms / 1000), F.lit(1))).cast("long").alias("rows_per_sec"),
        (rows.cast("double") / (ms.cast("double") / F.lit(1000.0))).alias("rows_per_sec_exact"))
