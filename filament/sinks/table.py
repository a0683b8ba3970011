"""Typed table sink (K1–K3, O2) and run-scoped publication.

Rows are appended as Parquet under ``<table>/run_id=<id>/`` partitioned by the event
month (``yyyyMM`` of the event-time column).  With an event time the rows are range-partitioned on
(month, storage order) first — one shuffle and a sampling pass over the staged rows — so a
run writes few files per month, the table is ordered, and a month that holds most rows
is split by event time instead of landing in one task.  A run folder is written once: a
folder that exists is an error, never overwritten.  The ledger append after the write is the
commit point: ``read_table`` returns only the runs it is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH_COL = "event_month"
INGEST_TIME_COL = "ingest_time"


def with_layout(df: DataFrame, event_time: str = "", sort_fields: tuple[str, ...] = (),
                ingest_time: bool = True, range_partitions: int | None = None) -> DataFrame:
    """K2 + K3 + O2: month column, ingest time default, sorted output.

    With ``range_partitions`` the rows are range-partitioned on (month, storage
    order) first: each task writes one contiguous key range, so a run spanning many
    months writes few files per month (not one per task and month), the table is
    globally ordered, and a month holding most rows is split by event time across
    tasks rather than landing in one."""
    if ingest_time and INGEST_TIME_COL not in df.columns:
        df = df.withColumn(INGEST_TIME_COL, F.current_timestamp())
    order = []
    if event_time:
        df = df.withColumn(MONTH_COL, F.date_format(F.col(event_time), "yyyyMM"))
        order.append(MONTH_COL)
    order += [c for c in sort_fields]
    if order and range_partitions:
        df = df.repartitionByRange(range_partitions, *order)
    return df.sortWithinPartitions(*order) if order else df


def write_run(df: DataFrame, table_path: str, run_id: str, event_time: str = "",
              sort_fields: tuple[str, ...] = (), ingest_time: bool = True, range_partitions: int | None = None) -> str:
    """K1: append one run's rows; returns the run directory."""
    out = f"{table_path.rstrip('/')}/run_id={run_id}"
    if range_partitions is None and event_time:
        range_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = with_layout(df, event_time, sort_fields, ingest_time, range_partitions)
    w = laid.write.mode("errorifexists")
    if event_time:
        w = w.partitionBy(MONTH_COL)
    w.parquet(out)
    return out


def read_table(spark: SparkSession, table_path: str, committed_runs: list[str] | DataFrame) -> DataFrame:
    """Published rows: only the committed runs given (``plans.run.committed_runs``; ``run_id``
    partition pruning).  What a crashed run left behind is never returned."""
    df = spark.read.option("basePath", table_path).parquet(table_path)
    if isinstance(committed_runs, DataFrame):
        # one row per committed run: collected (control plane) so the filter prunes
        # run_id partitions at planning time
        runs = [r.run_id for r in committed_runs.select("run_id").distinct().collect()]
        return df.filter(F.col("run_id").isin(runs))
    return df.filter(F.col("run_id").isin(list(committed_runs)))
