"""Dead-letter (K5), archive (K6) and external-database (K4) sinks.

Files are never moved by Spark jobs: the content of a dead or archived file is
written as rows (raw line, file path, reason) under ``run_id=<id>/pipeline=<name>/``, which is
what a downstream replay needs.  Like the table, only runs that the ledger names count, so
lines written before a crash are not read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.sinks.table import read_table


BROADCAST_FILES = 100_000


def dead_letter_rows(lines: DataFrame, dead: DataFrame, pipeline: str, n_dead: int | None = None) -> DataFrame:
    """Raw lines of the files in ``dead`` (``file_path, error``) with the reason.  The
    file list (one row per dead file) is broadcast only when its counted size allows."""
    d = dead.select(F.col("file_path").alias("_file"), F.col("error").alias("reason"))
    if n_dead is not None and n_dead <= BROADCAST_FILES:
        d = F.broadcast(d)
    return (lines.join(d, "_file", "inner")
                 .select(F.lit(pipeline).alias("pipeline"), F.col("_file").alias("file_path"),
                         F.col("_raw").alias("line"), "reason"))


def write_lines(rows: DataFrame, path: str, run_id: str) -> None:
    """One run's dead-letter or archive rows, in a folder of their own."""
    rows.write.mode("errorifexists").partitionBy("pipeline").parquet(f"{path.rstrip('/')}/run_id={run_id}")


def read_lines(spark: SparkSession, path: str, committed_runs: DataFrame) -> DataFrame:
    """Dead-letter or archive rows of committed runs."""
    return read_table(spark, path, committed_runs)


def archive_rows(lines: DataFrame, files: DataFrame, pipeline: str, n_files: int | None = None) -> DataFrame:
    """Raw lines of successfully processed files (batch archive)."""
    f = files.select(F.col("file_path").alias("_file"))
    if n_files is not None and n_files <= BROADCAST_FILES:
        f = F.broadcast(f)
    return (lines.join(f, "_file", "left_semi")
                 .select(F.lit(pipeline).alias("pipeline"), F.col("_file").alias("file_path"), F.col("_raw").alias("line")))


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10000, properties: dict | None = None) -> None:
    """K4: append to an external database through Spark's JDBC writer (the driver jar
    must be on the cluster classpath; not exercised offline)."""
    (df.write.format("jdbc").mode("append")
       .option("url", url).option("dbtable", table).option("batchsize", str(batch_size))
       .options(**(properties or {})).save())
