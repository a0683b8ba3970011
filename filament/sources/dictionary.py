"""Dictionary file source (S8): ``key,value`` lines.

Blank and ``#`` lines are skipped, a line is split at its first comma only, both
sides trimmed, lines without a comma ignored, and the last duplicate key wins.
With ``max_line_bytes`` a line of that size or more fails the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.functions.text import go_trim
from filament.sources.lines import scan_lines


class DictFileError(ValueError):
    pass


def dict_from_lines(lines: DataFrame) -> DataFrame:
    """``key, value`` from a lines frame with ``_line`` and a file order ``_o``."""
    t = lines.filter((F.col("_line") != "") & ~F.col("_line").startswith("#"))
    t = t.withColumn("_kv", F.split(F.col("_line"), ",", 2)).filter(F.size("_kv") == 2)
    t = t.select(go_trim(F.get(F.col("_kv"), 0)).alias("key"),
                 go_trim(F.get(F.col("_kv"), 1)).alias("value"), F.col("_o"))
    return t.groupBy("key").agg(F.max_by("value", "_o").alias("value"))


def load_dict_file(spark: SparkSession, path: str, max_line_bytes: int | None = None) -> DataFrame:
    lines = scan_lines(spark, path, max_line_bytes=max_line_bytes)
    if max_line_bytes and lines.filter("_too_long").limit(1).count():
        raise DictFileError(f"scan dict file: {path}: token too long")
    return dict_from_lines(lines.withColumn("_o", F.struct("_block", "_mid")))
