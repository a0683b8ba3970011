"""Per-file verdict (A3, A4): rows per file and the first error by line order.

One bad row fails its file; files without data rows are still ``done`` with 0 rows,
so counts are left-joined from the list of claimed files.

Only counts and minimum positions are aggregated (hash aggregation with partial
aggregation; a string-valued ``min_by`` would force a sort of every row).  The
message of each failed file's first error is fetched afterwards from the error rows
at those positions.  Scanned lines are grouped per (file, split) first — positions
are row ids, ordered within a split — and combined per file on the small result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def _err(typed: DataFrame, error_col: str):
    return F.col(error_col).isNotNull()


def split_verdicts(typed: DataFrame, error_col: str = "_err_field") -> DataFrame:
    """Per (file, split) of scanned lines: rows, transform-dropped rows, errors and the
    first error position (row id)."""
    err = _err(typed, error_col)
    terr = F.col("_terr").isNotNull() if "_terr" in typed.columns else F.lit(False)
    return typed.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(terr.cast("long")).alias("_nterr"),
        F.count(F.when(err, 1)).alias("_nerr"),
        F.min(F.when(err, F.col("_mid"))).alias("_epos"))


def combine(per_unit: DataFrame) -> DataFrame:
    """Per file: ``rows, dropped, errors`` and the (split, position) of the first error."""
    per_file = per_unit.groupBy("_file").agg(
        F.sum("_n").alias("rows"), F.sum("_nterr").alias("dropped"), F.sum("_nerr").alias("errors"),
        F.min(F.when(F.col("_nerr") > 0, F.col("_block"))).alias("_eblock"))
    first = per_unit.select("_file", F.col("_block").alias("_eblock"), "_epos")
    return per_file.join(first, ["_file", "_eblock"], "left")


def keyed_verdicts(typed: DataFrame, error_col: str = "_err_field") -> DataFrame:
    """``combine`` for derived lines, ordered by (``_ord``, ``_pos``): the smallest ``_ord``
    with an error per file, then the smallest ``_pos`` in it, so neither is bounded."""
    err = _err(typed, error_col)
    terr = F.col("_terr").isNotNull() if "_terr" in typed.columns else F.lit(False)
    per_file = typed.groupBy("_file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(terr.cast("long")).alias("dropped"),
        F.count(F.when(err, 1)).alias("errors"), F.min(F.when(err, F.col("_ord"))).alias("_eblock"))
    first = typed.filter(err).groupBy("_file", F.col("_ord").alias("_eblock")).agg(F.min("_pos").alias("_epos"))
    return per_file.join(first, ["_file", "_eblock"], "left").select("_file", "rows", "dropped", "errors", "_eblock", "_epos")


BROADCAST_FILES = 100_000


def first_error_messages(typed: DataFrame, firsts: DataFrame, message, error_col: str = "_err_field",
                         n_firsts: int | None = None) -> DataFrame:
    """``_file, first_error`` for the positions in ``firsts`` (``_file, _eblock, _epos``);
    ``message`` builds the text from the row's error codes."""
    e = typed.filter(_err(typed, error_col)).withColumn("_msg", message)
    block, pos = ("_block", "_mid") if "_block" in typed.columns else ("_ord", "_pos")
    e = e.select("_file", F.col(block).alias("_eblock"), F.col(pos).cast("long").alias("_epos"), F.col("_msg").alias("first_error"))
    keys = ["_file", "_eblock", "_epos"]
    right = firsts.select(*keys)
    if n_firsts is not None and n_firsts <= BROADCAST_FILES:    # one row per failed file, counted
        right = F.broadcast(right)
    return e.join(right, keys, "inner").select("_file", "first_error")


def file_verdict(typed: DataFrame, message, error_col: str = "_err_field") -> DataFrame:
    """``_file, rows, dropped, errors, first_error`` per file present in ``typed``."""
    v = combine(split_verdicts(typed, error_col)) if "_block" in typed.columns else keyed_verdicts(typed, error_col)
    v = v.withColumn("_epos", F.col("_epos").cast("long"))
    firsts = v.filter(F.col("errors") > 0)
    msgs = first_error_messages(typed, firsts, message, error_col)
    return v.join(msgs, "_file", "left").drop("_eblock", "_epos")


def verdict_for_files(files: DataFrame, verdict: DataFrame) -> DataFrame:
    """Claimed files (``_file``) left-joined with their verdict: ``rows`` 0 when no row."""
    return (files.join(verdict, "_file", "left")
                 .withColumn("rows", F.coalesce(F.col("rows"), F.lit(0)).cast("long")))
