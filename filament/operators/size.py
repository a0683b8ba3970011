"""Sizes that decide about broadcasts: bytes, not rows, and counted, not guessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from filament.functions.text import col

#: bytes up to which the small side of a join is broadcast; beyond that Spark decides at run time
BROADCAST_BYTES = 256 << 20
#: bytes of a row besides its texts: fixed-width fields, hash slot and pointers
ROW_BYTES = 128


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: its texts and ``ROW_BYTES``."""
    texts = [F.coalesce(F.octet_length(col(f.name)), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, StringType)]
    out = F.lit(ROW_BYTES).cast("long")
    for t in texts:
        out = out + t
    return out


def frame_bytes(df: DataFrame) -> int:
    """Bytes of all rows (one aggregation)."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("n")).first().n


def small_side(df: DataFrame, n_bytes: int | None) -> DataFrame:
    """``df`` marked for broadcast if it is known to be small; of unknown size or larger, AQE decides when the
    side is there."""
    return F.broadcast(df) if n_bytes is not None and n_bytes <= BROADCAST_BYTES else df
