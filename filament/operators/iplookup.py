"""IP range lookup (J1) and multi-field IP enrichment.

Lookup semantics: the *last* range (in start order, ties by file order) whose start
is ≤ ip, accepted only if ip ≤ its end.  Spark has no range join, and a ``BETWEEN``
join is both wrong (overlaps match twice) and a nested loop.  The rewrite:

1. clip every range to end before the next range's start (``lead`` over all ranges,
   including inverted ones, which shadow but never match) → disjoint intervals that
   give the same answer;
2. explode each interval over the /16 buckets it covers (≤ ranges + 65,536 rows since
   the intervals are disjoint);
3. equi-join the probe on ``ip >> 16`` with the residual ``ip BETWEEN start AND end``:
   a broadcast hash join when the exploded table is small (the usual case), else a
   shuffle join (AQE splits a hot bucket of probes).

The ``lead`` runs per /16 bucket of the start plus one bounded window (≤ 65,536
rows) carrying each bucket's first start to the previous bucket: no single-task sort
of the whole table.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filament.functions.ip import ip_to_u32
from filament.functions.text import col, go_trim
from filament.operators.size import small_side


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """``start, end`` clipped so intervals are disjoint and the lookup answer is kept.
    Input needs ``start, end, _order``; rows with NULL start/end are dropped."""
    r = ranges.filter(F.col("start").isNotNull() & F.col("end").isNotNull())
    r = r.withColumn("_sb", F.shiftright("start", 16))
    in_bucket = Window.partitionBy("_sb").orderBy("start", "_order")
    r = r.withColumn("_next_in", F.lead("start").over(in_bucket))
    # first start of the following non-empty bucket (bounded: one row per bucket)
    firsts = r.groupBy("_sb").agg(F.min("start").alias("_first"))
    firsts = firsts.withColumn("_next_bucket_first", F.lead("_first").over(Window.orderBy("_sb"))).drop("_first")
    r = r.join(F.broadcast(firsts), "_sb", "left")
    nxt = F.coalesce(F.col("_next_in"), F.col("_next_bucket_first"))
    clipped = F.when(nxt.isNull(), F.col("end")).otherwise(F.least(F.col("end"), nxt - 1))
    return (r.withColumn("end", clipped)
             .filter(F.col("end") >= F.col("start"))
             .drop("_sb", "_next_in", "_next_bucket_first"))


def bucketed_ranges(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges exploded over the /16 buckets they cover (column ``_bucket``)."""
    d = disjoint_ranges(ranges)
    return d.withColumn("_bucket", F.explode(F.sequence(F.shiftright("start", 16), F.shiftright("end", 16))))


def lookup(df: DataFrame, ip: "F.Column", table: DataFrame, attrs: list[str], prefix: str,
           table_bytes: int | None = None) -> DataFrame:
    """Left-join the attributes of the range containing ``ip`` as ``_m_<attr>`` plus a
    ``_m_hit`` flag.  ``table`` comes from ``bucketed_ranges``; ``table_bytes`` is its
    counted size (``size.frame_bytes``; broadcast while small)."""
    probe = df.withColumn("_ipv", ip).withColumn("_ipb", F.shiftright("_ipv", 16))
    right = table.select(
        F.col("_bucket").alias("_rb"), F.col("start").alias("_rs"), F.col("end").alias("_re"),
        *[F.col(a).alias(f"_m_{a}") for a in attrs], F.lit(True).alias("_m_hit"))
    right = small_side(right, table_bytes)
    cond = ((F.col("_ipb") == F.col("_rb")) & (F.col("_ipv") >= F.col("_rs")) & (F.col("_ipv") <= F.col("_re")))
    return probe.join(right, cond, "left").drop("_ipv", "_ipb", "_rb", "_rs", "_re")


def ip_enrich(df: DataFrame, fields: list[str], label_fields: list[str], table: DataFrame,
              attrs: list[str], table_bytes: int | None = None, trimmed: Collection[str] = ()) -> DataFrame:
    """For each field in order, look its (trimmed) value up; on a match write
    ``<prefix>_<attr>`` for every attribute the range has, overwriting; empty or absent
    values and misses leave the columns as they are.  The prefix is the label at the
    field's first position in ``fields``, else the field name.  All probe integers are
    computed in one projection before the joins."""
    present = [f for f in fields if f in df.columns]          # absent key: no-op
    # trimmed keys first, as their own columns: the conversion references its input
    # many times inside CASE branches, where Spark does not share subexpressions
    keys = {f"_ik{j}": (col(field) if field in trimmed else go_trim(col(field))) for j, field in enumerate(present)}
    df = df.withColumns(keys) if keys else df
    ipcols = {f"_ip{j}": F.when(F.col(f"_ik{j}") != "", ip_to_u32(F.col(f"_ik{j}"))) for j in range(len(present))}
    df = df.withColumns(ipcols).drop(*keys) if ipcols else df
    for j, field in enumerate(present):
        idx = fields.index(field)
        prefix = label_fields[idx] if idx < len(label_fields) else field
        df = lookup(df, F.col(f"_ip{j}"), table, attrs, prefix, table_bytes)
        updates = {}
        for a in attrs:
            name = f"{prefix}_{a}"
            existing = col(name) if name in df.columns else F.lit(None).cast("string")
            updates[name] = F.when(F.col("_m_hit"), F.coalesce(F.col(f"_m_{a}"), existing)).otherwise(existing)
        df = df.withColumns(updates).drop("_m_hit", *[f"_m_{a}" for a in attrs])
    return df.drop(*ipcols)
