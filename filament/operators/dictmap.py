"""Dictionary mapping.

Exact, case-sensitive lookup of a row key.  Absent key → no-op; hit → mapped value
(which may be empty); miss → value kept, or ``default`` when one is set; the result
goes to ``target`` (else in place).  Small dictionaries become a map literal inside
the projection (no join at all); large ones a left join on the key, broadcast
while its counted bytes allow.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filament.functions.text import col
from filament.operators.size import frame_bytes, small_side

MAP_LITERAL_MAX = 1000


def map_literal(d: dict[str, str]):
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def _apply(df: DataFrame, field: str, hit, mapped, target: str, default: str) -> DataFrame:
    tgt = target or field
    current = col(tgt) if tgt in df.columns else F.lit(None).cast("string")
    miss = F.lit(default) if default else current
    return df.withColumn(tgt, F.when(col(field).isNull(), current).when(hit, mapped).otherwise(miss))


def dict_map(df: DataFrame, field: str, mapping: dict[str, str], target: str = "", default: str = "") -> DataFrame:
    """J3 with an in-memory dictionary (inline ``dict`` in a spec)."""
    if field not in df.columns:
        return df
    if len(mapping) <= MAP_LITERAL_MAX:
        m = map_literal(mapping) if mapping else F.create_map().cast("map<string,string>")
        looked = F.try_element_at(m, col(field))
        hit = looked.isNotNull()           # dictionary values are never NULL
        return _apply(df, field, hit, looked, target, default)
    spark = df.sparkSession
    table = spark.createDataFrame(list(mapping.items()), "key string, value string")
    return dict_map_table(df, field, table, frame_bytes(table), target, default)


def dict_map_table(df: DataFrame, field: str, table: DataFrame, table_bytes: int | None = None,
                   target: str = "", default: str = "") -> DataFrame:
    """J3 with a dictionary DataFrame ``key, value`` (unique keys)."""
    if field not in df.columns:
        return df
    right = table.select(F.col("key").alias("_dk"), F.col("value").alias("_dv"), F.lit(True).alias("_dhit"))
    right = small_side(right, table_bytes)
    j = df.join(right, col(field) == F.col("_dk"), "left")
    out = _apply(j, field, F.col("_dhit").isNotNull(), F.col("_dv"), target, default)
    return out.drop("_dk", "_dv", "_dhit")
