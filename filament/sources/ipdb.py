"""IP-range table source.

Text file ``start_ip,end_ip[,attr…]``: blank and ``#`` lines skipped, physical line 1
skipped when it looks like a header, split on ``,`` without quotes, rows with fewer
than two parts ignored, attributes named by ``columns`` (extra parts dropped, short
rows lack the attribute → NULL).  A bad start/end IP fails the whole load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.functions.ip import ip_to_u32
from filament.functions.text import go_trim
from filament.operators.size import ROW_BYTES

# Words that mark physical line 1 of an IP table as a header.
HEADER_WORDS = ["start", "begin", "起始"]


class IPTableError(ValueError):
    pass


def ranges_from_lines(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Ranges from a lines frame with ``_line`` (trimmed), ``_phys`` (1-based physical
    line number) and ``_order`` (file order).  Returns ``start, end, <columns…>,
    _order, _bad`` where ``_bad`` is an error message for an unparsable IP."""
    t = lines.filter((F.col("_line") != "") & ~F.col("_line").startswith("#"))
    header = F.lit(False)
    for w in HEADER_WORDS:
        header = header | F.col("_line").contains(w)
    t = t.filter(~((F.col("_phys") == 1) & header))
    t = t.withColumn("_p", F.split(F.col("_line"), ",", -1)).filter(F.size("_p") >= 2)
    t = (t.withColumn("_s", ip_to_u32(go_trim(F.get(F.col("_p"), 0))))
          .withColumn("_e", ip_to_u32(go_trim(F.get(F.col("_p"), 1)))))
    out = t.select(
        F.col("_s").alias("start"),
        F.col("_e").alias("end"),
        *[go_trim(F.get(F.col("_p"), i + 2)).alias(c) for i, c in enumerate(columns)],
        F.col("_order"),
        F.when(F.col("_s").isNull(), F.concat(F.lit("line "), F.col("_phys").cast("string"),
                                                    F.lit(': invalid start IP "'), F.get(F.col("_p"), 0), F.lit('"')))
         .when(F.col("_e").isNull(), F.concat(F.lit("line "), F.col("_phys").cast("string"),
                                                    F.lit(': invalid end IP "'), F.get(F.col("_p"), 1), F.lit('"')))
         .alias("_bad"),
    )
    return out


def load_ip_table(spark: SparkSession, path: str, columns: list[str], check: bool = True) -> DataFrame:
    """Read an IP table file into ``start, end, <columns…>, _order, _bad`` (one Spark job
    checks for bad IPs when ``check``; the table is a small dimension).  The frame is cached; who loads it
    releases it."""
    from filament.sources.lines import number_scanned, scan_lines
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    size = hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hp).getLen()
    max_split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    index_bytes = (size // max_split + 1) * (3 * len(path) + ROW_BYTES)      # one row per split
    lines = number_scanned(scan_lines(spark, path, keep_blank=True), index_bytes=index_bytes, with_head=False)
    lines = lines.withColumn("_phys", F.col("_line_no")).withColumn("_order", F.col("_line_no"))
    ranges = ranges_from_lines(lines, columns).cache()          # a small dimension, used twice
    if check:
        bad = ranges.filter(F.col("_bad").isNotNull()).select("_bad").limit(1).collect()
        if bad:
            raise IPTableError(bad[0][0])
    return ranges
