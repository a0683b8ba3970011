"""Helpers shared by the operators: reading tables, staging in the shared folder, Arrow maps."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: ids of a semi-join side are broadcast up to this many bytes (8 per id), else shuffled
BROADCAST_ID_BYTES = 32 << 20
#: rows that a Python function holds as Python objects at a time
SLICE_ROWS = 512
#: rows of whole texts, sets or ids that Spark hands to Python at a time where it stages; both sides hold them
BATCH_ROWS = 4 * SLICE_ROWS
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    Unset, a local session (``local[...]``) gets a temporary folder of its own, set as the
    checkpoint folder; a cluster must name one.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, so a lost executor
    never recomputes what came before, and later uses do not run it again."""
    spark = spark or df.sparkSession
    path = shared_folder(spark)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession):
    """Arrow batches of at most ``BATCH_ROWS`` rows (fewer if the session says so); the session's setting comes back."""
    rows = spark.conf.get(BATCH_SETTING)
    if 0 < int(rows) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_SETTING, rows)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` for a generator of column dicts (name -> list, numpy or Arrow array).  It
    gets at most ``SLICE_ROWS`` rows at a time, however large Spark's batches are."""
    st = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(st)

    def run(batches):
        for cols in fn(b.slice(a, SLICE_ROWS) for b in batches for a in range(0, b.num_rows, SLICE_ROWS)):
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type)
                 for f in arrow for c in [cols[f.name]]], schema=arrow)
        cols = None
        give_back()

    return df.mapInArrow(run, st)


def per_worker(key, make: Callable):
    """``make()`` once per Python worker process and key: tables and caches outlive a task
    (a worker that is lost or replaced makes them again)."""
    held = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held[key] = make()
        give_back()
    return held[key]


def forget(key):
    """Drops what a worker holds under ``key``; nothing if it holds none."""
    held = getattr(sys.modules.get("_llm_worker"), "held", {})
    if held.pop(key, None) is not None:
        give_back()


def give_back():
    """Hands free memory back to the system.  Arrow's pool and malloc keep what a task freed otherwise, and it counts for
    the executor in all stages to come.  It is taken anew at a cost, so this is for the end of a task, not for each batch."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def semi_join_ids(df: DataFrame, ids: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (or not, for ``left_anti``).  ``ids`` should be
    staged: it is counted, and broadcast only under the documented byte bound."""
    small = ids.count() * 8 * len(on) <= BROADCAST_ID_BYTES
    return df.join(F.broadcast(ids) if small else ids, on, how)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges(u, v)``: any comparable type, any direction, loops and repeats allowed.
    Returns ``(node, root)``, root the smallest node of the component, one row per node
    that has an edge to another node (the roots included).  Each round is two
    pre-aggregated minima joined back to the edges; hot nodes are split by Spark's skew
    join.  Nothing is collected but one changed/unchanged flag a round.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("u").alias("a"), F.col("v").alias("b"))
        if large:
            both = both.unionByName(e.select(F.col("v").alias("a"), F.col("u").alias("b")))
        m = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        j = both.join(m, "a")
        if large:  # each larger neighbour is hung on the smallest of the neighbourhood
            out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("u"), F.col("m").alias("v"))
        else:  # edges run from the larger end (a) to smaller ones (b); a itself hangs on the smallest too
            out = j.select(F.col("b").alias("u"), F.col("m").alias("v")).unionByName(
                m.select(F.col("a").alias("u"), F.col("m").alias("v")))
        return out.where(F.col("u") != F.col("v")).distinct()

    down = staged(edges.where(F.col("u") != F.col("v"))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        new = staged(star(star(down, large=True), large=False))
        same = new.join(down, ["u", "v"], "left_anti").isEmpty() and down.join(new, ["u", "v"], "left_anti").isEmpty()
        down = new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
