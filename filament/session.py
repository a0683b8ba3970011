"""Session helpers: a tuned local session for tests/bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "filament",
                  extra: dict | None = None) -> SparkSession:
    """Session used by tests and bench.  On a cluster, configure the session outside and
    pass it in; nothing in the library requires these settings except the time zone."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # many small input files: pack by size, not by a 4 MB per-file open cost
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .config("spark.sql.files.minPartitionNum", str(2 * max(1, shuffle_partitions)))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # the call site of every column expression costs a dozen round trips to the JVM; plans here have thousands
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_base(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    return sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder under the cluster's shared checkpoint location (``spark.checkpoint.dir``).

    The setting is read from the session; only when it is unset in a local session (tests)
    a scratch folder is created and set as the context's checkpoint folder.  A cluster that
    names none is an error: its executors would write to disks of their own.
    """
    base = checkpoint_base(spark)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="filament-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir() or base
    if base.startswith("file:"):
        base = base[len("file:"):]
    return base.rstrip("/") + "/" + sub


def local_frame(spark: SparkSession, rows: list, schema):
    """A small control-plane DataFrame (file paths, ledger records, verdicts) built
    through Arrow as a local relation: no Python worker is started to hold it.
    Naive datetimes are taken as local time, as PySpark returns them."""
    import datetime as _dt

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, TimestampType

    st = schema if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    cols = []
    for i, f in enumerate(st.fields):
        vals = [None if r is None else r[i] for r in rows]
        if isinstance(f.dataType, TimestampType):
            vals = [None if v is None else v.astimezone(_dt.timezone.utc) for v in vals]
        cols.append(vals)
    arrow_schema = to_arrow_schema(st)
    table = pa.Table.from_arrays([pa.array(c, type=arrow_schema.field(i).type) for i, c in enumerate(cols)],
                                 schema=arrow_schema)
    return spark.createDataFrame(table, schema=st)
