"""Continuous directory source (S10): Structured Streaming discovers new files, each
micro-batch's files are ingested with the batch operators.

``readStream.text(dir)`` keeps the file source's own log of seen files (so a file
is offered once), ``pathGlobFilter`` applies the name pattern, and ``maxFileAge`` is
set very high so late-copied old files are not silently skipped.  Inside
``foreachBatch`` the micro-batch's distinct file paths (one row per file) are
collected, temp-suffixed names dropped, and ``run_files`` enqueues, claims and
ingests them — the ledger keeps a replayed micro-batch from publishing a file twice.
Run ids start with the id that the checkpoint gives the query, so two streams, or a stream
begun anew, never share a run folder; a batch that is replayed after a crash takes back the
files that its stream left ``processing``, and each batch retries failed files that are due.
The text source passes over hidden names (``_x``, ``.x``); each batch adds those from
the folder's listing.
With the ``marker`` and ``stable_size`` readiness a file becomes ready without a new file
appearing (it grows old, or an empty marker joins it, which the text source never
offers).  Such a stream ticks: each trigger is one micro-batch of one row of
Spark's ``rate-micro-batch`` source, its handler lists the folder, and the files that are
ready by now go to the ledger, which is the stream's state: handled files drop out
of the same join that claims the new ones.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filament.functions.text import decode_file_uri
from filament.operators.chain import ChainContext
from filament.plans.run import run_files, run_ready
from filament.operators.ready import ready_files
from filament.session import shared_dir
from filament.sources.listing import list_dir
from filament.spec import PipelineSpec, SpecError


def start_stream(spark: SparkSession, spec: PipelineSpec, ctx: ChainContext, ledger_path: str, table_path: str,
                 checkpoint: str | None = None, available_now: bool = True, interval: str = "30 seconds",
                 max_files_per_trigger: int | None = None, dead_letter_path: str = "") -> StreamingQuery:
    ticks = spec.ready_strategy != "atomic_rename"
    if ticks and max_files_per_trigger:
        raise SpecError("max_files_per_trigger needs the atomic_rename readiness: a tick takes all files that are ready")
    checkpoint = checkpoint or shared_dir(spark, f"stream-{spec.name}")
    if ticks:
        src = (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load())
    else:
        reader = (spark.readStream.format("text").option("lineSep", "\n")
                  .option("pathGlobFilter", spec.file_pattern).option("maxFileAge", "36500d"))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        src = reader.load(spec.watch_dir_clean).select(F.col("_metadata.file_path").alias("_uri"),
                                                       F.col("_metadata.file_size").alias("_size"),
                                                       F.col("_metadata.file_modification_time").alias("_mtime"))
    owner = None

    def stream_id() -> str:
        """The query id that Spark keeps in the checkpoint (the same after a restart)."""
        text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
        return "stream-" + json.loads(text)["id"]

    suffixes = tuple(x for x in spec.temp_suffixes if x)
    base = spec.watch_dir_clean

    def handle(batch, epoch_id: int) -> None:
        nonlocal owner
        owner = owner or stream_id()
        files = (batch.groupBy("_uri").agg(F.max("_size").alias("_size"), F.max("_mtime").alias("_mtime"))
                      .select(decode_file_uri(F.col("_uri")).alias("p"), "_size", "_mtime").collect())
        todo = []
        for r in files:
            name = r.p.rsplit("/", 1)[-1]
            if suffixes and name.endswith(suffixes):
                continue
            todo.append((f"{base}/{name}" if base not in (".", "") else name, int(r._size or 0), r._mtime))
        known = {t[0] for t in todo}
        hidden = ready_files(list_dir(spark, base).filter(F.col("name").rlike("^[_.]")), spec, dt.datetime.now(dt.timezone.utc))
        todo += [(r.path, r.size, r.mtime) for r in hidden.collect() if r.path not in known]
        if todo:
            run_files(spark, spec, ctx, todo, ledger_path, table_path, owner, dead_letter_path=dead_letter_path)

    def tick(batch, epoch_id: int) -> None:
        nonlocal owner
        owner = owner or stream_id()
        now = dt.datetime.now(dt.timezone.utc)
        ready = ready_files(list_dir(spark, base), spec, now).select("path", "size", "mtime")
        run_ready(spark, spec, ctx, ready, ledger_path, table_path, owner, now, dead_letter_path)

    w = src.writeStream.foreachBatch(tick if ticks else handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
