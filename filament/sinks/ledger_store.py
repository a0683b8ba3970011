"""The ledger on disk: per pipeline a log of batches, and snapshots of the latest records.

::

    <ledger>/pipeline=<name>/log/batch=<n>/       records appended together
                            /snapshot/upto=<n>/   latest record per file of batches 1..n
                            /history/upto=<n>/    batches of a compaction, in one place

The state of a pipeline is its newest snapshot overlaid with the batches after it (``read_latest``); the whole history
is the ``history`` folders and the batches after the newest of them (``read_history``).  ``compact`` merges both when
the tail has grown; batches and snapshots that a reader may still hold are removed one compaction later.  A folder counts
once its ``_SUCCESS`` file is there, so a crash leaves nothing half visible.  A pipeline has one runner at a
time; pipelines don't share folders.  No step collects records or sends them through one task.
"""

from __future__ import annotations

import re
import urllib.parse
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filament.operators import ledger as L

#: batches after a snapshot at which the tail is folded in: at least the first if they weigh a quarter of the snapshot, at the latest the second
COMPACT_FROM, COMPACT_AT = 16, 64
#: a tail of so many bytes on disk has its keys broadcast
BROADCAST_TAIL_BYTES = 4 << 20
#: sequence numbers of a batch
SEQS = 8
_NAME = re.compile(r"/pipeline=([^/]*)/(log|snapshot|history)/(?:batch|upto)=(\d+)/_SUCCESS$")


@dataclass
class Folders:
    """Complete folders of one pipeline, by number."""
    log: dict[int, str] = field(default_factory=dict)
    snapshot: dict[int, str] = field(default_factory=dict)
    history: dict[int, str] = field(default_factory=dict)

    def tail(self, upto: int) -> list[str]:
        return [p for n, p in sorted(self.log.items()) if n > upto]


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def pipeline_dir(path: str, pipeline: str) -> str:
    return f"{path.rstrip('/')}/pipeline={urllib.parse.quote(pipeline, safe='')}"


def folders(spark: SparkSession, path: str) -> dict[str, Folders]:
    """All complete folders, from one listing (a few dozen names a pipeline, however many records)."""
    out: dict[str, Folders] = {}
    p, fs = _fs(spark, path.rstrip("/") + "/pipeline=*/*/*/_SUCCESS")
    for st in fs.globStatus(p) or []:
        where = st.getPath().toString()
        m = _NAME.search(where)
        if m:
            own = out.setdefault(urllib.parse.unquote(m[1]), Folders())
            getattr(own, m[2])[int(m[3])] = where[:-len("/_SUCCESS")]
    return out


def next_batch(spark: SparkSession, path: str, pipeline: str) -> int:
    """The number of the batch to write: beyond all that were ever begun."""
    used = [0]
    for kind in ("log", "snapshot", "history"):
        p, fs = _fs(spark, f"{pipeline_dir(path, pipeline)}/{kind}")
        if fs.exists(p):
            used += [int(n) for st in fs.listStatus(p) for n in re.findall(r"=(\d+)$", st.getPath().getName())]
    return max(used) + 1


def batch_dir(path: str, pipeline: str, batch: int) -> str:
    return f"{pipeline_dir(path, pipeline)}/log/batch={batch:012d}"


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    return L.conform(spark.read.parquet(*paths)) if paths else L.empty_ledger(spark)


def _size(spark: SparkSession, paths: list[str]) -> int:
    return sum(fs.getContentSummary(p).getLength() for p, fs in (_fs(spark, x) for x in paths))


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Every record ever appended."""
    return _read(spark, [p for own in folders(spark, path).values()
                         for p in [*own.history.values(), *own.tail(max(own.history, default=0))]])


def overlay(snapshot: DataFrame, tail: DataFrame, small_tail: bool) -> DataFrame:
    """The latest records of a snapshot (one a file) and the records after it."""
    newer = L.latest(tail)
    keys = newer.select(*L.KEY)
    return snapshot.join(F.broadcast(keys) if small_tail else keys, L.KEY, "left_anti").unionByName(newer)


def _state(spark: SparkSession, own: Folders, upto: int | None = None) -> DataFrame:
    upto = max(own.snapshot, default=0) if upto is None else upto
    tail = own.tail(upto)
    if not upto:
        return L.latest(_read(spark, tail))
    snapshot = _read(spark, [own.snapshot[upto]])
    return overlay(snapshot, _read(spark, tail), _size(spark, tail) <= BROADCAST_TAIL_BYTES) if tail else snapshot


def read_latest(spark: SparkSession, path: str, pipeline: str | None = None) -> DataFrame:
    """The latest record of each file, of one pipeline or all."""
    found = folders(spark, path)
    parts = [_state(spark, own) for name, own in found.items() if pipeline in (None, name)]
    out = parts[0] if parts else L.empty_ledger(spark)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def compact(spark: SparkSession, path: str, pipeline: str, force: bool = False) -> bool:
    """Fold the tail into a new snapshot and its batches into one history folder, if there is enough of it."""
    own = folders(spark, path).get(pipeline, Folders())
    upto = max(own.snapshot, default=0)
    tail = own.tail(upto)
    if not tail or not force and (len(tail) < COMPACT_FROM or (
            len(tail) < COMPACT_AT and upto and 4 * _size(spark, tail) < _size(spark, [own.snapshot[upto]]))):
        return False
    last, base = max(own.log), pipeline_dir(path, pipeline)
    held = max(own.history, default=0)
    if held < last:
        _read(spark, own.tail(held)).write.mode("overwrite").parquet(f"{base}/history/upto={last:012d}")
    _state(spark, own).write.mode("overwrite").parquet(f"{base}/snapshot/upto={last:012d}")
    # what the compaction before this one covered is read by nobody now
    for n, p in own.log.items():
        if n <= upto:
            _remove(spark, p)
    for n, p in own.snapshot.items():
        if n < upto:
            _remove(spark, p)
    return True
