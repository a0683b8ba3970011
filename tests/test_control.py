"""Readiness, the ledger transitions and the reports over it, as pure DataFrame functions."""
import datetime as dt

from pyspark.sql import functions as F

from filament.operators import ledger as L
from filament.operators.ready import ready_files
from filament.spec import FieldSpec, PipelineSpec

NOW = dt.datetime(2026, 5, 18, 12, 0, 0, tzinfo=dt.timezone.utc)


def _listing(spark, rows):
    return spark.createDataFrame([(f"/d/{n}", n, d, 10, m, "") for n, d, m in rows],
                                 "path string, name string, is_dir boolean, size long, mtime timestamp, uri string")


def _spec(**kw):
    return PipelineSpec(name="p", watch_dir="/d", table="t", fields=[FieldSpec("a")], **kw)


def test_marker_required(spark):
    old = NOW - dt.timedelta(hours=2)
    lst = _listing(spark, [("cdr.csv", False, old), ("cdr2.csv", False, old), ("cdr2.csv.ok", False, old),
                           ("dir.csv", True, old), ("dir.csv.ok", False, old), ("x.csv.tmp", False, old),
                           ("x.csv.tmp.ok", False, old)])
    got = sorted(r.name for r in ready_files(lst, _spec(file_pattern="*.csv", ready_strategy="marker"), NOW).collect())
    assert got == ["cdr2.csv"]


def test_temp_suffix_and_stable_delay(spark):
    lst = _listing(spark, [("a.csv", False, NOW - dt.timedelta(hours=2)), ("b.csv", False, NOW - dt.timedelta(seconds=5)),
                           ("c.csv.tmp", False, NOW - dt.timedelta(hours=2)), ("d.csv.writing", False, NOW),
                           ("e.csv", False, NOW - dt.timedelta(hours=1))])
    atomic = sorted(r.name for r in ready_files(lst, _spec(file_pattern="*"), NOW).collect())
    assert atomic == ["a.csv", "b.csv", "e.csv"]
    stable = sorted(r.name for r in ready_files(lst, _spec(ready_strategy="stable_size", stable_delay_s=3600), NOW).collect())
    assert stable == ["a.csv", "e.csv"]          # the boundary (exactly the delay) is ready


def _cur(spark, rows):
    return L.latest(spark.createDataFrame(rows, L.LEDGER_SCHEMA)) if rows else L.latest(L.empty_ledger(spark))


def test_ledger_lifecycle(spark):
    ready = spark.createDataFrame([("/data/a.csv", 5, NOW)], "path string, size long, mtime timestamp")
    log = []
    enq = L.enqueue(_cur(spark, log), ready, "dns", NOW, 1).collect()
    assert [(r.status, r.attempts) for r in enq] == [("pending", 0)]
    log += enq
    # re-enqueue of a pending file is allowed (keeps attempts)
    assert [r.status for r in L.enqueue(_cur(spark, log), ready, "dns", NOW, 2).collect()] == ["pending"]
    claimed = L.claim(_cur(spark, log), "dns", NOW, 3).collect()
    assert [r.status for r in claimed] == ["processing"]
    log += claimed
    assert L.claim(_cur(spark, log), "dns", NOW, 4).count() == 0          # no double claim
    # interrupted → recovered to pending
    rec = L.recover(_cur(spark, log), "dns", NOW, 5).collect()
    assert [r.status for r in rec] == ["pending"]
    cur = _cur(spark, log)
    err = spark.createDataFrame([("/data/a.csv", "boom")], "file_path string, error string")
    failed = L.fail(cur, err, NOW, 6, retry_failed=True, retry_interval_s=60, max_retries=3).collect()
    assert [(r.status, r.attempts, r.error) for r in failed] == [("failed", 1, "boom")]
    assert failed[0].next_retry_at == dt.datetime(2026, 5, 18, 12, 1, 0)
    log += failed
    # retry boundary is inclusive
    assert L.retry(_cur(spark, log), "dns", 3, NOW + dt.timedelta(seconds=59), 7).count() == 0
    assert L.retry(_cur(spark, log), "dns", 3, NOW + dt.timedelta(seconds=60), 7).count() == 1
    # done: rows set, error cleared, attempts kept; done files are not enqueued again
    v = spark.createDataFrame([("/data/a.csv", 42)], "file_path string, rows long")
    done = L.done(_cur(spark, log), v, NOW, 8, "r1").collect()
    assert [(r.status, r.rows, r.error, r.attempts) for r in done] == [("done", 42, "", 1)]
    log += done
    assert L.enqueue(_cur(spark, log), ready, "dns", NOW, 9).count() == 0


def test_max_retries_and_dead(spark):
    rec = [("dns", "/data/b.csv", 5, NOW, "processing", 0, 1, NOW, None, None, "", "", 1, "r", 0)]
    cur = _cur(spark, rec)
    err = spark.createDataFrame([("/data/b.csv", "bad")], "file_path string, error string")
    dead = L.fail(cur, err, NOW, 2, True, 5, 2, "/dead").collect()[0]
    assert (dead.status, dead.attempts, dead.dead_letter_to, dead.next_retry_at) == ("dead", 2, "/dead/b.csv", None)
    no_dir = L.fail(cur, err, NOW, 2, True, 5, 2, "").collect()[0]
    assert (no_dir.status, no_dir.dead_letter_to) == ("dead", "")
    no_retry = L.fail(cur, err, NOW, 2, False, 5, 2).collect()[0]
    assert (no_retry.status, no_retry.next_retry_at) == ("failed", None)
    # a dead file is never eligible again
    assert L.retry(_cur(spark, rec + [tuple(dead)]), "dns", 5, NOW + dt.timedelta(days=1), 3).count() == 0


def test_latest_and_status(spark):
    rows = [("p", "/f", 1, NOW, s, 0, 0, NOW, None, None, "", "", q, "r", 0) for s, q in
            [("pending", 1), ("processing", 3), ("done", 2)]]
    cur = _cur(spark, rows)
    assert [r.status for r in cur.collect()] == ["processing"]
    assert [(r.status, r.files) for r in L.status_counts(cur).collect()] == [("processing", 1)]


def test_counters_over_the_whole_ledger(spark):
    """A file that failed twice and then passed has two failures; names are sanitized."""
    from filament.operators.report import counters_from_ledger, throughput_from_ledger
    at = lambda s: NOW + dt.timedelta(seconds=s)
    log = []
    for seq, (status, when, retry, rows, read) in enumerate([
            ("pending", 0, None, 0, None), ("processing", 1, None, 0, None), ("failed", 3, at(9), 0, None), ("pending", 9, None, 0, None),
            ("processing", 10, None, 0, None), ("failed", 14, None, 0, None), ("pending", 20, None, 0, None), ("processing", 21, None, 0, None),
            ("done", 22, None, 40, 45)]):
        log.append(("a.b é", "/f", 1, NOW, status, rows, 0, at(when), retry, None, "", "", seq, "r", read))
    log.append(("a.b é", "/g", 1, NOW, "processing", 0, 0, at(2), None, None, "", "", 0, "r", None))
    log.append(("a.b é", "/g", 1, NOW, "dead", 0, 0, at(4), None, None, "", "", 1, "r", None))
    df = spark.createDataFrame(log, L.LEDGER_SCHEMA)
    got = {(r.pipeline, r.metric): r.value for r in counters_from_ledger(df).collect()}
    want = {"files_seen_total": 2, "files_processing_total": 4, "files_done_total": 1, "files_failed_total": 3, "files_dead_total": 1,
            "files_scheduled_retry_total": 1, "files_failed_no_retry_total": 1, "rows_read_total": 45, "rows_written_total": 40,
            "transform_errors_total": 5, "file_process_ms_total": 9000}
    assert got == {("a_b___", k): v for k, v in want.items()}
    t = throughput_from_ledger(df).collect()[0]
    assert (t.rows_written, t.elapsed_ms, t.rows_per_sec) == (40, 21000, 1)
