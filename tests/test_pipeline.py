"""End-to-end runs on the fixture files: golden rows, failure → retry → dead letter, hidden,
empty, vanished and unreadable files, crashes, provenance, streaming and plan shape."""
import datetime as dt
import hashlib
import os
import re
import shutil
import time

import pytest
from pyspark.sql import functions as F

from filament.operators import ledger as L
from filament.plans import run as R
from filament.plans.ingest import parse, typed_rows
from filament.plans.run import committed_runs, load_context, read_ledger, run_once
from filament.sinks.files import read_lines
from filament.sinks.table import read_table, write_run
from filament.sources.lines import scan_lines
from filament.spec import DedupSpec, FieldSpec

from filament.streaming.stream import start_stream
from specs import DATA, GEO, shop_spec, voice_spec

NOW = dt.datetime(2025, 5, 1, tzinfo=dt.timezone.utc)
GOOD, BAD = os.path.join(DATA, "shop", "shop_1.log"), os.path.join(DATA, "bad", "shop_bad.log")


@pytest.fixture(scope="module")
def ctx(spark):
    return load_context(spark, [shop_spec(DATA + "/shop")], DATA + "/sites.csv", GEO)


def folder(tmp, name="w"):
    path = os.path.join(tmp, name)
    os.makedirs(path)
    return path


def rows_of(spark, tmp, spec, sub):
    return read_table(spark, f"{tmp}/tables/{sub}", committed_runs(spark, f"{tmp}/ledger", spec.name))


def states(spark, tmp):
    return {r.file_path.rsplit("/", 1)[1]: (r.status, r.attempts) for r in L.latest(read_ledger(spark, f"{tmp}/ledger")).collect()}


def test_voice_golden(spark, ctx, tmp):
    spec = voice_spec(DATA + "/voice")
    r = run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/v", now=NOW)
    assert (r.files_done, r.rows_written, r.files_failed) == (1, 4, 0)
    rows = sorted(rows_of(spark, tmp, spec, "v").collect(), key=lambda x: x.started)
    assert {(x.switch, x.area) for x in rows} == {("msc-7", "west")}
    assert [x.route for x in rows] == ["trunk-12", "trunk;13", "trunk-12", "trunk-1"]
    assert [x.codec for x in rows] == ["PCMA", "PCMU", "G729", "99"] and [x.cause for x in rows] == [16, 31, 0, 16]
    assert [(x.caller_site, x.caller_owner) for x in rows] == [("Lyon", "core"), ("Turin", "edge"), ("Lyon", "core"), ("", "")]
    assert [(x.callee_site, x.callee_owner) for x in rows] == [("peer-a", "carrier"), ("lab", ""), ("peer-a", "carrier"), ("lab", "")]
    assert [x.event_month for x in rows] == [202503, 202503, 202503, 202504]
    assert all(x.ingest_time is not None for x in rows)                    # K3
    assert run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/v", now=NOW).files_claimed == 0


def test_shop_golden_and_archive(spark, ctx, tmp):
    spec = shop_spec(DATA + "/shop", archive_dir=f"{tmp}/archive")
    r = run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW)
    assert (r.files_done, r.rows_written) == (1, 2)
    rows = sorted(rows_of(spark, tmp, spec, "s").collect(), key=lambda x: x.at)
    assert [(x.verb, x.status_code, int(x.bytes_sent), x.url) for x in rows] == [("GET", 200, 5120, "/cart?id=1"), ("POST", 502, 0, "/pay")]
    assert [(x.client_site, x.server_site) for x in rows] == [("Lyon", "lab"), ("", "lab")]
    kept = read_lines(spark, f"{tmp}/archive", committed_runs(spark, f"{tmp}/ledger", spec.name)).collect()
    assert sorted(x.line for x in kept) == open(GOOD).read().splitlines()


def test_failing_archive_takes_nothing_back(spark, ctx, tmp):
    with open(f"{tmp}/file", "w") as fh:
        fh.write("not a folder")
    spec = shop_spec(DATA + "/shop", archive_dir=f"{tmp}/file")
    with pytest.warns(UserWarning, match="archive of run"):
        r = run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW)
    assert r.files_done == 1 and rows_of(spark, tmp, spec, "s").count() == 2
    assert states(spark, tmp) == {"shop_1.log": ("done", 0)}


def test_bad_file_retry_then_dead(spark, ctx, tmp):
    watch = folder(tmp)
    shutil.copy(BAD, watch)
    spec = shop_spec(watch, dead_letter_dir=os.path.join(tmp, "dead"))
    go = lambda later: run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW + later, dead_letter_path=f"{tmp}/dl")
    r1 = go(dt.timedelta())
    assert (r1.files_failed, r1.files_dead, r1.rows_written) == (1, 0, 0)
    err = list(r1.errors.values())[0]
    assert err == 'field "status_code": strconv.ParseUint: parsing "teapot": invalid syntax'
    assert go(dt.timedelta(seconds=2)).files_claimed == 0          # before the retry interval
    r3 = go(dt.timedelta(minutes=5))
    assert (r3.files_failed, r3.files_dead) == (1, 1)
    last = read_ledger(spark, f"{tmp}/ledger").orderBy(F.desc("seq")).first()
    assert (last.status, last.attempts, last.dead_letter_to) == ("dead", 2, os.path.join(tmp, "dead") + "/shop_bad.log")
    dl = read_lines(spark, f"{tmp}/dl", committed_runs(spark, f"{tmp}/ledger", spec.name, "dead")).collect()
    assert [(x.reason, x.pipeline, x.line) for x in dl] == [(err, "shop", open(BAD).read().rstrip("\n"))]
    assert not os.path.exists(f"{tmp}/tables/s")                    # no rows published
    assert go(dt.timedelta(days=1)).files_claimed == 0


def test_dead_letters_once_after_a_crash(spark, ctx, tmp, monkeypatch):
    watch = folder(tmp)
    shutil.copy(BAD, watch)
    spec = shop_spec(watch, max_retries=1)
    go = lambda: run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW, dead_letter_path=f"{tmp}/dl")
    real, calls = R.append_ledger, []

    def crash(df, path):
        calls.append(path)
        if len(calls) == 2:                                           # behind the dead letters, before the commit
            raise RuntimeError("crash")
        real(df, path)

    monkeypatch.setattr(R, "append_ledger", crash)
    with pytest.raises(RuntimeError):
        go()
    assert go().files_dead == 1
    assert read_lines(spark, f"{tmp}/dl", committed_runs(spark, f"{tmp}/ledger", spec.name, "dead")).count() == 1


def test_crash_before_commit_publishes_once(spark, ctx, tmp, monkeypatch):
    watch = folder(tmp)
    shutil.copy(GOOD, watch)
    spec = shop_spec(watch)
    real, calls = R.append_ledger, []

    def crash(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("crash")
        real(df, path)

    monkeypatch.setattr(R, "append_ledger", crash)
    with pytest.raises(RuntimeError):
        run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW)
    assert rows_of(spark, tmp, spec, "s").count() == 0                # written, not committed
    run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW)
    assert rows_of(spark, tmp, spec, "s").count() == 2
    with pytest.raises(Exception, match="already exists"):
        write_run(spark.range(1), f"{tmp}/tables/s", committed_runs(spark, f"{tmp}/ledger", spec.name).first()[0])


def test_hidden_empty_and_mixed_files(spark, ctx, tmp):
    watch = folder(tmp)
    good = open(GOOD).read()
    for name, body in [("ok.log", good), ("_hidden.log", good), (".dot.log", good.rstrip("\n")), ("empty.log", ""), ("blank.log", "\n \n"),
                       ("bad.log", good + open(BAD).read())]:
        with open(os.path.join(watch, name), "w") as fh:
            fh.write(body)
    spec = shop_spec(watch)
    r = run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/m", now=NOW)
    assert (r.files_done, r.files_failed, r.rows_written) == (5, 1, 6)
    assert states(spark, tmp) == {"ok.log": ("done", 0), "_hidden.log": ("done", 0), ".dot.log": ("done", 0), "empty.log": ("done", 0),
                                  "blank.log": ("done", 0), "bad.log": ("failed", 1)}
    assert rows_of(spark, tmp, spec, "m").count() == 6                      # the bad file published nothing


def test_vanished_and_unreadable_files(spark, ctx, tmp):
    """A file that is gone or broken fails by itself, up to dead; the others publish."""
    watch = folder(tmp)
    shutil.copy(BAD, os.path.join(watch, "gone.log"))
    spec = shop_spec(watch)
    go = lambda n: run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", now=NOW + dt.timedelta(hours=n))
    go(0)
    os.remove(os.path.join(watch, "gone.log"))
    shutil.copy(GOOD, os.path.join(watch, "ok.log"))
    with open(os.path.join(watch, "broken.log.gz"), "wb") as fh:
        fh.write(b"\x1f\x8b not gzip at all")
    spec.file_pattern = "*.log*"
    r = go(1)
    assert (r.files_done, r.files_failed, r.files_dead) == (1, 2, 1)
    assert "no such file" in r.errors[os.path.join(watch, "gone.log")] and "broken.log.gz" in r.errors[os.path.join(watch, "broken.log.gz")]
    assert states(spark, tmp) == {"gone.log": ("dead", 2), "broken.log.gz": ("failed", 1), "ok.log": ("done", 0)}
    assert go(2).files_dead == 1 and states(spark, tmp)["broken.log.gz"] == ("dead", 2)
    assert rows_of(spark, tmp, spec, "s").count() == 2


def test_provenance_fields(spark, ctx, tmp):
    spec = voice_spec(DATA + "/voice", dedup=DedupSpec(enabled=True))
    spec.fields = spec.fields + [FieldSpec(n, "String", generated=True) for n in
                                 ("_etl_source_file", "_etl_line_number", "_etl_row_hash", "_etl_record_id")]
    run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/p", now=NOW)
    rows = sorted(rows_of(spark, tmp, spec, "p").collect(), key=lambda x: int(x._etl_line_number))
    assert [x._etl_source_file for x in rows] == ["calls_a.cdr"] * 4
    assert [x._etl_line_number for x in rows] == ["2", "3", "4", "5"]
    path = os.path.join(DATA, "voice", "calls_a.cdr")
    h = hashlib.sha1(open(path).read().split("\n")[1].encode()).hexdigest()
    assert rows[0]._etl_row_hash == h
    assert rows[0]._etl_record_id == hashlib.sha1(f"{path}\0" f"2\0{h}\0".encode()).hexdigest()


def stream(spark, spec, ctx, tmp, ck="ck"):
    start_stream(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", checkpoint=f"{tmp}/{ck}").awaitTermination()


def test_streaming_again_and_anew(spark, ctx, tmp):
    watch = folder(tmp)
    spec = shop_spec(watch)
    shutil.copy(GOOD, os.path.join(watch, "a.log"))
    shutil.copy(GOOD, os.path.join(watch, "_h.log"))
    with open(os.path.join(watch, "b.log.tmp"), "w") as fh:
        fh.write("partial")
    stream(spark, spec, ctx, tmp)
    assert rows_of(spark, tmp, spec, "s").count() == 4
    stream(spark, spec, ctx, tmp)
    assert rows_of(spark, tmp, spec, "s").count() == 4                # nothing new
    shutil.copy(GOOD, os.path.join(watch, "c.log"))
    stream(spark, spec, ctx, tmp)
    assert rows_of(spark, tmp, spec, "s").count() == 6
    shutil.copy(GOOD, os.path.join(watch, "d.log"))
    stream(spark, spec, ctx, tmp, ck="ck2")                           # a checkpoint begun anew starts at batch 0 again
    assert rows_of(spark, tmp, spec, "s").count() == 8


def test_streaming_replay_after_a_crash(spark, ctx, tmp, monkeypatch):
    """A crash behind the claim: the replayed batch takes its files back and publishes once."""
    watch = folder(tmp)
    spec = shop_spec(watch)
    shutil.copy(GOOD, os.path.join(watch, "a.log"))
    monkeypatch.setattr(R, "ingest_claimed", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(Exception, match="crash"):
        stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("processing", 0)}
    monkeypatch.undo()
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 2


def test_streaming_retries(spark, ctx, tmp):
    watch = folder(tmp)
    spec = shop_spec(watch)
    spec.retry_interval_s = 0
    shutil.copy(BAD, os.path.join(watch, "a.log"))
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("failed", 1)}
    shutil.copy(GOOD, os.path.join(watch, "a.log"))                   # mended in place; the next batch retries it
    shutil.copy(GOOD, os.path.join(watch, "b.log"))
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("done", 1), "b.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 4


def test_streaming_by_age(spark, ctx, tmp):
    """A stream with stable_size takes a file once it is old enough, though no new file starts a batch."""
    watch = folder(tmp)
    spec = shop_spec(watch)
    spec.ready_strategy, spec.stable_delay_s = "stable_size", 3600
    for name in ("a.log", "b.log"):
        shutil.copy(GOOD, os.path.join(watch, name))
    long_ago = time.time() - 7200
    os.utime(os.path.join(watch, "a.log"), (long_ago, long_ago))
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 2
    os.utime(os.path.join(watch, "b.log"), (long_ago, long_ago))
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("done", 0), "b.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 4
    stream(spark, spec, ctx, tmp)
    assert rows_of(spark, tmp, spec, "s").count() == 4


def test_streaming_by_marker(spark, ctx, tmp):
    """A stream with marker takes a file when its empty marker is there, in ticks of a running query too."""
    watch = folder(tmp)
    spec = shop_spec(watch)
    spec.ready_strategy, spec.marker_suffix = "marker", ".ok"
    for name in ("a.log", "b.log"):
        shutil.copy(GOOD, os.path.join(watch, name))
    open(os.path.join(watch, "a.log.ok"), "w").close()
    stream(spark, spec, ctx, tmp)
    assert states(spark, tmp) == {"a.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 2
    running = start_stream(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/tables/s", checkpoint=f"{tmp}/ck2", available_now=False,
                           interval="1 second")
    try:
        open(os.path.join(watch, "b.log.ok"), "w").close()
        end = time.time() + 60
        while states(spark, tmp).get("b.log") != ("done", 0) and time.time() < end:
            time.sleep(1)
    finally:
        running.stop()
    assert states(spark, tmp) == {"a.log": ("done", 0), "b.log": ("done", 0)} and rows_of(spark, tmp, spec, "s").count() == 4


def test_plan_shape(spark, ctx):
    """No nested-loop join, no Python on the row path, and no shuffle at all when
    the spec needs no line numbers."""
    spec = shop_spec(DATA + "/shop")
    typed = typed_rows(parse(scan_lines(spark, [GOOD], directory=DATA + "/shop"), spec, ctx), spec)
    plan = typed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "PythonUDF" not in plan and "EvalPython" not in plan
    main_path = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in main_path and "BroadcastHashJoin" in plan


def test_aggregates_are_hash_based(spark, ctx, tmp):
    """The per-split line index and the per-file verdict aggregate counts and minimum
    positions only: hash aggregation with partial aggregation, never a sort of all rows."""
    from filament.operators.verdict import split_verdicts
    from filament.sources.lines import scan_lines, split_index
    spec = voice_spec(DATA + "/voice")
    lines = scan_lines(spark, [DATA + "/voice/calls_a.cdr"], directory=DATA + "/voice")
    for df in (split_index(lines), split_verdicts(typed_rows(parse(lines, spec, ctx, 1), spec))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_one_broadcast_serves_all_ip_fields(spark, ctx):
    """Two IP fields are looked up in one broadcast table: the second join reuses the exchange."""
    spec = shop_spec(DATA + "/shop")
    spark.conf.set("spark.sql.adaptive.enabled", "false")        # the reuse is planned ahead then
    try:
        typed = typed_rows(parse(scan_lines(spark, [GOOD], directory=DATA + "/shop"), spec, ctx), spec)
        plan = typed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"ReusedExchange \[_rb#", plan)) == 1


def test_sides_over_the_bound_are_not_broadcast(spark, ctx, monkeypatch):
    from filament.operators import size
    monkeypatch.setattr(size, "BROADCAST_BYTES", 10)
    assert ctx.ip_table_bytes > 10
    spec = shop_spec(DATA + "/shop")
    typed = typed_rows(parse(scan_lines(spark, [GOOD], directory=DATA + "/shop"), spec, ctx), spec)
    assert "strategy=broadcast" not in typed._jdf.queryExecution().optimizedPlan().toString()


def test_frame_bytes(spark):
    from filament.operators.size import ROW_BYTES, frame_bytes
    df = spark.createDataFrame([("é", None, 1), (None, "abc", 2)], "a string, `b.c` string, n int")
    assert frame_bytes(df) == 2 * ROW_BYTES + 5 and frame_bytes(df.limit(0)) == 0


def test_context_releases_its_tables(spark, tmp):
    spec = shop_spec(folder(tmp))
    own = load_context(spark, [spec], os.path.join(DATA, "sites.csv"), GEO)
    held = list(own.held)
    assert len(held) == 3 and all(d.storageLevel.useMemory for d in held)
    own.close()
    assert not own.held and not any(d.storageLevel.useMemory for d in held)
