"""The ledger on disk, the one-pass transitions, and files that can't be read."""
import datetime as dt
import os
import random
import shutil

from pyspark.sql import functions as F

from filament.operators import ledger as L
from filament.plans import run as R
from filament.plans.run import committed_runs, load_context, run_once
from filament.sinks import ledger_store as S
from filament.sinks.files import read_lines

from specs import DATA, GEO, shop_spec

NOW = dt.datetime(2026, 5, 18, 12, 0, 0, tzinfo=dt.timezone.utc)
GOOD = os.path.join(DATA, "shop", "shop_1.log")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*[n for n, _ in L.LEDGER_COLUMNS]).collect()), key=str)


def test_step_equals_the_four_transitions(spark):
    """One join gives the records that recover, retry, enqueue and claim give one after the other."""
    rng = random.Random(8)
    log = [("p" if rng.random() < 0.9 else "q", f"/d/f{i}", rng.choice([None, 3]), NOW, rng.choice(L.STATES), 5, rng.randrange(4), NOW,
            rng.choice([None, NOW, NOW + dt.timedelta(hours=1)]), None, rng.choice(["", None]), rng.choice(["", "boom"]), 1, rng.choice(["a-1", "b-2", None]), None)
           for i in range(150)]
    cur = spark.createDataFrame(log, L.LEDGER_SCHEMA)
    ready = spark.createDataFrame([(f"/d/f{i}", i, NOW) for i in range(0, 200, 2)], "path string, size long, mtime timestamp")
    for reclaim, retry, limit in ((None, True, 2), ("a-", True, -1), (None, False, 2)):
        mine = cur if reclaim is None else cur.filter(F.col("run_id").startswith(reclaim))
        moved = L.recover(mine, "p", NOW, 7)
        if retry:
            moved = moved.unionByName(L.retry(cur, "p", limit, NOW, 7))
        after = L.latest(cur.unionByName(moved))
        queued = L.enqueue(after, ready, "p", NOW, 8, "r")
        claimed = L.claim(L.latest(cur.unionByName(moved).unionByName(queued)), "p", NOW, 9, "r")
        got = L.step(cur, ready, "p", NOW, 7, "r", retry, limit, reclaim)
        assert rows_of(got) == rows_of(moved.unionByName(queued).unionByName(claimed))
    assert L.step(L.empty_ledger(spark), ready.limit(0), "p", NOW, 1, "r", True, 2).count() == 0


def batch(spark, path, pipeline, records):
    n = S.next_batch(spark, path, pipeline)
    R.append_ledger(spark.createDataFrame([(pipeline, f, 1, NOW, s, 0, 0, NOW, None, None, "", "", n * S.SEQS, "r", 0) for f, s in records], L.LEDGER_SCHEMA),
                    S.batch_dir(path, pipeline, n))
    return n


def test_snapshots_and_compaction(spark, tmp):
    path, want, total = f"{tmp}/ledger", {}, 0
    rng = random.Random(4)
    assert S.read_latest(spark, path).count() == 0 and S.read_history(spark, path).count() == 0 and not S.compact(spark, path, "a b/ü", True)
    for k in range(7):
        for pipeline in ("a b/ü", "c"):
            own = {f"/f{rng.randrange(12)}": rng.choice(L.STATES) for _ in range(4)}
            batch(spark, path, pipeline, own.items())
            want |= {(pipeline, f): s for f, s in own.items()}
            total += len(own)
        if k in (2, 3, 5):
            assert S.compact(spark, path, "a b/ü", force=True)
        if k == 4:  # a crash in the middle of a write leaves a folder that doesn't count
            os.makedirs(S.batch_dir(path, "c", S.next_batch(spark, path, "c")) + "/_temporary")
        latest = S.read_latest(spark, path)
        assert {(r.pipeline, r.file_path): r.status for r in latest.collect()} == want and latest.count() == len(want)
        assert S.read_history(spark, path).count() == total
    own = S.folders(spark, path)["a b/ü"]
    assert len(own.snapshot) == 2 and len(own.log) < 7 and not S.compact(spark, path, "c")      # too short a tail
    assert {r.file_path for r in S.read_latest(spark, path, "c").collect()} == {f for p, f in want if p == "c"}


def test_a_million_files(spark, tmp):
    """A snapshot of a million records, a tail, a listing as long: one pass, no collect of records, few rows written."""
    path, n = f"{tmp}/ledger", 1_000_000
    old = spark.range(n).select(F.lit("p").alias("pipeline"), F.format_string("/d/f%07d", "id").alias("file_path"), F.lit("done").alias("status"),
                                F.lit(0).alias("attempts"), F.lit(8).alias("seq"), F.lit("r0").alias("run_id"))
    R.append_ledger(L.conform(old), S.batch_dir(path, "p", 1))
    assert S.compact(spark, path, "p", force=True)
    batch(spark, path, "p", [("/d/f0000007", "failed"), ("/d/f0000008", "processing")])
    ready = spark.range(n + 5).select(F.format_string("/d/f%07d", "id").alias("path"), F.lit(1).cast("long").alias("size"), F.lit(NOW).cast("timestamp").alias("mtime"))
    state = S.read_latest(spark, path, "p")
    assert state.count() == n
    got = L.step(state, ready, "p", NOW, 100, "r1", True, 3)
    assert sorted(r.file_path for r in got.filter("status = 'processing'").collect()) == [f"/d/f{i:07d}" for i in (7, 8, *range(n, n + 5))]
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Window" not in plan             # the snapshot isn't shuffled to find the latest


def lone(spark, tmp, name, body, rounds):
    watch = os.path.join(tmp, "w")
    os.makedirs(watch)
    with open(os.path.join(watch, name), "wb") as fh:
        fh.write(body)
    spec = shop_spec(watch, max_retries=rounds)
    spec.file_pattern, spec.retry_interval_s = "*.log*", 0
    ctx = load_context(spark, [spec], DATA + "/sites.csv", GEO)
    go = lambda h: run_once(spark, spec, ctx, f"{tmp}/ledger", f"{tmp}/t", now=NOW + dt.timedelta(hours=h), dead_letter_path=f"{tmp}/dl")
    return watch, spec, go


def test_lone_unreadable_file(spark, tmp):
    """It fails by itself, up to dead, leaves its reason, and the next good file is ingested."""
    watch, spec, go = lone(spark, tmp, "a.log.gz", b"\x1f\x8b not gzip at all", 2)
    r = go(0)
    assert (r.files_failed, r.files_dead, r.files_done) == (1, 0, 0) and "a.log.gz" in list(r.errors.values())[0]
    r = go(1)
    assert (r.files_failed, r.files_dead) == (1, 1)
    last = S.read_latest(spark, f"{tmp}/ledger").collect()
    assert [(x.status, x.attempts) for x in last] == [("dead", 2)]
    letters = read_lines(spark, f"{tmp}/dl", committed_runs(spark, f"{tmp}/ledger", spec.name, "dead")).collect()
    assert [(x.line, x.file_path) for x in letters] == [(None, os.path.join(watch, "a.log.gz"))] and "a.log.gz" in letters[0].reason
    shutil.copy(GOOD, os.path.join(watch, "b.log"))
    r = go(2)
    assert (r.files_claimed, r.files_done, r.rows_written) == (1, 1, 2)


def test_many_unreadable_files_and_what_is_read_again(spark, tmp, monkeypatch):
    watch, spec, go = lone(spark, tmp, "bad0.log.gz", b"\x1f\x8b no", 5)
    for k in range(1, 5):
        shutil.copy(os.path.join(watch, "bad0.log.gz"), os.path.join(watch, f"bad{k}.log.gz"))
    shutil.copy(GOOD, os.path.join(watch, "ok.log"))
    probed, real = [], R.unreadable_files
    monkeypatch.setattr(R, "unreadable_files", lambda s, paths: probed.append(sorted(map(os.path.basename, paths))) or real(s, paths))
    r = go(0)
    assert (r.files_done, r.files_failed) == (1, 5) and len(probed) == 2 and len(probed[0]) == 1 and len(probed[1]) == 4
    assert all("ok.log" not in p for p in probed)
    # a failure of another kind reads nothing again and is raised
    assert R.read_failures(spark, RuntimeError("executor lost while /w/ok.log was read"), ["/w/ok.log"], 9) == {}
    assert R.named_files(RuntimeError("[FAILED_READ_FILE.NO_HINT] reading file:///w/a%20b.log. x"), ["/w/a b.log", "/w/a b.log.1", "/w/b.log"]) == ["/w/a b.log"]
