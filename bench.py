"""Benchmark: end-to-end file ingestion (the reference's published metric) plus the
headline registered queries, at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Setup (untimed): the DNS-like feed derived from ``events`` (header line per file)
and the HTTP-like feed derived from ``lineitem`` (``|++|`` delimiter) are written as
real files into landing folders, with an IP-range file derived from ``customer``.
Timed: loading the IP table, one ``run_once`` per pipeline (list → ledger → read →
parse → enrich → typed → verdict → publish → ledger), then each headline query
(executed with a no-op sink).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filament.plans import catalog as C  # noqa: E402
from filament.plans import derived as D  # noqa: E402
from filament.plans.run import load_context, run_once  # noqa: E402
from filament.session import build_session, checkpoint_base  # noqa: E402

HEADLINE = ["ingest_events", "line_numbers", "split_quoted", "cast_ints", "cast_times", "ip_lookup",
            "ip_lookup_overlap", "file_verdict", "dedup_rows", "ledger_latest", "enqueue_files", "sink_layout"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    spark = build_session(f"local[{cpus}]", cpus, "filament-bench",
                          extra={"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": "16m"})
    root = tempfile.mkdtemp(prefix="filament-bench-")
    if not checkpoint_base(spark):
        spark.sparkContext.setCheckpointDir(root + "/ckpt")

    # -- setup (untimed)
    dns_dir = D.write_landing(spark, D.dns_texts(spark, sf_dir), root + "/dns", "f{}.cdr", D.N_FILES)
    http_dir = D.write_landing(spark, D.http_texts(spark, sf_dir), root + "/http", "h{}.log", D.N_HTTP_FILES)
    ip_dir = D.write_landing(spark, D.ip_table_texts(spark, sf_dir), root + "/ip", "ipdb{}.csv", 1)
    with open(root + "/http_method.csv", "w") as fh:
        fh.write("".join(f"{k},{v}\n" for k, v in D.METHODS.items()))
    dns, http = D.dns_spec(dns_dir), D.http_spec(http_dir, root + "/http_method.csv")

    # -- timed ingestion
    times: dict[str, float] = {}
    t0 = time.time()
    ctx = load_context(spark, [dns, http], ip_dir + "/ipdb0.csv", list(D.RANGE_ATTRS))
    times["load_dimensions"] = time.time() - t0
    rows = 0
    phases: dict[str, dict] = {}
    for spec in (dns, http):
        t = time.time()
        r = run_once(spark, spec, ctx, root + "/ledger", root + "/tables/" + spec.name)
        times["ingest_" + spec.name] = time.time() - t
        phases[spec.name] = r.phases
        rows += r.rows_written
        if r.files_failed:
            raise SystemExit(f"bench ingestion failed files: {r.errors}")
    ingest_s = time.time() - t0

    # -- timed headline queries
    qs = C.QUERIES
    for name in HEADLINE:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = time.time() - t

    out = {"metric": "end_to_end_ingest_sec", "value": round(ingest_s, 3), "unit": "sec",
           "rows": rows, "rows_per_sec": round(rows / ingest_s, 1),
           "queries": {k: round(v, 3) for k, v in times.items()},
           "ingest_phases": phases, "total_sec": round(sum(times.values()), 3), "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": cpus}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
