"""Benchmark: the pipeline and the headline queries at one scale factor.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1) and
prints ONE JSON line:
  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Steps timed (each fully executed; outputs written or sunk to ``noop``):
  medallion   raw events -> Silver (+ dead letter) -> 3 Gold tables, written
  daily_job   cohort Gold + DQ report for every day, read back from Silver
  q01..q15    analytics SQL over the *written* Gold/Silver tables
  dq_suite    Silver expectation suite, per day, one pass
  stream      availableNow run of the Silver + hourly sales stream queries
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from ripplelake.fixtures import raw_events
    from ripplelake.operators import quality
    from ripplelake.operators.bronze import to_payload
    from ripplelake.plans import analytics, jobs
    from ripplelake.session import build_session, scratch_path
    from ripplelake.streaming.pipeline import run_streaming_pipeline

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), app="ripplelake-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    # Warm-up (not timed): one pass of the same jobs over the small sf0.001
    # tables, so JIT/codegen start-up is not billed to the measured scale.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        warm = scratch_path(spark, "bench-warm")
        jobs.run_medallion(spark, raw_events(spark, warm_dir), warm).collect()
        jobs.run_daily(spark, warm, None, gate=False).collect()
    run(raw_events(spark, sf_dir).limit(10))

    base = scratch_path(spark, "bench-lake")
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    timed("medallion", lambda: jobs.run_medallion(spark, raw_events(spark, sf_dir), base).collect())
    timed("daily_job", lambda: jobs.run_daily(spark, base, None, gate=False).collect())

    p = jobs.lake(base)
    tables = {
        "silver_events": spark.read.parquet(p["silver"]),
        "gold_revenue_metrics": spark.read.parquet(p["revenue"]),
        "gold_top_products": spark.read.parquet(p["products"]),
        "gold_user_segments": spark.read.parquet(p["segments"]),
    }
    for q in [f"q{i:02d}" for i in range(1, 16)]:
        timed(q, lambda q=q: analytics.run_query(spark, q, tables).collect())
    timed("dq_suite", lambda: quality.run_suite(tables["silver_events"], quality.SILVER_SUITE,
                                                by="event_date").collect())

    src = scratch_path(spark, "bench-src")
    to_payload(raw_events(spark, sf_dir)).write.text(src)
    lake2, ck = scratch_path(spark, "bench-stream"), scratch_path(spark, "bench-ck")
    timed("stream", lambda: run_streaming_pipeline(spark, src, lake2, ck, available_now=True,
                                                   only=["silver", "gold-sales"]).await_all())

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "events": n_events,
        "medallion_events_per_sec": round(n_events / times["medallion"], 1) if times["medallion"] else None,
        "stream_events_per_sec": round(n_events / times["stream"], 1) if times["stream"] else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
