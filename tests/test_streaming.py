"""Streaming: late data against the watermark (FIXTURES.md section 3) and
the dedup-within-watermark helper."""
import json
import os

from conftest import SF, make_event

from ripplelake.operators.bronze import to_payload
from ripplelake.operators.silver import dedup_events
from ripplelake.plans.tables import PipelineTables
from ripplelake.session import scratch_path
from ripplelake.sources.readers import read_event_stream
from ripplelake.streaming import metrics
from ripplelake.streaming.pipeline import STATS_METRIC, run_streaming_pipeline, silver_stream


def _files(folder, batches):
    t0 = 1_700_000_000
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"part-{i}.json")
        with open(path, "w") as fh:
            for eid, hhmm in rows:
                fh.write(json.dumps(make_event(event_id=eid, timestamp=f"2024-01-01T{hhmm}:00+00:00")) + "\n")
        os.utime(path, (t0 + 10 * i, t0 + 10 * i))


def _run(spark, batches, name):
    src = scratch_path(spark, "late-src")
    os.makedirs(src)
    _files(src, batches)
    records = read_event_stream(spark, src, "text", max_files_per_trigger=1)
    agg = metrics.user_metrics(silver_stream(records))
    q = (agg.writeStream.format("memory").queryName(name).outputMode("append")
            .option("checkpointLocation", scratch_path(spark, "late-ck"))
            .trigger(availableNow=True).start())
    q.awaitTermination()
    dropped = sum((p.get("stateOperators") or [{}])[0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress)
    out = {r["window_start"].strftime("%H:%M"): r["total_events"]
           for r in spark.sql(f"SELECT * FROM {name}").collect()}
    return out, dropped


def test_late_row_dropped_after_watermark_moves(spark):
    batches = [[("a", "00:05"), ("b", "02:30")], [("f", "02:40")],
               [("late", "00:50"), ("inwm", "02:20")], [("c", "05:00")]]
    out, dropped = _run(spark, batches, "late_case")
    assert out == {"00:00": 1, "02:00": 3}
    assert dropped == 1


def test_late_row_counted_in_batch_after_raise(spark):
    batches = [[("a", "00:05"), ("b", "02:30")], [("late", "00:50"), ("inwm", "02:20")], [("c", "05:00")]]
    out, dropped = _run(spark, batches, "late_case2")
    assert out == {"00:00": 2, "02:00": 2}
    assert dropped == 0


def test_observed_stats_and_dedup_within_watermark(spark):
    src = scratch_path(spark, "dup-src")
    os.makedirs(src)
    rows = [("x", "00:05"), ("x", "00:06"), ("y", "00:07"), (None, "00:08")]
    with open(os.path.join(src, "part-0.json"), "w") as fh:
        for eid, hhmm in rows:
            fh.write(json.dumps(make_event(event_id=eid, timestamp=f"2024-01-01T{hhmm}:00+00:00")) + "\n")
    silver = silver_stream(read_event_stream(spark, src, "text"))
    q = (dedup_events(silver, within_watermark=True).writeStream.format("memory").queryName("dedup_case")
         .option("checkpointLocation", scratch_path(spark, "dup-ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    ids = sorted(r["event_id"] for r in spark.sql("SELECT event_id FROM dedup_case").collect())
    assert ids == ["x", "y"]
    stats = [p["observedMetrics"][STATS_METRIC] for p in q.recentProgress if p.get("observedMetrics")]
    assert stats[0]["total_read"] == 4 and stats[0]["total_valid"] == 3


def test_full_pipeline_starts_every_query(spark):
    src = scratch_path(spark, "pipe-src")
    to_payload(PipelineTables(spark, SF["0.001"]).raw_events).write.text(src)
    base, ck = scratch_path(spark, "pipe-lake"), scratch_path(spark, "pipe-ck")
    pipe = run_streaming_pipeline(spark, src, base, ck, available_now=True)
    pipe.await_all()
    assert set(pipe.queries) == {"bronze", "silver", "rejected", "gold-sales", "gold-users", "gold-products"}
    assert spark.read.parquet(f"{base}/bronze/raw_events").count() == 1000
    assert spark.read.parquet(f"{base}/silver/stream_events").count() == 916
    assert spark.read.json(f"{base}/silver/stream_rejected").count() == 84
    for table in ["sales_metrics", "user_metrics", "product_metrics"]:
        assert spark.read.parquet(f"{base}/gold/{table}").count() > 0
    pipe.stop()


def test_streaming_health_alarm(spark):
    from ripplelake.operators import monitoring
    src = scratch_path(spark, "health-src")
    to_payload(PipelineTables(spark, SF["0.001"]).raw_events).write.text(src)
    pipe = run_streaming_pipeline(spark, src, scratch_path(spark, "health-lake"), scratch_path(spark, "health-ck"),
                                  available_now=True, only=["silver"])
    series = monitoring.streaming_progress_metrics(spark, pipe.queries.values())
    assert series.filter("metric = 'BatchProcessingTimeMs'").count() >= 2
    rules = monitoring.rules_frame(spark, monitoring.STREAMING_RULES)
    out = monitoring.threshold_alarm(series, rules).collect()
    assert out and all(r["alarm_name"] == "spark-batch-processing-slow" and not r["in_alarm"] for r in out)


def test_concurrent_pipeline_with_processing_time_triggers(spark):
    src = scratch_path(spark, "conc-src")
    to_payload(PipelineTables(spark, SF["0.001"]).raw_events).write.text(src)
    base, ck = scratch_path(spark, "conc-lake"), scratch_path(spark, "conc-ck")
    pipe = run_streaming_pipeline(spark, src, base, ck, trigger="1 second")
    try:
        assert all(q.isActive for q in pipe.queries.values())
        for stage in (["bronze"], ["silver", "rejected"], ["gold-sales", "gold-users", "gold-products"]):
            for name in stage:
                pipe.queries[name].processAllAvailable()
        assert spark.read.parquet(f"{base}/silver/stream_events").count() == 916
        assert spark.read.json(f"{base}/silver/stream_rejected").count() == 84
        assert spark.read.parquet(f"{base}/gold/user_metrics").count() > 0
    finally:
        pipe.stop()
    assert not any(q.isActive for q in pipe.queries.values())


def test_batch_and_stream_share_a_base(spark):
    from ripplelake.plans import jobs

    raw = PipelineTables(spark, SF["0.001"]).raw_events
    src, base, ck = (scratch_path(spark, f"both-{x}") for x in ("src", "lake", "ck"))
    to_payload(raw).limit(100).write.text(src)
    jobs.run_medallion(spark, raw, base)
    run_streaming_pipeline(spark, src, base, ck, available_now=True, only=["silver", "rejected"]).await_all()
    jobs.run_medallion(spark, raw, base)
    assert spark.read.parquet(f"{base}/silver/cleaned_events").count() == 916
    streamed = spark.read.parquet(f"{base}/silver/stream_events").count()
    assert streamed + spark.read.json(f"{base}/silver/stream_rejected").count() == 100
