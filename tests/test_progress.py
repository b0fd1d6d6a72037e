"""Progress table, alarms over more than a hundred updates, and sketches that combine."""
import datetime as dt

from conftest import SF, make_event, raw_frame
from pyspark.sql import functions as F

from ripplelake.operators import gold, monitoring, silver
from ripplelake.operators.bronze import to_payload
from ripplelake.plans.tables import PipelineTables
from ripplelake.session import scratch_path
from ripplelake.streaming.pipeline import silver_stream


def update(second, rows=5, lag=1.0, ms=200, query="silver"):
    ts = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)
    out = {"name": query, "batchId": second, "timestamp": ts.isoformat().replace("+00:00", "Z"), "batchDuration": ms,
           "numInputRows": rows, "processedRowsPerSecond": 1.0}
    if rows:
        out["eventTime"] = {"max": (ts - dt.timedelta(seconds=lag)).isoformat().replace("+00:00", "Z")}
    return out


def alarms(spark, updates):
    table = monitoring.ProgressTable(spark, scratch_path(spark, "progress"), every=60)
    for u in updates:
        table.append(u)
    table.flush()
    found = table.read()
    assert found.count() == len(updates)
    out = monitoring.threshold_alarm(monitoring.progress_metrics(found), monitoring.rules_frame(spark, monitoring.PROGRESS_RULES))
    return {(r["alarm_name"], r["period_start"].minute) for r in out.filter("in_alarm").collect()}


def test_three_hundred_updates_all_count(spark):
    """Slow batches in the first five minutes alarm although the last hundred updates are quick."""
    slow = [update(s, ms=130000) for s in range(300)]
    assert alarms(spark, slow + [update(s) for s in range(300, 600)]) == {("spark-batch-processing-slow", 4)}
    assert alarms(spark, [update(s) for s in range(300)]) == set()


def test_lag_and_age_alarms(spark):
    late = [update(s, lag=61 if s < 180 else 2) for s in range(240)]
    assert alarms(spark, late) == {("consumer-lag-high", 2)}
    silent = [update(0)] + [update(s, rows=0) for s in range(1, 600)]
    assert alarms(spark, silent) == {("silver-no-new-data", m) for m in (7, 8, 9)}


def test_listener_keeps_every_update(spark):
    src = scratch_path(spark, "progress-src")
    to_payload(PipelineTables(spark, SF["0.001"]).raw_events).repartition(4).write.text(src)
    table = monitoring.ProgressTable(spark, scratch_path(spark, "progress"), every=2)
    spark.streams.addListener(table)
    try:
        q = (silver_stream(spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(src)
                           .withColumnRenamed("value", "raw_payload")).writeStream.format("noop")
             .option("checkpointLocation", scratch_path(spark, "progress-ck")).queryName("kept").trigger(availableNow=True).start())
        q.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20000)
        table.flush()
    finally:
        spark.streams.removeListener(table)
    got = table.read().filter("query = 'kept'")
    assert got.agg(F.sum("input_rows")).first()[0] == sum(p["numInputRows"] for p in q.recentProgress) > 0


def test_event_metrics_equal_single_readings(spark):
    raw = raw_frame(spark, [make_event(event_id=None if i % 5 == 0 else f"e{i}", revenue=i + 0.25,
                                       timestamp=f"2024-01-15T10:{i % 60:02d}:{i % 7:02d}+00:00") for i in range(100)])
    tagged = silver.tag_records(raw)
    single = tagged.select(F.lit("NullEventId").alias("metric"), F.col(silver.EVENT_TS).alias("ts"),
                           F.when(F.col("event_id").isNull(), 100.0).otherwise(0.0).alias("value"))
    rules = monitoring.rules_frame(spark, [("a", "NullEventId", s, 120, 10.0, ">", 2) for s in ("avg", "max", "sum", "count")])
    rules = rules.withColumn("alarm_name", F.col("statistic"))
    both = [sorted(map(tuple, monitoring.threshold_alarm(m, rules).collect())) for m in (single, monitoring.event_metrics(tagged))]
    assert both[0] == both[1] and both[0]


def test_sketches_combine(spark):
    t = PipelineTables(spark, SF["0.01"])
    stored = scratch_path(spark, "sketches")
    gold.buyer_sketches(t.silver_events).write.parquet(stored)
    for by in ([], ["country"], ["report_date"]):
        got = {tuple(r[c] for c in by): r["unique_buyers"] for r in gold.distinct_buyers(spark.read.parquet(stored), *by).collect()}
        exact = (t.silver_events.filter("event_type = 'purchase'").withColumn("report_date", F.col("event_date").cast("string"))
                 .groupBy(*by).agg(F.countDistinct("user_id").alias("n")).collect())
        assert len(got) == len(exact)
        for r in exact:
            assert abs(got[tuple(r[c] for c in by)] - r["n"]) <= max(2, 4 * gold.SKETCH_ERROR * r["n"])
