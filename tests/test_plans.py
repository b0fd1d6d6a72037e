"""Physical plan shape: pruning, pushdown, partial top-k, single-pass DQ."""
import pytest
from conftest import SF

from ripplelake.operators import gold, quality
from ripplelake.plans import jobs
from ripplelake.plans.tables import PipelineTables
from ripplelake.session import scratch_path
from ripplelake.sources import readers, sinks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver_path(spark):
    path = scratch_path(spark, "plan-silver")
    sinks.write_silver(PipelineTables(spark, SF["0.001"]).silver_events, path)
    return path


def test_run_date_prunes_partitions(spark, silver_path):
    p = plan(readers.load_silver(spark, silver_path, "2024-01-15"))
    assert "PartitionFilters: [isnotnull(event_year" in p and "event_day" in p


def test_purchase_filter_pushed_to_scan(spark, silver_path):
    p = plan(gold.revenue_metrics(readers.load_silver(spark, silver_path)))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in p


def test_column_pruning(spark, silver_path):
    df = gold.revenue_metrics(readers.load_silver(spark, silver_path))
    scan = [line for line in plan(df).splitlines() if "ReadSchema" in line][0]
    assert "session_id" not in scan and "product_name" not in scan


def test_leaderboard_uses_partial_group_limit(spark, silver_path):
    p = plan(gold.top_products(readers.load_silver(spark, silver_path)))
    assert "WindowGroupLimit" in p


def test_dq_report_is_one_scan(spark, silver_path):
    p = plan(quality.dq_report(readers.load_silver(spark, silver_path)))
    assert p.count("FileScan parquet") == 1


def test_daily_job_writes_every_day(spark):
    base = scratch_path(spark, "plan-lake")
    counts = {r["table"]: r["row_count"] for r in
              jobs.run_medallion(spark, PipelineTables(spark, SF["0.001"]).raw_events, base).collect()}
    assert counts["read"] == 1000 and counts["valid"] == 916 and counts["silver_events"] == 916
    report = jobs.run_daily(spark, base, "2024-01-15", gate=False).collect()
    assert len(report) == 1 and report[0]["run_date"] == "2024-01-15"
    with pytest.raises(Exception):
        jobs.run_daily(spark, base, "2024-01-15", gate=True)  # duplicates in the fixture -> gate fails


def test_daily_job_empty_day_reports_no_data(spark):
    from ripplelake.operators.quality import DataQualityError
    base = scratch_path(spark, "empty-lake")
    jobs.run_medallion(spark, PipelineTables(spark, SF["0.001"]).raw_events, base).collect()
    before = spark.read.parquet(jobs.lake(base)["revenue"]).count()
    with pytest.raises(DataQualityError, match="NO_DATA"):
        jobs.run_daily(spark, base, "2023-06-01", gate=True)
    report = jobs.run_daily(spark, base, "2023-06-01", gate=False).collect()
    assert report[0]["status"] == "NO_DATA"
    assert spark.read.parquet(jobs.lake(base)["revenue"]).count() == before


def test_batch_dedup_collapses_copies_before_the_shuffle(spark):
    from ripplelake.operators.silver import dedup_events
    p = plan(dedup_events(PipelineTables(spark, SF["0.001"]).silver_events))
    exchange_at = p.index("Exchange hashpartitioning(event_id")
    assert "partial_min(struct(" in p[exchange_at:]   # map-side partial below the exchange


def test_hot_user_is_collapsed_map_side_and_counted_exactly(spark):
    from pyspark.sql import functions as F
    s = PipelineTables(spark, SF["0.001"]).silver_events
    hot = s.withColumn("user_id", F.lit("UHOT")).withColumn("device_type", F.lit("mobile")) \
           .withColumn("country", F.lit("US"))
    skewed = s.unionByName(hot).unionByName(hot).unionByName(hot)   # hot user ~3/4 of rows
    seg = gold.user_segments(skewed)
    p = plan(seg)
    first_exchange = p.rindex("Exchange hashpartitioning")
    assert "partial_count" in p[first_exchange:]                   # partial aggregate below the shuffle
    got = {r["report_date"]: r["event_count"] for r in seg.filter("user_id = 'UHOT'").collect()}
    want = {r[0]: 3 * r[1] for r in s.groupBy(F.date_format("event_date", "yyyy-MM-dd")).count().collect()}
    assert got == want
