"""Sources, sinks and catalog: Bronze landing round trip, loaders, DDL."""
import pytest
from conftest import SF
from pyspark.sql import functions as F

from ripplelake.operators import bronze
from ripplelake.operators.silver import REASON, tag_records
from ripplelake.plans.tables import PipelineTables
from ripplelake.session import scratch_path
from ripplelake.sources import catalog, readers, sinks


@pytest.fixture(scope="module")
def landed(spark):
    path = scratch_path(spark, "bronze")
    payloads = bronze.to_payload(PipelineTables(spark, SF["0.001"]).raw_events)
    extra = spark.createDataFrame([("{not json",), ("   ",)], "raw_payload string")
    bronze.land_bronze_json(payloads.unionByName(extra), path)
    return path


def test_landing_keeps_every_nonblank_line(spark, landed):
    assert spark.read.text(landed).count() == 1001  # 1000 events + 1 malformed, blank skipped


def test_read_bronze_one_day_and_malformed(spark, landed):
    day = readers.read_bronze(spark, landed, "2024-01-15")
    assert 0 < day.count() < 1000
    allrows = tag_records(readers.read_bronze(spark, landed))
    assert allrows.filter(F.col(REASON) == "malformed_json").count() == 1
    # valid rows survive the JSON round trip unchanged in number
    assert allrows.filter(F.col(REASON).isNull()).count() == 916
    assert readers.read_bronze(spark, landed, skip_malformed=True).count() == 1000


def test_loaders(spark):
    t = PipelineTables(spark, SF["0.001"])
    base = scratch_path(spark, "lake")
    sinks.write_silver(t.silver_events, f"{base}/silver/cleaned_events")
    assert readers.load_silver_partition(spark, f"{base}/silver/cleaned_events", "2024-01-15").count() > 0
    with pytest.raises(readers.NoDataError):
        readers.load_silver_partition(spark, f"{base}/silver/cleaned_events", "2023-06-01")
    with pytest.raises(ValueError):
        readers.load_layer(spark, base, "bronze", "x", "2024-01-15")
    assert readers.load_layer(spark, base, "silver", "cleaned_events", "2024-01-15").count() > 0


def test_dynamic_overwrite_keeps_other_days(spark):
    t = PipelineTables(spark, SF["0.001"])
    path = scratch_path(spark, "gold")
    from ripplelake.operators import gold
    sinks.write_gold(gold.revenue_metrics(t.silver_events), path)
    before = spark.read.parquet(path).count()
    sinks.write_gold(gold.revenue_metrics(t.silver_events, "2024-01-15"), path)
    assert spark.read.parquet(path).count() == before


def test_catalog_tables_and_partitions(spark):
    t = PipelineTables(spark, SF["0.001"])
    base = scratch_path(spark, "cat")
    sinks.write_silver(t.silver_events, f"{base}/silver/cleaned_events")
    names = catalog.create_tables(spark, base, "ct_")
    assert "ct_silver_events" in names
    parts = catalog.refresh_partitions(spark, "ct_silver_events").collect()
    assert len(parts) == 30
    assert spark.table("ct_silver_events").count() == 916


def test_connector_columns_feed_the_envelope(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(b'{"event_id": "E1"}', b"U1", 42, dt.datetime(2024, 1, 2, 3, 4, 5))],
        "value binary, key binary, offset long, timestamp timestamp")
    env = bronze.bronze_envelope(readers.normalize_records(df)).first()
    assert env["raw_payload"] == '{"event_id": "E1"}' and env["partition_key"] == "U1"
    assert env["sequence_number"] == "42" and (env["ingest_year"], env["ingest_day"]) == (2024, 2)


def test_landing_can_skip_malformed(spark):
    path = scratch_path(spark, "bronze-skip")
    payloads = bronze.to_payload(PipelineTables(spark, SF["0.001"]).raw_events)
    extra = spark.createDataFrame([("{not json",), ("",)], "raw_payload string")
    bronze.land_bronze_json(payloads.unionByName(extra), path, skip_malformed=True)
    assert spark.read.text(path).count() == 1000


def test_dead_letter_rerun_is_idempotent_with_run_date(spark):
    from ripplelake.operators.silver import rejected_records
    from ripplelake.operators.silver import tag_records as tag
    rej = rejected_records(tag(PipelineTables(spark, SF["0.001"]).raw_events))
    path = scratch_path(spark, "dead")
    sinks.write_rejected(rej, path, "2024-01-15")
    sinks.write_rejected(rej, path, "2024-01-15")
    assert spark.read.json(path).count() == 84
    sinks.write_rejected(rej, path)          # ad-hoc run: appended under today
    assert spark.read.json(path).count() == 168
