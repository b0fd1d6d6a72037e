"""Data-quality semantics: DQ report, suites (mostly, unique), layers, gate."""
import pytest
from conftest import SF, make_event, raw_frame
from pyspark.sql import functions as F

from ripplelake.operators import quality
from ripplelake.operators.silver import raw_to_silver


@pytest.fixture(scope="module")
def silver(spark):
    events = [make_event(event_id=f"E{i}", user_id=f"U{i % 3}") for i in range(10)]
    events.append(make_event(event_id="E1"))  # one duplicate id
    return raw_to_silver(raw_frame(spark, events))


def test_dq_report_counts_duplicates(silver):
    r = quality.dq_report(silver, "2026-03-18").first()
    assert r["total_records"] == 11 and r["duplicate_event_ids"] == 1
    assert r["status"] == "WARN" and r["null_event_id_pct"] == 0.0


def test_dq_report_no_data(silver):
    r = quality.dq_report(silver, "2020-01-01").collect()
    assert len(r) == 1 and r[0]["status"] == "NO_DATA" and r[0]["total_records"] == 0


def test_gate_fails_closed(silver):
    with pytest.raises(quality.DataQualityError, match="duplicate_ids=1"):
        quality.dq_gate(quality.dq_report(silver, "2026-03-18"))
    with pytest.raises(quality.DataQualityError, match="NO_DATA"):
        quality.dq_gate(quality.dq_report(silver, "2020-01-01"))


def test_gate_passes_clean(spark):
    clean = raw_to_silver(raw_frame(spark, [make_event(event_id=f"E{i}") for i in range(5)]))
    report = quality.dq_report(clean, "2026-03-18")
    assert quality.dq_gate(report) is report


def test_mostly_and_unique(spark):
    df = spark.createDataFrame([(i, None if i < 1 else i, i % 50) for i in range(100)], "id int, v int, k int")
    suite = {"suite_name": "t", "expectations": [
        ("expect_column_values_to_not_be_null", {"column": "v", "mostly": 0.99}),
        ("expect_column_values_to_not_be_null", {"column": "v", "mostly": 1.0}),
        ("expect_column_values_to_be_unique", {"column": "k"}),
        ("expect_column_values_to_be_between", {"column": "v", "min_value": 1, "max_value": 98, "mostly": 0.99}),
        ("expect_table_row_count_to_be_between", {"min_value": 1, "max_value": 100}),
        ("expect_column_to_exist", {"column": "nope"}),
    ]}
    res = {r["expectation_index"]: r for r in quality.run_suite(df, suite, "d").collect()}
    assert res[0]["success"] and not res[1]["success"]
    assert res[2]["unexpected_count"] == 100 and not res[2]["success"]  # every member of a repeated value
    # 98 of 99 evaluated rows in range: 0.9899 < mostly 0.99 -> fails
    assert res[3]["element_count"] == 99 and res[3]["unexpected_count"] == 1 and not res[3]["success"]
    assert res[4]["success"] and not res[5]["success"]
    summary = quality.suite_summary(quality.run_suite(df, suite, "d")).first()
    assert summary["evaluated"] == 6 and summary["failed"] == 4 and summary["success_pct"] == 33.3


def test_validate_layers_load_error_is_failure(spark, silver):
    def boom():
        raise FileNotFoundError("no gold partition")
    out = quality.validate_layers(spark, "2026-03-18", lambda: silver, boom).collect()
    by_suite = {r["suite"]: r for r in out}
    assert by_suite["gold_sales_suite"]["passed"] is False
    assert "no gold partition" in by_suite["gold_sales_suite"]["error"]
    assert all(r["overall_passed"] is False for r in out)
    with pytest.raises(ValueError):
        quality.validate_layers(spark, None, layer="bronze")


def test_validate_layers_fails_on_empty_days_and_read_errors(spark, silver):
    from pyspark.sql import functions as F

    empty = quality.validate_layers(spark, None, lambda: silver.limit(0), layer="silver", by="event_date").collect()
    assert len(empty) == 1 and not empty[0]["passed"] and "row_count" in empty[0]["failed_expectations"]
    broken = silver.withColumn("country", F.raise_error(F.lit("damaged file")).cast("string"))
    rows = quality.validate_layers(spark, None, lambda: broken, layer="silver").collect()
    assert len(rows) == 1 and not rows[0]["overall_passed"] and "damaged file" in rows[0]["error"]


def test_validate_layers_loads_by_date(spark, silver):
    from ripplelake.session import scratch_path
    from ripplelake.sources import sinks
    from ripplelake.streaming import metrics

    base = scratch_path(spark, "layers")
    sinks.write_silver(silver, f"{base}/silver/cleaned_events")
    metrics.sales_metrics(silver, exact_distinct=True).write.parquet(f"{base}/gold/sales_metrics")
    got = {r["suite"]: r for r in quality.validate_layers(spark, "2026-03-18", base=base).collect()}
    assert got["gold_sales_suite"]["error"] is None and got["gold_sales_suite"]["passed"]
    assert got["silver_events_suite"]["error"] is None and not got["silver_events_suite"]["passed"]


def test_observed_suite_equals_run_suite(spark):
    from ripplelake.operators import quality
    from ripplelake.plans.tables import PipelineTables
    from ripplelake.session import scratch_path
    from ripplelake.sources import sinks
    silver = PipelineTables(spark, SF["0.001"]).silver_events
    silver = silver.unionByName(silver.limit(3)).withColumn("price", F.when(F.col("event_hour") != 3, F.col("price")))
    for df, suite in [(silver, quality.SILVER_SUITE),
                      (silver.drop("country"), quality.SILVER_SUITE | {"expectations": quality.SILVER_SUITE["expectations"][:4]})]:
        path = scratch_path(spark, "observed")
        observed, results = quality.observe_suite(df, suite)
        sinks.write_silver(observed, path)
        written = spark.read.parquet(path)
        assert sorted(map(tuple, results(written).collect()), key=str) == sorted(
            map(tuple, quality.run_suite(written, suite).collect()), key=str)


def test_missing_day_fails(spark):
    from ripplelake.operators import quality
    from ripplelake.plans.tables import PipelineTables
    silver = PipelineTables(spark, SF["0.001"]).silver_events.filter("event_day <> 16")
    got = quality.validate_layers(spark, None, lambda: silver, layer="silver", by="event_date",
                                  expected_days=["2024-01-15", "2024-01-16"]).collect()
    missing = [r for r in got if r["error"]]
    assert [(r["run_date"], r["passed"]) for r in missing] == [("2024-01-16", False)] and not got[0]["overall_passed"]
