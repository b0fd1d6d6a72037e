"""Late rows, reruns and emptied days of the daily medallion job; amounts beyond range; long reports."""
import pytest
from conftest import make_event, raw_frame
from pyspark.sql import functions as F

from ripplelake.operators import quality, silver
from ripplelake.plans import jobs
from ripplelake.session import scratch_path, shared_dir
from ripplelake.sources import publish, readers


def event(i, day, **kw):
    return make_event(event_id=f"e{i}", timestamp=f"2024-01-{day:02d}T10:00:00+00:00", user_id=f"u{i}", **kw)


def test_late_rows_join_their_day(spark):
    base = scratch_path(spark, "late")
    first = [event(i, 15) for i in range(5)]
    late = [event(10, 15), event(11, 16)]
    jobs.run_medallion(spark, raw_frame(spark, first), base, "2024-01-15").collect()
    for _ in range(2):  # a rerun changes nothing
        got = {r["table"]: r["row_count"] for r in jobs.run_medallion(
            spark, raw_frame(spark, late), base, "2024-01-16", bronze=raw_frame(spark, first + late)).collect()}
        assert got["silver_events"] == 7 and got["read"] == 2 and got["valid"] == 2
    p = jobs.lake(base)
    days = {r["event_day"]: r["count"] for r in spark.read.parquet(p["silver"]).groupBy("event_day").count().collect()}
    assert days == {15: 6, 16: 1}
    gold = spark.read.parquet(p["revenue"]).groupBy("report_day").agg(F.sum("purchase_count").alias("n")) \
        if "purchase_count" in spark.read.parquet(p["revenue"]).columns else None
    if gold is not None:
        assert {r["report_day"]: r["n"] for r in gold.collect()} == {15: 6, 16: 1}


def test_rerun_without_purchases_clears_gold(spark):
    base = scratch_path(spark, "stale")
    jobs.run_medallion(spark, raw_frame(spark, [event(1, 15)]), base, "2024-01-15").collect()
    assert spark.read.parquet(jobs.lake(base)["revenue"]).count() == 1
    view = event(1, 15, event_type="product_view", revenue=None)
    jobs.run_medallion(spark, raw_frame(spark, [view]), base, "2024-01-15").collect()
    assert spark.read.parquet(jobs.lake(base)["revenue"]).count() == 0


def test_amount_out_of_range_is_rejected(spark):
    raw = raw_frame(spark, [event(1, 15), event(2, 15, price=1e15, revenue=None), event(3, 15, revenue=1e300)])
    tagged = silver.tag_records(raw)
    reasons = {r["event_id"]: r["_rejection_reason"] for r in silver.rejected_records(tagged).collect()}
    assert reasons == {"e2": "price_out_of_range", "e3": "price_out_of_range"}
    base = scratch_path(spark, "poison")
    jobs.run_medallion(spark, raw, base).collect()
    assert spark.read.parquet(jobs.lake(base)["revenue"]).count() == 1


def test_totals_above_a_trillion(spark):
    from ripplelake.operators import gold
    raw = raw_frame(spark, [event(i, 15, price=9e11, revenue=9e11) for i in range(4)])
    total = gold.revenue_metrics(silver.raw_to_silver(raw)).collect()[0]
    assert total["total_revenue"] == 3.6e12


def test_gate_counts_every_breaching_day(spark):
    days = spark.range(150).select(
        F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).cast("string").alias("run_date"),
        F.lit(0).cast("long").alias("total_records"), F.lit(0.0).alias("null_event_id_pct"),
        F.lit(0).cast("long").alias("duplicate_event_ids"), F.lit("NO_DATA").alias("status"))
    with pytest.raises(quality.DataQualityError, match=r"150 day\(s\), 2024-01-01 to 2024-05-29"):
        quality.dq_gate(days)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError("no context")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def silver_days(spark, base):
    rows = spark.read.parquet(jobs.lake(base)["silver"])
    return {r["event_day"]: r["count"] for r in rows.groupBy("event_day").count().collect()}


def gold_orders(spark, base):
    rows = spark.read.parquet(jobs.lake(base)["revenue"])
    return {r["report_day"]: r["n"] for r in rows.groupBy("report_day").agg(F.sum("total_orders").alias("n")).collect()}


def test_late_rows_without_bronze_lose_nothing(spark):
    base = scratch_path(spark, "late")
    jobs.run_medallion(spark, raw_frame(spark, [event(i, 15) for i in range(5)]), base, "2024-01-15").collect()
    for _ in range(2):  # a rerun supersedes its own rows only
        got = {r["table"]: r["row_count"] for r in jobs.run_medallion(
            spark, raw_frame(spark, [event(10, 15), event(11, 16)]), base, "2024-01-16").collect()}
        assert got["silver_events"] == 7 and got["read"] == 2
        assert silver_days(spark, base) == gold_orders(spark, base) == {15: 6, 16: 1}
    jobs.run_medallion(spark, raw_frame(spark, [event(i, 15) for i in range(3)]), base, "2024-01-15").collect()
    assert silver_days(spark, base) == gold_orders(spark, base) == {15: 4, 16: 1}


def test_emptied_days_disappear(spark):
    base = scratch_path(spark, "emptied")
    bad = event(9, 15, event_type="nonsense")
    jobs.run_medallion(spark, raw_frame(spark, [event(1, 15), event(2, 14), bad]), base, "2024-01-15").collect()
    jobs.run_medallion(spark, raw_frame(spark, [event(3, 16)]), base, "2024-01-16").collect()
    p = jobs.lake(base)
    assert spark.read.json(p["rejected"]).count() == 1
    got = jobs.run_medallion(spark, raw_frame(spark, []), base, "2024-01-15").collect()
    assert {r["table"]: r["row_count"] for r in got}["silver_events"] == 0
    assert silver_days(spark, base) == gold_orders(spark, base) == {16: 1}
    assert publish.files_by_day(spark, p["rejected"]) == {}
    jobs.run_medallion(spark, raw_frame(spark, []), base, "2024-01-16").collect()  # the last rows: tables can still be read
    for k in ("silver", "revenue", "products", "segments"):
        assert spark.read.parquet(p[k]).count() == 0


def test_a_killed_run_leaves_the_old_state(spark, monkeypatch):
    base = scratch_path(spark, "killed")
    jobs.run_medallion(spark, raw_frame(spark, [event(i, 15) for i in range(4)]), base, "2024-01-15").collect()

    def fail(*_, **__):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:  # before the commit
        m.setattr(jobs.gold, "user_segments", fail)
        with pytest.raises(RuntimeError, match="killed"):
            jobs.run_medallion(spark, raw_frame(spark, [event(7, 15)]), base, "2024-01-16")
    assert silver_days(spark, base) == gold_orders(spark, base) == {15: 4}
    moved = publish._fs
    with monkeypatch.context() as m:  # after the commit, between two tables
        def once(spark_, path):
            if "/gold/top_products" in path and "_staging" in path:
                raise RuntimeError("killed")
            return moved(spark_, path)

        real = publish._move
        m.setattr(publish, "_move", lambda s, b, x: (m.setattr(publish, "_fs", once), real(s, b, x)))
        with pytest.raises(RuntimeError, match="killed"):
            jobs.run_medallion(spark, raw_frame(spark, [event(7, 15)]), base, "2024-01-16")
    assert readers.load_silver(spark, jobs.lake(base)["silver"], "2024-01-15").count() == 5  # a reader finishes it
    assert silver_days(spark, base) == gold_orders(spark, base) == {15: 5}
    assert readers.load_layer(spark, base, "gold", "top_products", "2024-01-15").count() == 1


def test_two_runs_of_one_number_conflict(spark):
    base = scratch_path(spark, "conflict")
    jobs.run_medallion(spark, raw_frame(spark, [event(1, 15)]), base, "2024-01-15").collect()
    with pytest.raises(publish.PublishConflict):
        publish.commit(spark, base, publish.Manifest("2024-01-16", f"{base}/_staging/x"), -1)
    jobs.run_medallion(spark, raw_frame(spark, [event(2, 15)]), base, "2024-01-16", bronze=raw_frame(
        spark, [event(1, 15), event(2, 15)])).collect()
    with pytest.raises(publish.PublishConflict, match="rebuilt from Bronze"):
        jobs.run_medallion(spark, raw_frame(spark, [event(1, 15)]), base, "2024-01-15")


def test_many_days_in_one_job_each(spark):
    """Forty touched days: published Silver is pruned to them, and no job is per day."""
    base = scratch_path(spark, "many")
    rows = [make_event(event_id=f"m{i}", timestamp=f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}T10:00:00+00:00") for i in range(40)]
    jobs.run_medallion(spark, raw_frame(spark, rows), base, "2024-03-01").collect()
    assert spark.read.parquet(jobs.lake(base)["silver"]).count() == 40
    days = {jobs.datetime.date(2024, 1, 5)}
    plan = jobs.other_runs(spark, jobs.lake(base)["silver"], days, "run-x-")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "make_dat" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert plan.count() == 1
