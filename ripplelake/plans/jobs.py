"""Batch jobs (J1, J2) composed from the operators.

Lineage is cut at every layer boundary by a written table: Gold is built
from the Silver table read back from storage (with partition pruning), not
from the in-memory plan that produced it.  A lost executor therefore only
recomputes tasks of the current stage, and a failed job can be rerun: every
write replaces exactly the partitions it produces (dynamic overwrite).
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, quality, silver
from ..schemas import GOLD_PARTITIONS, SILVER_PARTITIONS, SILVER_SCHEMA
from ..session import ensure_utc
from ..sources import catalog, publish, readers, sinks


def lake(base: str) -> dict[str, str]:
    b = base.rstrip("/")
    return {
        "silver": f"{b}/silver/cleaned_events",
        "rejected": f"{b}/silver/rejected",
        "revenue": f"{b}/gold/revenue_metrics",
        "products": f"{b}/gold/top_products",
        "segments": f"{b}/gold/user_segments",
        "daily_revenue": f"{b}/gold/daily_revenue",
        "daily_products": f"{b}/gold/daily_top_products",
        "daily_users": f"{b}/gold/daily_user_cohorts",
        "dq": f"{b}/gold/dq_reports",
    }


def run_concurrently(tasks: list[Callable[[], object]]) -> list[object]:
    """Submit independent Spark jobs from threads of one session.

    Independent writes over the same committed input finish with small
    final stages; running them side by side keeps the executors busy.  The
    first failure is re-raised after all jobs have ended.
    """
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        futures = [pool.submit(t) for t in tasks]
        return [f.result() for f in futures]


def run_medallion(spark: SparkSession, raw: DataFrame, base: str, run_date=None,
                  bronze: DataFrame | None = None) -> DataFrame:
    """Raw events -> Silver + dead letter + stats -> daily Gold tables.

    ``raw`` is any raw-event frame (Bronze read with ``read_bronze`` or a
    typed frame).  With ``run_date``, ``raw`` is what arrived in that run: its
    valid rows join the event days they belong to, beside what earlier runs
    brought, late ones too, and Gold is rebuilt for exactly those days in one job
    per table.  A rerun of the same ``run_date`` supersedes that run's rows
    alone, its dead letter included; a day that is left without rows
    disappears.  All tables are staged first and published by one manifest
    (``sources.publish``): a run killed on the way changes nothing.  With
    ``bronze`` (all that has arrived) the touched days are rebuilt from it
    instead; runs whose rows it superseded must be rerun with ``bronze`` too.
    Without ``run_date`` all days in ``raw`` are replaced.  Returns one row per
    written table with its row count (of those days), plus the transform stats rows.
    """
    ensure_utc(spark)
    p = lake(base)
    tagged = silver.tag_records(raw)
    if run_date is not None:
        return _publish_run(spark, tagged, None if bronze is None else silver.tag_records(bronze), base.rstrip("/"), run_date)
    # Stats ride along the Silver write (Observation): no cache of the raw
    # input and no extra pass; the dead letter is a second, filtered scan
    # that runs next to the Silver write.
    obs = Observation("transform_stats")
    observed = tagged.observe(obs, F.count(F.lit(1)).alias("total_read"),
                              F.count_if(F.col(silver.REASON).isNull()).alias("total_valid"))
    run_concurrently([
        lambda: sinks.write_silver(silver.to_silver(observed), p["silver"]),
        lambda: sinks.write_rejected(silver.rejected_records(tagged), p["rejected"], run_date),
    ])
    stats = dict(obs.get)
    stats["total_rejected"] = stats["total_read"] - stats["total_valid"]
    silver_t = readers.load_silver(spark, p["silver"], run_date)
    run_concurrently([
        lambda: sinks.write_gold(gold.revenue_metrics(silver_t), p["revenue"]),
        lambda: sinks.write_gold(gold.top_products(silver_t), p["products"]),
        lambda: sinks.write_gold(gold.user_segments(silver_t), p["segments"]),
    ])
    counts = [spark.read.parquet(p[k]).agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(name).alias("table"), "row_count")
              for k, name in [("silver", "silver_events"), ("revenue", "gold_revenue_metrics"),
                              ("products", "gold_top_products"), ("segments", "gold_user_segments")]]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    stat_rows = spark.createDataFrame(
        [("read", stats["total_read"]), ("valid", stats["total_valid"]), ("rejected", stats["total_rejected"])],
        "table string, row_count long")
    return out.unionByName(stat_rows)


def _day_of(folder: str) -> datetime.date:
    return datetime.date(*[int(x.split("=")[1]) for x in folder.split("/")])


def _folder_of(day: datetime.date, columns: list[str]) -> str:
    return "/".join(f"{c}={v}" for c, v in zip(columns, (day.year, day.month, day.day)))


def _publish_run(spark: SparkSession, arrived: DataFrame, bronze: DataFrame | None, base: str, run_date) -> DataFrame:
    """Stage the run's Silver, dead letter and Gold, then publish them together (frames are tagged)."""
    publish.settle(spark, base)
    run_day = gold.as_date(run_date)
    seen = len(publish.manifests(spark, base)) - 1
    m = publish.Manifest(run_day.isoformat(), f"{base}/_staging/{uuid.uuid4().hex[:12]}")
    before, folder = publish.last_of(spark, base, m.run), {k: v[len(base) + 1:] for k, v in lake(base).items()}
    stage = {k: f"{m.staging}/{v}" for k, v in folder.items()}
    held = before.tables[folder["silver"]]["days"] if before else {}
    if bronze is None:
        for day, files in held.items():
            there = {name for name, _ in publish.children(spark, f"{base}/{folder['silver']}/{day}")}
            if not {before.prefix() + f for f in files} <= there:
                raise publish.PublishConflict(f"{day} was rebuilt from Bronze after run {m.run}: pass bronze= to rerun it")
        source = arrived
    else:
        day = F.to_date(F.col(silver.EVENT_TS))
        days = arrived.filter(F.col(silver.REASON).isNull()).select(day.alias("d")).distinct()
        known = [r.d for r in days.collect()]  # event days of one run
        source = bronze.filter(day.isin([run_day, *known, *map(_day_of, held)]))
    obs = Observation("arrived")
    counted = arrived.observe(obs, F.count(F.lit(1)).alias("read"), F.count_if(F.col(silver.REASON).isNull()).alias("valid"))
    # The stats ride along the dead letter's scan of what arrived.
    run_concurrently([lambda: sinks.write_silver(silver.to_silver(source), stage["silver"]),
                      lambda: sinks.write_rejected(silver.rejected_records(counted), stage["rejected"], run_date)])
    stats = dict(obs.get)
    touched = {run_day, *map(_day_of, held), *map(_day_of, publish.files_by_day(spark, stage["silver"]))}
    m.add(spark, folder["silver"], "append" if bronze is None else "replace",
          publish.schema_of(silver_frame(spark), SILVER_PARTITIONS), {_folder_of(d, SILVER_PARTITIONS) for d in touched})
    m.add(spark, folder["rejected"], "replace", None, {_folder_of(run_day, ["year", "month", "day"])})
    new = spark.read.schema(SILVER_SCHEMA).parquet(stage["silver"]) if any(publish.files_by_day(spark, stage["silver"]).values()) \
        else silver_frame(spark)
    if bronze is None and any(publish.files_by_day(spark, f"{base}/{folder['silver']}").values()):
        new = new.unionByName(other_runs(spark, f"{base}/{folder['silver']}", touched, m.prefix()))
    tables = [("revenue", gold.revenue_metrics, "gold_revenue_metrics"), ("products", gold.top_products, "gold_top_products"),
              ("segments", gold.user_segments, "gold_user_segments")]
    built = {k: build(new) for k, build, _ in tables}
    run_concurrently([lambda k=k: sinks.write_gold(built[k], stage[k]) for k, _, _ in tables])
    for k, _, _ in tables:
        m.add(spark, folder[k], "replace", publish.schema_of(built[k], GOLD_PARTITIONS), {_folder_of(d, GOLD_PARTITIONS) for d in touched})
    publish.commit(spark, base, m, seen)
    counts = [_of_days(spark.read.parquet(f"{base}/{folder[k]}"), touched, columns).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("table"), "row_count")
              for k, name, columns in [("silver", "silver_events", SILVER_PARTITIONS)] + [(k, name, GOLD_PARTITIONS) for k, _, name in tables]]
    return reduce(DataFrame.unionByName, counts).unionByName(spark.createDataFrame(
        [("read", stats["read"]), ("valid", stats["valid"]), ("rejected", stats["read"] - stats["valid"])],
        "table string, row_count long"))


def silver_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SILVER_SCHEMA)


def _of_days(df: DataFrame, days: set[datetime.date], columns: list[str]) -> DataFrame:
    """Rows of the given days, by a filter on the partition columns."""
    return df.filter(F.make_date(*columns).isin(sorted(days)))


def other_runs(spark: SparkSession, path: str, days: set[datetime.date], prefix: str) -> DataFrame:
    """Published Silver rows of the days, without the files whose names start with ``prefix``."""
    rows = _of_days(spark.read.schema(SILVER_SCHEMA).parquet(path), days, SILVER_PARTITIONS)
    return rows.filter(~F.col("_metadata.file_name").startswith(prefix)).select(*SILVER_SCHEMA.names)


YESTERDAY = "yesterday"


def run_daily(spark: SparkSession, base: str, run_date=YESTERDAY, gate: bool = True,
              refresh_table: str | None = None) -> DataFrame:
    """Cohort-variant Gold (D2, D4, D6) and the DQ report (E0) for one
    day, yesterday (UTC) unless said otherwise, or for every day in Silver when
    ``run_date`` is None (backfill).

    Every plan reads the partition-pruned Silver; an empty day writes a
    NO_DATA report.  The gate (E11) runs on the
    written report and fails closed; then partitions are refreshed (A9).
    Returns the DQ report read back from storage.
    """
    ensure_utc(spark)
    if run_date == YESTERDAY:
        run_date = datetime.datetime.now(datetime.timezone.utc).date() - datetime.timedelta(days=1)
    p = lake(base)
    # No cache: each plan re-reads only its columns of the pruned partition,
    # which at production size is cheaper than holding a day in executors.
    day = readers.load_silver(spark, p["silver"], run_date)
    # An empty day writes its NO_DATA report and clears its Gold partitions.
    run_concurrently([
        lambda: sinks.write_dq_report(quality.dq_report(day, run_date), p["dq"]),
        lambda: sinks.write_gold(gold.daily_revenue(day, run_date), p["daily_revenue"], run_date=run_date),
        lambda: sinks.write_gold(gold.top_products_cohort(day, run_date), p["daily_products"], run_date=run_date),
        lambda: sinks.write_gold(gold.user_cohorts(day, run_date), p["daily_users"], run_date=run_date),
    ])
    written = spark.read.parquet(p["dq"])
    if run_date is not None:
        written = written.filter(F.col("run_date") == str(run_date))
    written = written.drop("year", "month", "day")
    if gate:
        quality.dq_gate(written)
    if refresh_table:
        catalog.refresh_partitions(spark, refresh_table)
    return written
