"""Registry of named queries: Spark builder + DuckDB oracle text.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input (the keys of jobs and streams run these when built); the oracle (when the operator is SQL-expressible) is the same
computation written independently for DuckDB over the driver's views.
Columns that are wall-clock stamps (created_at, processed_at, updated_at)
are left out of compared outputs; timestamps are returned as
TIMESTAMP_NTZ (UTC wall clock) so the comparison does not depend on a zone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold, monitoring, quality, silver
from ..schemas import RAW_COLUMNS
from ..streaming import metrics
from . import analytics, oracle_analytics
from . import oracle_more as om
from .oracle import with_ctes
from .sqlkit import DIV, R, tables_in
from .tables import PipelineTables

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    build: Builder
    oracle: str | None
    doc: str


REGISTRY: dict[str, Entry] = {}

STAMP_COLUMNS = {"created_at", "processed_at", "updated_at"}


def register(name: str, oracle: str | None, doc: str = ""):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = Entry(fn, oracle, doc or (fn.__doc__ or "").strip().splitlines()[0])
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Drop wall-clock stamps; timestamps as UTC wall clock (NTZ)."""
    cols = []
    for f in df.schema.fields:
        if f.name in STAMP_COLUMNS:
            continue
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _tables(spark: SparkSession, sf_dir: str) -> PipelineTables:
    return PipelineTables(spark, sf_dir)


# ---------------------------------------------------------------------------
# Raw, tagged, Silver
# ---------------------------------------------------------------------------
register("raw_events", with_ctes("SELECT * FROM @raw_events"),
         "raw producer events derived from the events table")(
    lambda spark, d: _tables(spark, d).raw_events)

_RAW_LIST = ", ".join(f'"{c}"' if c == "timestamp" else c for c in RAW_COLUMNS)
register("rejected_events",
         with_ctes(f"SELECT {_RAW_LIST}, _rejection_reason FROM @tagged WHERE _rejection_reason IS NOT NULL"),
         "dead-letter rows with the first failing rule")(
    lambda spark, d: _tables(spark, d).rejected_events)

register("rejection_counts",
         with_ctes("SELECT COALESCE(_rejection_reason, 'valid') AS reason, COUNT(*) AS row_count "
                   "FROM @tagged GROUP BY COALESCE(_rejection_reason, 'valid')"),
         "rows per validation outcome")(
    lambda spark, d: silver.rejection_counts(_tables(spark, d).tagged))

register("silver_events", with_ctes("SELECT * FROM @silver_events"),
         "typed, validated Silver events")(
    lambda spark, d: comparable(_tables(spark, d).silver_events))

_VALID = "COUNT(*) FILTER (WHERE _rejection_reason IS NULL)"
register("transform_stats",
         with_ctes(f"SELECT COUNT(*) AS total_read, {_VALID} AS total_valid, "
                   f"COUNT(*) - {_VALID} AS total_rejected, "
                   f"{R(DIV(f'(COUNT(*) - {_VALID}) * 100.0', 'GREATEST(COUNT(*), 1)'), 1)} AS rejected_pct "
                   "FROM @tagged"),
         "read / valid / rejected counts")(
    lambda spark, d: silver.transform_stats(_tables(spark, d).tagged))

# ---------------------------------------------------------------------------
# Gold (daily variant, every day)
# ---------------------------------------------------------------------------
def _table(name: str) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(_tables(spark, sf_dir).get(name))
    return build


for _name in ["gold_revenue_metrics", "gold_top_products", "gold_user_segments"]:
    register(_name.removeprefix("gold_"), with_ctes(f"SELECT * FROM @{_name}"), f"Gold table {_name}")(
        _table(_name))

# ---------------------------------------------------------------------------
# Analytics SQL over Gold/Silver
# ---------------------------------------------------------------------------
def _sql_query(sql: str) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return analytics.run_sql(spark, sql, _tables(spark, sf_dir).bind(tables_in(sql)))
    return build


for _q, _sql in analytics.QUERIES.items():
    # X2 shows raw JSON payloads, which DuckDB would print in another form: rows-only.
    register(_q, None if _q == "x02" else with_ctes(oracle_analytics.ORACLES[_q]),
             analytics.DESCRIPTIONS[_q])(_sql_query(_sql))


# ---------------------------------------------------------------------------
# Cohort (batch job) variants.  Approximate distinct counts have no exact
# twin: the approximate form is registered rows-only, plus an exact form.
# ---------------------------------------------------------------------------
def _joined(df: DataFrame, col: str) -> DataFrame:
    """Arrays as sorted comma-joined text for engine-neutral comparison."""
    return df.withColumn(col, F.array_join(F.array_sort(col), ","))


register("daily_revenue", None, "hourly revenue, approximate customers (rows-only)")(
    lambda spark, d: gold.daily_revenue(_tables(spark, d).silver_events))
register("daily_revenue_exact", with_ctes(om.DAILY_REVENUE_EXACT), "hourly revenue, exact customers")(
    lambda spark, d: gold.daily_revenue(_tables(spark, d).silver_events, exact_distinct=True))
register("top_products_cohort", None, "cohort leaderboard, rank() <= 50, approximate users (rows-only)")(
    lambda spark, d: gold.top_products_cohort(_tables(spark, d).silver_events))
register("top_products_cohort_exact", with_ctes(om.TOP_PRODUCTS_COHORT_EXACT), "cohort leaderboard, exact users")(
    lambda spark, d: gold.top_products_cohort(_tables(spark, d).silver_events, exact_distinct=True))
register("user_cohorts", with_ctes(om.USER_COHORTS), "user cohorts with event-type sets")(
    lambda spark, d: _joined(gold.user_cohorts(_tables(spark, d).silver_events), "event_types"))
register("rolling_7d_revenue", with_ctes(om.ROLLING_7D), "trailing 7-day mean of daily revenue")(
    lambda spark, d: gold.rolling_7d_revenue(gold.daily_revenue(_tables(spark, d).silver_events)))

# ---------------------------------------------------------------------------
# Hourly-window metrics applied to the bounded Silver (batch form of C1-C3)
# ---------------------------------------------------------------------------
register("sales_metrics", with_ctes(om.SALES_METRICS_EXACT), "hourly sales windows (batch, exact buyers)")(
    lambda spark, d: comparable(_tables(spark, d).gold_sales_metrics))
register("product_metrics", with_ctes(om.PRODUCT_METRICS_EXACT), "hourly product windows (batch, exact users)")(
    lambda spark, d: comparable(metrics.product_metrics(_tables(spark, d).silver_events, exact_distinct=True)))
register("user_metrics", with_ctes(om.USER_METRICS), "hourly user windows (batch)")(
    lambda spark, d: comparable(_joined(metrics.user_metrics(_tables(spark, d).silver_events),
                                        "event_types_seen")))

# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------
register("dq_report", with_ctes("SELECT * FROM @gold_dq_reports"), "DQ report per day")(
    lambda spark, d: _tables(spark, d).gold_dq_reports)
register("dq_silver_suite", with_ctes("SELECT * FROM @silver_suite_results"),
         "Silver expectation suite, per day")(
    lambda spark, d: quality.run_suite(_tables(spark, d).silver_events, quality.SILVER_SUITE, by="event_date"))
register("dq_silver_summary", with_ctes(om.summary_sql("silver_suite_results")), "Silver suite summary per day")(
    lambda spark, d: quality.suite_summary(
        quality.run_suite(_tables(spark, d).silver_events, quality.SILVER_SUITE, by="event_date")))
register("dq_gold_suite", with_ctes("SELECT * FROM @gold_suite_results"), "Gold sales suite")(
    lambda spark, d: quality.run_suite(_tables(spark, d).gold_sales_metrics, quality.GOLD_SALES_SUITE))
register("dq_gate", with_ctes(om.DQ_GATE), "DQ report rows breaching the gate")(
    lambda spark, d: quality.dq_gate_issues(_tables(spark, d).gold_dq_reports))
_LAYERS = (f"SELECT *, CAST(NULL AS VARCHAR) AS error, bool_and(passed) OVER () AS overall_passed FROM ("
           f"{om.summary_sql('silver_suite_results')} UNION ALL {om.summary_sql('gold_suite_results')}) l")
register("validate_layers", with_ctes(_LAYERS), "Silver + Gold suites with overall flag")(
    lambda spark, d: quality.validate_layers(
        spark, None, lambda: _tables(spark, d).silver_events, lambda: _tables(spark, d).gold_sales_metrics,
        by="event_date"))


# ---------------------------------------------------------------------------
# Monitoring
# ---------------------------------------------------------------------------
register("layer_freshness", with_ctes(om.LAYER_FRESHNESS),
         "age of the newest Silver event at a fixed instant")(
    lambda spark, d: comparable(monitoring.layer_freshness(
        _tables(spark, d).silver_events, now=om.FRESHNESS_NOW, time_col="event_timestamp")))
register("threshold_alarm", with_ctes(om.THRESHOLD_ALARM),
         "N-consecutive-period threshold alarms over derived metrics")(
    lambda spark, d: comparable(monitoring.threshold_alarm(
        monitoring.event_metrics(_tables(spark, d).tagged), monitoring.rules_frame(spark))))


def _progress_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms over a progress table of one update per minute of events, thousands of updates in all."""
    minute = F.floor(F.unix_micros("event_timestamp") / F.lit(60_000_000))
    bought = F.col("event_type") == "purchase"
    progress = _tables(spark, sf_dir).silver_events.groupBy(minute.alias("batch_id")).agg(
        F.lit("silver").alias("query"), (F.count(F.lit(1)) * 45000).alias("duration_ms"), F.count_if(bought).alias("input_rows"),
        F.lit(None).cast("double").alias("rows_per_second"), F.max(F.when(bought, F.col("event_timestamp"))).alias("newest_event"))
    progress = progress.withColumn("ts", F.timestamp_seconds((F.col("batch_id") + 1) * 60))
    return comparable(monitoring.threshold_alarm(monitoring.progress_metrics(progress),
                                                 monitoring.rules_frame(spark, monitoring.PROGRESS_RULES)))


def _written_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age of the newest written Silver row by ``processed_at``, an hour after that write: 3600 s, a breach."""
    from . import jobs
    base, _ = _medallion_base(spark, sf_dir)
    written = spark.read.parquet(jobs.lake(base)["silver"])
    now = written.agg((F.max("processed_at") + F.expr("interval 1 hour")).cast("string").alias("now")).first()["now"]
    return monitoring.layer_freshness(written, now).select("age_seconds", "breached")


def _distinct_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers per day and country from hourly sketches, held against exact counts."""
    silver_t = _tables(spark, sf_dir).silver_events
    by = ["report_date", "country"]
    exact = (silver_t.filter("event_type = 'purchase'").withColumn("report_date", F.date_format("event_date", "yyyy-MM-dd"))
             .groupBy(*by).agg(F.countDistinct("user_id").alias("exact_buyers")))
    found = gold.distinct_buyers(gold.buyer_sketches(silver_t), *by)
    bound = F.greatest(F.lit(1.0), F.lit(4 * gold.SKETCH_ERROR) * F.col("exact_buyers"))
    return exact.join(found, by).select(*by, "exact_buyers", (
        F.abs(F.col("unique_buyers") - F.col("exact_buyers")) <= bound).alias("within_bound"))


register("progress_alarm", with_ctes(om.PROGRESS_ALARM), "lag, age and slow-batch alarms over a progress table")(_progress_alarm)
register("written_freshness", "SELECT CAST(3600 AS BIGINT) AS age_seconds, TRUE AS breached",
         "M1 on processed_at of the written Silver")(_written_freshness)
register("distinct_buyers", with_ctes(om.DISTINCT_BUYERS), "buyers of any grouping from stored sketches, error bounded")(
    _distinct_buyers)


# ---------------------------------------------------------------------------
# Streaming: each run lands the raw payloads as text files (derived from the
# events table by Spark), runs the query with an availableNow trigger into a
# fresh folder under the shared checkpoint dir, and reads the sink back.
# ---------------------------------------------------------------------------
def run_stream_once(spark: SparkSession, sf_dir: str, query: str, **options) -> str:
    from ..operators.bronze import to_payload
    from ..session import scratch_path
    from ..streaming.pipeline import run_streaming_pipeline

    src = scratch_path(spark, "stream-src")
    to_payload(_tables(spark, sf_dir).raw_events).write.text(src)
    base, ck = scratch_path(spark, "stream-lake"), scratch_path(spark, "stream-ck")
    run_streaming_pipeline(spark, src, base, ck, available_now=True, only=[query], **options).await_all()
    return base


def _stream_read(folder: str, query: str, drop: tuple[str, ...] = ()) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = run_stream_once(spark, sf_dir, query)
        df = spark.read.parquet(f"{base}/{folder}")
        return comparable(df.drop(*drop))
    return build


def _stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze written by the stream, payloads parsed back to raw events
    (the envelope's ingest stamps are wall-clock and not compared)."""
    base = run_stream_once(spark, sf_dir, "bronze")
    return silver.parse_events(spark.read.parquet(f"{base}/bronze/raw_events")).select(*RAW_COLUMNS)


register("stream_bronze", with_ctes("SELECT * FROM @raw_events"),
         "streaming Bronze: every payload parses back to the event sent")(_stream_bronze)
register("stream_silver", with_ctes("SELECT * FROM @silver_events"), "streaming Silver")(
    lambda spark, d: comparable(spark.read.parquet(f"{run_stream_once(spark, d, 'silver')}/silver/stream_events")
                                .select(*[c for c in silver.SILVER_SCHEMA.fieldNames()])))


def _stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_stream_once(spark, sf_dir, "rejected")
    schema = T.StructType(silver.EVENT_SCHEMA.fields + [T.StructField("raw_payload", T.StringType()),
                                                        T.StructField("_rejection_reason", T.StringType())])
    return spark.read.schema(schema).json(f"{base}/silver/stream_rejected").select(*RAW_COLUMNS, "_rejection_reason")


register("stream_rejected", with_ctes(f"SELECT {_RAW_LIST}, _rejection_reason FROM @tagged "
                                      "WHERE _rejection_reason IS NOT NULL"), "streaming dead letter")(
    _stream_rejected)
# Approximate distinct columns (unique_buyers / unique_users) are left out of
# the compared stream outputs; the batch forms above check exact counts.
register("stream_sales_metrics", with_ctes(om.STREAM_SALES), "streaming hourly sales (closed windows)")(
    _stream_read("gold/sales_metrics", "gold-sales", ("unique_buyers",)))
register("stream_product_metrics", with_ctes(om.STREAM_PRODUCTS), "streaming hourly products (closed windows)")(
    _stream_read("gold/product_metrics", "gold-products", ("unique_users",)))


def _stream_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_stream_once(spark, sf_dir, "gold-users")
    return comparable(_joined(spark.read.parquet(f"{base}/gold/user_metrics"), "event_types_seen"))


def _stream_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver streamed in two halves: compacted after the first, so half of the rows are late
    for compacted days, compacted again, and read with the last day not yet compacted."""
    from ..operators.bronze import to_payload
    from ..session import scratch_path
    from ..sources import compaction
    from ..streaming.pipeline import lake_paths, run_streaming_pipeline

    src, base, ck = (scratch_path(spark, f"compact-{x}") for x in ("src", "lake", "ck"))
    payload = to_payload(_tables(spark, sf_dir).raw_events)
    newest = _tables(spark, sf_dir).silver_events.agg(F.max("event_date")).first()[0]
    table, schema = lake_paths(base, ck)["silver"][0], silver.SILVER_SCHEMA
    for half in (0, 1):
        payload.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == half).write.mode("append").text(src)
        run_streaming_pipeline(spark, src, base, ck, available_now=True, only=["silver"]).await_all()
        compaction.compact(spark, table, schema, compaction.SILVER_DAY, newest)
    return comparable(compaction.read(spark, table, schema))


register("stream_compacted", with_ctes("SELECT * FROM @silver_events"), "streamed Silver after two compactions")(
    _stream_compacted)


def _stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of streamed Silver that keeps one row per event id, with their rows (1)."""
    base = run_stream_once(spark, sf_dir, "silver", deduplicate=True)
    return spark.read.parquet(f"{base}/silver/stream_events").groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


register("stream_dedup", with_ctes("SELECT DISTINCT event_id, CAST(1 AS BIGINT) AS n FROM @silver_events"),
         "stream deduplicated within the watermark")(_stream_dedup)
register("stream_user_metrics", with_ctes(om.STREAM_USERS), "streaming hourly users (closed windows)")(
    _stream_users)


# ---------------------------------------------------------------------------
# Jobs, catalog, dedup, partition pruning (write to the shared folder, then
# read back what was written)
# ---------------------------------------------------------------------------
def _medallion_base(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    from ..session import scratch_path
    from . import jobs
    base = scratch_path(spark, "lake")
    counts = jobs.run_medallion(spark, _tables(spark, sf_dir).raw_events, base)
    return base, counts


register("medallion_job", with_ctes(om.MEDALLION_COUNTS), "J2 row counts per written table")(
    lambda spark, d: _medallion_base(spark, d)[1])


def _two_runs(spark: SparkSession, sf_dir: str) -> str:
    """A lake from two daily runs: what mobile devices sent arrives a run late, for all its days."""
    from ..session import scratch_path
    from . import jobs
    base, raw = scratch_path(spark, "lake"), _tables(spark, sf_dir).raw_events
    late = F.coalesce(F.col("device_type") == "mobile", F.lit(False))
    jobs.run_medallion(spark, raw.filter(~late), base, "2024-02-01")
    jobs.run_medallion(spark, raw.filter(late), base, "2024-02-02")
    return base


def _written(table: str):
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        from . import jobs
        return comparable(spark.read.parquet(jobs.lake(_two_runs(spark, sf_dir))[table]))
    return build


def _late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources import readers
    return comparable(readers.load_silver(spark, f"{_two_runs(spark, sf_dir)}/silver/cleaned_events"))


def _rejected_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jobs
    like = _tables(spark, sf_dir).rejected_events
    found = spark.read.schema(like.schema).json(jobs.lake(_two_runs(spark, sf_dir))["rejected"])
    return found.select(*like.columns)


def _emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run that brought a day is repeated without rows: the day goes, the others stay."""
    from ..fixtures import FIXTURE_RUN_DATE
    from ..session import scratch_path
    from . import jobs
    base, raw = scratch_path(spark, "lake"), _tables(spark, sf_dir).raw_events
    of_day = F.coalesce(F.substring("timestamp", 1, 10) == FIXTURE_RUN_DATE, F.lit(False))
    jobs.run_medallion(spark, raw.filter(of_day), base, FIXTURE_RUN_DATE)
    jobs.run_medallion(spark, raw.filter(~of_day), base, "2024-02-01")
    jobs.run_medallion(spark, raw.limit(0), base, FIXTURE_RUN_DATE)
    return comparable(spark.read.parquet(jobs.lake(base)["revenue"]))


register("medallion_late_rows", with_ctes("SELECT * FROM @silver_events"), "Silver after a run with late rows of all days")(_late_rows)
register("medallion_gold_written", with_ctes("SELECT * FROM @gold_revenue_metrics"), "revenue Gold as written by two runs")(
    _written("revenue"))
register("medallion_products_written", with_ctes("SELECT * FROM @gold_top_products"), "product Gold as written by two runs")(
    _written("products"))
register("medallion_segments_written", with_ctes("SELECT * FROM @gold_user_segments"), "segment Gold as written by two runs")(
    _written("segments"))
register("medallion_rejected_written",
         with_ctes(f"SELECT {_RAW_LIST}, _rejection_reason FROM @tagged WHERE _rejection_reason IS NOT NULL"),
         "dead letter as written by two runs")(_rejected_written)
register("medallion_emptied_day", with_ctes("SELECT * FROM @gold_revenue_metrics WHERE report_date <> '2024-01-15'"),
         "revenue Gold after a rerun that empties a day")(_emptied_day)


def _daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jobs
    base, _ = _medallion_base(spark, sf_dir)
    return jobs.run_daily(spark, base, None, gate=False)


register("daily_job", with_ctes("SELECT * FROM @gold_dq_reports"), "J1 backfill: DQ report read back")(_daily_job)


def _catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid
    from ..sources import catalog
    base, _ = _medallion_base(spark, sf_dir)
    prefix = f"t{uuid.uuid4().hex[:8]}_"
    catalog.create_tables(spark, base, prefix)
    found = catalog.refresh_partitions(spark, prefix + "silver_events")
    catalog.drop_tables(spark, prefix)
    return found


def _published_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions added to the catalog from the manifests of two runs, without listing the table's folders."""
    import uuid
    from ..sources import catalog
    base, prefix = _two_runs(spark, sf_dir), f"t{uuid.uuid4().hex[:8]}_"
    catalog.create_tables(spark, base, prefix)
    catalog.add_published(spark, prefix + "silver_events", base, "silver/cleaned_events")
    found = spark.sql(f"SHOW PARTITIONS {prefix}silver_events")
    catalog.drop_tables(spark, prefix)
    return found


register("catalog_published", with_ctes(om.SILVER_PARTITION_LIST), "partitions added from the writers' manifests")(
    _published_partitions)
register("catalog_partitions", with_ctes(om.SILVER_PARTITION_LIST), "partitions discovered after a write")(
    _catalog_partitions)


def _pruned_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..fixtures import FIXTURE_RUN_DATE
    from ..sources import readers
    base, _ = _medallion_base(spark, sf_dir)
    day = readers.load_silver(spark, f"{base}/silver/cleaned_events", FIXTURE_RUN_DATE)
    return comparable(gold.user_segments(day))


register("partition_pruned_load", with_ctes(om.SEGMENTS_ONE_DAY),
         "one Silver partition loaded by partition filter -> user segments")(_pruned_load)


def _layer_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..fixtures import FIXTURE_RUN_DATE
    from ..sources import readers
    base, _ = _medallion_base(spark, sf_dir)
    return comparable(readers.load_layer(spark, base, "gold", "top_products", FIXTURE_RUN_DATE))


def _silver_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..fixtures import FIXTURE_RUN_DATE
    from ..sources import readers
    base, _ = _medallion_base(spark, sf_dir)
    return comparable(readers.load_silver_partition(spark, f"{base}/silver/cleaned_events", FIXTURE_RUN_DATE))


def _catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the catalog's Bronze and streamed sales tables, read by name."""
    import uuid
    from ..operators.bronze import bronze_envelope, to_payload
    from ..session import scratch_path
    from ..sources import catalog
    base, prefix, t = scratch_path(spark, "lake"), f"t{uuid.uuid4().hex[:8]}_", _tables(spark, sf_dir)
    bronze_envelope(to_payload(t.raw_events)).write.partitionBy("ingest_year", "ingest_month", "ingest_day").parquet(
        f"{base}/bronze/raw_events")
    t.gold_sales_metrics.write.parquet(f"{base}/gold/sales_metrics")
    catalog.create_tables(spark, base, prefix)
    catalog.refresh_partitions(spark, prefix + "bronze_events")
    rows = [spark.table(prefix + n).agg(F.count(F.lit(1)).alias("n")).first()["n"] for n in ("bronze_events", "gold_sales_metrics")]
    revenue = spark.table(prefix + "gold_sales_metrics").agg(
        F.lit(rows[0]).alias("bronze_rows"), F.lit(rows[1]).alias("sales_rows"), F.sum("total_orders").alias("orders"))
    found = spark.createDataFrame(revenue.collect(), revenue.schema)  # one row, kept when the tables go
    catalog.drop_tables(spark, prefix)
    return found


def _global_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of all days ranked by units viewed, without one task seeing all."""
    products = _tables(spark, sf_dir).gold_top_products.select("report_date", "product_id", "product_views")
    ranked = gold.global_rank(products, "product_views")
    return gold.global_rank(ranked, "product_views", name="dense", dense=True)


def _observed_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Silver suite from the Silver write's own pass."""
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, "observed")
    observed, results = quality.observe_suite(_tables(spark, sf_dir).silver_events, quality.SILVER_SUITE)
    sinks.write_silver(observed, path)
    return results(spark.read.parquet(path))


register("observed_suite", with_ctes(f"SELECT DISTINCT * FROM ({om.SILVER_SUITE_WHOLE_SQL}) r"), "Silver suite observed while Silver is written")(_observed_suite)
register("layer_load", with_ctes("SELECT * FROM @gold_top_products WHERE report_date = '2024-01-15'"),
         "one day of a Gold table by the layer loader")(_layer_load)
register("silver_partition_load", with_ctes("SELECT * FROM @silver_events WHERE event_date = DATE '2024-01-15'"),
         "one Silver day by the partition loader")(_silver_partition)
register("catalog_tables", with_ctes("SELECT (SELECT COUNT(*) FROM @raw_events) AS bronze_rows, COUNT(*) AS sales_rows, "
                                     "CAST(SUM(total_orders) AS BIGINT) AS orders FROM @gold_sales_metrics"),
         "Bronze and streamed sales read through the catalog")(_catalog_tables)
register("global_rank", with_ctes("SELECT report_date, product_id, product_views, RANK() OVER (ORDER BY product_views DESC) AS rank, "
                                  "DENSE_RANK() OVER (ORDER BY product_views DESC) AS dense FROM @gold_top_products"),
         "rank over a whole frame by ranges")(_global_rank)
register("dedup_events", with_ctes(om.DEDUP_EVENTS), "one row per event id (earliest event)")(
    lambda spark, d: comparable(silver.dedup_events(_tables(spark, d).silver_events)))


# ---------------------------------------------------------------------------
# Bronze landing round trip (A2 -> A3 -> Silver) and the quality flags
# ---------------------------------------------------------------------------
def _bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.bronze import land_bronze_json, to_payload
    from ..session import scratch_path
    from ..sources import readers
    path = scratch_path(spark, "bronze-landing")
    land_bronze_json(to_payload(_tables(spark, sf_dir).raw_events), path)
    return comparable(silver.to_silver(silver.tag_records(readers.read_bronze(spark, path))))


register("bronze_roundtrip", with_ctes("SELECT * FROM @silver_events"),
         "raw JSON landed by event day, read back, validated to Silver")(_bronze_roundtrip)
register("flag_valid_events", with_ctes(om.FLAG_VALID), "rows passing the five quality flags (B3/B4)")(
    lambda spark, d: silver.filter_valid(silver.quality_flags(_tables(spark, d).raw_events)))


def queries() -> dict[str, Builder]:
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.oracle for k, v in REGISTRY.items() if v.oracle is not None}
