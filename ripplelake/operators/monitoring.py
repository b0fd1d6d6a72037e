"""Monitoring as table operators (M1, M2).

* ``layer_freshness``: age of the newest record of a layer and a breach flag.
* ``threshold_alarm``: metric alarms over a metric series: a
  statistic per fixed period, compared with a threshold, in alarm after N
  consecutive breaching periods (a missing period breaks the streak).

Both run on aggregated data: the alarm windows see one row per rule and
period, never raw events, so the per-rule window partitions stay bounded by
time span / period, not by data volume.
"""

from __future__ import annotations

import datetime as dt
import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.money import money, money_sum, ratio, to_double
from ..functions.rules import blank

FRESHNESS_THRESHOLD_S = 300  # fixed value: Silver freshness alarm (> 300 s)

RULE_SCHEMA = T.StructType([
    T.StructField("alarm_name", T.StringType(), False),
    T.StructField("metric", T.StringType(), False),
    T.StructField("statistic", T.StringType(), False),      # avg | max | sum | count
    T.StructField("period_seconds", T.LongType(), False),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("comparison", T.StringType(), False),     # > | >=
    T.StructField("evaluation_periods", T.IntegerType(), False),
])

# Example rules over metrics the pipeline derives from its own data (the
# null event-id rate has the production alarm's threshold of 0.5 %).
DEFAULT_RULES = [
    ("dq-null-rate-breach", "NullEventId", "avg", 86400, 0.5, ">", 1),
    ("rejected-records-high", "RejectedRecord", "sum", 3600, 2.0, ">", 2),
    ("revenue-hour-high", "PurchaseRevenue", "sum", 3600, 500.0, ">=", 3),
]


# Streaming-health rules (fixed values of the production alarms).
STREAMING_RULES = [
    ("spark-batch-processing-slow", "BatchProcessingTimeMs", "avg", 60, 120000.0, ">", 5),
]

#: The production alarms on a running pipeline (fixed values): consumer lag above 60,000 ms, the newest
#: Silver write older than 300 s, and micro-batches above 120,000 ms.
PROGRESS_RULES = [
    ("consumer-lag-high", "ConsumerLagMs", "max", 60, 60000.0, ">", 3),
    ("silver-no-new-data", "LastWriteAgeSeconds", "max", 60, 300.0, ">", 3),
    *STREAMING_RULES,
]

PROGRESS_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])


def streaming_progress_metrics(spark: SparkSession, queries) -> DataFrame:
    """Metric series from the recent progress of running streaming queries:
    BatchProcessingTimeMs, RecordsProcessedPerSecond and InputRows per
    micro-batch.  ``recentProgress`` is a bounded driver-side log (the last
    ~100 batches per query), so this is query metadata, not data."""
    import datetime as _dt
    rows = []
    for q in queries:
        for p in q.recentProgress:
            ts = _dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00"))
            rows.append(("BatchProcessingTimeMs", ts, float(p.get("batchDuration") or 0)))
            rows.append(("RecordsProcessedPerSecond", ts, float(p.get("processedRowsPerSecond") or 0)))
            rows.append(("InputRows", ts, float(p.get("numInputRows") or 0)))
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


PROGRESS_COLUMNS = ("query string, batch_id long, ts timestamp, duration_ms long, input_rows long, rows_per_second double, "
                    "newest_event timestamp")


def _progress_row(p: dict) -> tuple:
    def time(x: str | None) -> dt.datetime | None:
        return dt.datetime.fromisoformat(x.replace("Z", "+00:00")) if x else None

    newest = (p.get("eventTime") or {}).get("max")
    return (p.get("name"), p["batchId"], time(p["timestamp"]), int(p.get("batchDuration") or 0), int(p.get("numInputRows") or 0),
            float(p.get("processedRowsPerSecond") or 0), time(newest))


class ProgressTable(StreamingQueryListener):
    """Keeps every progress update of the session's streams in a Parquet table.

    Spark itself remembers the last hundred updates of a query; this listener
    appends them, ``every`` at a time and when a query ends, so alarms see all.
    Register with ``spark.streams.addListener``; ``flush`` writes what is held.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 60) -> None:
        self.spark, self.path, self.every = spark, path, every
        self.held: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.append(json.loads(event.progress.json))

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def append(self, progress: dict) -> None:
        with self.lock:
            self.held.append(_progress_row(progress))
            full = len(self.held) >= self.every
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS_COLUMNS).parquet(self.path)


def progress_metrics(progress: DataFrame) -> DataFrame:
    """Metric series (metric, ts, value) of a progress table: one row per update and metric.

    ConsumerLagMs is how far the newest event read lies behind the update;
    LastWriteAgeSeconds the time since the query's last update with rows (an
    update with rows has age 0; before the first one there is none).
    """
    past = Window.partitionBy("query").orderBy("ts", "batch_id").rowsBetween(Window.unboundedPreceding, 0)
    written = F.last(F.when(F.col("input_rows") > 0, F.col("ts")), ignorenulls=True).over(past)
    values = {
        "BatchProcessingTimeMs": F.col("duration_ms"),
        "RecordsProcessedPerSecond": F.col("rows_per_second"),
        "InputRows": F.col("input_rows"),
        "ConsumerLagMs": (F.unix_micros("ts") - F.unix_micros("newest_event")) / 1000,
        "LastWriteAgeSeconds": (F.unix_micros("ts") - F.unix_micros("written")) / 1000000,
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in values.items()])
    return (progress.withColumn("written", written).select("ts", F.explode(pairs).alias("m"))
            .select("m.metric", "ts", "m.value").filter("value is not null"))


def layer_freshness(df: DataFrame, now: str | None = None, time_col: str = "processed_at",
                    threshold_s: int = FRESHNESS_THRESHOLD_S) -> DataFrame:
    """M1: newest ``time_col``, its age in whole seconds at ``now`` (default:
    the current time) and ``breached`` (age > threshold).  One aggregate."""
    now_col = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    last = df.agg(F.max(time_col).alias("last_write"))
    age = F.unix_seconds(now_col) - F.unix_seconds(F.col("last_write"))
    return last.select("last_write", age.alias("age_seconds"), (age > threshold_s).alias("breached"))


def event_metrics(tagged: DataFrame, seconds: int = 60) -> DataFrame:
    """Metric series of tagged raw events, summed up per ``seconds`` before it is made long:
    (metric, ts, total, top, n), a few rows per period instead of four per record.

    Rules whose period is a multiple of ``seconds`` give the same statistics as
    over single records.
    """
    from .silver import EVENT_TS, REASON
    sold = F.when(F.col(REASON).isNull() & (F.col("event_type") == "purchase"), F.col("revenue"))
    values = {"RecordsRead": F.lit(1.0), "NullEventId": F.when(blank("event_id"), 100.0).otherwise(0.0),
              "RejectedRecord": F.col(REASON).isNotNull().cast("double"), "PurchaseRevenue": sold}
    parts = {"total": money_sum, "top": F.max, "n": F.count}
    period = F.floor(F.unix_micros(EVENT_TS) / F.lit(seconds * 1_000_000)) * seconds
    wide = tagged.filter(F.col(EVENT_TS).isNotNull()).groupBy(period.alias("_period")).agg(
        *[part(v).alias(f"{k}_{name}") for k, v in values.items() for name, part in parts.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), *[F.col(f"{k}_{name}").alias(name) for name in parts]) for k in values])
    return (wide.select(F.timestamp_seconds("_period").alias("ts"), F.explode(rows).alias("m"))
                .select("m.metric", "ts", "m.total", "m.top", "m.n").filter("n > 0"))


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(list(rules or DEFAULT_RULES), RULE_SCHEMA)


def threshold_alarm(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """M2: per rule and period: statistic, breached, in_alarm.

    ``metrics``: single readings (metric, ts, value), or sums of some
    (metric, ts, total, top, n).

    The join is left to the optimizer, as ``rules`` is the caller's frame; metrics are bucketed per rule period and aggregated with a
    map-side partial step before any window runs.
    """
    if "value" in metrics.columns:  # single readings
        metrics = metrics.select("metric", "ts", money("value").alias("total"), F.col("value").alias("top"),
                                 F.col("value").isNotNull().cast("long").alias("n"))
    m = metrics.join(rules, "metric")
    idx = F.floor(F.unix_micros(F.col("ts")) / (F.col("period_seconds") * F.lit(1_000_000)))
    per = (m.groupBy("alarm_name", "statistic", "period_seconds", "threshold", "comparison",
                     "evaluation_periods", idx.alias("period_idx"))
            .agg(F.sum("total").alias("_sum"), F.max("top").alias("_max"), F.sum("n").alias("_n")))
    stat = (F.when(F.col("statistic") == "avg", ratio(F.col("_sum"), F.col("_n")))
             .when(F.col("statistic") == "max", F.col("_max"))
             .when(F.col("statistic") == "sum", to_double("_sum"))
             .otherwise(F.col("_n").cast("double")))
    per = per.withColumn("statistic_value", stat)
    breached = F.when(F.col("comparison") == ">=", F.col("statistic_value") >= F.col("threshold")) \
                .otherwise(F.col("statistic_value") > F.col("threshold"))
    per = per.withColumn("breached", breached)
    # Gaps and islands: breaching periods with contiguous indexes share
    # period_idx - (breaches so far); the streak is the position inside.
    w = Window.partitionBy("alarm_name").orderBy("period_idx").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_island", F.col("period_idx") - F.sum(F.col("breached").cast("long")).over(w))
    streak_w = Window.partitionBy("alarm_name", "_island", "breached").orderBy("period_idx")
    per = per.withColumn("_streak", F.when(F.col("breached"), F.row_number().over(streak_w)).otherwise(0))
    return per.select(
        "alarm_name",
        F.timestamp_seconds(F.col("period_idx") * F.col("period_seconds")).alias("period_start"),
        "statistic_value", "breached",
        (F.col("_streak") >= F.col("evaluation_periods")).alias("in_alarm"),
    )
