"""Structured Streaming pipeline (C4-C8, J3) as a chained medallion.

    source --(bronze)--> Bronze table --(silver, rejected)--> Silver table,
    dead letter --(gold-sales, gold-users, gold-products)--> hourly Gold

The source is read once (Bronze); Silver and the dead letter stream the
Bronze table; the three Gold queries stream the Silver table, so JSON is
parsed and validated once per record for Silver (and once for the dead
letter) instead of once per Gold table.  Every query has its own
checkpoint; file sinks commit through their metadata log and downstream file
sources read only committed files, so each hop is exactly-once and every
query restarts where it stopped after a driver or executor loss.

Semantics:
* the event-time watermark (10 min) is defined once per stateful query, on
  the stream it aggregates (Spark refuses a second definition);
* a 1-hour window is emitted once, when the watermark passes its end
  (append mode), and its state is then dropped: state is bounded by the open
  windows x keys;
* rows whose window was already emitted are dropped as late; late rows of a
  window still open are counted.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bronze import bronze_envelope
from ..operators.silver import REASON, dedup_stream, parse_events, rejected_records, tag_records, to_silver
from ..schemas import BRONZE_SCHEMA, SILVER_SCHEMA, WATERMARK_DELAY
from ..session import ensure_utc
from ..sources.readers import read_event_stream
from ..sources.sinks import write_bronze_stream, write_gold_stream, write_silver_stream
from . import metrics

STATS_METRIC = "transform_stats"
#: Files a trigger takes, so that the first one after an outage is bounded.
MAX_FILES = 1000


def _payload(records: DataFrame) -> DataFrame:
    col = "raw_payload" if "raw_payload" in records.columns else "data"
    return records.select(F.col(col).cast("string").alias("raw_payload"))


def silver_stream(records: DataFrame, watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """C4 + B2-B15: parse, validate, type; optional event-time watermark.

    ``records`` carries the payload as ``data`` (a source) or ``raw_payload``
    (the Bronze table).  B15 in streams: read/valid counts per micro-batch
    are observed on the tagged rows and reported in the query progress
    (``observedMetrics["transform_stats"]``), without an extra pass.
    """
    tagged = tag_records(parse_events(_payload(records)))
    tagged = tagged.observe(STATS_METRIC, F.count(F.lit(1)).alias("total_read"),
                            F.count_if(F.col(REASON).isNull()).alias("total_valid"))
    out = to_silver(tagged)
    return out.withWatermark("event_timestamp", watermark) if watermark else out


def rejected_stream(records: DataFrame) -> DataFrame:
    """Dead letter of the stream: rejected rows with their reason and the
    processing day (the streaming path keeps what it drops, B7/K7)."""
    tagged = tag_records(parse_events(_payload(records)))
    today = F.current_date()
    return (rejected_records(tagged)
            .withColumn("year", F.year(today)).withColumn("month", F.month(today))
            .withColumn("day", F.dayofmonth(today)))


def stream_table(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream a table written by an upstream file sink (committed files only)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


@dataclass
class StreamingPipeline:
    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def await_all(self, timeout: float | None = None) -> None:
        """Wait for all queries; a query that fails stops the others and raises."""
        until = None if timeout is None else time.monotonic() + timeout
        while True:
            failed = next((q for q in self.queries.values() if q.exception() is not None), None)
            if failed is not None:
                self.stop()
                raise failed.exception()
            running = [q for q in self.queries.values() if q.isActive]
            if not running or (until is not None and time.monotonic() >= until):
                return
            running[0].awaitTermination(1)

    def process_all_available(self) -> None:
        for q in self.queries.values():
            q.processAllAvailable()

    def stop(self) -> None:
        """Stop the queries.  A batch under way is given up and run again from
        its checkpoint at the next start; sinks commit whole batches only."""
        for q in self.queries.values():
            if q.isActive:
                q.stop()


def lake_paths(base: str, checkpoints: str) -> dict[str, tuple[str, str]]:
    """Folder and checkpoint of each query.  None is a folder of the batch jobs:
    readers of a streamed folder see the files of the stream's log only."""
    b, c = base.rstrip("/"), checkpoints.rstrip("/")
    return {
        "bronze": (f"{b}/bronze/raw_events", f"{c}/bronze"),
        "silver": (f"{b}/silver/stream_events", f"{c}/silver"),
        "rejected": (f"{b}/silver/stream_rejected", f"{c}/rejected"),
        "gold-sales": (f"{b}/gold/sales_metrics", f"{c}/gold_sales"),
        "gold-users": (f"{b}/gold/user_metrics", f"{c}/gold_users"),
        "gold-products": (f"{b}/gold/product_metrics", f"{c}/gold_products"),
    }


# Query -> upstream query it streams from; stages run in this order.
UPSTREAM = {"bronze": None, "silver": "bronze", "rejected": "bronze",
            "gold-sales": "silver", "gold-users": "silver", "gold-products": "silver"}
STAGES = [["bronze"], ["silver", "rejected"], ["gold-sales", "gold-users", "gold-products"]]


def _with_upstream(names) -> set[str]:
    out: set[str] = set()
    for n in names:
        while n is not None and n not in out:
            out.add(n)
            n = UPSTREAM[n]
    return out


def run_streaming_pipeline(spark: SparkSession, source: str, base: str, checkpoints: str,
                           fmt: str = "text", options: dict | None = None,
                           available_now: bool = False, max_files_per_trigger: int | None = MAX_FILES,
                           max_records_per_trigger: int | None = None,
                           trigger: str | None = None, only: list[str] | None = None,
                           deduplicate: bool = False) -> StreamingPipeline:
    """Start the chained queries (products too) and return them.

    ``only`` selects queries; their upstream queries are included.  With
    ``available_now`` the stages run one after another (each drains what its
    upstream committed); otherwise all queries run concurrently.
    ``deduplicate``: Silver keeps one row per event id within the watermark; choose it
    at the first start, since the checkpoint holds its state.
    """
    ensure_utc(spark)
    paths = lake_paths(base, checkpoints)
    kw = {"available_now": available_now, "trigger": trigger}
    wanted = _with_upstream(only or UPSTREAM)

    def bronze_table() -> DataFrame:
        return stream_table(spark, paths["bronze"][0], BRONZE_SCHEMA, max_files_per_trigger)

    def silver_table() -> DataFrame:
        return (stream_table(spark, paths["silver"][0], SILVER_SCHEMA, max_files_per_trigger)
                .withWatermark("event_timestamp", WATERMARK_DELAY))

    def silver_rows() -> DataFrame:
        if deduplicate:
            return dedup_stream(silver_stream(bronze_table()))
        return silver_stream(bronze_table(), watermark=None)

    builders = {
        "bronze": lambda: write_bronze_stream(
            bronze_envelope(read_event_stream(spark, source, fmt, options, max_files_per_trigger, max_records_per_trigger)),
            *paths["bronze"], name="bronze", **kw),
        "silver": lambda: write_silver_stream(silver_rows(), *paths["silver"], name="silver", **kw),
        "rejected": lambda: _write_json_stream(rejected_stream(bronze_table()), *paths["rejected"], **kw),
        "gold-sales": lambda: write_gold_stream(metrics.sales_metrics(silver_table()),
                                                *paths["gold-sales"], "gold-sales", **kw),
        "gold-users": lambda: write_gold_stream(metrics.user_metrics(silver_table()),
                                                *paths["gold-users"], "gold-users", **kw),
        "gold-products": lambda: write_gold_stream(metrics.product_metrics(silver_table()),
                                                   *paths["gold-products"], "gold-products", **kw),
    }
    pipe = StreamingPipeline()
    for stage in STAGES:
        started = [n for n in stage if n in wanted]
        for name in started:
            pipe.queries[name] = builders[name]()
        if available_now:
            for name in started:
                pipe.queries[name].awaitTermination()
    return pipe


def _write_json_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                       trigger: str | None = None) -> StreamingQuery:
    """K7 for streams: dead letter as NDJSON by processing day."""
    w = (df.writeStream.format("json").outputMode("append").option("path", path)
           .option("checkpointLocation", checkpoint).partitionBy("year", "month", "day").queryName("rejected"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger or "60 seconds")
    return w.start()
