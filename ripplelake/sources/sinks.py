"""Sinks (K1-K8).

Batch tables are written partitioned with dynamic partition overwrite, so a
daily run replaces exactly the days it produced and keeps every other day;
reruns are idempotent (a retried or restarted job rewrites the same
partitions).  Streams append with one checkpoint per query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.gold import as_date
from ..operators.silver import enforce_schema
from ..schemas import GOLD_PARTITIONS, SILVER_PARTITIONS, SILVER_SCHEMA, TRIGGER_INTERVAL


def _trigger(writer, trigger: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger or TRIGGER_INTERVAL)


def write_stream(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                 name: str | None = None, trigger: str | None = None,
                 available_now: bool = False, retention: str | None = None) -> StreamingQuery:
    """K1-K3: append a stream to Parquet with its own checkpoint.

    Parquet sinks accept append mode only; windowed aggregates therefore rely
    on the watermark to emit each window once, when it closes.  ``retention``
    (e.g. ``"30d"``): the sink's log forgets files older than that; only for
    tables that ``compaction.compact`` covers, and downstream streams read, sooner.
    """
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint))
    if retention:
        w = w.option("retention", retention)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger, available_now).start()


def write_bronze_stream(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """K1: Bronze envelope by ingest year/month/day."""
    return write_stream(df, path, checkpoint, ["ingest_year", "ingest_month", "ingest_day"], **kw)


def write_silver_stream(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """K2: Silver by event year/month/day."""
    return write_stream(df, path, checkpoint, SILVER_PARTITIONS, **kw)


def write_gold_stream(df: DataFrame, path: str, checkpoint: str, name: str, **kw) -> StreamingQuery:
    """K3: one named append query per Gold table."""
    return write_stream(df, path, checkpoint, None, name=name, **kw)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], mode: str = "overwrite") -> None:
    """Partitioned Parquet write; ``overwrite`` replaces only the partitions
    present in ``df`` (dynamic partition overwrite).  Rows are dealt by
    partition before, large ones in parts, so a day has few files."""
    (df.hint("rebalance", *partition_by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


def write_gold(df: DataFrame, path: str, mode: str = "overwrite", run_date=None) -> None:
    """K4/K8: a Gold table by report year/month/day.

    With ``run_date`` (``df`` is that day's rows) the day's partition is
    replaced even by an empty frame, so a rerun leaves nothing stale.
    """
    if run_date is None:
        write_partitioned(df, path, GOLD_PARTITIONS, mode)
        return
    d = as_date(run_date)
    day = "/".join(f"{c}={v}" for c, v in zip(GOLD_PARTITIONS, (d.year, d.month, d.day)))
    df.drop(*GOLD_PARTITIONS).write.mode(mode).option("partitionOverwriteMode", "static").parquet(f"{path}/{day}")


def write_dq_report(report: DataFrame, path: str) -> None:
    """K5: DQ report rows (one per run day), one small file per day."""
    d = F.to_date(F.col("run_date"))
    out = (report.withColumn("year", F.year(d)).withColumn("month", F.month(d))
                 .withColumn("day", F.dayofmonth(d)))
    # One row per day: repartitioning by day gives one file per partition.
    write_partitioned(out.repartition("year", "month", "day"), path, ["year", "month", "day"])


def write_silver(df: DataFrame, path: str) -> None:
    """K6: typed Silver (declared schema) by event day, Snappy Parquet."""
    write_partitioned(enforce_schema(df, SILVER_SCHEMA), path, SILVER_PARTITIONS)


def write_rejected(df: DataFrame, path: str, run_date=None) -> None:
    """K7: dead letter as NDJSON.

    With ``run_date`` (one Bronze day per run) the rejects land in that run
    day's partition with dynamic overwrite, so a rerun replaces them.
    Without it they are appended under the processing day (rejected rows
    often have no usable event time).
    """
    import datetime as _dt
    if run_date is not None:
        d = run_date if isinstance(run_date, _dt.date) else _dt.date.fromisoformat(str(run_date))
        day, mode = F.lit(d), "overwrite"
    else:
        day, mode = F.current_date(), "append"
    (df.withColumn("year", F.year(day)).withColumn("month", F.month(day))
       .withColumn("day", F.dayofmonth(day))
       .write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy("year", "month", "day").json(path))
