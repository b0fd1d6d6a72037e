"""Readers (A1, A3-A6).

All readers return lazy DataFrames; date restrictions are filters on the
partition columns, which the Parquet/text scans turn into partition pruning
(``PartitionFilters`` in the plan), never string-built paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gold import as_date, for_run_date
from ..operators.silver import parse_events
from ..schemas import GOLD_PARTITIONS
from . import publish


class NoDataError(RuntimeError):
    """A requested partition holds no data."""


# Connector column names -> the record columns the Bronze envelope reads.
_RECORD_COLUMNS = {"value": "data", "key": "partitionKey", "offset": "sequenceNumber",
                   "timestamp": "approximateArrivalTimestamp"}


#: Records of a micro-batch from a log connector: 10,000 a fetch, for a hundred shards.
MAX_RECORDS = 1_000_000


def normalize_records(df: DataFrame) -> DataFrame:
    """Rename connector columns (log/queue or text file) to ``data``,
    ``partitionKey``, ``sequenceNumber``, ``approximateArrivalTimestamp``."""
    for src, dst in _RECORD_COLUMNS.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    return df


def read_event_stream(spark: SparkSession, source: str, fmt: str = "text",
                      options: dict | None = None, max_files_per_trigger: int | None = None,
                      max_records_per_trigger: int | None = None) -> DataFrame:
    """A1: raw record stream.

    ``fmt``/``options`` select the connector: for the file source ``source``
    is a folder and ``maxFilesPerTrigger`` caps each micro-batch; for a log
    connector (``fmt="kafka"``) ``source`` is the topic, reading starts at the
    latest offsets unless ``options`` say otherwise, and
    ``max_records_per_trigger`` (MAX_RECORDS unless given) caps each micro-batch.  Columns are
    normalized for the Bronze envelope (``normalize_records``).
    """
    opts = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        opts.setdefault("subscribe", source)
        opts.setdefault("startingOffsets", "latest")
        opts.setdefault("maxOffsetsPerTrigger", str(max_records_per_trigger or MAX_RECORDS))
        df = reader.options(**opts).load()
    else:
        if max_files_per_trigger:
            opts.setdefault("maxFilesPerTrigger", str(max_files_per_trigger))
        df = reader.options(**opts).load(source)
    return normalize_records(df)


#: Names of Bronze files: JSON lines, as the text writer or a producer names them.
BRONZE_FILES = "*.{json,ndjson,txt}"


def read_bronze(spark: SparkSession, path: str, run_date=None, skip_malformed: bool = False,
                files: str = BRONZE_FILES) -> DataFrame:
    """A3: Bronze NDJSON (``year=/month=/day=`` dirs) parsed to raw events.

    Only files whose names match ``files`` are read.  Blank lines are skipped.  Malformed lines are kept with ``_corrupt`` set
    so the Silver step rejects them as ``malformed_json`` (auditable), or
    dropped here with ``skip_malformed``.
    """
    df = spark.read.option("pathGlobFilter", files).text(path)
    if run_date is not None:
        d = as_date(run_date)
        df = df.filter((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day))
    df = df.filter(F.trim(F.col("value")) != "")
    if skip_malformed:
        df = df.filter(F.get_json_object(F.col("value"), "$").isNotNull())
    return parse_events(df, "value")


def load_silver(spark: SparkSession, path: str, run_date=None, merge_schema: bool = False) -> DataFrame:
    """A4: Silver Parquet with a partition predicate for one day (or all)."""
    publish.settle_above(spark, path)
    reader = spark.read.option("mergeSchema", "true") if merge_schema else spark.read
    return for_run_date(reader.parquet(path), run_date)


def load_silver_partition(spark: SparkSession, path: str, run_date) -> DataFrame:
    """A5: one day of Silver; raise ``NoDataError`` when it is empty.

    The emptiness probe reads at most one row of the pruned partition.
    """
    df = load_silver(spark, path, run_date, merge_schema=True)
    if df.limit(1).count() == 0:
        raise NoDataError(f"no Silver data for {run_date}")
    return df


def load_layer(spark: SparkSession, base: str, layer: str, subpath: str, run_date=None) -> DataFrame:
    """A Silver or Gold table restricted to one day via its partition
    columns; any other layer raises ``ValueError``."""
    if layer == "silver":
        return load_silver(spark, f"{base}/silver/{subpath}", run_date)
    if layer == "gold":
        publish.settle(spark, base.rstrip("/"))
        df = spark.read.parquet(f"{base}/gold/{subpath}")
        if run_date is None:
            return df
        d = as_date(run_date)
        y, m, dd = GOLD_PARTITIONS
        if y not in df.columns:  # streamed tables are kept by window
            return df.filter(F.to_date("window_start") == F.lit(d))
        return df.filter((F.col(y) == d.year) & (F.col(m) == d.month) & (F.col(dd) == d.day))
    raise ValueError(f"layer {layer!r} is neither silver nor gold")
