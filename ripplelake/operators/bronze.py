"""Bronze step: keep every record as it arrived (B1, A2).

Bronze is the replay source: the original payload text plus transport
metadata, partitioned by ingest (or event) day.  No record is dropped here;
validation happens in the Silver step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS


def to_payload(raw: DataFrame) -> DataFrame:
    """Serialise typed raw events to one JSON document per row
    (``raw_payload``), as a producer would send them.  NULL fields are left
    out of the document, like absent keys."""
    cols = [c for c in RAW_COLUMNS if c in raw.columns]
    return raw.select(F.to_json(F.struct(*cols)).alias("raw_payload"))


def _opt(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def bronze_envelope(records: DataFrame) -> DataFrame:
    """B1: payload bytes/text -> ``raw_payload`` plus transport metadata.

    Accepts a record stream with ``data`` (binary or string, as queue and
    log connectors deliver it) or ``value`` (text files) or ``raw_payload``;
    optional ``partitionKey``, ``sequenceNumber`` and
    ``approximateArrivalTimestamp``.  The arrival time (else the processing
    time) gives the ingest year/month/day partition.
    """
    payload = (F.col("data") if "data" in records.columns
               else F.col("value") if "value" in records.columns else F.col("raw_payload"))
    arrival = _opt(records, "approximateArrivalTimestamp", F.current_timestamp())
    out = records.select(
        payload.cast("string").alias("raw_payload"),
        _opt(records, "partitionKey", F.lit(None)).cast("string").alias("partition_key"),
        _opt(records, "sequenceNumber", F.lit(None)).cast("string").alias("sequence_number"),
        arrival.cast("timestamp").alias("arrival_time"),
        F.current_timestamp().alias("processing_time"),
    )
    return (out.withColumn("ingest_year", F.year("arrival_time"))
               .withColumn("ingest_month", F.month("arrival_time"))
               .withColumn("ingest_day", F.dayofmonth("arrival_time")))


def landing_partition(payload_col: str = "raw_payload") -> list[Column]:
    """A2: year/month/day of the event time in the payload, else of now."""
    ts = F.coalesce(F.try_to_timestamp(F.get_json_object(F.col(payload_col), "$.timestamp")),
                    F.current_timestamp())
    return [F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day")]


def land_bronze_json(payloads: DataFrame, path: str, payload_col: str = "raw_payload",
                     skip_malformed: bool = False) -> None:
    """A2: append raw JSON lines under ``year=/month=/day=`` by event day.

    Blank lines are skipped.  By default malformed text is kept for audit
    and rejected later in Silver (``malformed_json``); ``skip_malformed``
    drops it at landing instead, as a consumer that discards undecodable
    messages does.  Rows are dealt by day first, a large day in
    parts, so a day gets few files; no driver-side buffering.
    """
    body = F.col(payload_col)
    kept = payloads.filter(body.isNotNull() & (F.trim(body) != ""))
    if skip_malformed:
        kept = kept.filter(F.get_json_object(body, "$").isNotNull())
    (kept.select(body.alias("value"), *landing_partition(payload_col)).hint("rebalance", "year", "month", "day")
         .write.mode("append").partitionBy("year", "month", "day").text(path))
