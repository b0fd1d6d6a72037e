"""Declared schemas, value domains and business thresholds.

Everything here is a fixed value of the data contract; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values of the event contract (must equal the upstream producer's).
# ---------------------------------------------------------------------------
VALID_EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "purchase", "search", "wishlist_add"]
VALID_DEVICE_TYPES = ["mobile", "desktop", "tablet"]
DEFAULT_SCHEMA_VERSION = "1.0"
WATERMARK_DELAY = "10 minutes"
WINDOW_DURATION = "1 hour"
TRIGGER_INTERVAL = "60 seconds"

# Segment thresholds (strictly greater than), fixed values.
#   daily  : spend > 500 vip, > 100 high_value, > 0 buyer, events > 10 engaged_browser, else casual_browser
#   cohort : spend > 200 high_value, > 0 buyer, events > 10 engaged_browser, else casual_browser
DAILY_SEGMENTS = [("vip", 500.0), ("high_value", 100.0), ("buyer", 0.0)]
COHORT_SEGMENTS = [("high_value", 200.0), ("buyer", 0.0)]
ENGAGED_EVENTS = 10

# Leaderboard sizes, fixed values.
TOP_N_DAILY = 20
TOP_N_COHORT = 50

# DQ gate threshold on null event id percentage, fixed value.
DQ_NULL_EVENT_ID_PCT = 0.5

# ---------------------------------------------------------------------------
# Raw event as sent by producers (JSON document).  ``_corrupt`` captures text
# that does not parse or has a wrong-typed field.
# ---------------------------------------------------------------------------
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("schema_version", T.StringType()),
])
CORRUPT_COL = "_corrupt"
EVENT_SCHEMA_WITH_CORRUPT = T.StructType(EVENT_SCHEMA.fields + [T.StructField(CORRUPT_COL, T.StringType())])
RAW_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# ---------------------------------------------------------------------------
# Silver: 20 typed columns; partitioned by event_year/month/day.
# ``nullable=False`` marks the null contract, checked by the quality suite.
# ---------------------------------------------------------------------------
SILVER_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType()),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("device_type", T.StringType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("event_timestamp", T.TimestampType(), False),
    T.StructField("event_date", T.DateType(), False),
    T.StructField("event_hour", T.IntegerType(), False),
    T.StructField("event_year", T.IntegerType(), False),
    T.StructField("event_month", T.IntegerType(), False),
    T.StructField("event_day", T.IntegerType(), False),
    T.StructField("schema_version", T.StringType()),
    T.StructField("processed_at", T.TimestampType(), False),
])
SILVER_PARTITIONS = ["event_year", "event_month", "event_day"]
GOLD_PARTITIONS = ["report_year", "report_month", "report_day"]

GOLD_REVENUE_SCHEMA = T.StructType([
    T.StructField("event_hour", T.IntegerType()),
    T.StructField("country", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("unique_buyers", T.LongType()),
    T.StructField("report_date", T.StringType()),
    T.StructField("created_at", T.StringType()),
])
GOLD_PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("purchase_count", T.LongType()),
    T.StructField("cart_adds", T.LongType()),
    T.StructField("product_views", T.LongType()),
    T.StructField("unique_users", T.LongType()),
    T.StructField("conversion_rate", T.DoubleType()),
    T.StructField("revenue_rank", T.IntegerType()),
    T.StructField("report_date", T.StringType()),
    T.StructField("created_at", T.StringType()),
])
GOLD_SEGMENTS_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("daily_spend", T.DoubleType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("session_count", T.LongType()),
    T.StructField("user_segment", T.StringType()),
    T.StructField("report_date", T.StringType()),
    T.StructField("created_at", T.StringType()),
])
GOLD_SALES_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("country", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("total_revenue", T.DoubleType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("total_units_sold", T.LongType()),
    T.StructField("avg_order_value", T.DoubleType()),
    T.StructField("unique_buyers", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])
BRONZE_SCHEMA = T.StructType([
    T.StructField("raw_payload", T.StringType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("sequence_number", T.StringType()),
    T.StructField("arrival_time", T.TimestampType()),
    T.StructField("processing_time", T.TimestampType()),
    T.StructField("ingest_year", T.IntegerType()),
    T.StructField("ingest_month", T.IntegerType()),
    T.StructField("ingest_day", T.IntegerType()),
])
BRONZE_COLUMNS = BRONZE_SCHEMA.fieldNames()
