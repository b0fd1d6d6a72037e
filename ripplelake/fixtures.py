"""Derive raw clickstream events from the driver's ``events`` table.

The driver table (event_id, ts, user_id, event_type, value, props) has no
products, devices or faults, so raw producer events are derived from it by the
fixed rules of FIXTURES.md section 3.  The same rules are written twice: as
Spark column expressions (``raw_events``) and as DuckDB SQL
(``RAW_EVENTS_SQL``) for the oracle.  The mapping is a pure projection, so it
is a narrow, per-partition step that scales with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EVENT_SCHEMA

# Fixed values of the fixture mapping (FIXTURES.md section 3).
FIXTURE_CATEGORIES = ["Electronics", "Footwear", "Apparel", "Home", "Kitchen", "Sports"]  # by k % 50 % 6
FIXTURE_COUNTRIES = ["US", "GB", "DE", "FR", "CA", "AU", "JP", "IN", "BR", "MX"]  # by user_id % 10
FIXTURE_RUN_DATE = "2024-01-15"  # a day that is non-empty at every scale


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lit_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def raw_events_from(events: DataFrame) -> DataFrame:
    """Project the driver ``events`` frame onto the producer event schema.

    Values used by several output columns (the props key, the cleaned type,
    the has-product flag) are computed once in an intermediate projection;
    Catalyst keeps such non-cheap shared expressions un-inlined.
    """
    e = F.col("event_id")
    u = F.col("user_id")
    t = F.col("event_type")
    clean = (F.when(t == "view", "product_view")
             .when(t == "click", "add_to_cart")
             .when(t == "purchase", "purchase")
             .when(t == "signup", "page_view")
             .when(t == "error", F.when(e % 2 == 0, "search").otherwise("wishlist_add")))
    base = events.select(
        "event_id", "user_id", "ts", "value",
        (F.get_json_object(F.col("props"), "$.k").try_cast("long") % 50).alias("_p"),
        clean.alias("_clean"),
    ).withColumn("_hasp", F.col("_clean").isin("product_view", "add_to_cart", "purchase", "wishlist_add"))

    p, value, has_product = F.col("_p"), F.col("value"), F.col("_hasp")
    iso = F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    bucket = u % 20

    cols = {
        "event_id": (F.when(e % 97 == 0, F.lit(None).cast("string"))
                     .when(e % 97 == 1, F.lit(""))
                     .when(e % 83 == 0, F.concat(F.lit("E"), (e - 1).cast("string")))
                     .otherwise(F.concat(F.lit("E"), e.cast("string")))),
        "timestamp": (F.when(e % 101 == 0, F.lit(None).cast("string"))
                      .when(e % 103 == 0, F.lit("not-a-time"))
                      .otherwise(iso)),
        "user_id": F.when(e % 107 != 0, F.concat(F.lit("U"), F.lpad(u.cast("string"), 6, "0"))),
        "session_id": F.concat(F.lit("S"), u.cast("string"), F.lit("-"), F.dayofmonth("ts").cast("string")),
        "event_type": F.when(e % 109 == 0, F.lit("click")).otherwise(F.col("_clean")),
        "product_id": F.when(has_product, F.concat(F.lit("P"), F.lpad((p + 1).cast("string"), 3, "0"))),
        "product_name": F.when(has_product, F.concat(F.lit("Product "), (p + 1).cast("string"))),
        "category": F.when(has_product & (p % 13 != 0),
                           F.element_at(_lit_array(FIXTURE_CATEGORIES), (p % 6 + 1).cast("int"))),
        "price": F.when(has_product, F.when(e % 113 == 0, -value).otherwise(value)),
        "quantity": F.when(has_product, F.when(e % 127 == 0, F.lit(0)).otherwise(e % 5 + 1)).cast("int"),
        "device_type": (F.when(e % 137 == 0, F.lit(None).cast("string"))
                         .when(e % 131 == 0, F.lit("smartwatch"))
                         .when(bucket < 11, F.lit("mobile"))
                         .when(bucket < 17, F.lit("desktop"))
                         .otherwise(F.lit("tablet"))),
        "country": F.element_at(_lit_array(FIXTURE_COUNTRIES), (u % 10 + 1).cast("int")),
        "ip_address": F.lit(None).cast("string"),
        "user_agent": F.lit(None).cast("string"),
        "revenue": F.when((F.col("_clean") == "purchase") & (e % 7 != 0),
                          (value.cast("decimal(12,2)") * (e % 5 + 1)).cast("double")),
        "schema_version": F.when(e % 2 == 0, F.lit("1.0")),
    }
    return base.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw producer events derived from ``{sf_dir}/events.parquet``."""
    return raw_events_from(read_table(spark, sf_dir, "events"))


# DuckDB twin of ``raw_events_from`` (oracle side); reads the ``events`` view.
RAW_EVENTS_SQL = """
SELECT
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_id % 97 = 1 THEN ''
       WHEN event_id % 83 = 0 THEN 'E' || CAST(event_id - 1 AS VARCHAR)
       ELSE 'E' || CAST(event_id AS VARCHAR) END AS event_id,
  CASE WHEN event_id % 101 = 0 THEN NULL
       WHEN event_id % 103 = 0 THEN 'not-a-time'
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS "timestamp",
  CASE WHEN event_id % 107 = 0 THEN NULL ELSE 'U' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS user_id,
  'S' || CAST(user_id AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR) AS session_id,
  CASE WHEN event_id % 109 = 0 THEN 'click' ELSE et END AS event_type,
  CASE WHEN hasp THEN 'P' || lpad(CAST(p + 1 AS VARCHAR), 3, '0') END AS product_id,
  CASE WHEN hasp THEN 'Product ' || CAST(p + 1 AS VARCHAR) END AS product_name,
  CASE WHEN hasp AND p % 13 <> 0
       THEN ['Electronics', 'Footwear', 'Apparel', 'Home', 'Kitchen', 'Sports'][CAST(p % 6 + 1 AS INTEGER)] END AS category,
  CASE WHEN hasp THEN (CASE WHEN event_id % 113 = 0 THEN -value ELSE value END) END AS price,
  CAST(CASE WHEN hasp THEN (CASE WHEN event_id % 127 = 0 THEN 0 ELSE event_id % 5 + 1 END) END AS INTEGER) AS quantity,
  CASE WHEN event_id % 137 = 0 THEN NULL
       WHEN event_id % 131 = 0 THEN 'smartwatch'
       WHEN user_id % 20 < 11 THEN 'mobile'
       WHEN user_id % 20 < 17 THEN 'desktop'
       ELSE 'tablet' END AS device_type,
  ['US', 'GB', 'DE', 'FR', 'CA', 'AU', 'JP', 'IN', 'BR', 'MX'][CAST(user_id % 10 + 1 AS INTEGER)] AS country,
  CAST(NULL AS VARCHAR) AS ip_address,
  CAST(NULL AS VARCHAR) AS user_agent,
  CASE WHEN et = 'purchase' AND event_id % 7 <> 0
       THEN CAST(CAST(value AS DECIMAL(12,2)) * (event_id % 5 + 1) AS DOUBLE) END AS revenue,
  CASE WHEN event_id % 2 = 0 THEN '1.0' END AS schema_version
FROM (
  SELECT *, et IN ('product_view', 'add_to_cart', 'purchase', 'wishlist_add') AS hasp
  FROM (
    SELECT *,
      CASE event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
                      WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'page_view'
                      WHEN 'error' THEN (CASE WHEN event_id % 2 = 0 THEN 'search' ELSE 'wishlist_add' END)
      END AS et,
      TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 50 AS p
    FROM events
  ) m0
) m1
"""
