"""DuckDB twins of the pipeline, used only as a correctness oracle.

The CTEs rebuild raw -> tagged -> Silver -> Gold from the ``events`` view by
the written rules, independently of the Spark code.  ``with_ctes(sql)``
prefixes a query with the whole chain (DuckDB skips unreferenced CTEs).
"""

from __future__ import annotations

from ..fixtures import RAW_EVENTS_SQL
from .sqlkit import DIV, R, for_duckdb

EVENT_TYPES_SQL = "('page_view', 'product_view', 'add_to_cart', 'purchase', 'search', 'wishlist_add')"
DEVICES_SQL = "('mobile', 'desktop', 'tablet')"

TAGGED_SQL = f"""
SELECT r.*,
  TRY_CAST(substr("timestamp", 1, 26) AS TIMESTAMP) AS _event_ts,
  CASE
    WHEN event_id IS NULL OR event_id = '' THEN 'missing_event_id'
    WHEN user_id IS NULL OR user_id = '' THEN 'missing_user_id'
    WHEN "timestamp" IS NULL OR "timestamp" = '' THEN 'missing_timestamp'
    WHEN event_type IS NULL OR event_type NOT IN {EVENT_TYPES_SQL}
      THEN 'invalid_event_type:' || COALESCE(event_type, 'None')
    WHEN device_type IS NULL OR device_type NOT IN {DEVICES_SQL}
      THEN 'invalid_device_type:' || COALESCE(device_type, 'None')
    WHEN price IS NOT NULL AND price <= 0 THEN 'invalid_price'
    WHEN quantity IS NOT NULL AND quantity < 1 THEN 'invalid_quantity'
    WHEN TRY_CAST(substr("timestamp", 1, 26) AS TIMESTAMP) IS NULL THEN 'unparseable_timestamp'
    WHEN country IS NULL OR trim(country) = '' THEN 'missing_country'
  END AS _rejection_reason
FROM raw_events r
"""

SILVER_SQL = """
SELECT event_id, user_id, session_id, lower(trim(event_type)) AS event_type,
  product_id, product_name, category,
  CASE WHEN price <> 0 THEN price END AS price,
  CAST(CASE WHEN quantity <> 0 THEN quantity END AS INTEGER) AS quantity,
  lower(trim(device_type)) AS device_type, upper(trim(country)) AS country,
  CASE WHEN rev <> 0 THEN rev END AS revenue,
  _event_ts AS event_timestamp,
  CAST(_event_ts AS DATE) AS event_date,
  CAST(hour(_event_ts) AS INTEGER) AS event_hour,
  CAST(year(_event_ts) AS INTEGER) AS event_year,
  CAST(month(_event_ts) AS INTEGER) AS event_month,
  CAST(day(_event_ts) AS INTEGER) AS event_day,
  COALESCE(schema_version, '1.0') AS schema_version
FROM (
  SELECT *,
    CASE WHEN event_type = 'purchase' AND revenue IS NULL
         THEN (CASE WHEN price <> 0 AND quantity <> 0
                    THEN CAST(ROUND(CAST(price AS DECIMAL(20,6)) * quantity, 2) AS DOUBLE) END)
         ELSE revenue END AS rev
  FROM tagged WHERE _rejection_reason IS NULL
) v
"""

_STAMP = """strftime(event_date, '%Y-%m-%d') AS report_date,
  CAST(year(event_date) AS INTEGER) AS report_year,
  CAST(month(event_date) AS INTEGER) AS report_month,
  CAST(day(event_date) AS INTEGER) AS report_day"""

_MONEY = "CAST(SUM(CAST({} AS DECIMAL(20,6))) AS DOUBLE)"


PURCHASE_REVENUE = "CASE WHEN event_type = 'purchase' THEN revenue END"


def _m(expr: str) -> str:
    return _MONEY.format(expr)


GOLD_REVENUE_SQL = f"""
SELECT event_hour, country, category,
  {R(f"COALESCE({_m('revenue')}, 0)", 2)} AS total_revenue,
  COUNT(event_id) AS total_orders,
  CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_units_sold,
  {R(DIV(_m('price'), 'COUNT(price)'), 2)} AS avg_order_value,
  COUNT(DISTINCT user_id) AS unique_buyers,
  {_STAMP}
FROM silver_events
WHERE event_type = 'purchase'
GROUP BY event_date, event_hour, country, category
"""

GOLD_PRODUCTS_SQL = f"""
SELECT product_id, product_name, category, {R('rev', 2)} AS revenue,
  purchase_count, cart_adds, product_views, unique_users,
  {R(DIV('purchase_count', 'GREATEST(cart_adds, 1)'), 4)} AS conversion_rate,
  CAST(revenue_rank AS INTEGER) AS revenue_rank,
  {_STAMP}
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_date
                               ORDER BY rev DESC, product_id, product_name, category) AS revenue_rank
  FROM (
    SELECT event_date, product_id, product_name, category,
      COALESCE({_m(PURCHASE_REVENUE)}, 0) AS rev,
      COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
      COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
      COUNT(*) FILTER (WHERE event_type = 'product_view') AS product_views,
      COUNT(DISTINCT user_id) AS unique_users
    FROM silver_events
    WHERE product_id IS NOT NULL AND product_name IS NOT NULL AND category IS NOT NULL
    GROUP BY event_date, product_id, product_name, category
  ) a
) b
WHERE revenue_rank <= 20
"""

GOLD_SEGMENTS_SQL = f"""
SELECT user_id, device_type, country, spend AS daily_spend, order_count, event_count, session_count,
  CASE WHEN spend > 500 THEN 'vip' WHEN spend > 100 THEN 'high_value' WHEN spend > 0 THEN 'buyer'
       WHEN event_count > 10 THEN 'engaged_browser' ELSE 'casual_browser' END AS user_segment,
  {_STAMP}
FROM (
  SELECT event_date, user_id, device_type, country,
    {R(f"COALESCE({_m(PURCHASE_REVENUE)}, 0)", 2)} AS spend,
    COUNT(*) FILTER (WHERE event_type = 'purchase') AS order_count,
    COUNT(*) AS event_count,
    COUNT(DISTINCT session_id) AS session_count
  FROM silver_events
  WHERE user_id IS NOT NULL AND device_type IS NOT NULL AND country IS NOT NULL
  GROUP BY event_date, user_id, device_type, country
) s
"""


def ctes() -> list[tuple[str, str]]:
    return [
        ("raw_events", RAW_EVENTS_SQL),
        ("tagged", TAGGED_SQL),
        ("silver_events", SILVER_SQL),
        ("gold_revenue_metrics", GOLD_REVENUE_SQL),
        ("gold_top_products", GOLD_PRODUCTS_SQL),
        ("gold_user_segments", GOLD_SEGMENTS_SQL),
    ] + EXTRA_CTES


EXTRA_CTES: list[tuple[str, str]] = []


def register_cte(name: str, sql: str) -> None:
    """Add (or replace) a named CTE; idempotent across re-imports."""
    for i, (existing, _) in enumerate(EXTRA_CTES):
        if existing == name:
            EXTRA_CTES[i] = (name, sql)
            return
    EXTRA_CTES.append((name, sql))


def with_ctes(sql: str) -> str:
    """Prefix a portable query (``@table`` refs) with the oracle CTE chain."""
    body = ",\n".join(f"{name} AS (\n{text}\n)" for name, text in ctes())
    return f"WITH {body}\n{for_duckdb(sql)}"
