"""Named analytics queries over the Gold and Silver tables (Q1-Q15, R1-R7,
X1-X2) as SQL text.

Each query reads the tables named ``@table`` (Gold/Silver/Bronze).  Spark runs
the text with the tables bound as DataFrames (``run_sql``), so Catalyst
plans it like any DataFrame code: top-k queries become
``TakeOrderedAndProject`` (per-task top k, then a k-row merge), and the
``OVER ()`` shares run on an already-aggregated frame of a few rows.

Compared with the original query text, money sums are exact, rounding is
half up, and every LIMIT has a total order (tie breakers appended), so the
result is the same on every run and every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .sqlkit import DIV, ISUM, MSUM, R, for_spark, tables_in

SEG = "@gold_user_segments"

QUERIES: dict[str, str] = {
    # -- products -------------------------------------------------------------
    "q01": f"""
SELECT revenue_rank, product_name, category, {R('revenue', 2)} AS revenue,
       purchase_count, cart_adds, product_views,
       {R('conversion_rate * 100', 2)} AS conversion_pct, unique_users
FROM @gold_top_products
ORDER BY revenue_rank ASC, report_date ASC, product_id ASC
LIMIT 10""",
    "q02": f"""
SELECT product_name, category, cart_adds, purchase_count,
       {R('conversion_rate * 100', 2)} AS conversion_pct, {R('revenue', 2)} AS revenue
FROM @gold_top_products
WHERE cart_adds > 0
ORDER BY conversion_rate DESC, report_date ASC, product_id ASC
LIMIT 10""",
    "q03": f"""
SELECT product_name, product_views, purchase_count,
       {R('conversion_rate * 100', 2)} AS conversion_pct, {R('revenue', 2)} AS revenue
FROM @gold_top_products
WHERE product_views > 10 AND conversion_rate < 0.1
ORDER BY product_views DESC, report_date ASC, product_id ASC
LIMIT 10""",
    # -- revenue --------------------------------------------------------------
    "q04": f"""
SELECT {MSUM('total_revenue')} AS total_revenue,
       {ISUM('total_orders')} AS total_orders,
       {ISUM('unique_buyers')} AS unique_buyers,
       {R(DIV(MSUM('total_revenue'), 'SUM(total_orders)'), 2)} AS avg_order_value
FROM @gold_revenue_metrics""",
    "q05": f"""
SELECT country,
       {R(MSUM('total_revenue'), 2)} AS total_revenue,
       {ISUM('total_orders')} AS total_orders,
       {ISUM('unique_buyers')} AS unique_buyers,
       {R(DIV(MSUM('total_revenue') + ' * 100.0', 'SUM(SUM(CAST(total_revenue AS DECIMAL(20,6)))) OVER ()'), 2)}
         AS revenue_share_pct
FROM @gold_revenue_metrics
GROUP BY country
ORDER BY total_revenue DESC, country ASC""",
    "q06": f"""
SELECT category,
       {R(MSUM('total_revenue'), 2)} AS total_revenue,
       {ISUM('total_orders')} AS total_orders,
       {R(DIV(MSUM('avg_order_value'), 'COUNT(avg_order_value)'), 2)} AS avg_order_value
FROM @gold_revenue_metrics
WHERE category IS NOT NULL
GROUP BY category
ORDER BY total_revenue DESC, category ASC""",
    "q07": f"""
SELECT event_hour,
       {R(MSUM('total_revenue'), 2)} AS revenue,
       {ISUM('total_orders')} AS orders,
       {ISUM('unique_buyers')} AS buyers
FROM @gold_revenue_metrics
GROUP BY event_hour
ORDER BY event_hour ASC""",
    "q08": f"""
SELECT country, category,
       {R(MSUM('total_revenue'), 2)} AS revenue,
       {ISUM('total_orders')} AS orders
FROM @gold_revenue_metrics
WHERE category IS NOT NULL
GROUP BY country, category
ORDER BY revenue DESC, country ASC, category ASC
LIMIT 20""",
    # -- users ----------------------------------------------------------------
    "q09": f"""
SELECT user_segment,
       COUNT(*) AS user_count,
       {R(DIV('COUNT(*) * 100.0', 'SUM(COUNT(*)) OVER ()'), 2)} AS pct_of_users,
       {R(DIV(MSUM('daily_spend'), 'COUNT(daily_spend)'), 2)} AS avg_spend,
       {ISUM('order_count')} AS total_orders,
       {R(DIV('SUM(event_count)', 'COUNT(event_count)'), 1)} AS avg_events
FROM {SEG}
GROUP BY user_segment
ORDER BY avg_spend DESC, user_segment ASC""",
    "q10": f"""
SELECT device_type,
       COUNT(DISTINCT user_id) AS users,
       {R(MSUM('daily_spend'), 2)} AS total_spend,
       {R(DIV(MSUM('daily_spend'), 'COUNT(daily_spend)'), 2)} AS avg_spend,
       {ISUM('order_count')} AS orders
FROM {SEG}
GROUP BY device_type
ORDER BY total_spend DESC, device_type ASC""",
    "q11": f"""
SELECT user_id, country, device_type, user_segment,
       {R('daily_spend', 2)} AS spend, order_count, event_count
FROM {SEG}
WHERE user_segment IN ('vip', 'high_value')
ORDER BY daily_spend DESC, user_id ASC, report_date ASC, device_type ASC, country ASC
LIMIT 20""",
    "q12": f"""
SELECT country,
       COUNT(DISTINCT user_id) AS users,
       {R(MSUM('daily_spend'), 2)} AS total_spend,
       COUNT_IF(user_segment IN ('buyer', 'high_value', 'vip')) AS buyers
FROM {SEG}
GROUP BY country
ORDER BY total_spend DESC, country ASC""",
    # -- silver ---------------------------------------------------------------
    "q13": f"""
SELECT event_type,
       COUNT(*) AS event_count,
       COUNT(DISTINCT user_id) AS unique_users,
       {R(DIV('COUNT(*) * 100.0', 'SUM(COUNT(*)) OVER ()'), 2)} AS pct_of_events
FROM @silver_events
GROUP BY event_type
ORDER BY event_count DESC, event_type ASC""",
    "q14": f"""
SELECT category,
       COUNT(*) AS purchase_events,
       {R(MSUM('revenue'), 2)} AS total_revenue,
       {R(DIV(MSUM('price'), 'COUNT(price)'), 2)} AS avg_price,
       {ISUM('quantity')} AS units_sold
FROM @silver_events
WHERE event_type = 'purchase' AND category IS NOT NULL
GROUP BY category
ORDER BY total_revenue DESC, category ASC""",
    "q15": """
SELECT COUNT(*) AS total_records,
       COUNT(*) - COUNT(event_id) AS null_event_ids,
       COUNT(*) - COUNT(user_id) AS null_user_ids,
       COUNT(*) - COUNT(event_type) AS null_event_types,
       CAST(COUNT_IF(event_type = 'purchase' AND revenue IS NULL) AS BIGINT) AS purchases_missing_revenue
FROM @silver_events""",
    # -- walkthrough queries ----------------------------------------------------
    "r01": """
SELECT product_name, category, revenue, purchase_count, conversion_rate
FROM @gold_top_products
ORDER BY revenue DESC, report_date ASC, product_id ASC
LIMIT 10""",
    "r02": f"""
SELECT product_name, category, {R('revenue', 2)} AS revenue, purchase_count,
       {R('conversion_rate * 100', 2)} AS conversion_pct
FROM @gold_top_products
ORDER BY revenue DESC, report_date ASC, product_id ASC
LIMIT 10""",
    "r03": f"""
SELECT country,
       {MSUM('total_revenue')} AS total_revenue,
       {ISUM('total_orders')} AS total_orders,
       {ISUM('unique_buyers')} AS unique_buyers,
       {R(DIV(MSUM('total_revenue'), 'SUM(total_orders)'), 2)} AS avg_order_value
FROM @gold_revenue_metrics
GROUP BY country
ORDER BY total_revenue DESC, country ASC""",
    "r05": f"""
SELECT user_segment,
       COUNT(*) AS user_count,
       {R(DIV(MSUM('daily_spend'), 'COUNT(daily_spend)'), 2)} AS avg_spend,
       {ISUM('order_count')} AS total_orders,
       {R(DIV('SUM(event_count)', 'COUNT(event_count)'), 1)} AS avg_events_per_user
FROM {SEG}
GROUP BY user_segment
ORDER BY avg_spend DESC, user_segment ASC""",
    "r06": """
SELECT event_type,
       COUNT(DISTINCT user_id) AS unique_users,
       COUNT(*) AS total_events
FROM @silver_events
GROUP BY event_type
ORDER BY unique_users DESC, event_type ASC""",
    "r07": """
SELECT COUNT(*) AS total_records,
       COUNT(*) - COUNT(event_id) AS null_event_ids,
       COUNT(*) - COUNT(user_id) AS null_user_ids,
       CAST(COUNT_IF(event_type = 'purchase' AND revenue IS NULL) AS BIGINT) AS purchases_missing_revenue
FROM @silver_events""",
    # -- runbook queries --------------------------------------------------------
    "x01": """
SELECT *
FROM @gold_dq_reports
ORDER BY run_date DESC
LIMIT 1""",
    "x02": """
SELECT raw_payload
FROM @bronze_events
ORDER BY raw_payload
LIMIT 10""",
}
# R4 (hourly heatmap) is the same query as Q7.
QUERIES["r04"] = QUERIES["q07"]

# -- dashboard feeds (P1-P5) ----------------------------------------------------
_PURCHASE = "is_valid AND event_type = 'purchase'"
QUERIES["p01"] = f"""
SELECT {R(MSUM(f"CASE WHEN {_PURCHASE} THEN revenue END"), 2)} AS total_revenue,
       COUNT(CASE WHEN {_PURCHASE} THEN 1 END) AS total_orders,
       COUNT(DISTINCT CASE WHEN {_PURCHASE} THEN user_id END) AS unique_buyers,
       COUNT(DISTINCT CASE WHEN is_valid THEN country END) AS countries,
       {R(DIV(MSUM(f"CASE WHEN {_PURCHASE} THEN revenue END"), f"COUNT(CASE WHEN {_PURCHASE} THEN 1 END)"), 2)}
         AS avg_order_value,
       {R(DIV(f"COUNT(CASE WHEN {_PURCHASE} THEN 1 END) * 100.0", "COUNT(CASE WHEN is_valid THEN 1 END)"), 1)}
         AS purchase_rate_pct,
       COUNT(CASE WHEN NOT is_valid THEN 1 END) AS rejected_rows,
       {R(DIV("COUNT(CASE WHEN is_valid THEN 1 END) * 100.0", "COUNT(*)"), 1)} AS dq_pass_pct
FROM (
  SELECT event_type, revenue, user_id, country, TRUE AS is_valid FROM @silver_events
  UNION ALL
  SELECT CAST(NULL AS STRING), CAST(NULL AS DOUBLE), CAST(NULL AS STRING), CAST(NULL AS STRING), FALSE
  FROM @rejected_events
) k"""
# Country -> region, fixed values of the dashboard.
REGIONS = {"Americas": ["US", "CA", "BR", "MX"], "Europe": ["GB", "DE", "FR"], "Asia-Pacific": ["AU", "JP", "IN"]}
_REGION_CASE = "CASE " + " ".join(
    f"WHEN country IN ({', '.join(repr(c) for c in cs)}) THEN '{r}'" for r, cs in REGIONS.items()) + " ELSE 'Other' END"
QUERIES["p02"] = f"""
SELECT region,
       {R(MSUM('total_revenue'), 2)} AS revenue,
       {ISUM('total_orders')} AS orders,
       COUNT(DISTINCT country) AS countries
FROM (SELECT {_REGION_CASE} AS region, country, total_revenue, total_orders FROM @gold_revenue_metrics) g
GROUP BY region
ORDER BY revenue DESC, region ASC"""
QUERIES["p03"] = f"""
SELECT event_hour, revenue,
       CASE WHEN revenue > 1000 THEN 'high' WHEN revenue > 600 THEN 'medium' ELSE 'low' END AS band
FROM (
  SELECT event_hour, {R(f"COALESCE({MSUM('total_revenue')}, 0)", 2)} AS revenue
  FROM (
    SELECT CAST(id AS INT) AS event_hour, CAST(NULL AS DOUBLE) AS total_revenue FROM @hours
    UNION ALL
    SELECT event_hour, total_revenue FROM @gold_revenue_metrics
  ) u
  GROUP BY event_hour
) h
ORDER BY event_hour"""
QUERIES["p04"] = f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY revenue DESC, report_date ASC, product_id ASC) AS INTEGER) AS position,
       product_name, category, revenue, orders, conversion_pct
FROM (
  SELECT product_id, report_date, product_name, category, {R('revenue', 2)} AS revenue,
         purchase_count AS orders, {R('conversion_rate * 100', 1)} AS conversion_pct
  FROM @gold_top_products
  ORDER BY revenue DESC, report_date ASC, product_id ASC
  LIMIT 8
) t"""
# Exact distinct buyers over Silver: the Gold tables sum per-group distinct
# counts (kept as published), which over-counts people across groups.
QUERIES["exact_buyers"] = """
SELECT COUNT(DISTINCT user_id) AS exact_buyers,
       COUNT(*) AS purchases
FROM @silver_events
WHERE event_type = 'purchase'"""
# P5 (funnel: users per event type) is R6.
QUERIES["p05"] = QUERIES["r06"]

DESCRIPTIONS = {
    "q01": "top 10 products by rank", "q02": "best converting products", "q03": "many views, low conversion",
    "q04": "total revenue summary", "q05": "revenue by country with share", "q06": "revenue by category",
    "q07": "hourly revenue", "q08": "country x category revenue", "q09": "user segment distribution",
    "q10": "users by device", "q11": "vip and high value users", "q12": "users by country",
    "q13": "event type distribution", "q14": "category revenue from Silver purchases", "q15": "null counts",
    "r01": "product list by revenue", "r02": "top products with conversion %", "r03": "country with AOV",
    "r04": "hourly heatmap", "r05": "segments without share", "r06": "funnel by unique users",
    "r07": "data quality check", "x01": "latest DQ report", "x02": "sample raw Bronze payloads",
    "p01": "KPI tiles", "p02": "revenue by region", "p03": "hourly revenue bands (24 hours)",
    "p04": "product leaderboard (8)", "p05": "purchase funnel",
    "exact_buyers": "exact distinct buyers over Silver purchases",
}


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run portable query text with ``@name`` bound to ``tables[name]``."""
    needed = tables_in(sql)
    missing = [t for t in needed if t not in tables]
    if missing:
        raise KeyError(f"query needs tables {missing}")
    return spark.sql(for_spark(sql), **{t: tables[t] for t in needed})


def run_query(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Run a named analytics query over the given Gold/Silver frames."""
    return run_sql(spark, QUERIES[name], tables)
