"""DuckDB oracle text for the cohort variants, hourly-window metrics and the
quality operators (independent SQL over the oracle CTE chain)."""

from __future__ import annotations

from ..operators.monitoring import DEFAULT_RULES, PROGRESS_RULES
from ..operators.quality import GOLD_SALES_SUITE, SILVER_SUITE
from .oracle import _STAMP, PURCHASE_REVENUE, register_cte
from .sqlkit import DIV, MSUM, R

PURCHASE_OR_ZERO = "CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END"

DAILY_REVENUE_EXACT = f"""
SELECT event_hour, country, category,
  {MSUM('revenue')} AS hourly_revenue,
  COUNT(event_id) AS order_count,
  COUNT(DISTINCT user_id) AS unique_customers,
  {DIV(MSUM('price'), 'COUNT(price)')} AS avg_price,
  {_STAMP}
FROM silver_events WHERE event_type = 'purchase'
GROUP BY event_date, event_hour, country, category
"""

TOP_PRODUCTS_COHORT_EXACT = f"""
SELECT product_id, product_name, category, CAST(rev AS DOUBLE) AS daily_revenue,
  purchase_count, cart_add_count, view_count, unique_users,
  {R(DIV('purchase_count', 'GREATEST(cart_add_count, 1)'), 4)} AS conversion_rate,
  CAST(revenue_rank AS INTEGER) AS revenue_rank, {_STAMP}
FROM (
  SELECT *, RANK() OVER (PARTITION BY event_date ORDER BY rev DESC) AS revenue_rank
  FROM (
    SELECT event_date, product_id, product_name, category,
      SUM(CAST({PURCHASE_OR_ZERO} AS DECIMAL(20,6))) AS rev,
      COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase_count,
      COUNT(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN event_id END) AS cart_add_count,
      COUNT(DISTINCT CASE WHEN event_type = 'product_view' THEN event_id END) AS view_count,
      COUNT(DISTINCT user_id) AS unique_users
    FROM silver_events WHERE product_id IS NOT NULL
    GROUP BY event_date, product_id, product_name, category
  ) a
) b
WHERE revenue_rank <= 50
"""

USER_COHORTS = f"""
SELECT user_id, country, device_type, event_count, spend AS daily_spend, event_types, session_count,
  CASE WHEN spend > 200 THEN 'high_value' WHEN spend > 0 THEN 'buyer'
       WHEN event_count > 10 THEN 'engaged_browser' ELSE 'casual_browser' END AS user_segment,
  {_STAMP}
FROM (
  SELECT event_date, user_id, country, device_type,
    COUNT(event_id) AS event_count,
    CAST(SUM(CAST({PURCHASE_OR_ZERO} AS DECIMAL(20,6))) AS DOUBLE) AS spend,
    array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types,
    COUNT(DISTINCT session_id) AS session_count
  FROM silver_events
  GROUP BY event_date, user_id, country, device_type
) u
"""

ROLLING_7D = f"""
SELECT country, category, day, CAST(day_rev AS DOUBLE) AS day_revenue,
  {R(DIV('SUM(day_rev) OVER w', 'COUNT(day_rev) OVER w'), 2)} AS rolling_7d_avg,
  COUNT(day_rev) OVER w AS days_in_window
FROM (
  SELECT country, category, event_date AS day, SUM(CAST(hourly AS DECIMAL(20,6))) AS day_rev
  FROM (
    SELECT event_date, event_hour, country, category, {MSUM('revenue')} AS hourly
    FROM silver_events WHERE event_type = 'purchase'
    GROUP BY event_date, event_hour, country, category
  ) h
  GROUP BY country, category, event_date
) d
WINDOW w AS (PARTITION BY country, category ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
"""

SALES_METRICS_EXACT = f"""
SELECT date_trunc('hour', event_timestamp) AS window_start,
  date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end,
  country, category,
  {R(MSUM('revenue'), 2)} AS total_revenue,
  COUNT(event_id) AS total_orders,
  CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
  {R(DIV(MSUM('price'), 'COUNT(price)'), 2)} AS avg_order_value,
  COUNT(DISTINCT user_id) AS unique_buyers
FROM silver_events WHERE event_type = 'purchase'
GROUP BY date_trunc('hour', event_timestamp), country, category
"""

PRODUCT_METRICS_EXACT = f"""
SELECT date_trunc('hour', event_timestamp) AS window_start, product_id, product_name, category,
  {R(MSUM(PURCHASE_OR_ZERO), 2)} AS revenue,
  COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
  COUNT(*) FILTER (WHERE event_type = 'add_to_cart') AS cart_adds,
  COUNT(*) FILTER (WHERE event_type = 'product_view') AS product_views,
  COUNT(DISTINCT user_id) AS unique_users,
  {R(DIV("COUNT(*) FILTER (WHERE event_type = 'purchase')", "COUNT(*) FILTER (WHERE event_type = 'add_to_cart')"), 4)}
    AS conversion_rate
FROM silver_events WHERE product_id IS NOT NULL
GROUP BY date_trunc('hour', event_timestamp), product_id, product_name, category
"""

USER_METRICS = f"""
SELECT date_trunc('hour', event_timestamp) AS window_start, user_id, device_type, country,
  COUNT(event_id) AS total_events,
  {R(MSUM(PURCHASE_OR_ZERO), 2)} AS total_spend,
  array_to_string(list_sort(list(DISTINCT event_type)), ',') AS event_types_seen,
  max(event_timestamp) AS last_seen
FROM silver_events
GROUP BY date_trunc('hour', event_timestamp), user_id, device_type, country
"""

DQ_REPORT = f"""
SELECT strftime(event_date, '%Y-%m-%d') AS run_date,
  COUNT(*) AS total_records,
  {R(DIV('COUNT(*) FILTER (WHERE event_id IS NULL) * 100.0', 'COUNT(*)'), 3)} AS null_event_id_pct,
  {R(DIV('COUNT(*) FILTER (WHERE user_id IS NULL) * 100.0', 'COUNT(*)'), 3)} AS null_user_id_pct,
  {R(DIV('COUNT(*) FILTER (WHERE event_timestamp IS NULL) * 100.0', 'COUNT(*)'), 3)} AS null_timestamp_pct,
  COUNT(*) - (COUNT(DISTINCT event_id) + MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END)) AS duplicate_event_ids,
  COUNT(*) FILTER (WHERE price IS NOT NULL AND price <= 0) AS invalid_price_count,
  COUNT(*) FILTER (WHERE event_type = 'purchase' AND revenue IS NULL) AS purchases_missing_revenue,
  CASE WHEN COUNT(*) FILTER (WHERE event_id IS NULL) = 0 AND COUNT(*) FILTER (WHERE user_id IS NULL) = 0
        AND COUNT(*) - (COUNT(DISTINCT event_id) + MAX(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END)) = 0
        AND COUNT(*) FILTER (WHERE price IS NOT NULL AND price <= 0) = 0
       THEN 'PASS' ELSE 'WARN' END AS status
FROM silver_events
GROUP BY event_date
"""

DQ_GATE = """
SELECT run_date, total_records,
  concat_ws('; ',
    CASE WHEN null_event_id_pct > 0.5 THEN 'null_event_id_pct=' || CAST(null_event_id_pct AS VARCHAR) END,
    CASE WHEN duplicate_event_ids > 0 THEN 'duplicate_ids=' || CAST(duplicate_event_ids AS VARCHAR) END,
    CASE WHEN status = 'NO_DATA' THEN 'NO_DATA' END) AS issues
FROM gold_dq_reports
WHERE null_event_id_pct > 0.5 OR duplicate_event_ids > 0 OR status = 'NO_DATA'
"""


def _sql_list(values) -> str:
    return "(" + ", ".join("'" + v + "'" for v in values) + ")"


def suite_results_sql(suite: dict, table: str, day_col: str | None, columns: list[str]) -> str:
    """Per-expectation results of a suite, written as plain SQL."""
    day = f"strftime({day_col}, '%Y-%m-%d')" if day_col else "CAST(NULL AS VARCHAR)"
    group = f"GROUP BY {day_col}" if day_col else ""
    parts = []
    for i, (etype, kw) in enumerate(suite["expectations"]):
        col = kw.get("column")
        mostly = float(kw.get("mostly", 1.0))
        col_sql = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        if etype == "expect_column_to_exist":
            ev, un = "1", ("0" if col in columns else "1")
            src = f"SELECT {day} AS run_date, CAST({ev} AS BIGINT) AS e, CAST({un} AS BIGINT) AS u FROM {table} {group}"
        elif etype == "expect_table_row_count_to_be_between":
            cond = " OR ".join(
                ([f"COUNT(*) < {kw['min_value']}"] if kw.get("min_value") is not None else [])
                + ([f"COUNT(*) > {kw['max_value']}"] if kw.get("max_value") is not None else [])) or "FALSE"
            src = (f"SELECT {day} AS run_date, COUNT(*) AS e, CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS BIGINT) AS u "
                   f"FROM {table} {group}")
        elif etype == "expect_column_values_to_be_unique":
            inner_day = f"{day_col}, " if day_col else ""
            outer_day = f"strftime({day_col}, '%Y-%m-%d')" if day_col else "CAST(NULL AS VARCHAR)"
            src = (f"SELECT {outer_day} AS run_date, CAST(SUM(n) AS BIGINT) AS e, "
                   f"CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS u FROM ("
                   f"SELECT {inner_day}{col}, COUNT(*) AS n FROM {table} WHERE {col} IS NOT NULL "
                   f"GROUP BY {inner_day}{col}) g {group}")
        else:
            if etype == "expect_column_values_to_not_be_null":
                ev, bad = "COUNT(*)", f"{col} IS NULL"
            elif etype == "expect_column_values_to_be_in_set":
                ev, bad = f"COUNT({col})", f"{col} IS NOT NULL AND {col} NOT IN {_sql_list(kw['value_set'])}"
            elif etype == "expect_column_values_to_be_between":
                conds = ([f"{col} < {kw['min_value']}"] if kw.get("min_value") is not None else []) + \
                        ([f"{col} > {kw['max_value']}"] if kw.get("max_value") is not None else [])
                ev, bad = f"COUNT({col})", f"{col} IS NOT NULL AND ({' OR '.join(conds)})"
            elif etype == "expect_column_value_lengths_to_equal":
                ev, bad = f"COUNT({col})", f"{col} IS NOT NULL AND length({col}) <> {kw['value']}"
            else:
                raise ValueError(etype)
            src = (f"SELECT {day} AS run_date, COUNT(*) AS e0, {ev} AS e, "
                   f"COUNT(*) FILTER (WHERE {bad}) AS u FROM {table} {group}")
        parts.append(
            f"SELECT '{suite['suite_name']}' AS suite, run_date, CAST({i} AS INTEGER) AS expectation_index, "
            f"'{etype}' AS expectation_type, {col_sql} AS \"column\", CAST(e AS BIGINT) AS element_count, "
            f"CAST(u AS BIGINT) AS unexpected_count, "
            f"(e = 0 OR CAST(e - u AS DOUBLE) >= {mostly} * CAST(e AS DOUBLE)) AS success FROM ({src}) s{i}")
    return "\nUNION ALL\n".join(parts)


SILVER_COLUMNS = ["event_id", "user_id", "session_id", "event_type", "product_id", "product_name", "category",
                  "price", "quantity", "device_type", "country", "revenue", "event_timestamp", "event_date",
                  "event_hour", "event_year", "event_month", "event_day", "schema_version", "processed_at"]
SALES_COLUMNS = ["window_start", "window_end", "country", "category", "total_revenue", "total_orders",
                 "total_units_sold", "avg_order_value", "unique_buyers", "updated_at"]

SILVER_SUITE_SQL = suite_results_sql(SILVER_SUITE, "silver_events", "event_date", SILVER_COLUMNS)
SILVER_SUITE_WHOLE_SQL = suite_results_sql(SILVER_SUITE, "silver_events", None, SILVER_COLUMNS)
GOLD_SUITE_SQL = suite_results_sql(GOLD_SALES_SUITE, "gold_sales_metrics", None, SALES_COLUMNS)


def summary_sql(results_cte: str) -> str:
    return f"""
SELECT suite, run_date, bool_and(success) AS passed, COUNT(*) AS evaluated,
  COUNT(*) FILTER (WHERE NOT success) AS failed,
  COALESCE(array_to_string(list_sort(list(CASE WHEN NOT success
       THEN expectation_type || ':' || COALESCE("column", '') END)), ';'), '') AS failed_expectations,
  {R(DIV('(COUNT(*) - COUNT(*) FILTER (WHERE NOT success)) * 100.0', 'GREATEST(COUNT(*), 1)'), 1)} AS success_pct
FROM {results_cte}
GROUP BY suite, run_date
"""


__all__ = ["DAILY_REVENUE_EXACT", "TOP_PRODUCTS_COHORT_EXACT", "USER_COHORTS", "ROLLING_7D",
           "SALES_METRICS_EXACT", "PRODUCT_METRICS_EXACT", "USER_METRICS", "DQ_REPORT", "DQ_GATE",
           "SILVER_SUITE_SQL", "GOLD_SUITE_SQL", "summary_sql", "PURCHASE_REVENUE"]


register_cte("gold_sales_metrics", SALES_METRICS_EXACT)
register_cte("gold_dq_reports", DQ_REPORT)
register_cte("silver_suite_results", SILVER_SUITE_SQL)
register_cte("gold_suite_results", GOLD_SUITE_SQL)

register_cte("rejected_events", "SELECT * FROM tagged WHERE _rejection_reason IS NOT NULL")
register_cte("hours", "SELECT CAST(range AS BIGINT) AS id FROM range(24)")

FRESHNESS_NOW = "2024-01-31 00:00:00"
LAYER_FRESHNESS = f"""
SELECT max(event_timestamp) AS last_write,
  CAST(floor(epoch_us(TIMESTAMP '{FRESHNESS_NOW}') / 1000000) AS BIGINT)
    - CAST(floor(epoch_us(max(event_timestamp)) / 1000000) AS BIGINT) AS age_seconds,
  (CAST(floor(epoch_us(TIMESTAMP '{FRESHNESS_NOW}') / 1000000) AS BIGINT)
    - CAST(floor(epoch_us(max(event_timestamp)) / 1000000) AS BIGINT)) > 300 AS breached
FROM silver_events
"""

_ONLY_TS = "FROM tagged WHERE _event_ts IS NOT NULL"
EVENT_METRICS = f"""
SELECT 'RecordsRead' AS metric, _event_ts AS ts, CAST(1.0 AS DOUBLE) AS value {_ONLY_TS}
UNION ALL
SELECT 'NullEventId', _event_ts,
  CAST(CASE WHEN event_id IS NULL OR event_id = '' THEN 100.0 ELSE 0.0 END AS DOUBLE) {_ONLY_TS}
UNION ALL
SELECT 'RejectedRecord', _event_ts,
  CAST(CASE WHEN _rejection_reason IS NOT NULL THEN 1.0 ELSE 0.0 END AS DOUBLE) {_ONLY_TS}
UNION ALL
SELECT 'PurchaseRevenue', _event_ts, revenue {_ONLY_TS}
  AND _rejection_reason IS NULL AND event_type = 'purchase' AND revenue IS NOT NULL
"""


def _rules(rules) -> str:
    return "SELECT * FROM (VALUES " + ", ".join(
        f"('{a}', '{m}', '{st}', CAST({p} AS BIGINT), CAST({t} AS DOUBLE), '{c}', CAST({n} AS INTEGER))"
        for a, m, st, p, t, c, n in rules) + \
        ") r(alarm_name, metric, statistic, period_seconds, threshold, comparison, evaluation_periods)"


ALARM_RULES = _rules(DEFAULT_RULES)
ALARM_PERIODS = """
SELECT *, CASE WHEN comparison = '>=' THEN statistic_value >= threshold
               ELSE statistic_value > threshold END AS breached
FROM (
  SELECT alarm_name, statistic, period_seconds, threshold, comparison, evaluation_periods, period_idx,
    CASE statistic WHEN 'avg' THEN CAST(s AS DOUBLE) / CAST(n AS DOUBLE) WHEN 'max' THEN mx
                   WHEN 'sum' THEN CAST(s AS DOUBLE) ELSE CAST(n AS DOUBLE) END AS statistic_value
  FROM (
    SELECT alarm_name, statistic, period_seconds, threshold, comparison, evaluation_periods,
      CAST(floor(epoch_us(ts) / (period_seconds * 1000000.0)) AS BIGINT) AS period_idx,
      SUM(CAST(value AS DECIMAL(20,6))) AS s, MAX(value) AS mx, COUNT(value) AS n
    FROM event_metrics JOIN alarm_rules USING (metric)
    GROUP BY ALL
  ) a
) b
"""
THRESHOLD_ALARM = """
SELECT alarm_name, make_timestamp(period_idx * period_seconds * 1000000) AS period_start,
  statistic_value, breached,
  (CASE WHEN breached THEN ROW_NUMBER() OVER (PARTITION BY alarm_name, island, breached ORDER BY period_idx)
        ELSE 0 END) >= evaluation_periods AS in_alarm
FROM (
  SELECT *, period_idx - SUM(CAST(breached AS BIGINT)) OVER (
      PARTITION BY alarm_name ORDER BY period_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM alarm_periods
) i
"""
register_cte("event_metrics", EVENT_METRICS)
register_cte("alarm_rules", ALARM_RULES)
register_cte("alarm_periods", ALARM_PERIODS)

# One update per minute of events: its rows are the minute's purchases, its time follows all its events.
PROGRESS = """
SELECT make_timestamp((minute + 1) * 60000000) AS ts, purchases, newest, events * 45000 AS duration_ms,
  LAST_VALUE(CASE WHEN purchases > 0 THEN minute END IGNORE NULLS) OVER (
    ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS written, minute
FROM (
  SELECT epoch_us(event_timestamp) // 60000000 AS minute, COUNT(*) AS events,
    COUNT(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    MAX(epoch_us(event_timestamp)) FILTER (WHERE event_type = 'purchase') AS newest
  FROM silver_events GROUP BY 1
) m
"""
PROGRESS_SERIES = """
SELECT 'BatchProcessingTimeMs' AS metric, ts, CAST(duration_ms AS DOUBLE) AS value FROM progress
UNION ALL SELECT 'ConsumerLagMs', ts, (epoch_us(ts) - newest) / 1000.0 FROM progress WHERE newest IS NOT NULL
UNION ALL SELECT 'LastWriteAgeSeconds', ts, (minute - written) * 60.0 FROM progress WHERE written IS NOT NULL
"""
register_cte("progress", PROGRESS)
register_cte("progress_series", PROGRESS_SERIES)
register_cte("progress_rules", _rules(PROGRESS_RULES))
register_cte("progress_periods", ALARM_PERIODS.replace("event_metrics", "progress_series").replace("alarm_rules", "progress_rules"))
PROGRESS_ALARM = THRESHOLD_ALARM.replace("alarm_periods", "progress_periods")
DISTINCT_BUYERS = """
SELECT CAST(event_date AS VARCHAR) AS report_date, country, COUNT(DISTINCT user_id) AS exact_buyers, TRUE AS within_bound
FROM silver_events WHERE event_type = 'purchase' GROUP BY event_date, country
"""


# -- streams (availableNow): only windows closed by the final watermark -------
# The watermark follows the newest event time among the rows each query
# aggregates (Catalyst pushes the query's filter below the watermark).
def _closed(filter_sql: str) -> str:
    return (f"date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <= "
            f"(SELECT max(event_timestamp) FROM silver_events WHERE {filter_sql}) - INTERVAL 10 MINUTE")


STREAM_SALES = f"""
SELECT window_start, window_end, country, category, total_revenue, total_orders, total_units_sold, avg_order_value
FROM ({SALES_METRICS_EXACT}) s
WHERE window_end <= (SELECT max(event_timestamp) FROM silver_events WHERE event_type = 'purchase')
                    - INTERVAL 10 MINUTE
"""
STREAM_PRODUCTS = f"""
SELECT window_start, product_id, product_name, category, revenue, purchase_count, cart_adds, product_views,
  conversion_rate
FROM ({PRODUCT_METRICS_EXACT}) s
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(event_timestamp) FROM silver_events
                                         WHERE product_id IS NOT NULL) - INTERVAL 10 MINUTE
"""
STREAM_USERS = f"""
SELECT * FROM ({USER_METRICS}) s
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(event_timestamp) FROM silver_events) - INTERVAL 10 MINUTE
"""

MEDALLION_COUNTS = """
SELECT 'silver_events' AS "table", COUNT(*) AS row_count FROM silver_events
UNION ALL SELECT 'gold_revenue_metrics', COUNT(*) FROM gold_revenue_metrics
UNION ALL SELECT 'gold_top_products', COUNT(*) FROM gold_top_products
UNION ALL SELECT 'gold_user_segments', COUNT(*) FROM gold_user_segments
UNION ALL SELECT 'read', COUNT(*) FROM tagged
UNION ALL SELECT 'valid', COUNT(*) FROM tagged WHERE _rejection_reason IS NULL
UNION ALL SELECT 'rejected', COUNT(*) FROM tagged WHERE _rejection_reason IS NOT NULL
"""
SILVER_PARTITION_LIST = """
SELECT DISTINCT 'event_year=' || event_year || '/event_month=' || event_month || '/event_day=' || event_day
  AS "partition"
FROM silver_events
"""
SEGMENTS_ONE_DAY = "SELECT * FROM gold_user_segments WHERE report_date = '2024-01-15'"
_DEDUP_ORDER = ("event_timestamp, user_id, session_id, event_type, product_id, product_name, category, "
                "price, quantity, device_type, country, revenue, schema_version")
DEDUP_EVENTS = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY
    {", ".join(c.strip() + " ASC NULLS FIRST" for c in _DEDUP_ORDER.split(","))}) AS rn
  FROM silver_events
) d WHERE rn = 1
"""

FLAG_VALID = """
SELECT * FROM raw_events
WHERE COALESCE(event_type IN ('page_view', 'product_view', 'add_to_cart', 'purchase', 'search', 'wishlist_add'), FALSE)
  AND COALESCE(device_type IN ('mobile', 'desktop', 'tablet'), FALSE)
  AND event_id IS NOT NULL AND "timestamp" IS NOT NULL AND user_id IS NOT NULL
  AND (price IS NULL OR price > 0)
  AND (quantity IS NULL OR quantity > 0)
"""
