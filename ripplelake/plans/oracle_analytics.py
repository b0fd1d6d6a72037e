"""DuckDB SQL of the analytics queries, for verification only.

Written from the questions that the queries answer, with DuckDB's own means
(``FILTER``, ``QUALIFY``, subqueries): no text is shared with the Spark
library.  Money is added up in whole millionths; results are rounded half up
from six decimals.
"""

from __future__ import annotations


def _money(x: str, where: str = "") -> str:
    only = f" FILTER (WHERE {where})" if where else ""
    return f"(CAST(SUM(CAST(ROUND({x} * 1000000) AS HUGEINT)){only} AS DOUBLE) / 1000000)"


def _half_up(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def _total(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def _first(n: int, order: str) -> str:
    return f"QUALIFY row_number() OVER (ORDER BY {order}) <= {n}"


_REVENUE, _PRODUCTS, _USERS = "gold_revenue_metrics", "gold_top_products", "gold_user_segments"
_PCT = _half_up("conversion_rate * 100", 2)
_BY_REVENUE = "revenue DESC, report_date, product_id"
_SALES = "event_type = 'purchase'"
_FUNNEL = "SELECT event_type, COUNT(DISTINCT user_id) AS unique_users, COUNT(*) AS total_events FROM silver_events GROUP BY ALL"
_HOURLY = f"""
SELECT event_hour, {_half_up(_money('total_revenue'), 2)} AS revenue, {_total('total_orders')} AS orders,
       {_total('unique_buyers')} AS buyers
FROM {_REVENUE} GROUP BY event_hour"""
_MISSING = f"""COUNT(*) AS total_records,
       COUNT(*) FILTER (event_id IS NULL) AS null_event_ids,
       COUNT(*) FILTER (user_id IS NULL) AS null_user_ids,
       COUNT(*) FILTER ({_SALES} AND revenue IS NULL) AS purchases_missing_revenue"""

ORACLES: dict[str, str] = {
    "q01": f"""
SELECT revenue_rank, product_name, category, {_half_up('revenue', 2)} AS revenue, purchase_count, cart_adds,
       product_views, {_PCT} AS conversion_pct, unique_users
FROM {_PRODUCTS} {_first(10, 'revenue_rank, report_date, product_id')}""",
    "q02": f"""
SELECT product_name, category, cart_adds, purchase_count, {_PCT} AS conversion_pct, {_half_up('revenue', 2)} AS revenue
FROM {_PRODUCTS} WHERE cart_adds >= 1 {_first(10, 'conversion_rate DESC, report_date, product_id')}""",
    "q03": f"""
SELECT product_name, product_views, purchase_count, {_PCT} AS conversion_pct, {_half_up('revenue', 2)} AS revenue
FROM {_PRODUCTS} WHERE product_views >= 11 AND NOT conversion_rate >= 0.1
{_first(10, 'product_views DESC, report_date, product_id')}""",
    "q04": f"""
SELECT {_money('total_revenue')} AS total_revenue, {_total('total_orders')} AS total_orders,
       {_total('unique_buyers')} AS unique_buyers,
       {_half_up(f"{_money('total_revenue')} / NULLIF(SUM(total_orders), 0)::DOUBLE", 2)} AS avg_order_value
FROM {_REVENUE}""",
    "q05": f"""
SELECT country, {_half_up('spent', 2)} AS total_revenue, orders AS total_orders, buyers AS unique_buyers,
       {_half_up(f"spent * 100 / NULLIF((SELECT {_money('total_revenue')} FROM {_REVENUE}), 0)", 2)} AS revenue_share_pct
FROM (SELECT country, {_money('total_revenue')} AS spent, {_total('total_orders')} AS orders,
             {_total('unique_buyers')} AS buyers FROM {_REVENUE} GROUP BY country) c""",
    "q06": f"""
SELECT category, {_half_up(_money('total_revenue'), 2)} AS total_revenue, {_total('total_orders')} AS total_orders,
       {_half_up(f"{_money('avg_order_value')} / NULLIF(COUNT(avg_order_value), 0)", 2)} AS avg_order_value
FROM {_REVENUE} GROUP BY category HAVING category IS NOT NULL""",
    "q07": _HOURLY,
    "q08": f"""
SELECT * FROM (
  SELECT country, category, {_half_up(_money('total_revenue'), 2)} AS revenue, {_total('total_orders')} AS orders
  FROM {_REVENUE} GROUP BY country, category HAVING category IS NOT NULL) c
{_first(20, 'revenue DESC, country, category')}""",
    "q09": f"""
SELECT user_segment, COUNT(*) AS user_count,
       {_half_up(f"COUNT(*) * 100 / (SELECT COUNT(*) FROM {_USERS})::DOUBLE", 2)} AS pct_of_users,
       {_half_up(f"{_money('daily_spend')} / NULLIF(COUNT(daily_spend), 0)", 2)} AS avg_spend,
       {_total('order_count')} AS total_orders, {_half_up('AVG(event_count)', 1)} AS avg_events
FROM {_USERS} GROUP BY user_segment""",
    "q10": f"""
SELECT device_type, COUNT(DISTINCT user_id) AS users, {_half_up(_money('daily_spend'), 2)} AS total_spend,
       {_half_up(f"{_money('daily_spend')} / NULLIF(COUNT(daily_spend), 0)", 2)} AS avg_spend,
       {_total('order_count')} AS orders
FROM {_USERS} GROUP BY device_type""",
    "q11": f"""
SELECT user_id, country, device_type, user_segment, {_half_up('daily_spend', 2)} AS spend, order_count, event_count
FROM {_USERS} WHERE user_segment = 'vip' OR user_segment = 'high_value'
{_first(20, 'daily_spend DESC, user_id, report_date, device_type, country')}""",
    "q12": f"""
SELECT country, COUNT(DISTINCT user_id) AS users, {_half_up(_money('daily_spend'), 2)} AS total_spend,
       COUNT(*) FILTER (user_segment NOT IN ('engaged_browser', 'casual_browser')) AS buyers
FROM {_USERS} GROUP BY country""",
    "q13": f"""
SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_id) AS unique_users,
       {_half_up("COUNT(*) * 100 / (SELECT COUNT(*) FROM silver_events)::DOUBLE", 2)} AS pct_of_events
FROM silver_events GROUP BY event_type""",
    "q14": f"""
SELECT category, COUNT(*) FILTER ({_SALES}) AS purchase_events,
       {_half_up(_money('revenue', _SALES), 2)} AS total_revenue,
       {_half_up(f"{_money('price', _SALES)} / NULLIF(COUNT(price) FILTER ({_SALES}), 0)", 2)} AS avg_price,
       CAST(SUM(quantity) FILTER ({_SALES}) AS BIGINT) AS units_sold
FROM silver_events GROUP BY category HAVING category IS NOT NULL AND COUNT(*) FILTER ({_SALES}) > 0""",
    "q15": f"SELECT {_MISSING}, COUNT(*) FILTER (event_type IS NULL) AS null_event_types FROM silver_events",
    "r01": f"""
SELECT product_name, category, revenue, purchase_count, conversion_rate FROM {_PRODUCTS} {_first(10, _BY_REVENUE)}""",
    "r02": f"""
SELECT product_name, category, {_half_up('p.revenue', 2)} AS revenue, purchase_count, {_PCT} AS conversion_pct
FROM {_PRODUCTS} p {_first(10, 'p.' + _BY_REVENUE)}""",
    "r03": f"""
SELECT country, {_money('total_revenue')} AS total_revenue, {_total('total_orders')} AS total_orders,
       {_total('unique_buyers')} AS unique_buyers,
       {_half_up(f"{_money('total_revenue')} / NULLIF(SUM(total_orders), 0)::DOUBLE", 2)} AS avg_order_value
FROM {_REVENUE} GROUP BY country""",
    "r04": _HOURLY,
    "r05": f"""
SELECT user_segment, COUNT(*) AS user_count,
       {_half_up(f"{_money('daily_spend')} / NULLIF(COUNT(daily_spend), 0)", 2)} AS avg_spend,
       {_total('order_count')} AS total_orders, {_half_up('AVG(event_count)', 1)} AS avg_events_per_user
FROM {_USERS} GROUP BY user_segment""",
    "r06": _FUNNEL,
    "r07": f"SELECT {_MISSING} FROM silver_events",
    "x01": "SELECT * FROM gold_dq_reports WHERE run_date = (SELECT MAX(run_date) FROM gold_dq_reports)",
    "p01": f"""
SELECT {_half_up('spent', 2)} AS total_revenue, orders AS total_orders, buyers AS unique_buyers, countries,
       {_half_up('spent / NULLIF(orders, 0)', 2)} AS avg_order_value,
       {_half_up('orders * 100 / NULLIF(good, 0)::DOUBLE', 1)} AS purchase_rate_pct,
       bad AS rejected_rows, {_half_up('good * 100 / NULLIF(good + bad, 0)::DOUBLE', 1)} AS dq_pass_pct
FROM (SELECT {_money('revenue', _SALES)} AS spent, COUNT(*) FILTER ({_SALES}) AS orders,
             COUNT(DISTINCT user_id) FILTER ({_SALES}) AS buyers, COUNT(DISTINCT country) AS countries,
             COUNT(*) AS good FROM silver_events) s,
     (SELECT COUNT(*) AS bad FROM tagged WHERE _rejection_reason IS NOT NULL) r""",
    "p02": f"""
SELECT COALESCE(region, 'Other') AS region, {_half_up(_money('total_revenue'), 2)} AS revenue,
       {_total('total_orders')} AS orders, COUNT(DISTINCT g.country) AS countries
FROM {_REVENUE} g LEFT JOIN (
  VALUES ('US', 'Americas'), ('CA', 'Americas'), ('BR', 'Americas'), ('MX', 'Americas'), ('GB', 'Europe'),
         ('DE', 'Europe'), ('FR', 'Europe'), ('AU', 'Asia-Pacific'), ('JP', 'Asia-Pacific'), ('IN', 'Asia-Pacific')
) v(code, region) ON g.country = code
GROUP BY COALESCE(region, 'Other')""",
    "p03": f"""
SELECT event_hour, revenue, if(revenue > 1000, 'high', if(revenue > 600, 'medium', 'low')) AS band
FROM (SELECT CAST(h.range AS INTEGER) AS event_hour, {_half_up(f"COALESCE({_money('total_revenue')}, 0)", 2)} AS revenue
      FROM range(24) h LEFT JOIN {_REVENUE} g ON g.event_hour = h.range GROUP BY h.range) t""",
    "p04": f"""
SELECT CAST(row_number() OVER (ORDER BY p.{_BY_REVENUE}) AS INTEGER) AS position, product_name, category,
       {_half_up('p.revenue', 2)} AS revenue, purchase_count AS orders,
       {_half_up('conversion_rate * 100', 1)} AS conversion_pct
FROM {_PRODUCTS} p QUALIFY position <= 8""",
    "p05": _FUNNEL,
    "exact_buyers": f"""
SELECT COUNT(*) AS exact_buyers, CAST(SUM(n) AS BIGINT) AS purchases
FROM (SELECT user_id, COUNT(*) AS n FROM silver_events WHERE {_SALES} GROUP BY user_id) b""",
}
