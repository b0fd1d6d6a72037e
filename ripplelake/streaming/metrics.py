"""Hourly windowed Gold metrics.

Column-expression builders that work on streaming and on batch frames.  On a
stream the watermark is set once, in the Silver step (``silver_stream``);
these builders must not set it again (Spark refuses a redefined watermark).
In a stream, exact distinct counts are not supported, so buyers/users are
``approx_count_distinct``; batch callers may ask for exact counts.

State: the group key includes the 1-hour window, so state per key lives
until the watermark passes window end + delay and is then emitted once
(append mode) and dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import conversion_rate, mean, money_sum, round_half_up, to_double
from ..functions.rules import event_type_marks, event_type_set
from ..schemas import WINDOW_DURATION

TS = "event_timestamp"


class Hourly:
    """One hourly roll-up: its keys, the running totals a window keeps, and the columns shown when it closes."""

    def __init__(self, *keys: str) -> None:
        self.keys, self.totals, self.shown = keys, {}, {}

    def total(self, name: str, aggregate: Column, show: bool = True) -> Hourly:
        self.totals[name] = aggregate
        return self.show(name, F.col(name)) if show else self

    def show(self, name: str, value: Column) -> Hourly:
        self.shown[name] = value
        return self

    def money(self, name: str, amount: Column | str) -> Hourly:
        """An exact sum, shown in whole cents."""
        return self.total(f"_{name}", money_sum(amount), show=False).show(name, round_half_up(to_double(f"_{name}"), 2))

    def distinct(self, name: str, column: str, exact: bool) -> Hourly:
        return self.total(name, F.countDistinct(column) if exact else F.approx_count_distinct(column))

    def types(self, **wanted: str) -> Hourly:
        """Events by type: name=event_type."""
        for name, kind in wanted.items():
            self.total(name, F.count_if(F.col("event_type") == kind))
        return self

    def over(self, events: DataFrame, ends: bool = False) -> DataFrame:
        hours = events.groupBy(F.window(TS, WINDOW_DURATION), *self.keys).agg(*[c.alias(n) for n, c in self.totals.items()])
        bounds = {"window_start": F.col("window.start")} | ({"window_end": F.col("window.end")} if ends else {})
        columns = bounds | {k: F.col(k) for k in self.keys} | self.shown | {"updated_at": F.current_timestamp()}
        return hours.select(*[c.alias(n) for n, c in columns.items()])


#: What a purchase brings in; other events bring nothing.
SPENT = "if(event_type = 'purchase', revenue, 0)"


def sales_metrics(silver: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Purchases per 1-hour window x country x category."""
    prices = {"_prices": money_sum("price"), "_priced": F.count("price")}
    sales = Hourly("country", "category").money("total_revenue", "revenue")
    sales.total("total_orders", F.count("event_id")).total("total_units_sold", F.sum("quantity"))
    for name, aggregate in prices.items():
        sales.total(name, aggregate, show=False)
    sales.show("avg_order_value", round_half_up(mean("_prices", "_priced"), 2))
    sales.distinct("unique_buyers", "user_id", exact_distinct)
    return sales.over(silver.filter("event_type = 'purchase'"), ends=True)


def product_metrics(silver: DataFrame, exact_distinct: bool = False) -> DataFrame:
    """Per 1-hour window x product: revenue, purchase/cart/view counts,
    users, conversion rate (NULL when there were no cart adds)."""
    products = Hourly("product_id", "product_name", "category").money("revenue", F.expr(SPENT))
    products.types(purchase_count="purchase", cart_adds="add_to_cart", product_views="product_view")
    products.distinct("unique_users", "user_id", exact_distinct)
    products.show("conversion_rate", conversion_rate("purchase_count", "cart_adds", guard=False))
    return products.over(silver.filter("product_id is not null"))


def user_metrics(silver: DataFrame) -> DataFrame:
    """Per 1-hour window x user x device x country: events, spend, set
    of event types (at most 6 values), last event time."""
    users = Hourly("user_id", "device_type", "country").total("total_events", F.count("event_id")).money("total_spend", F.expr(SPENT))
    for name, mark in event_type_marks().items():
        users.total(name, mark, show=False)
    users.show("event_types_seen", event_type_set()).total("last_seen", F.max(TS))
    return users.over(silver)
