"""Business rules as single column expressions (no UDFs).

``rejection_reason`` takes the first failing rule of one list, NULL
means valid.  The same expression serves the batch and the streaming Silver
step, so both paths reject the same rows for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (COHORT_SEGMENTS, CORRUPT_COL, DAILY_SEGMENTS, ENGAGED_EVENTS,
                       VALID_DEVICE_TYPES, VALID_EVENT_TYPES)


#: Largest price, line total or revenue of one event.
MAX_AMOUNT = 1e12


def blank(col: str) -> Column:
    """NULL or empty string (a falsy value in the producer's language)."""
    c = F.col(col)
    return c.isNull() | (c == F.lit(""))


def parse_event_time(col: str = "timestamp") -> Column:
    """ISO-8601 text to a UTC instant; NULL (never an error) when unparseable.

    Text without an offset is read in the session zone, which the library
    pins to UTC.
    """
    return F.try_to_timestamp(F.col(col))


def in_domain(col: str, values: list[str]) -> Column:
    # NULL IN (...) is NULL: a missing value is outside the domain.
    return F.coalesce(F.col(col).isin(*values), F.lit(False))


def too_large(amount: Column) -> Column:
    """Not finite, or beyond MAX_AMOUNT; False for NULL."""
    return F.coalesce(F.isnan(amount) | (F.abs(amount) > F.lit(MAX_AMOUNT)), F.lit(False))


class Rule(NamedTuple):
    """A reason for rejecting a record, and when it applies (NULL: it does not)."""

    reason: str
    applies: Column
    shown: str | None = None  # column whose value the reason ends with

    def label(self) -> Column:
        if self.shown is None:
            return F.lit(self.reason)
        return F.concat(F.lit(f"{self.reason}:"), F.coalesce(F.col(self.shown), F.lit("None")))


#: Columns without which a record is of no use, columns with a closed set of values, and least amounts.
REQUIRED = ("event_id", "user_id", "timestamp")
DOMAINS = {"event_type": VALID_EVENT_TYPES, "device_type": VALID_DEVICE_TYPES}
ABOVE = {"price": 0, "quantity": 0}


def field_rules(missing: Callable[[str], Column] = blank) -> list[Rule]:
    """Rules on single producer fields, in order; the reasons and the boolean flags both come from here."""
    return [*[Rule(f"missing_{c}", missing(c)) for c in REQUIRED],
            *[Rule(f"invalid_{c}", ~in_domain(c, known), c) for c, known in DOMAINS.items()],
            *[Rule(f"invalid_{c}", F.col(c) <= least) for c, least in ABOVE.items()]]


def rejection_reason(ts_col: str = "_event_ts", check_corrupt: bool = True) -> Column:
    """First failing validation rule, or NULL for a valid record.

    Order: malformed_json, the ``field_rules`` (missing_<column>,
    invalid_event_type:<v>, invalid_device_type:<v>, invalid_price (<= 0),
    invalid_quantity (< 1)), unparseable_timestamp, missing_country,
    price_out_of_range (an amount that is not finite or above MAX_AMOUNT, which
    sums could not hold).  A NULL price or quantity is valid.
    """
    total = F.col("price") * F.coalesce(F.col("quantity"), F.lit(1))
    rules = [Rule("malformed_json", F.col(CORRUPT_COL).isNotNull())] if check_corrupt else []
    rules += field_rules() + [
        Rule("unparseable_timestamp", F.col(ts_col).isNull()),
        Rule("missing_country", F.coalesce(F.trim(F.col("country")), F.lit("")) == ""),
        Rule("price_out_of_range", too_large(total) | too_large(F.col("price")) | too_large(F.col("revenue"))),
    ]
    return F.coalesce(*[F.when(r.applies, r.label()) for r in rules])


def segment(spend: Column | str, events: Column | str, variant: str = "daily") -> Column:
    """User segment from spend and event count (strict > thresholds).

    daily : >500 vip, >100 high_value, >0 buyer, events>10 engaged_browser, else casual_browser
    cohort: >200 high_value, >0 buyer, events>10 engaged_browser, else casual_browser
    """
    spend = F.col(spend) if isinstance(spend, str) else spend
    events = F.col(events) if isinstance(events, str) else events
    tiers = DAILY_SEGMENTS if variant == "daily" else COHORT_SEGMENTS
    chain = None
    for name, floor in tiers:
        cond = spend > F.lit(floor)
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
    return chain.when(events > F.lit(ENGAGED_EVENTS), F.lit("engaged_browser")).otherwise(F.lit("casual_browser"))


def event_type_marks() -> dict[str, Column]:
    """Aggregates: whether each valid event type occurs."""
    return {f"_has_{t}": F.max(F.col("event_type") == t) for t in VALID_EVENT_TYPES}


def event_type_set() -> Column:
    """The sorted types marked by ``event_type_marks``."""
    return F.array_compact(F.array(*[F.when(F.col(f"_has_{t}"), F.lit(t)) for t in sorted(VALID_EVENT_TYPES)]))
