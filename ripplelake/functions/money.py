"""Exact money and rate arithmetic as Spark column expressions.

Money is stored as double, but summing doubles depends on the order rows
arrive in, which differs between runs, executors and engines.  Every money
sum therefore runs in a fixed-point decimal and is cast back to double once,
and every rounded mean/rate is rounded from a fixed decimal representation
(half up), so results are identical on every cluster layout.  All of these
stay JVM-side, inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(26,6)"      # per-row money value (up to 6 decimals); sums are decimal(36,6)
ROUNDING = "decimal(38,6)"   # representation a value is rounded from


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: Column | str) -> Column:
    return _c(col).try_cast(MONEY)


def money_sum(col: Column | str) -> Column:
    """Exact sum of a money column (decimal); NULL when no non-null input."""
    return F.sum(money(col))


def to_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def round_half_up(col: Column | str, digits: int) -> Column:
    """Round a double half-up at ``digits`` decimals, returning double."""
    return F.round(_c(col).try_cast(ROUNDING), digits).cast("double")


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den in double; NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(to_double(num), to_double(den))


def mean(total: Column | str, n: Column | str) -> Column:
    """Mean from an exact total and a count (double, unrounded)."""
    return ratio(total, n)


def share_pct(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """Rounded percentage part*100/whole."""
    return round_half_up(ratio(to_double(part) * F.lit(100.0), whole), digits)


def conversion_rate(purchases: Column | str, carts: Column | str, guard: bool = True) -> Column:
    """purchases / carts rounded to 4 decimals.

    ``guard=True`` divides by max(carts, 1) (batch rule: 0 carts count as 1);
    ``guard=False`` returns NULL for 0 carts (streaming rule).
    """
    den = F.greatest(_c(carts), F.lit(1)) if guard else _c(carts)
    return round_half_up(ratio(purchases, den), 4)
