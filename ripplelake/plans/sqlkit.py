"""Portable SQL snippets shared by the Spark query library and its oracle.

The same text must give identical values in Spark SQL and in DuckDB, so
money is summed in fixed point and rounded from a fixed decimal (half up).
Table references are written ``@name`` and bound per engine: Spark passes
DataFrames as ``spark.sql`` arguments, the oracle uses CTE names.
"""

from __future__ import annotations

import re

_TABLE = re.compile(r"@([a-z_][a-z0-9_]*)")


def R(expr: str, digits: int) -> str:
    """Round a numeric expression half up at ``digits``; double result."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def MSUM(expr: str) -> str:
    """Exact money sum, as double."""
    return f"CAST(SUM(CAST({expr} AS DECIMAL(26,6))) AS DOUBLE)"


def ISUM(expr: str) -> str:
    """Integer sum as BIGINT (DuckDB would give HUGEINT)."""
    return f"CAST(SUM({expr}) AS BIGINT)"


def DIV(num: str, den: str) -> str:
    """Double division, NULL when the divisor is 0 or NULL."""
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"


def tables_in(sql: str) -> list[str]:
    return sorted(set(_TABLE.findall(sql)))


def for_spark(sql: str) -> str:
    return _TABLE.sub(lambda m: "{" + m.group(1) + "}", sql)


def for_duckdb(sql: str) -> str:
    return _TABLE.sub(lambda m: m.group(1), sql)
