"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver's gate runs the same comparison at sf0.01)."""
import pytest
from conftest import SF

import __spark_entry__ as entry
from ripplelake.plans import registry
from tools.check_oracle import compare, connect

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF["0.001"])


def test_registry_is_consistent():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(QUERIES) >= 60
    rows_only = sorted(set(QUERIES) - set(ORACLES))
    assert rows_only == ["daily_revenue", "top_products_cohort", "x02"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF["0.001"])
    assert compare(df, con, ORACLES[name]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 10 and "revenue_share_pct" in df.columns
