"""Counts published for the driver tables (FIXTURES.md section 3)."""
import pytest
from conftest import SF

from ripplelake.operators import gold
from ripplelake.operators.silver import rejection_counts
from ripplelake.plans.tables import PipelineTables

REJECTIONS = {
    "0.001": {"valid": 916, "missing_event_id": 22, "missing_user_id": 9, "missing_timestamp": 9,
              "invalid_event_type:click": 9, "invalid_device_type:smartwatch": 7, "invalid_device_type:None": 7,
              "invalid_price": 7, "invalid_quantity": 5, "unparseable_timestamp": 9},
    "0.01": {"valid": 9160, "missing_event_id": 208, "missing_user_id": 92, "missing_timestamp": 97,
             "invalid_event_type:click": 90, "invalid_device_type:smartwatch": 75, "invalid_device_type:None": 71,
             "invalid_price": 59, "invalid_quantity": 53, "unparseable_timestamp": 95},
}
SEGMENTS_2024_01_15 = {"0.001": {"high_value": 3, "buyer": 2, "casual_browser": 6},
                       "0.01": {"vip": 2, "high_value": 20, "buyer": 27, "casual_browser": 76}}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_rejection_counts(spark, sf):
    t = PipelineTables(spark, SF[sf])
    got = {r["reason"]: r["row_count"] for r in rejection_counts(t.tagged).collect()}
    assert got == REJECTIONS[sf]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_duplicates_and_fallback(spark, sf):
    t = PipelineTables(spark, SF[sf])
    s = t.silver_events
    dup = s.count() - s.select("event_id").distinct().count()
    assert dup == {"0.001": 12, "0.01": 105}[sf]
    fallback = t.tagged.filter("_rejection_reason IS NULL AND event_type = 'purchase' AND revenue IS NULL").count()
    assert fallback == {"0.001": 17, "0.01": 265}[sf]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_daily_segments(spark, sf):
    t = PipelineTables(spark, SF[sf])
    seg = gold.user_segments(t.silver_events, "2024-01-15").groupBy("user_segment").count().collect()
    assert {r[0]: r[1] for r in seg} == SEGMENTS_2024_01_15[sf]
