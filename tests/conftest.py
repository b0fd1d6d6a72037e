import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from ripplelake.session import build_session
    # Tests read filters from plans; Spark cuts them at 100 characters, which long expression ids use up.
    s = build_session(master="local[*]", shuffle_partitions=8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    yield s
    s.stop()


# Base producer event (one row; tests override fields).
BASE_EVENT = {
    "event_id": "test-event-001", "timestamp": "2026-03-18T10:00:00+00:00", "user_id": "U123456",
    "session_id": "sess-001", "event_type": "purchase", "product_id": "P001", "product_name": "MacBook Pro",
    "category": "Electronics", "price": 999.99, "quantity": 1, "revenue": 999.99, "device_type": "mobile",
    "country": "US", "schema_version": "1.0",
}


def make_event(**overrides):
    e = dict(BASE_EVENT)
    e.update(overrides)
    return e


def raw_frame(spark, events):
    from ripplelake.schemas import EVENT_SCHEMA
    rows = [tuple(e.get(f.name) for f in EVENT_SCHEMA.fields) for e in events]
    return spark.createDataFrame(rows, EVENT_SCHEMA)
