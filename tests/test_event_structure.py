"""Event structure: schema and JSON round trip through the parser (B2)."""
import json

from conftest import BASE_EVENT, make_event, raw_frame

from ripplelake.operators.bronze import to_payload
from ripplelake.operators.silver import parse_events
from ripplelake.schemas import EVENT_SCHEMA, SILVER_SCHEMA


def test_event_schema_has_producer_fields():
    names = set(EVENT_SCHEMA.fieldNames())
    assert set(BASE_EVENT) <= names
    assert {"ip_address", "user_agent"} <= names


def test_field_types():
    types = {f.name: f.dataType.simpleString() for f in EVENT_SCHEMA.fields}
    assert types["price"] == "double" and types["revenue"] == "double"
    assert types["quantity"] == "int" and types["timestamp"] == "string"


def test_silver_schema_has_20_columns_and_null_contract():
    assert len(SILVER_SCHEMA.fields) == 20
    required = {f.name for f in SILVER_SCHEMA.fields if not f.nullable}
    assert {"event_id", "user_id", "event_type", "device_type", "country", "event_timestamp"} <= required


def test_json_round_trip(spark):
    df = parse_events(to_payload(raw_frame(spark, [make_event()])))
    row = df.first().asDict()
    for k, v in BASE_EVENT.items():
        assert row[k] == v, k
    assert row["_corrupt"] is None


def test_payload_is_json_document(spark):
    text = to_payload(raw_frame(spark, [make_event()])).first()["raw_payload"]
    assert json.loads(text)["event_id"] == "test-event-001"


def test_malformed_and_wrong_typed_text_is_flagged(spark):
    df = spark.createDataFrame([("not json",), ('{"event_id": "x", "price": "oops"}',)], "raw_payload string")
    rows = parse_events(df).collect()
    assert all(r["_corrupt"] is not None for r in rows)
