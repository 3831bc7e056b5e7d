"""Decoding of events: both types, corner cases of the JSON parser, narrow schemas."""

from datetime import datetime, timezone

import pytest
from conftest import sale

from tidemark.operators.decode import decode_with_raw, parse_events
from tidemark.schemas import EVENT_FIELDS, REVENUE_FIELDS, pick

STOCK = (
    '{"event_type":"stock","event_id":"stock-1","ts":"2025-01-01T10:00:05Z","sku":"SKU0001",'
    '"category":"home","warehouse":"PT-LIS","quantity_delta":-3}'
)


def only(df):
    (row,) = df.collect()
    return row


def test_both_types_share_one_schema(raw):
    rows = parse_events(
        raw([sale("s", "2025-01-01T10:00:00Z", order_id="O1", customer_id="C1"), STOCK])
    )
    assert rows.columns == [*EVENT_FIELDS, "event_time"]
    by_type = {r.event_type: r for r in rows.collect()}
    assert by_type["sale"].order_id == "O1" and by_type["sale"].sku is None
    assert by_type["stock"].quantity_delta == -3 and by_type["stock"].unit_price is None
    assert dict(rows.dtypes)["event_time"] == "timestamp"


def test_time_is_an_instant_whatever_the_session_zone(raw):
    row = only(parse_events(raw([sale("s", "2025-03-09T02:30:00Z")])))
    # collected as a naive datetime in the zone of the Python process
    assert row.event_time.astimezone(timezone.utc) == datetime(
        2025, 3, 9, 2, 30, tzinfo=timezone.utc
    )


@pytest.mark.parametrize("text", [None, "", "plainly no JSON", "{}", "[1, 2]"])
def test_unusable_payloads_give_nulls_and_keep_the_text(raw, text):
    row = only(decode_with_raw(raw([text])))
    assert row.raw_json == text
    assert all(row[c] is None for c in (*EVENT_FIELDS, "event_time"))


@pytest.mark.parametrize("quantity", ['"two"', "1.5", "99999999999"])
def test_a_wrong_field_is_null_and_the_others_stay(raw, quantity):
    text = sale("s", "2025-01-01T10:00:00Z").replace('"quantity": 1', f'"quantity": {quantity}')
    row = only(parse_events(raw([text])))
    assert row.quantity is None
    assert (row.event_id, row.unit_price) == ("s", 5.0)


def test_trailing_text_extra_fields_and_numeric_ids(raw):
    text = sale(7, "2025-01-01T10:00:00Z", colour="red") + " trailing"
    row = only(parse_events(raw([text])))
    assert row.event_id == "7" and row.category == "books"


def test_unreadable_time_is_null_not_an_error(raw):
    row = only(parse_events(raw([sale("s", "some time today")])))
    assert row.ts == "some time today" and row.event_time is None


def test_text_values_decode_like_binary_ones(spark):
    frame = spark.createDataFrame([(STOCK,)], ["value"])
    assert only(parse_events(frame)).sku == "SKU0001"


def test_narrow_schema_and_kept_columns(raw):
    row = only(decode_with_raw(raw([STOCK]), REVENUE_FIELDS, keep=("offset",)))
    assert row.offset == 0 and row.category == "home"
    assert "warehouse" not in row.asDict()
    with pytest.raises(KeyError):
        pick(EVENT_FIELDS, "colour")


def test_payload_is_parsed_once(raw):
    """A filter on decoded fields must not bring a second parse."""
    events = parse_events(raw([STOCK])).filter("event_type = 'sale' AND event_time IS NOT NULL")
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
