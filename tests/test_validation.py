"""One case per rule, then the cases where JSON types and Spark types differ."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import item, order_event
from millrace.operators.decode import decode_events
from millrace.operators.validation import classify, ingest_plan, quarantine_rows
from millrace.functions.rules import first_item_fault

CASES = [
    (order_event(), None),
    (order_event(order_status="delivered"), None),
    ("not json", "CORRUPT_PAYLOAD"),
    ("[1,2]", "CORRUPT_PAYLOAD"),
    ("5", "CORRUPT_PAYLOAD"),
    ("null", "CORRUPT_PAYLOAD"),
    (None, "CORRUPT_PAYLOAD"),
    ("", "CORRUPT_PAYLOAD"),
    ('{"event_id": "e", "order_id": ', "CORRUPT_PAYLOAD"),
    ("{}", "NULL_EVENT_ID"),
    (order_event(event_id=None), "NULL_EVENT_ID"),
    (order_event(event_id=""), "NULL_EVENT_ID"),
    (order_event(order_id=...), "NULL_ORDER_ID"),
    (order_event(customer_id=None), "NULL_CUSTOMER_ID"),
    (order_event(location_id=""), "NULL_LOCATION_ID"),
    (order_event(payment_method_id=None), "NULL_PAYMENT_METHOD"),
    (order_event(payment_method_id="PAY-FAKE-METHOD"), "INVALID_PAYMENT_METHOD"),
    (order_event(order_status="FLYING_TO_SPACE"), "INVALID_ORDER_STATUS"),
    (order_event(order_status=...), "INVALID_ORDER_STATUS"),
    (order_event(total_amount=-49.99), "NEGATIVE_OR_NULL_TOTAL"),
    (order_event(total_amount=None), "NEGATIVE_OR_NULL_TOTAL"),
    (order_event(total_amount="7"), "NEGATIVE_OR_NULL_TOTAL"),
    (order_event(total_amount=True), "NEGATIVE_OR_NULL_TOTAL"),
    (order_event(total_amount=float("nan")), "NEGATIVE_OR_NULL_TOTAL"),
    (order_event(net_amount=-1), "NEGATIVE_OR_NULL_NET"),
    (order_event(net_amount=...), "NEGATIVE_OR_NULL_NET"),
    (order_event(items=[]), "EMPTY_ITEMS_ARRAY"),
    (order_event(items=...), "EMPTY_ITEMS_ARRAY"),
    (order_event(items={"product_id": "P1"}), "EMPTY_ITEMS_ARRAY"),
    (order_event(items="P1"), "EMPTY_ITEMS_ARRAY"),
    (order_event(items=[5, item()]), "CORRUPT_LINE_ITEM"),
    (order_event(items=[item(), None]), "CORRUPT_LINE_ITEM"),
    (order_event(items=[item(), [1]]), "CORRUPT_LINE_ITEM"),
    (order_event(items=[item(product_id=...)]), "NULL_PRODUCT_ID"),
    (order_event(items=[item(quantity=0)]), "INVALID_QUANTITY"),
    (order_event(items=[item(quantity=1.5)]), "INVALID_QUANTITY"),
    (order_event(items=[item(quantity=2.0)]), "INVALID_QUANTITY"),
    (order_event(items=[item(quantity="2")]), "INVALID_QUANTITY"),
    (order_event(items=[item(quantity=True)]), "INVALID_QUANTITY"),
    (order_event(items=[item(unit_price=-0.01)]), "INVALID_UNIT_PRICE"),
    (order_event(items=[item(unit_price=None)]), "INVALID_UNIT_PRICE"),
    (order_event(order_timestamp=None), "NULL_TIMESTAMP"),
    (order_event(order_timestamp=""), "NULL_TIMESTAMP"),
    (order_event(order_timestamp="2099-01-01T00:00:00+00:00"), "FUTURE_TIMESTAMP_ANOMALY"),
    (order_event(order_timestamp="2026-02-14T11:59:59Z"), None),
    (order_event(order_timestamp="2026-02-14T12:00:01Z"), "FUTURE_TIMESTAMP_ANOMALY"),
    (order_event(order_timestamp="not-a-date"), "MALFORMED_TIMESTAMP"),
    (order_event(order_timestamp="2026-01-15T11:00:00"), "MALFORMED_TIMESTAMP"),
    (order_event(order_timestamp="20240101T000000Z"), "MALFORMED_TIMESTAMP"),
    (order_event(order_timestamp="2026-13-41T00:00:00Z"), "MALFORMED_TIMESTAMP"),
    (order_event(order_timestamp=1700000000), "MALFORMED_TIMESTAMP"),
    (order_event(discount_amount=None, tax_amount=None), None),
    (order_event(discount_amount=..., tax_amount=...), None),
    (order_event(item_count=0), "CONSTRAINT_ITEM_COUNT"),
    (order_event(item_count=...), "CONSTRAINT_ITEM_COUNT"),
    (order_event(discount_amount=-1.0), "CONSTRAINT_DISCOUNT_AMOUNT"),
    (order_event(tax_amount=-1.0), "CONSTRAINT_TAX_AMOUNT"),
    (order_event(total_amount=1e11), "CONSTRAINT_TOTAL_AMOUNT"),
    (order_event(items=[item(total_item_price=...)]), "CONSTRAINT_TOTAL_ITEM_PRICE"),
    (order_event(items=[item(), item(total_item_price=-1.0)]), "CONSTRAINT_TOTAL_ITEM_PRICE"),
]


@pytest.fixture(scope="module")
def verdicts(messages, as_of):
    rows = classify(decode_events(messages(*[p for p, _ in CASES])), as_of).collect()
    return {r["seq"]: r for r in rows}


@pytest.mark.parametrize("number", range(len(CASES)))
def test_first_failing_rule_names_the_error(verdicts, number):
    assert verdicts[number]["error_code"] == CASES[number][1]
    assert (verdicts[number]["rejection_reason"] is None) == (CASES[number][1] is None)


REASONS = [
    (order_event(customer_id=None), "Field 'customer_id' is missing or null."),
    (order_event(payment_method_id="PAY-X"), "Payment method 'PAY-X' is not in reference dimensions."),
    (order_event(order_status="lost"), "Order status 'LOST' is not a recognized state."),
    (order_event(order_status=...), "Order status 'NONE' is not a recognized state."),
    (order_event(total_amount=-49.99), "Gross total amount -49.99 is negative or not a number."),
    (order_event(total_amount=None), "Gross total amount None is negative or not a number."),
    (order_event(net_amount=-50), "Net amount -50 is negative or not a number."),
    (order_event(net_amount=-12345678.5), "Net amount -12345678.5 is negative or not a number."),
    (order_event(items=[item(), 7]), "Line item at index 1 is malformed."),
    (order_event(items=[item(), item(product_id="")]), "Line item at index 1 has missing product_id."),
    (order_event(items=[item(quantity=-3)]), "Line item P1 has invalid quantity: -3."),
    (order_event(total_amount="abc"), "Gross total amount abc is negative or not a number."),
    (order_event(items=[item(), item(quantity=1.5)]), "Line item P1 has invalid quantity: 1.5."),
    (order_event(items=[item(quantity="x")]), "Line item P1 has invalid quantity: x."),
    (order_event(items=[item(unit_price=None)]), "Line item P1 has negative/null unit price: None."),
    (order_event(items=[item(unit_price=-2.5)]), "Line item P1 has negative/null unit price: -2.5."),
    (
        order_event(order_timestamp="2099-01-01T00:00:00+00:00"),
        "Timestamp 2099-01-01T00:00:00+00:00 is unreasonably far in the future.",
    ),
    (
        order_event(order_timestamp="not-a-date"),
        "Could not parse timestamp 'not-a-date': Invalid isoformat string: 'not-a-date'",
    ),
    (
        order_event(order_timestamp="2026-01-15T11:00:00"),
        "Could not parse timestamp '2026-01-15T11:00:00': can't compare offset-naive and offset-aware datetimes",
    ),
]


def test_reasons_quote_the_bad_value(messages, as_of):
    rows = classify(decode_events(messages(*[p for p, _ in REASONS])), as_of).orderBy("seq").collect()
    assert [r["rejection_reason"] for r in rows] == [reason for _, reason in REASONS]


def test_tolerance_is_a_parameter(messages, as_of):
    raw = messages(order_event(order_timestamp="2026-01-15T12:00:03Z"))
    assert classify(decode_events(raw), as_of).first()["error_code"] is None
    strict = classify(decode_events(raw), as_of, tolerance="2.592 seconds").first()
    assert strict["error_code"] == "FUTURE_TIMESTAMP_ANOMALY"


def test_first_bad_item_wins_over_later_ones(messages):
    raw = messages(order_event(items=[item(), item(quantity=0, unit_price=-1), 5]))
    fault = decode_events(raw).select(first_item_fault().alias("f")).first()["f"]
    assert (fault["item_index"], fault["code"]) == (1, "INVALID_QUANTITY")


def test_log_keeps_the_payload_of_rejected_events_only(messages, as_of):
    bad = order_event(2, customer_id=None, surprise={"kept": True})
    log = ingest_plan(messages(order_event(1), bad), as_of).withColumn("batch_id", F.lit(0))
    rows = {r["seq"]: r for r in log.collect()}
    assert rows[0]["raw_payload"] and rows[0]["items"][0]["product_id"] == "P1"
    assert json.loads(rows[1]["raw_payload"]) == bad
    assert rows[1]["total_amount"] is None
    quarantined = quarantine_rows(log).collect()
    assert [r["failed_validation_rule"] for r in quarantined] == ["Rule_NULL_CUSTOMER_ID"]
    assert (quarantined[0]["event_id"], quarantined[0]["order_id"]) == ("evt-2", "ORD-2")


def test_facts_take_exact_money_and_whole_milliseconds(messages, as_of):
    event = order_event(total_amount=2.675, order_timestamp="2026-01-15T13:00:00.1234+02:00", discount_amount=None)
    row = ingest_plan(messages(event), as_of).first()
    assert str(row["total_amount"]) == "2.68"
    assert str(row["discount_amount"]) == "0.00"
    assert row["ingest_latency_ms"] == 1376
    early = ingest_plan(messages(order_event(order_timestamp="2026-01-15T12:30:00Z")), as_of).first()
    assert early["ingest_latency_ms"] == 0


def test_metadata_values_become_text(messages):
    row = decode_events(messages(order_event())).first()
    assert row["metadata"] == {"device": "web", "session_duration_sec": "42"}


def test_payload_is_parsed_once_per_event(messages, as_of):
    plan = ingest_plan(messages(order_event()), as_of)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(event_id") == 1
