from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from millrace.model import RAW_EVENT  # noqa: E402
from millrace.session import local_session  # noqa: E402

AS_OF = "2026-01-15 12:00:00"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "millrace-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of(spark):
    return F.lit(AS_OF).cast("timestamp")


def order_event(number: int = 1, **changes) -> dict:
    """A valid order event; keyword arguments replace fields, and ``...`` leaves one out."""
    event = {
        "event_id": f"evt-{number}",
        "order_id": f"ORD-{number}",
        "customer_id": "CUST-1042",
        "location_id": "LOC-A",
        "payment_method_id": "PAY-CC-VISA",
        "order_status": "PENDING",
        "items": [
            {"product_id": "P1", "quantity": 2, "unit_price": 10.0, "total_item_price": 20.0, "discount_applied": 1.0}
        ],
        "item_count": 2,
        "total_amount": 20.0,
        "discount_amount": 1.0,
        "tax_amount": 1.52,
        "net_amount": 20.52,
        "order_timestamp": "2026-01-15T11:00:00+00:00",
        "metadata": {"device": "web", "session_duration_sec": 42},
    }
    event.update(changes)
    return {k: v for k, v in event.items() if v is not ...}


def item(**changes) -> dict:
    line = {"product_id": "P1", "quantity": 2, "unit_price": 10.0, "total_item_price": 20.0, "discount_applied": 0.0}
    line.update(changes)
    return {k: v for k, v in line.items() if v is not ...}


@pytest.fixture(scope="session")
def messages(spark):
    """Raw messages from events (dicts) or payload texts, one sequence number each."""

    def make(*payloads, start: int = 0, received: str = "2026-01-15 11:00:01.500"):
        rows = [
            (p if isinstance(p, str) or p is None else json.dumps(p), start + i) for i, p in enumerate(payloads)
        ]
        frame = spark.createDataFrame(rows, "value string, seq long")
        return frame.withColumn("received_at", F.lit(received).cast("timestamp")).select(
            *[f.name for f in RAW_EVENT.fields]
        )

    return make
