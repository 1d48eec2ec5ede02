"""Classify decoded events and split them into valid orders and quarantined ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.clock import LATENCY_SQL, event_time
from millrace.functions.rules import DEFAULT_TOLERANCE, verdict
from millrace.functions.values import surrogate_key
from millrace.model import DEFAULT_STATUS, FACT_ITEM, TABLES
from millrace.operators.decode import decode_events

VALID, QUARANTINED = "valid", "quarantined"


def _with_instant(rows: DataFrame) -> DataFrame:
    """Add the instant of the order time as ``_instant``, unless it is there: the text is read once for all that need it."""
    return rows if "_instant" in rows.columns else rows.withColumn("_instant", event_time("order_timestamp"))


def classify(
    decoded: DataFrame,
    as_of: Column,
    tolerance: str = DEFAULT_TOLERANCE,
    check_constraints: bool = True,
) -> DataFrame:
    """Add ``error_code`` and ``rejection_reason``; both NULL for a valid event."""
    judged = _with_instant(decoded).withColumn("_as_of", as_of).withColumn("_verdict", verdict(tolerance, check_constraints))
    return judged.select(
        *decoded.columns,
        F.col("_verdict.code").alias("error_code"),
        F.col("_verdict.reason").alias("rejection_reason"),
    )


def _money(column: str, absent: str = "NULL") -> str:
    amount = f"try_cast({column} AS DECIMAL(12,2))"
    return amount if absent == "NULL" else f"coalesce({amount}, CAST({absent} AS DECIMAL(12,2)))"


# Wire line items as fact line items: money in decimals, an absent discount is 0. Arrays without absent discounts take one compiled cast.
FACT_ITEMS_SQL = f"""CASE WHEN coalesce(array_contains(items.discount_applied, -1D), true) THEN transform(items, i -> named_struct(
    'product_id', i.product_id, 'quantity', i.quantity, 'unit_price', {_money('i.unit_price')},
    'total_item_price', {_money('i.total_item_price')}, 'discount_applied', {_money('i.discount_applied', '0')}))
    ELSE try_cast(items AS ARRAY<{FACT_ITEM.simpleString()}>) END"""

FACT_COLUMNS_SQL = {
    "order_id": "order_id",
    "event_id": "event_id",
    "customer_id": "customer_id",
    "location_id": "location_id",
    "payment_method_id": "payment_method_id",
    "order_status": f"upper(coalesce(order_status, '{DEFAULT_STATUS}'))",
    "total_amount": _money("total_amount"),
    "discount_amount": _money("discount_amount", "0"),
    "tax_amount": _money("tax_amount", "0"),
    "net_amount": _money("net_amount"),
    "item_count": "item_count",
    "order_timestamp": "_ordered_at",
    "processed_at": "received_at",
    "ingest_latency_ms": LATENCY_SQL.format("_ordered_at", "received_at"),
}


def to_event_log(classified: DataFrame) -> DataFrame:
    """One typed row per event: its payload, and fact columns for a valid one.

    This is the only wide pass over a batch. Facts, line items and quarantine rows are
    projections of its result.
    """
    keep_always = {"order_id", "event_id", "processed_at"}
    facts = [
        f"{sql} AS {name}" if name in keep_always else f"CASE WHEN error_code IS NULL THEN {sql} END AS {name}"
        for name, sql in FACT_COLUMNS_SQL.items()
    ]
    return _with_instant(classified).withColumn("_ordered_at", F.coalesce("_instant", "received_at")).selectExpr(
        "seq",
        *facts,
        f"CASE WHEN error_code IS NULL THEN {FACT_ITEMS_SQL} END AS items",
        "value AS raw_payload",
        "error_code",
        "rejection_reason",
        f"CASE WHEN error_code IS NULL THEN '{VALID}' ELSE '{QUARANTINED}' END AS outcome",
    )


def ingest_plan(raw: DataFrame, as_of: Column, tolerance: str = DEFAULT_TOLERANCE) -> DataFrame:
    """Raw messages (value, seq, received_at) to event-log rows."""
    return to_event_log(classify(_with_instant(decode_events(raw)), as_of, tolerance))


def valid_events(log: DataFrame) -> DataFrame:
    return log.where(F.col("outcome") == VALID)


def order_versions_of(log: DataFrame) -> DataFrame:
    """Fact-shaped rows, one per valid event, with their place in the log."""
    names = [f.name for f in TABLES["fact_orders"].fields]
    return valid_events(log).select("batch_id", "seq", *names)


def quarantine_rows(log: DataFrame) -> DataFrame:
    """Rejected events as quarantine rows."""
    return log.where(F.col("outcome") == QUARANTINED).select(
        surrogate_key(F.col("raw_payload"), F.col("error_code"), F.col("batch_id"), F.col("seq")).alias(
            "quarantine_id"
        ),
        "event_id",
        "order_id",
        "raw_payload",
        "error_code",
        "rejection_reason",
        F.concat(F.lit("Rule_"), F.col("error_code")).alias("failed_validation_rule"),
        F.col("processed_at").alias("quarantined_at"),
        "batch_id",
        "seq",
    )
