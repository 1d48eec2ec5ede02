"""Where an order ended up: stored, quarantined or not seen yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.values import missing

# --- Fixed values: lookup states ----------------------------------------------------------
PERSISTED = "PERSISTED"
QUARANTINED = "QUARANTINED"
PENDING_INGESTION = "PENDING_INGESTION"
UNKNOWN = "UNKNOWN"
# --- end of fixed values ------------------------------------------------------------------


def with_dimensions(
    orders: DataFrame, customers: DataFrame, locations: DataFrame, payments: DataFrame
) -> DataFrame:
    """Left joins of the three order dimensions; Spark broadcasts those that are small enough."""
    return (
        orders.join(
            customers.select("customer_id", "customer_name", F.col("segment").alias("customer_segment")),
            "customer_id",
            "left",
        )
        .join(locations.select("location_id", "city", "country"), "location_id", "left")
        .join(
            payments.select("payment_method_id", F.col("method_type").alias("payment_method")),
            "payment_method_id",
            "left",
        )
    )


def order_status(
    requested: DataFrame,
    orders: DataFrame,
    quarantine: DataFrame,
    customers: DataFrame,
    locations: DataFrame,
    payments: DataFrame,
) -> DataFrame:
    """For every requested ``order_id``: found, status, destination and the stored attributes.

    Facts win over quarantine rows. Dimensions are joined to matched orders only.
    """
    ids = requested.select("order_id").distinct()
    matched = orders.join(ids, "order_id", "left_semi").select(
        "order_id",
        "event_id",
        "customer_id",
        "location_id",
        "payment_method_id",
        "order_status",
        "net_amount",
        "item_count",
        "ingest_latency_ms",
        "order_timestamp",
        "processed_at",
    )
    stored = with_dimensions(matched, customers, locations, payments).drop(
        "customer_id", "location_id", "payment_method_id", "customer_segment"
    )
    # Only rejections of the requested ids; one row per id, combined before the shuffle.
    rejected = (
        quarantine.join(ids.select("order_id").distinct(), "order_id", "left_semi")
        .groupBy("order_id")
        .agg(
            F.min_by(
                F.struct(
                    "quarantine_id",
                    F.col("event_id").alias("rejected_event_id"),
                    "error_code",
                    "rejection_reason",
                    "failed_validation_rule",
                    "quarantined_at",
                    "raw_payload",
                ),
                F.struct("batch_id", "seq"),
            ).alias("q")
        )
        .select("order_id", "q.*")
    )
    joined = (
        ids.join(stored.withColumn("_stored", F.lit(True)), "order_id", "left")
        .join(rejected.withColumn("_rejected", F.lit(True)), "order_id", "left")
    )
    is_stored = F.col("_stored").isNotNull()
    is_rejected = ~is_stored & F.col("_rejected").isNotNull()
    status = (
        F.when(missing(F.col("order_id")), UNKNOWN)
        .when(is_stored, PERSISTED)
        .when(is_rejected, QUARANTINED)
        .otherwise(PENDING_INGESTION)
    )
    attributes = [c for c in stored.columns if c not in ("order_id", "event_id")]
    faults = ["quarantine_id", "error_code", "rejection_reason", "failed_validation_rule", "quarantined_at", "raw_payload"]
    return joined.select(
        "order_id",
        (is_stored | is_rejected).alias("found"),
        status.alias("status"),
        F.when(is_stored, "fact_orders").when(is_rejected, "quarantine_orders").alias("destination"),
        F.when(is_stored, F.col("event_id")).when(is_rejected, F.col("rejected_event_id")).alias("event_id"),
        *attributes,
        *[F.when(is_rejected, F.col(c)).alias(c) for c in faults],
    )


def existing_orders(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming orders that are stored already."""
    return incoming.join(stored.select("order_id"), "order_id", "left_semi")
