"""KPIs, distributions, feeds and charts data.

Reports that group by a dimension attribute first count per foreign key, so the join sees
one row per key instead of one per fact, whatever share of the facts a key holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.values import mean, percent
from millrace.model import BATCH_METRIC
from millrace.operators.lookup import with_dimensions
from millrace.operators.running import running_total
from millrace.session import ensure_checkpoint_dir


def _count_status(status: str) -> Column:
    return F.coalesce(F.sum((F.col("order_status") == status).cast("long")), F.lit(0)).cast("long")


def _order_measures() -> list[Column]:
    return [
        F.count("order_id").alias("total_orders"),
        F.coalesce(F.sum("net_amount"), F.lit(0).cast("decimal(22,2)")).alias("_revenue"),
        F.coalesce(F.sum("item_count"), F.lit(0)).cast("long").alias("total_items_sold"),
        _count_status("DELIVERED").alias("delivered_orders"),
        _count_status("CANCELLED").alias("cancelled_orders"),
    ]


def executive_kpis(orders: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: orders, revenue, average value, items, delivered, cancelled, quarantined, delivery rate."""
    rejected = quarantine.agg(F.count("*")).scalar()
    totals = orders.agg(*_order_measures())
    return totals.select(
        "total_orders",
        F.col("_revenue").cast("double").alias("total_revenue"),
        F.coalesce(mean(F.col("_revenue"), F.col("total_orders")), F.lit(0.0)).alias("avg_order_value"),
        "total_items_sold",
        "delivered_orders",
        "cancelled_orders",
        rejected.alias("quarantined_count"),
        percent(F.col("delivered_orders"), F.col("total_orders"), 1, 0.0).alias("delivery_rate"),
    )


def live_ingest_rate(
    orders: DataFrame,
    metrics: DataFrame,
    as_of: Column,
    window_seconds: int = 30,
    batch_seconds: str = "3.0",
) -> DataFrame:
    """Events per second over the last window; failing that, of the latest batch; failing that, 0."""
    recent = orders.where(F.col("processed_at") >= as_of - F.expr(f"INTERVAL {window_seconds} SECONDS")).agg(
        F.count("*").alias("_recent")
    )
    latest = latest_batch_metric(metrics).select("metric_value").scalar()
    by_window = F.round(F.col("_recent").cast("decimal(20,0)") / F.lit(window_seconds), 1)
    by_batch = F.round(latest / F.lit(batch_seconds).cast("decimal(6,2)"), 1)
    return recent.select(
        F.when(F.col("_recent") > 0, by_window.cast("double"))
        .when(latest > 0, by_batch.cast("double"))
        .otherwise(F.lit(0.0))
        .alias("events_per_second")
    )


def recent_orders_feed(
    orders: DataFrame, customers: DataFrame, locations: DataFrame, payments: DataFrame, limit: int = 50
) -> DataFrame:
    """The newest orders with dimension attributes.

    The newest rows are fixed by a checkpoint. With at most ``limit`` keys to look for, each
    dimension is scanned past a broadcast of them instead of being shuffled to the join.
    """
    ensure_checkpoint_dir(orders.sparkSession)
    newest = (
        orders.select(
            "order_id",
            "event_id",
            "customer_id",
            "location_id",
            "payment_method_id",
            "order_status",
            "item_count",
            "net_amount",
            "ingest_latency_ms",
            "order_timestamp",
            "processed_at",
        )
        .orderBy(F.col("order_timestamp").desc(), "order_id")
        .limit(limit)
        .checkpoint()
    )

    def needed(dimension: DataFrame, key: str) -> DataFrame:
        keys = newest.select(key).distinct()
        return F.broadcast(dimension.join(F.broadcast(keys), key, "left_semi"))

    return with_dimensions(
        newest,
        needed(customers, "customer_id"),
        needed(locations, "location_id"),
        needed(payments, "payment_method_id"),
    ).select(
        "order_id",
        "event_id",
        "customer_name",
        "customer_segment",
        "city",
        "country",
        "payment_method",
        "order_status",
        "item_count",
        F.col("net_amount").cast("double").alias("net_amount"),
        "ingest_latency_ms",
        "order_timestamp",
        "processed_at",
    ).orderBy(F.col("order_timestamp").desc(), "order_id")


def revenue_by_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders, units and revenue per product category.

    Lines are combined per (order, product) before they meet products, so that repeated lines
    of a product cross the join once, and per (category, order) before categories are
    totalled, which counts each order once and spreads a category that holds most lines.
    """
    per_product = items.groupBy("order_id", "product_id").agg(
        F.sum("quantity").alias("units"), F.sum("total_item_price").alias("revenue")
    )
    per_order = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "order_id")
        .agg(F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    )
    return (
        per_order.groupBy("category")
        .agg(
            F.count("*").alias("order_count"),
            F.sum("units").cast("long").alias("total_units_sold"),
            F.sum("revenue").cast("double").alias("category_revenue"),
        )
        .orderBy(F.col("category_revenue").desc(), "category")
    )


def _per_key(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(F.count("order_id").alias("_orders"), F.sum("net_amount").alias("_net"))


def payment_distribution(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return (
        _per_key(orders, "payment_method_id")
        .join(payments.select("payment_method_id", "method_type", "provider"), "payment_method_id")
        .groupBy("method_type", "provider")
        .agg(F.sum("_orders").alias("order_count"), F.sum("_net").cast("double").alias("total_volume"))
        .orderBy(F.col("order_count").desc(), "method_type", "provider")
    )


def geo_distribution(orders: DataFrame, locations: DataFrame) -> DataFrame:
    places = ["city", "country", "region", "latitude", "longitude"]
    return (
        _per_key(orders, "location_id")
        .join(locations.select("location_id", *places), "location_id")
        .groupBy(*places)
        .agg(F.sum("_orders").alias("order_count"), F.sum("_net").cast("double").alias("total_revenue"))
        .orderBy(F.col("order_count").desc(), "city", "country")
    )


def payment_share(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Share of each payment type in the total volume."""
    per_type = (
        _per_key(orders, "payment_method_id")
        .join(payments.select("payment_method_id", "method_type"), "payment_method_id")
        .groupBy("method_type")
        .agg(F.sum("_net").alias("_net"))
    )
    # One row per payment type is left, so the unpartitioned window is over a handful of rows.
    total = F.sum("_net").over(Window.partitionBy())
    return per_type.select(
        "method_type",
        F.col("_net").cast("double").alias("total_volume"),
        F.try_divide(F.col("_net").cast("double"), total.cast("double")).alias("share"),
    )


def segment_spending(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, customers, spend and average order value per customer segment."""
    return (
        _per_key(orders, "customer_id")
        .join(customers.select("customer_id", "segment"), "customer_id")
        .groupBy("segment")
        .agg(
            F.sum("_orders").alias("order_count"),
            F.count("*").alias("customer_count"),
            F.sum("_net").alias("_net"),
        )
        .select(
            "segment",
            "order_count",
            "customer_count",
            F.col("_net").cast("double").alias("total_spend"),
            mean(F.col("_net"), F.col("order_count")).alias("avg_order_value"),
        )
    )


def status_breakdown(orders: DataFrame) -> DataFrame:
    """Orders per status with their share in percent."""
    per_status = orders.groupBy("order_status").agg(F.count("*").alias("order_count"))
    # At most one row per known status is left at this point.
    total = F.sum("order_count").over(Window.partitionBy())
    return per_status.select(
        "order_status",
        "order_count",
        percent(F.col("order_count"), total, 2, 0.0).alias("share_percent"),
    )


def hourly_volume(orders: DataFrame) -> DataFrame:
    """Orders and revenue per hour of the day."""
    return (
        orders.groupBy(F.hour("order_timestamp").alias("hour_of_day"))
        .agg(F.count("*").alias("order_count"), F.sum("net_amount").cast("double").alias("total_revenue"))
    )


def order_line_items(requested: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Line items of the requested orders with product attributes."""
    return items.join(requested.select("order_id").distinct(), "order_id", "left_semi").join(
        products.select("product_id", "product_name", "category"), "product_id", "left"
    )


def cumulative_revenue(orders: DataFrame, slices: int | None = None) -> DataFrame:
    """Running revenue in order of order time."""
    return running_total(
        orders.select("order_id", "order_timestamp", "net_amount"),
        ["order_timestamp", "order_id"],
        "net_amount",
        "cumulative_revenue",
        slices,
    )


def latency_histogram(orders: DataFrame, bins: int = 20) -> DataFrame:
    """Orders per equal-width latency bin; the highest value falls in the last bin."""
    latency = F.col("ingest_latency_ms")
    span = orders.agg(F.struct(F.min(latency).alias("low"), F.max(latency).alias("high"))).scalar()
    width = (span["high"] - span["low"]).cast("double") / F.lit(float(bins))
    position = F.floor(F.try_divide((latency - span["low"]).cast("double"), width))
    bin_no = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (
        orders.where(latency.isNotNull())
        .groupBy((bin_no + 1).alias("bin"))
        .agg(F.count("*").alias("order_count"))
        .select("bin", (span["low"] + width * (F.col("bin") - 1)).alias("bin_start"), "order_count")
    )


def quarantine_summary(quarantine: DataFrame) -> DataFrame:
    """Failures per code and reason."""
    return (
        quarantine.groupBy("error_code", "rejection_reason")
        .agg(F.count("*").alias("failure_count"))
        .orderBy(F.col("failure_count").desc(), "error_code", "rejection_reason")
    )


def quarantine_by_code(quarantine: DataFrame) -> DataFrame:
    return (
        quarantine.groupBy("error_code")
        .agg(F.count("*").alias("failure_count"))
        .orderBy(F.col("failure_count").desc(), "error_code")
    )


def quarantine_latest(quarantine: DataFrame, limit: int = 30) -> DataFrame:
    """The newest quarantined events with their payloads."""
    return quarantine.orderBy(F.col("quarantined_at").desc(), "batch_id", "seq").limit(limit)


def validation_pass_rate(orders: DataFrame, quarantine: DataFrame) -> DataFrame:
    valid = orders.agg(F.count("*").alias("valid_count"))
    rejected = quarantine.agg(F.count("*").alias("quarantined_count")).scalar()
    return valid.withColumn("quarantined_count", rejected).select(
        percent(
            F.col("valid_count"), F.col("valid_count") + F.col("quarantined_count"), 2, 100.0
        ).alias("pass_rate"),
        "valid_count",
        "quarantined_count",
    )


def latest_batch_metric(metrics: DataFrame) -> DataFrame:
    """The newest batch-size metric value."""
    return (
        metrics.where(F.col("metric_name") == BATCH_METRIC)
        .orderBy(F.col("timestamp").desc(), F.col("metric_id"))
        .limit(1)
        .select("timestamp", "metric_value")
    )
