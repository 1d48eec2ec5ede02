"""The hourly mart: true hourly windows, the all-time snapshot, and the changes that batches make to it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.model import TABLES
from millrace.operators.validation import QUARANTINED


def _measures() -> list[Column]:
    def having(status: str) -> Column:
        return F.sum((F.col("order_status") == status).cast("long"))

    return [
        F.count("order_id").alias("total_orders"),
        F.sum("net_amount").alias("_revenue"),
        F.sum("item_count").alias("total_items_sold"),
        having("DELIVERED").alias("successful_orders"),
        having("CANCELLED").alias("cancelled_orders"),
    ]


def _mart_row(start: Column, end: Column, updated_at: Column, types: Mapping[str, T.DataType] = {}) -> list[Column]:
    zero = F.lit(0).cast("long")
    revenue = F.coalesce(F.col("_revenue"), F.lit(0).cast("decimal(22,2)"))
    orders = F.coalesce(F.col("total_orders"), zero)
    average = F.coalesce(F.try_divide(revenue.cast("decimal(24,2)"), orders.cast("decimal(13,0)")), F.lit(0))
    values = {
        "hourly_window_start": start,
        "hourly_window_end": end,
        "total_orders": orders,
        "total_revenue": revenue,
        "avg_order_value": F.round(average, 2),
        "total_items_sold": F.coalesce(F.col("total_items_sold"), zero),
        "successful_orders": F.coalesce(F.col("successful_orders"), zero),
        "cancelled_orders": F.coalesce(F.col("cancelled_orders"), zero),
        "quarantined_orders": F.coalesce(F.col("quarantined_orders"), zero),
        "updated_at": updated_at,
    }
    schema = TABLES["hourly_order_aggregates"]
    return [values[f.name].cast(types.get(f.name, f.dataType)).alias(f.name) for f in schema.fields]


#: Revenue of all time, which the type of an hour's is too small for.
ALL_TIME = {"total_revenue": T.DecimalType(22, 2)}


def hourly_rollup(orders: DataFrame, quarantine: DataFrame, updated_at: Column) -> DataFrame:
    """One row per hour that saw orders or rejections.

    Orders fall in the hour of their order time, rejections in the hour of their rejection.
    Both sides are reduced to one row per hour before they meet.
    """
    hour = "INTERVAL 1 HOUR"
    facts = orders.groupBy(F.date_trunc("hour", "order_timestamp").alias("start")).agg(*_measures())
    rejected = quarantine.groupBy(F.date_trunc("hour", "quarantined_at").alias("start")).agg(
        F.count("*").alias("quarantined_orders")
    )
    start = F.col("start")
    return facts.join(rejected, "start", "full_outer").select(
        *_mart_row(start, start + F.expr(hour), updated_at)
    )


def rollup_snapshot(orders: DataFrame, quarantine: DataFrame, as_of: Column) -> DataFrame:
    """All-time totals, labelled with the hour before ``as_of``; revenue is as wide as its sum."""
    start = F.date_trunc("hour", as_of - F.expr("INTERVAL 1 HOUR"))
    rejected = quarantine.agg(F.count("*")).scalar()
    return orders.agg(*_measures()).withColumn("quarantined_orders", rejected).select(
        *_mart_row(start, start + F.expr("INTERVAL 1 HOUR"), as_of, ALL_TIME)
    )


#: What a batch of events did to an hour.
MART_CHANGE = T.StructType(
    [
        T.StructField("start", T.TimestampType()),
        T.StructField("total_orders", T.LongType()),
        T.StructField("_revenue", T.DecimalType(22, 2)),
        *[T.StructField(n, T.LongType()) for n in ("total_items_sold", "successful_orders", "cancelled_orders", "quarantined_orders")],
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def mart_changes(orders: DataFrame, log: DataFrame, now: Column) -> DataFrame:
    """Changes of the mart's sums, one row per hour that a batch touched.

    A new order adds all it has to the hour of its first event. Of a known one the batch takes back
    its earlier status and adds the later one; whatever else a repeated delivery says doesn't count.
    """
    new = ~F.col("known")

    def change(status: str) -> Column:
        after, before = ((F.coalesce(F.col(c), F.lit("")) == status).cast("long") for c in ("order_status", "status_before"))
        return F.sum(after - before)

    facts = orders.groupBy(F.date_trunc("hour", "order_timestamp").alias("start")).agg(
        F.sum(new.cast("long")).alias("total_orders"),
        F.sum(F.when(new, F.col("net_amount"))).alias("_revenue"),
        F.sum(F.when(new, F.col("item_count"))).alias("total_items_sold"),
        change("DELIVERED").alias("successful_orders"),
        change("CANCELLED").alias("cancelled_orders"),
    )
    rejected = log.where(F.col("outcome") == QUARANTINED).groupBy(F.date_trunc("hour", "processed_at").alias("start")).agg(
        F.count("*").alias("quarantined_orders")
    )
    both = facts.join(rejected, "start", "full_outer").withColumn("updated_at", now)
    zero = {f.name: F.coalesce(F.col(f.name), F.lit(0)) for f in MART_CHANGE.fields[1:-1]}
    return both.select(*[zero.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in MART_CHANGE.fields])


def mart_of_changes(changes: DataFrame) -> DataFrame:
    """The mart that changes of any number of batches add up to."""
    sums = changes.groupBy("start").agg(
        *[F.sum(f.name).alias(f.name) for f in MART_CHANGE.fields[1:-1]], F.max("updated_at").alias("updated_at")
    )
    start = F.col("start")
    return sums.select(*_mart_row(start, start + F.expr("INTERVAL 1 HOUR"), F.col("updated_at")))
