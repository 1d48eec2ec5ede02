"""Stateful streams: windowed totals, rates and deduplication.

Each takes the delay by which events of one window or repeats of one key can be apart: it bounds the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.decode import counted, decode_events
from millrace.operators.validation import classify, to_event_log, valid_events
from millrace.sources.tables import BATCH

def append_stream(rows: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet table; the file sink commits each micro-batch once."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start(path)
    )


def update_stream(groups: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Write the groups that changed in each micro-batch to a folder of that batch.

    A micro-batch that runs again replaces its folder. Read the result with ``latest_groups``.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}

    def save(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return (
        groups.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def latest_groups(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of every group an update stream has written."""
    updates = spark.read.parquet(path)
    values = [c for c in updates.columns if c not in (*keys, BATCH)]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*values), F.col(BATCH)).alias("_state"))
        .select(*keys, "_state.*")
    )


def distinct_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """First arrival of each key; keys are remembered for ``delay`` of event time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def rate_per_window(stream: DataFrame, time: str, delay: str, width_seconds: int = 30) -> DataFrame:
    """Events and events per second in tumbling windows of event time."""
    window = F.window(F.col(time), f"{width_seconds} seconds")
    return (
        stream.withWatermark(time, delay)
        .groupBy(window)
        .agg(F.count("*").alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            "events",
            F.round(F.col("events").cast("decimal(20,0)") / F.lit(width_seconds), 2)
            .cast("double")
            .alias("events_per_second"),
        )
    )


def valid_order_stream(raw: DataFrame, as_of) -> DataFrame:
    """Valid orders of a raw event stream, as typed rows.

    Checked and rejected events are counted on the way and show up in the query's progress.
    """
    checked = classify(decode_events(raw), as_of)
    rejected = F.count("error_code").alias("rejected")
    return valid_events(to_event_log(counted(checked, rejected, name="order_checks")))


def hourly_orders(orders: DataFrame, delay: str) -> DataFrame:
    """Orders, revenue and items per hour of order time, each order counted once.

    Measures are those that a repeated delivery cannot change, so it does not matter which
    copy of an order is kept.
    """
    once = distinct_within(orders, ["order_id"], "order_timestamp", delay)
    return (
        once.groupBy(F.window("order_timestamp", "1 hour").alias("hour"))
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("net_amount").cast("decimal(14,2)").alias("total_revenue"),
            F.sum("item_count").alias("total_items_sold"),
        )
        .select(
            F.col("hour.start").alias("hourly_window_start"),
            F.col("hour.end").alias("hourly_window_end"),
            "total_orders",
            "total_revenue",
            "total_items_sold",
        )
    )
