"""Pipeline statistics, metrics and freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.values import mean, surrogate_key
from millrace.model import (
    BATCH_COMPONENT,
    BATCH_METRIC,
    HEARTBEAT_COMPONENT,
    HEARTBEAT_METRIC,
    TABLES,
)
from millrace.operators.validation import VALID


def batch_stats(log: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Processed, valid, quarantined and duplicate events per batch, with latency totals.

    Only a count per batch meets the duplicates.
    """
    ok = F.col("outcome") == VALID
    counts = log.groupBy("batch_id").agg(
        F.count("*").alias("processed"),
        F.sum(ok.cast("long")).alias("valid"),
        F.sum((~ok).cast("long")).alias("quarantined"),
        F.sum(F.when(ok, F.col("ingest_latency_ms"))).alias("latency_total"),
        F.max("processed_at").alias("finished_at"),
    )
    return counts.join(duplicates, "batch_id", "left").select(
        "batch_id",
        "processed",
        "valid",
        "quarantined",
        F.coalesce("duplicates", F.lit(0)).cast("long").alias("duplicates"),
        "latency_total",
        "finished_at",
    )


def no_events() -> dict[str, int]:
    """Statistics of a batch without events."""
    return {"processed": 0, "valid": 0, "quarantined": 0, "duplicates": 0}


def _metric_rows(
    rows: DataFrame, stamp: Column, component: str, name: str, value: Column, unit: str, status: Column, details: Column, key: Column, also: tuple[str, ...] = ()
) -> DataFrame:
    values = {
        "metric_id": surrogate_key(F.lit(name), key),
        "timestamp": stamp,
        "component": F.lit(component),
        "metric_name": F.lit(name),
        "metric_value": value,
        "metric_unit": F.lit(unit),
        "status_indicator": status,
        "details": details,
    }
    schema = TABLES["pipeline_health_metrics"]
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema.fields], *also)


def batch_metrics(stats: DataFrame) -> DataFrame:
    """One health metric per batch: its size, with outcome counts and mean latency as details."""
    average = F.coalesce(
        F.round(F.try_divide(F.col("latency_total").cast("decimal(20,0)"), F.col("valid").cast("decimal(20,0)")), 2),
        F.lit(0),
    ).cast("double")
    details = F.to_json(
        F.struct(
            F.col("valid"),
            F.col("quarantined"),
            F.col("duplicates").alias("duplicates_detected"),
            average.alias("avg_latency_ms"),
        )
    )
    return _metric_rows(
        stats,
        F.col("finished_at"),
        BATCH_COMPONENT,
        BATCH_METRIC,
        F.col("processed"),
        "records",
        F.lit("HEALTHY"),
        details,
        F.col("batch_id"),
        ("batch_id",),
    )


def _row_count(table: DataFrame, name: str) -> Column:
    return table.agg(F.count("*")).scalar().alias(name)


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of the main tables and the mean ingest latency, as one row."""
    facts = tables["fact_orders"].agg(
        F.count("*").alias("fact_orders"),
        F.sum("ingest_latency_ms").alias("_latency"),
        F.count("ingest_latency_ms").alias("_timed"),
    )
    others = ["fact_order_items", "dim_customers", "dim_products", "quarantine_orders"]
    return facts.select(
        "fact_orders",
        *[_row_count(tables[n], n) for n in others],
        mean(F.col("_latency"), F.col("_timed")).alias("avg_latency_ms"),
    )


def warehouse_heartbeat(
    tables: Mapping[str, DataFrame], as_of: Column, latency_ms: float = 0.0, status: str = "HEALTHY"
) -> DataFrame:
    """A heartbeat metric with fact and quarantine counts as details."""
    counts = tables["fact_orders"].agg(F.count("*").alias("fact_orders_count")).select(
        "fact_orders_count",
        _row_count(tables["fact_order_items"], "items_count"),
        _row_count(tables["quarantine_orders"], "quarantine_count"),
    )
    details = F.to_json(F.struct("fact_orders_count", "items_count", "quarantine_count"))
    return _metric_rows(
        counts,
        as_of,
        HEARTBEAT_COMPONENT,
        HEARTBEAT_METRIC,
        F.lit(latency_ms),
        "ms",
        F.lit(status),
        details,
        as_of,
    )


def recent_batch_metrics(metrics: DataFrame, limit: int = 15) -> DataFrame:
    return (
        metrics.where(F.col("metric_name") == BATCH_METRIC)
        .orderBy(F.col("timestamp").desc(), "metric_id")
        .limit(limit)
        .select("timestamp", "metric_value", "details")
    )


def audit_history(audit_log: DataFrame, limit: int = 20) -> DataFrame:
    """The newest audit results."""
    return (
        audit_log.orderBy(F.col("audit_timestamp").desc(), "check_type")
        .limit(limit)
        .select(
            "check_name",
            "check_type",
            "table_audited",
            "records_evaluated",
            "records_passed",
            "records_failed",
            "pass_rate",
            "status",
            "audit_timestamp",
        )
    )


def worker_active(metrics: DataFrame, as_of: Column, within_seconds: int = 12) -> DataFrame:
    """Whether any ingest batch reported within the last seconds, as one row."""
    recent = metrics.where(
        (F.col("component") == BATCH_COMPONENT)
        & (F.col("timestamp") >= as_of - F.expr(f"INTERVAL {within_seconds} SECONDS"))
    ).limit(1)
    return recent.agg((F.count("*") > 0).alias("active"))


def table_freshness(stamps: Mapping[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Newest timestamp per table and its age in seconds."""

    def one(name: str, table: DataFrame, column: str) -> DataFrame:
        newest = table.agg(F.max(column).alias("last_update"))
        return newest.select(
            F.lit(name).alias("table_name"),
            "last_update",
            (F.unix_seconds(as_of) - F.unix_seconds("last_update")).alias("age_seconds"),
        )

    return reduce(DataFrame.unionByName, [one(n, t, c) for n, (t, c) in stamps.items()])
