"""Stored results: the hourly mart, the audit log and pipeline metrics."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.model import TABLES
from millrace.sources.tables import ATTEMPT, BATCH, BatchStore, clock_number

MART, AUDITS, METRICS = "hourly_order_aggregates", "data_quality_audit_log", "pipeline_health_metrics"
#: The time that a row belongs to, and the folder of its month.
TIMES = {MART: "hourly_window_start", AUDITS: "audit_timestamp", METRICS: "timestamp"}
MONTH = "month"


def month_of(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


class ResultStore:
    """Tables that runs append to. A mart hour is replaced by writing it again: readers take its last row.

    Every run of a table has a folder and a marker of its own, numbered by the clock and told apart by a random name. Nothing is read
    before a run is written, so any number of runs may be written at once and all are seen. Within a run rows lie in folders
    by month (a month of the mart is some 720 rows), which filters on the time prune.
    """

    def __init__(self, spark: SparkSession, root: str):
        month = T.StructField(MONTH, T.StringType())
        self.stores = {
            name: BatchStore(spark, f"{root.rstrip('/')}/{name}", {name: T.StructType([*TABLES[name].fields, month])})
            for name in (MART, AUDITS, METRICS)
        }

    def append(self, table: str, rows: DataFrame, stamp: Column) -> int:
        """Add the rows of one run; they are seen once they are all there. Returns the number of the run."""
        store, run, attempt = self.stores[table], clock_number(), BatchStore.new_attempt()
        columns = [f.name for f in TABLES[table].fields]
        placed = rows.select(*columns, month_of(F.col(TIMES[table])).alias(MONTH)).hint("rebalance", MONTH)
        store.write(table, placed, run, attempt, [MONTH])
        store.commit(run, attempt, stamp, 0)
        return run

    def _rows(self, table: str, months: Iterable[str] | None) -> DataFrame:
        """Rows of all finished runs with the number of their run, of the given months alone if there are any given."""
        store = self.stores[table]
        # Two runs of the same instant have names of their own, so it is not the latest of a number that counts but each.
        runs = store.runs().select(BATCH, ATTEMPT)
        rows = store.raw(table)
        if months is not None:
            rows = rows.where(F.col(MONTH).isin(list(months)))
        return rows.join(F.broadcast(runs), [BATCH, ATTEMPT], "left_semi").drop(MONTH)

    def replace_hours(self, rows: DataFrame, stamp: Column) -> int:
        """Write mart hours; those that are stored already are replaced."""
        return self.append(MART, rows, stamp)

    def mart(self, months: Iterable[str] | None = None) -> DataFrame:
        """One row per hour, of all months or of those given as yyyy-MM."""
        columns = [f.name for f in TABLES[MART].fields]
        last = F.max_by(F.struct(*columns), F.struct(BATCH, ATTEMPT)).alias("last")
        return self._rows(MART, months).groupBy("hourly_window_start").agg(last).select("last.*")

    def audit_log(self, months: Iterable[str] | None = None) -> DataFrame:
        return self._rows(AUDITS, months).drop(BATCH, ATTEMPT)

    def metrics(self, months: Iterable[str] | None = None) -> DataFrame:
        return self._rows(METRICS, months).drop(BATCH, ATTEMPT)
