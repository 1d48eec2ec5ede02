"""Progress of streams as rows of the metric table."""

from __future__ import annotations

import json
import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.functions.values import surrogate_key
from millrace.model import BATCH_COMPONENT, TABLES
from millrace.plans.results import METRICS, ResultStore

#: A metric row per trigger for the rows it took in and for their number a second.
ROWS_METRIC, RATE_METRIC = "STREAM_TRIGGER_ROWS", "STREAM_ROWS_PER_SECOND"


class ProgressMetrics(StreamingQueryListener):
    """Keeps the progress of every trigger of a session's streams until it is stored.

    Spark calls it on a thread of its own, so that it only notes what it is told; ``store`` writes it. Counts that
    a stream observes on its way go into the details. What is held is a few numbers per trigger since the last call of ``store``.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._rows: list[tuple] = []
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        details = json.dumps({"query": str(p.id), "name": p.name, "trigger": p.batchId, "duration_ms": p.batchDuration, "observed": observed}, default=str)
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).astimezone(timezone.utc)
        with self._lock:
            for name, value, unit in ((ROWS_METRIC, p.numInputRows, "records"), (RATE_METRIC, p.processedRowsPerSecond, "records/s")):
                self._rows.append((at, name, float(value or 0), unit, details, str(p.runId), int(p.batchId)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def _end_of(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def wait_for(self, query, seconds: float = 30) -> None:
        """Until all that a stream that has ended has reported is here."""
        self._end_of(str(query.runId)).wait(seconds)

    def rows(self, most: int | None = None) -> DataFrame:
        """What is held, or the first of it, as metric rows."""
        with self._lock:
            held = self._rows[:most]
        shape = "timestamp timestamp, metric_name string, metric_value double, metric_unit string, details string, run string, trigger long"
        values = {
            "metric_id": surrogate_key(F.col("metric_name"), F.col("run"), F.col("trigger")),
            "component": F.lit(BATCH_COMPONENT),
            "status_indicator": F.lit("HEALTHY"),
        }
        frame = self.spark.createDataFrame(held, shape)
        return frame.select(*[values.get(f.name, F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[METRICS].fields])

    def store(self, results: ResultStore, stamp) -> int:
        """Append what is held to the metric table, then forget it. Returns how many rows there were."""
        with self._lock:
            taken = len(self._rows)
        if taken:
            results.append(METRICS, self.rows(taken), stamp)
            with self._lock:
                del self._rows[:taken]
        return taken
