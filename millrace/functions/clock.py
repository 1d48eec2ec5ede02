"""Event time, offsets and latency."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns with doubled braces, as they go through ``str.format``.
_DATE_TIME = r"\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?"
_OFFSET = r"(Z|[+-]\d{{2}}:\d{{2}})"


# Instant of an ISO-8601 text that carries its offset, NULL otherwise.
EVENT_TIME_SQL = "CASE WHEN {0} RLIKE r'^" + _DATE_TIME + _OFFSET + "$' THEN try_to_timestamp({0}) END"

# A well-formed local date-time, which names no instant.
LOCAL_TIME_SQL = "{0} RLIKE r'^" + _DATE_TIME + "$'"


def event_time(column: str) -> Column:
    """Instant named by a text column."""
    return F.expr(EVENT_TIME_SQL.format(column))


# Whole milliseconds from event to processing, never negative.
LATENCY_SQL = "greatest(0L, (unix_micros({1}) - unix_micros({0})) div 1000L)"


def latency_ms(event: str, processed: str) -> Column:
    """Milliseconds between two timestamp columns."""
    return F.expr(LATENCY_SQL.format(event, processed))
