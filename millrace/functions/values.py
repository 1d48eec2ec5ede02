"""Numbers and text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def missing(column: Column) -> Column:
    """NULL and the empty string both count as not given."""
    return F.coalesce(column, F.lit("")) == ""


def percent(part: Column, whole: Column, digits: int, empty: float) -> Column:
    """``part / whole * 100`` rounded half up in decimal arithmetic, ``empty`` when whole is 0."""
    ratio = F.try_divide(part.cast("decimal(20,0)") * F.lit(100), whole.cast("decimal(20,0)"))
    return F.coalesce(F.round(ratio, digits), F.lit(empty).cast("decimal(6,2)")).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Exact decimal sum divided by the row count as double; NULL for no rows."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def surrogate_key(*parts: Column) -> Column:
    """A 64-bit key that is the same every time the same batch is written.

    Being a hash it may repeat in tables of billions of rows. Nothing here joins on it: the
    natural keys it is made of stay unique.
    """
    return F.xxhash64(*parts)
