"""A running total over a whole table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import ensure_checkpoint_dir

#: Rows of a slice, about; the number of slices follows the table.
SLICE_ROWS = 500_000


def running_total(
    rows: DataFrame, order_by: list[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows up to and including each one.

    Rows are range-partitioned on the full sort key, which must be unique, so that ties and
    busy periods are cut too. The cut is written to the checkpoint folder: range bounds come
    from a sample, and slice numbers must not change when a lost task is run again. Slice
    totals (one row per slice) are then accumulated and added to the running sum inside
    each slice.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    count = slices or -(-rows.count() // SLICE_ROWS) or 1
    sliced = (
        rows.repartitionByRange(count, *order_by)
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint()
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.sum(value).alias("_total"))
        .select("_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    # The offsets have one row per slice, so their size is bounded by ``count``.
    return (
        sliced.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_slice")
        .select(*rows.columns, (F.col("_inside") + F.col("_offset")).alias(name))
    )
