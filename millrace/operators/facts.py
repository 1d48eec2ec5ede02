"""Order facts, line-item facts and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.values import surrogate_key

TAX_RATE = "0.08"
LINE_DISCOUNT_RATE = "0.10"


def line_items_of(log: DataFrame) -> DataFrame:
    """One row per line item of each valid event in the given log rows."""
    exploded = log.where(F.col("items").isNotNull()).select(
        "batch_id",
        "seq",
        "order_id",
        F.col("processed_at").alias("created_at"),
        F.posexplode("items").alias("line_no", "item"),
    )
    return exploded.select(
        surrogate_key(F.col("order_id"), F.col("batch_id"), F.col("seq"), F.col("line_no")).alias("order_item_id"),
        "order_id",
        "line_no",
        F.col("item.product_id").alias("product_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.unit_price").alias("unit_price"),
        F.col("item.total_item_price").alias("total_item_price"),
        F.col("item.discount_applied").alias("discount_applied"),
        "created_at",
        "batch_id",
        "seq",
    )


def _tax(gross: Column, discount: Column, rate: str) -> Column:
    taxable = F.greatest(F.lit(0).cast("decimal(18,2)"), (gross - discount).cast("decimal(18,2)"))
    return F.round(taxable * F.lit(rate).cast("decimal(6,4)"), 2).cast("decimal(18,2)")


def _with_tax_and_net(totals: DataFrame, rate: str) -> DataFrame:
    gross, discount = F.col("total_amount"), F.col("discount_amount")
    taxed = totals.withColumn("tax_amount", _tax(gross, discount, rate))
    return taxed.withColumn("net_amount", (gross - discount + F.col("tax_amount")).cast("decimal(18,2)"))


def order_totals(items: DataFrame, key: str = "order_id", rate: str = TAX_RATE) -> DataFrame:
    """Totals of each order from its line-item rows; sums combine on the map side."""
    totals = items.groupBy(key).agg(
        F.sum("quantity").alias("item_count"),
        F.sum("total_item_price").cast("decimal(18,2)").alias("total_amount"),
        F.sum("discount_applied").cast("decimal(18,2)").alias("discount_amount"),
    )
    return _with_tax_and_net(totals, rate)


def order_totals_in_place(events: DataFrame, rate: str = TAX_RATE) -> DataFrame:
    """Totals of events that still hold their ``items`` array; needs no shuffle."""

    def total(field: str, zero: str) -> Column:
        start = F.lit(0).cast(zero)
        return F.aggregate("items", start, lambda acc, i: (acc + i[field]).cast(zero))

    totals = (
        events.withColumn("item_count", total("quantity", "bigint"))
        .withColumn("total_amount", total("total_item_price", "decimal(18,2)"))
        .withColumn("discount_amount", total("discount_applied", "decimal(18,2)"))
    )
    return _with_tax_and_net(totals, rate)


def price_lines(
    lines: DataFrame, discounted: Column | None = None, rate: str = LINE_DISCOUNT_RATE
) -> DataFrame:
    """Line price = quantity x unit price; discounted lines get a share of it off."""
    price = (F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).cast("decimal(18,2)")
    off = F.round(price * F.lit(rate).cast("decimal(4,2)"), 2).cast("decimal(18,2)")
    flag = F.lit(False) if discounted is None else discounted
    return lines.withColumn("total_item_price", price).withColumn(
        "discount_applied", F.when(flag, off).otherwise(F.lit(0).cast("decimal(18,2)"))
    )
