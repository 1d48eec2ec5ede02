"""Dimension rows: inferred from events, seeded from lookups, and the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.model import COLUMN_DEFAULTS, MONEY, TABLES

# --- Fixed values: what an inferred dimension row holds -----------------------------------
INFERRED_SEGMENT = "Standard"
UNKNOWN_PLACE = "Unknown"
GENERAL_CATEGORY = "General"
INFERRED_SUPPLIER = "SUPP-AUTO"
INFERRED_STOCK = 1000
COST_SHARE = "0.70"
PAYMENT_PREFIX = "PAY-"
# --- end of fixed values ------------------------------------------------------------------

DEFAULT_MAIL_DOMAIN = "customers.invalid"


def conform(rows: DataFrame, table: str, loaded_at: Column) -> DataFrame:
    """Columns, types and defaults of a table; columns not given take their default or NULL."""
    defaults = COLUMN_DEFAULTS.get(table, {})

    def value(name: str) -> Column:
        default = defaults.get(name)
        fallback = loaded_at if default == "now" else F.lit(default)
        if name not in rows.columns:
            return fallback
        return F.col(name) if default is None else F.coalesce(F.col(name), fallback)

    return rows.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])


def _new_keys(orders: DataFrame, key: str, known: DataFrame | None) -> DataFrame:
    keys = orders.select(key).distinct()
    # Keys lie by their hash already, so only those known are shuffled; as many as they are, they aren't broadcast.
    return keys if known is None else keys.join(known.select(key).hint("merge"), key, "left_anti")


def infer_customers(
    orders: DataFrame, known: DataFrame | None = None, mail_domain: str = DEFAULT_MAIL_DOMAIN
) -> DataFrame:
    key = F.col("customer_id")
    return _new_keys(orders, "customer_id", known).select(
        "customer_id",
        F.concat(F.lit("Customer "), key).alias("customer_name"),
        F.concat(F.lower(key), F.lit("@"), F.lit(mail_domain)).alias("email"),
        F.lit(INFERRED_SEGMENT).alias("segment"),
    )


def infer_locations(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return _new_keys(orders, "location_id", known).select(
        "location_id", F.lit(UNKNOWN_PLACE).alias("city"), F.lit(UNKNOWN_PLACE).alias("country")
    )


def infer_payment_methods(orders: DataFrame, known: DataFrame | None = None) -> DataFrame:
    kind = F.regexp_replace("payment_method_id", f"^{PAYMENT_PREFIX}", "")
    return _new_keys(orders, "payment_method_id", known).select(
        "payment_method_id", kind.alias("method_type"), kind.alias("provider")
    )


def cost_of(price: Column) -> Column:
    return F.round(price * F.lit(COST_SHARE).cast("decimal(4,2)"), 2).cast(MONEY)


def infer_products(items: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Products seen in line items; the price is that of the first line that named them."""
    priced = items.groupBy("product_id").agg(
        F.min_by("unit_price", F.struct("batch_id", "seq", "line_no")).alias("base_price")
    )
    if known is not None:
        # One row per product by now, so a best-seller is no hot key of this join.
        priced = priced.join(known.select("product_id").hint("merge"), "product_id", "left_anti")
    return priced.select(
        "product_id",
        F.concat(F.lit("Product "), F.col("product_id")).alias("product_name"),
        F.lit(GENERAL_CATEGORY).alias("category"),
        F.lit(GENERAL_CATEGORY).alias("subcategory"),
        "base_price",
        cost_of(F.col("base_price")).alias("cost_price"),
        F.lit(INFERRED_SUPPLIER).alias("supplier_id"),
        F.lit(INFERRED_STOCK).alias("inventory_count"),
    )


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between two date columns of a single-row frame."""
    days = bounds.select(F.explode(F.sequence(F.col(first), F.col(last))).alias("full_date"))
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.month(day).alias("month_num"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        weekday.isin(6, 7).alias("is_weekend"),
    )


def calendar_around(spark: SparkSession, start: str, days: int = 60) -> DataFrame:
    """A calendar of ``days`` days from an ISO date."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first"), F.date_add(F.lit(start).cast("date"), days - 1).alias("last")
    )
    return calendar(bounds, "first", "last")
