"""Wire format, table schemas and code lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: identifiers and labels that results must carry exactly -----------------
PAYMENT_METHOD_IDS = [
    "PAY-CC-VISA",
    "PAY-CC-MC",
    "PAY-CC-AMEX",
    "PAY-DC-VISA",
    "PAY-PAYPAL",
    "PAY-APPLE",
    "PAY-GOOGLE",
    "PAY-KLARNA",
    "PAY-CRYPTO",
]
ORDER_STATUSES = ["PENDING", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "REFUNDED"]
DEFAULT_STATUS = "PENDING"
PAYMENT_METHOD_ROWS = [
    ("PAY-CC-VISA", "Credit Card", "Visa"),
    ("PAY-CC-MC", "Credit Card", "Mastercard"),
    ("PAY-CC-AMEX", "Credit Card", "American Express"),
    ("PAY-DC-VISA", "Debit Card", "Visa Debit"),
    ("PAY-PAYPAL", "Digital Wallet", "PayPal"),
    ("PAY-APPLE", "Digital Wallet", "Apple Pay"),
    ("PAY-GOOGLE", "Digital Wallet", "Google Pay"),
    ("PAY-KLARNA", "BNPL", "Klarna"),
    ("PAY-CRYPTO", "Cryptocurrency", "BitPay"),
]
BATCH_METRIC = "BATCH_RECORDS_PROCESSED"
BATCH_COMPONENT = "SPARK"
HEARTBEAT_METRIC = "WAREHOUSE_HEARTBEAT"
HEARTBEAT_COMPONENT = "AIRFLOW"
# --- end of fixed values ------------------------------------------------------------------

MONEY = T.DecimalType(12, 2)

WIRE_ITEM = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("total_item_price", T.DoubleType()),
        T.StructField("discount_applied", T.DoubleType()),
    ]
)

WIRE_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("location_id", T.StringType()),
        T.StructField("payment_method_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("items", T.ArrayType(WIRE_ITEM)),
        T.StructField("item_count", T.IntegerType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("tax_amount", T.DoubleType()),
        T.StructField("net_amount", T.DoubleType()),
        T.StructField("order_timestamp", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)

# A raw message as it arrives: the payload plus its place in the stream.
RAW_EVENT = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("received_at", T.TimestampType()),
    ]
)

FACT_ITEM = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", MONEY),
        T.StructField("total_item_price", MONEY),
        T.StructField("discount_applied", MONEY),
    ]
)


def _table(*columns: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in columns])


_S, _I, _L, _B, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()

TABLES: dict[str, T.StructType] = {
    "dim_customers": _table(
        ("customer_id", _S, False),
        ("customer_name", _S, False),
        ("email", _S, False),
        ("segment", _S),
        ("city", _S),
        ("country", _S),
        ("signup_date", _TS),
        ("is_active", _B),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "dim_products": _table(
        ("product_id", _S, False),
        ("product_name", _S, False),
        ("category", _S, False),
        ("subcategory", _S),
        ("base_price", MONEY, False),
        ("cost_price", MONEY, False),
        ("supplier_id", _S),
        ("inventory_count", _I),
        ("created_at", _TS),
        ("updated_at", _TS),
    ),
    "dim_locations": _table(
        ("location_id", _S, False),
        ("city", _S, False),
        ("state", _S),
        ("country", _S, False),
        ("postal_code", _S),
        ("region", _S),
        ("latitude", T.DecimalType(9, 6)),
        ("longitude", T.DecimalType(9, 6)),
        ("created_at", _TS),
    ),
    "dim_payment_methods": _table(
        ("payment_method_id", _S, False),
        ("method_type", _S, False),
        ("provider", _S),
        ("is_active", _B),
    ),
    "dim_dates": _table(
        ("date_key", _I, False),
        ("full_date", T.DateType(), False),
        ("day_of_week", _I, False),
        ("day_name", _S, False),
        ("month_num", _I, False),
        ("month_name", _S, False),
        ("quarter", _I, False),
        ("year", _I, False),
        ("is_weekend", _B, False),
    ),
    "fact_orders": _table(
        ("order_id", _S, False),
        ("event_id", _S, False),
        ("customer_id", _S, False),
        ("location_id", _S, False),
        ("payment_method_id", _S, False),
        ("order_status", _S, False),
        ("total_amount", MONEY, False),
        ("discount_amount", MONEY),
        ("tax_amount", MONEY),
        ("net_amount", MONEY, False),
        ("item_count", _I, False),
        ("order_timestamp", _TS, False),
        ("processed_at", _TS),
        ("ingest_latency_ms", _L),
    ),
    "fact_order_items": _table(
        ("order_item_id", _L, False),
        ("order_id", _S, False),
        ("product_id", _S, False),
        ("quantity", _I, False),
        ("unit_price", MONEY, False),
        ("total_item_price", MONEY, False),
        ("discount_applied", MONEY),
        ("created_at", _TS),
    ),
    "quarantine_orders": _table(
        ("quarantine_id", _L, False),
        ("event_id", _S),
        ("order_id", _S),
        ("raw_payload", _S),
        ("error_code", _S, False),
        ("rejection_reason", _S, False),
        ("failed_validation_rule", _S, False),
        ("quarantined_at", _TS),
    ),
    "data_quality_audit_log": _table(
        ("audit_id", _L, False),
        ("check_name", _S, False),
        ("check_type", _S, False),
        ("table_audited", _S, False),
        ("records_evaluated", _L, False),
        ("records_passed", _L, False),
        ("records_failed", _L, False),
        ("pass_rate", T.DecimalType(6, 2), False),
        ("status", _S, False),
        ("audit_timestamp", _TS),
        ("details", _S),
    ),
    "pipeline_health_metrics": _table(
        ("metric_id", _L, False),
        ("timestamp", _TS),
        ("component", _S, False),
        ("metric_name", _S, False),
        ("metric_value", T.DecimalType(14, 4), False),
        ("metric_unit", _S, False),
        ("status_indicator", _S),
        ("details", _S),
    ),
    "hourly_order_aggregates": _table(
        ("hourly_window_start", _TS, False),
        ("hourly_window_end", _TS, False),
        ("total_orders", _L, False),
        ("total_revenue", T.DecimalType(14, 2), False),
        ("avg_order_value", MONEY, False),
        ("total_items_sold", _L, False),
        ("successful_orders", _L, False),
        ("cancelled_orders", _L, False),
        ("quarantined_orders", _L, False),
        ("updated_at", _TS),
    ),
}

# Values a column takes when a writer leaves it out; "now" stands for the load time.
COLUMN_DEFAULTS: dict[str, dict[str, object]] = {
    "dim_customers": {
        "segment": "Standard",
        "signup_date": "now",
        "is_active": True,
        "created_at": "now",
        "updated_at": "now",
    },
    "dim_products": {"inventory_count": 1000, "created_at": "now", "updated_at": "now"},
    "dim_locations": {"created_at": "now"},
    "dim_payment_methods": {"is_active": True},
    "fact_orders": {"discount_amount": 0, "tax_amount": 0, "processed_at": "now", "ingest_latency_ms": 0},
    "fact_order_items": {"discount_applied": 0, "created_at": "now"},
    "quarantine_orders": {"quarantined_at": "now"},
    "data_quality_audit_log": {"audit_timestamp": "now"},
    "pipeline_health_metrics": {"timestamp": "now", "status_indicator": "HEALTHY"},
    "hourly_order_aggregates": {
        "total_orders": 0,
        "total_revenue": 0,
        "avg_order_value": 0,
        "total_items_sold": 0,
        "successful_orders": 0,
        "cancelled_orders": 0,
        "quarantined_orders": 0,
        "updated_at": "now",
    },
}

PRIMARY_KEYS = {
    "dim_customers": "customer_id",
    "dim_products": "product_id",
    "dim_locations": "location_id",
    "dim_payment_methods": "payment_method_id",
    "dim_dates": "date_key",
    "fact_orders": "order_id",
    "fact_order_items": "order_item_id",
    "quarantine_orders": "quarantine_id",
    "data_quality_audit_log": "audit_id",
    "pipeline_health_metrics": "metric_id",
    "hourly_order_aggregates": "hourly_window_start",
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "location_id", "dim_locations", "location_id"),
    ("fact_orders", "payment_method_id", "dim_payment_methods", "payment_method_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
]

# Columns that a repeated dimension load refreshes; all others keep what was stored first.
DIMENSION_UPDATES = {
    "dim_payment_methods": ["method_type", "provider"],
    "dim_locations": ["city", "state", "country"],
    "dim_products": ["base_price", "cost_price", "inventory_count"],
    "dim_customers": ["segment", "email"],
    "dim_dates": [],
}

# Columns of an order that a later version of it replaces; the rest keep their first value.
ORDER_UPDATES = ["order_status", "processed_at", "ingest_latency_ms"]
ORDER_FIXED = [
    f.name for f in TABLES["fact_orders"].fields if f.name not in ORDER_UPDATES and f.name != "order_id"
]
