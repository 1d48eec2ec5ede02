"""Totals, calendar, contract, audits, reports and connector options on small inputs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import item, order_event
from millrace.model import TABLES
from millrace.operators import audits, contract, dimensions as dims, facts
from millrace.operators.decode import decode_events
from millrace.plans import marts, monitoring, reports
from millrace.session import scratch_path
from millrace.sources import connectors, events as ev, tables as tb

ORDER = "order_id string, customer_id string, location_id string, payment_method_id string, order_status string, " \
    "total_amount decimal(12,2), discount_amount decimal(12,2), tax_amount decimal(12,2), net_amount decimal(12,2), " \
    "item_count int, order_timestamp timestamp, processed_at timestamp, ingest_latency_ms long"


def orders_of(spark, *rows):
    base = {
        "order_id": "O", "customer_id": "C1", "location_id": "L1", "payment_method_id": "PAY-APPLE", "order_status": "PENDING",
        "total_amount": "10.00", "discount_amount": "0.00", "tax_amount": "0.00", "net_amount": "10.00", "item_count": 1,
        "order_timestamp": "2026-01-15 10:10:00", "processed_at": "2026-01-15 10:10:01", "ingest_latency_ms": 1000,
    }
    names = list(base)
    values = [tuple((base | r)[n] for n in names) for r in rows]
    text = ", ".join(f"{n} string" for n in names)
    frame = spark.createDataFrame([tuple(None if v is None else str(v) for v in row) for row in values], text)
    return frame.select(*[F.col(n).cast(t).alias(n) for n, t in (c.split() for c in ORDER.split(", "))])


def test_totals_follow_the_order_arithmetic(spark):
    rows = [("o", 2, Decimal("6998.00"), Decimal("100.00"))]
    items = spark.createDataFrame(rows, "order_id string, quantity int, total_item_price decimal(12,2), discount_applied decimal(12,2)")
    total = facts.order_totals(items).first()
    assert (total["tax_amount"], total["net_amount"]) == (Decimal("551.84"), Decimal("7449.84"))
    nested = items.groupBy("order_id").agg(F.collect_list(F.struct("quantity", "total_item_price", "discount_applied")).alias("items"))
    assert facts.order_totals_in_place(nested).drop("items").first().asDict() == total.asDict()


def test_discount_above_gross_is_not_taxed_below_zero(spark):
    items = spark.createDataFrame([("o", 1, Decimal("1.00"), Decimal("5.00"))], "order_id string, quantity int, total_item_price decimal(12,2), discount_applied decimal(12,2)")
    assert facts.order_totals(items).first()["tax_amount"] == Decimal("0.00")


def test_line_prices(spark):
    lines = spark.createDataFrame([(3, Decimal("9.99"), True), (3, Decimal("9.99"), False)], "quantity int, unit_price decimal(12,2), off boolean")
    rows = facts.price_lines(lines, F.col("off")).collect()
    assert [(r["total_item_price"], r["discount_applied"]) for r in rows] == [
        (Decimal("29.97"), Decimal("3.00")), (Decimal("29.97"), Decimal("0.00")),
    ]


def test_calendar(spark):
    days = dims.calendar_around(spark, "2024-02-28", 60).orderBy("date_key").collect()
    assert len(days) == 60
    leap = days[1].asDict()
    assert leap["date_key"] == 20240229 and leap["day_name"] == "Thursday" and leap["month_name"] == "February"
    assert (leap["day_of_week"], leap["quarter"], leap["is_weekend"]) == (4, 1, False)
    assert [d["is_weekend"] for d in days[3:5]] == [True, True]


def test_contract(messages):
    cases = [
        (order_event(), []),
        (order_event(order_status=..., event_id=...), []),
        (order_event(customer_id=None, item_count=0), ["customer_id", "item_count"]),
        (order_event(items=[]), ["items"]),
        (order_event(items=[item(quantity=0), item(unit_price=-1)]), ["items.quantity", "items.unit_price"]),
        (order_event(total_amount=-1, net_amount=-1, tax_amount=-1), ["total_amount", "tax_amount", "net_amount"]),
    ]
    rows = contract.contract_violations(decode_events(messages(*[c for c, _ in cases]))).orderBy("seq").collect()
    assert [r["violations"] for r in rows] == [v for _, v in cases]


def test_contract_defaults_are_the_same_on_every_run(messages):
    raw = messages(order_event(event_id=..., order_id=..., order_status=..., discount_amount=..., order_timestamp=..., metadata=...))
    filled = contract.apply_contract_defaults(decode_events(raw), F.col("received_at"))
    one, two = filled.first(), filled.first()
    assert one == two
    assert one["order_id"].startswith("ORD-") and len(one["order_id"]) == 14
    assert (one["order_status"], one["discount_amount"], one["metadata"]) == ("PENDING", 0.0, {})
    assert one["order_timestamp"] == "2026-01-15T11:00:01Z"
    random = contract.apply_contract_defaults(decode_events(raw), F.col("received_at"), random_ids=True)
    assert random.first()["event_id"] != one["event_id"]


def test_null_audit_counts_cells_and_rows(spark):
    orders = orders_of(spark, {"order_id": None, "customer_id": None}, {"order_id": "b", "total_amount": None}, {"order_id": "c"})
    row = audits.null_checks(orders).first()
    assert (row["records_evaluated"], row["records_failed"], row["rows_failed"], row["records_passed"]) == (3, 3, 2, 0)
    assert (row["pass_rate"], row["status"]) == (0.0, "FAILED")


def test_audits_of_an_empty_table_leave_no_row(spark):
    orders = orders_of(spark, {}).limit(0)
    key = lambda name: spark.createDataFrame([("x",)], f"{name} string")
    suite = audits.audit_suite(orders, key("customer_id"), key("location_id"), key("payment_method_id"), strict=True)
    assert suite.count() == 0


def test_referential_audit(spark):
    orders = orders_of(spark, {"customer_id": "X", "location_id": "Y"}, {"customer_id": "X"}, {})
    one = lambda name, v: spark.createDataFrame([(v,)], f"{name} string")
    row = audits.referential_checks(orders, one("customer_id", "C1"), one("location_id", "L1"), one("payment_method_id", "PAY-APPLE")).first()
    assert (row["records_failed"], row["rows_failed"], row["pass_rate"]) == (3, 2, 0.0)
    assert row["details"] == '{"total_orders":3,"orphan_customers":2,"orphan_locations":1,"orphan_payments":0}'


def test_financial_audit_is_exact_at_the_tolerance(spark):
    orders = orders_of(spark, {"net_amount": "10.05"}, {"net_amount": "10.06"}, {"net_amount": "99", "tax_amount": None})
    row = audits.financial_checks(orders).first()
    assert (row["records_failed"], row["pass_rate"]) == (1, 66.67)


def test_live_rate_chain(spark, as_of):
    orders = orders_of(spark, *[{"order_id": str(n), "processed_at": "2026-01-15 11:59:50"} for n in range(50)])
    empty = spark.createDataFrame([], TABLES["pipeline_health_metrics"])
    assert reports.live_ingest_rate(orders, empty, as_of).first()[0] == 1.7
    assert reports.live_ingest_rate(orders.limit(0), empty, as_of).first()[0] == 0.0
    stats = spark.createDataFrame(
        [(4, 10, 9, 1, 0, 90)], "batch_id long, processed long, valid long, quarantined long, duplicates long, latency_total long"
    ).withColumn("finished_at", as_of)
    metrics = monitoring.batch_metrics(stats)
    assert reports.live_ingest_rate(orders.limit(0), metrics, as_of).first()[0] == 3.3
    assert monitoring.worker_active(metrics, as_of + F.expr("INTERVAL 12 SECONDS")).first()["active"]
    assert not monitoring.worker_active(metrics, as_of + F.expr("INTERVAL 13 SECONDS")).first()["active"]


def test_kpis_of_nothing(spark):
    orders = orders_of(spark, {}).limit(0)
    quarantine = spark.createDataFrame([], TABLES["quarantine_orders"])
    row = reports.executive_kpis(orders, quarantine).first()
    assert row.asDict() == {
        "total_orders": 0, "total_revenue": 0.0, "avg_order_value": 0.0, "total_items_sold": 0, "delivered_orders": 0,
        "cancelled_orders": 0, "quarantined_count": 0, "delivery_rate": 0.0,
    }
    assert reports.validation_pass_rate(orders, quarantine).first()["pass_rate"] == 100.0


def test_hourly_mart(spark, as_of):
    orders = orders_of(
        spark, {"order_id": "a", "order_status": "DELIVERED"}, {"order_id": "b", "net_amount": "0.01"},
        {"order_id": "c", "order_timestamp": "2026-01-15 11:00:00", "order_status": "CANCELLED"},
    )
    quarantine = spark.createDataFrame([], TABLES["quarantine_orders"])
    mart = marts.hourly_rollup(orders, quarantine, as_of)
    assert mart.schema.simpleString() == TABLES["hourly_order_aggregates"].simpleString()
    rows = {str(r["hourly_window_start"]): r for r in mart.collect()}
    first = rows["2026-01-15 10:00:00"]
    assert (first["total_orders"], str(first["avg_order_value"]), first["successful_orders"]) == (2, "5.01", 1)


def test_snapshot_of_more_revenue_than_an_hour_can_hold(spark, as_of):
    orders = spark.range(200).selectExpr(
        "concat('ORD-', id) AS order_id", "CAST('9999999999.99' AS DECIMAL(12,2)) AS net_amount", "1 AS item_count", "'DELIVERED' AS order_status"
    )
    row = marts.rollup_snapshot(orders, spark.range(3), as_of).first()
    assert (row["total_orders"], str(row["total_revenue"]), str(row["avg_order_value"])) == (200, "1999999999998.00", "9999999999.99")


def test_histogram_edges(spark):
    rows = [{"order_id": str(n), "ingest_latency_ms": n} for n in range(101)]
    bins = {r["bin"]: r["order_count"] for r in reports.latency_histogram(orders_of(spark, *rows)).collect()}
    assert len(bins) == 20 and bins[20] == 6 and sum(bins.values()) == 101
    same = reports.latency_histogram(orders_of(spark, {}, {"order_id": "p"})).collect()
    assert [(r["bin"], r["order_count"]) for r in same] == [(1, 2)]


def test_histogram_and_kpis_need_no_wide_shuffle(spark):
    plan = reports.latency_histogram(orders_of(spark, {}))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_counted_write_and_missing_table(spark):
    path = scratch_path(spark, "counted")
    assert tb.write_counted(spark.range(37), path) == 37
    assert spark.read.parquet(path).count() == 37
    schema = TABLES["dim_dates"]
    assert tb.read_table(spark, scratch_path(spark, "absent"), schema).count() == 0


def test_parameter_scan_binds_values(spark):
    rows = tb.parameter_scan(
        spark, "SELECT order_id FROM {t} WHERE order_id = :id", {"t": orders_of(spark, {"order_id": "x' OR 1=1"}, {})}, id="x' OR 1=1"
    ).collect()
    assert [r[0] for r in rows] == ["x' OR 1=1"]


def test_catalog_defaults(spark, as_of):
    rows = spark.createDataFrame([("C", "N", "m@x")], "customer_id string, customer_name string, email string")
    row = dims.conform(rows, "dim_customers", as_of).first()
    assert (row["segment"], row["is_active"], row["city"]) == ("Standard", True, None)
    assert str(row["created_at"]) == "2026-01-15 12:00:00"
    assert tb.catalog_columns(spark).where("table_name = 'fact_orders' AND NOT nullable").count() == 10


def test_connector_options():
    source = connectors.kafka_source("b:9092", max_per_trigger=50)
    assert source["subscribe"] == "raw_orders" and source["failOnDataLoss"] == "false"
    assert source["maxOffsetsPerTrigger"] == "50" and "kafka.security.protocol" not in source
    secured = connectors.kafka_sink("b:9092", protocol="sasl_ssl", mechanism="SCRAM-SHA-256", username="u", password="p")
    assert secured["kafka.security.protocol"] == "SASL_SSL"
    assert "ScramLoginModule" in secured["kafka.sasl.jaas.config"]
    assert connectors.jdbc_url("postgres://u:p@db.host:6543/shop") == "jdbc:postgresql://db.host:6543/shop"
    assert connectors.jdbc_url("postgresql+psycopg2://u:p@h/x") == "jdbc:postgresql://h:5432/x"
    assert connectors.jdbc_url(host="h", database="d") == "jdbc:postgresql://h:5432/d"
    table = connectors.jdbc_table("u", "t", "me", "pw", "id", ("0", "9"), 4)
    assert table["numPartitions"] == "4"


def test_kafka_messages_become_raw_events(spark):
    rows = [(b"k", b'{"a":1}', 3, 7)]
    frame = spark.createDataFrame(rows, "key binary, value binary, partition int, offset long").withColumn(
        "timestamp", F.lit("2026-01-15 11:00:00").cast("timestamp")
    )
    row = ev.from_kafka(frame).first()
    assert (row["value"], row["seq"]) == ('{"a":1}', 3 * 2**48 + 7)
