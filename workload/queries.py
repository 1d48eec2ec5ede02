"""Every registered query, by name, as a function of the warehouse."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.functions.clock import event_time, latency_ms
from millrace.functions.rules import CONSTRAINT_PREFIX, DUPLICATE_EVENT_ID, first_item_fault
from millrace.model import BATCH_METRIC, DIMENSION_UPDATES, PAYMENT_METHOD_ROWS, PRIMARY_KEYS, TABLES
from millrace.operators import audits, contract, dimensions as dims, facts, lookup, versions as ver
from millrace.operators.decode import counted, decode_events
from millrace.operators.validation import classify, quarantine_rows
from millrace.plans import marts, monitoring, reports, results
from millrace.session import scratch_path, together
from millrace.sources import events as ev, tables as tb
from millrace.streaming import windows
from millrace.streaming.telemetry import ROWS_METRIC, ProgressMetrics
from millrace.streaming.ingest import CHANGES, LOG, OrderStore
from workload.stage import Warehouse, warehouse

Query = Callable[[Warehouse], DataFrame]
# The given orders and events lie less than this apart, and any of them may be repeated.
SPAN = "3650 days"

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(rows: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, so that results compare the same everywhere."""

    def flat(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return rows.select(*[flat(f) for f in rows.schema.fields])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(function(warehouse(spark, sf_dir)))

        run.__name__ = function.__name__
        run.__doc__ = function.__doc__
        return run

    return {name: bind(function) for name, function in QUERIES.items()}


ORDER_COLUMNS = [f.name for f in TABLES["fact_orders"].fields]
PLACE = ["batch_id", "seq"]


def decoded(w: Warehouse) -> DataFrame:
    return decode_events(w.raw())


def objects(w: Warehouse) -> DataFrame:
    return counted(decoded(w)).where(F.col("is_object"))


# --- sources and sinks --------------------------------------------------------------------


def _event_stream(w: Warehouse) -> DataFrame:
    schema = w.given("events").schema
    stream = ev.read_stream(w.spark, "parquet", {"pathGlobFilter": "events.parquet"}, schema, w.sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_source_events(w: Warehouse) -> DataFrame:
    """A file stream read to its end and appended to a table."""
    path = scratch_path(w.spark, "stream-source")
    rows = _event_stream(w).select("event_id", "ts", "user_id", "event_type", "value")
    windows.append_stream(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return w.spark.read.parquet(f"{path}/table")


@query
def decode_events_query(w: Warehouse) -> DataFrame:
    """Typed columns of every raw message."""
    return decoded(w).select(
        *PLACE,
        "is_object",
        "event_id",
        "order_id",
        "customer_id",
        "location_id",
        "payment_method_id",
        "order_status",
        "item_count",
        "total_amount",
        "discount_amount",
        "tax_amount",
        "net_amount",
        "order_timestamp",
        F.element_at("metadata", "device").alias("device"),
        F.element_at("metadata", "channel").alias("channel"),
        F.coalesce(F.size("items"), F.lit(0)).alias("items_decoded"),
    )


QUERIES["decode_events"] = QUERIES.pop("decode_events_query")


@query
def stream_bounded_ingest(w: Warehouse) -> DataFrame:
    """Outcome counts of a rate-capped stream that ran until its input was used up."""
    return w.streamed().log().groupBy("outcome").agg(F.count("*").alias("events"))


@query
def stream_ingest_orders(w: Warehouse) -> DataFrame:
    """Current orders after stream ingest."""
    return w.streamed().fact_orders().select(*ORDER_COLUMNS)


@query
def stream_quarantine(w: Warehouse) -> DataFrame:
    """Rejected events after stream ingest."""
    return w.streamed().quarantine().select(
        "event_id", "order_id", "error_code", "failed_validation_rule", "quarantined_at", "seq"
    )


@query
def publish_keyed_events(w: Warehouse) -> DataFrame:
    """Events published as key and JSON value, and read back."""
    path = scratch_path(w.spark, "published")
    outgoing = objects(w).select("seq", "order_id", "event_id", "order_status", "total_amount", "order_timestamp")
    ev.publish(outgoing, "parquet", {}, path)
    sent = F.from_json("value", "seq long, order_id string, event_id string, total_amount double")
    back = w.spark.read.parquet(path).select("key", sent.alias("sent"))
    return back.select(
        "key",
        F.col("sent.seq").alias("seq"),
        F.col("sent.order_id").alias("order_id"),
        F.col("sent.event_id").alias("event_id"),
        F.col("sent.total_amount").alias("total_amount"),
    )


@query
def publish_report(w: Warehouse) -> DataFrame:
    """What became of each published event, by what the sink gives back; every seventh order is not sent."""
    path = scratch_path(w.spark, "reported")
    events = objects(w)
    ev.publish(events.where(F.coalesce(F.regexp_extract("order_id", r"^ORD-(\d+)", 1).cast("long"), F.lit(1)) % 7 != 0), "parquet", {}, path)
    return ev.publish_report(events, "raw_orders", "FILES", w.spark.read.parquet(path)).select(
        "success", "mode", "topic", "order_id", "event_id", "timestamp"
    )


@query
def param_scan(w: Warehouse) -> DataFrame:
    """A table scan with named parameters."""
    text = (
        "SELECT order_id, order_status, net_amount FROM {orders} "
        "WHERE order_status = :status AND net_amount >= :floor"
    )
    return tb.parameter_scan(w.spark, text, {"orders": w.orders()}, status="DELIVERED", floor=100000)


@query
def write_rowcount(w: Warehouse) -> DataFrame:
    """Rows written per table, as counted by the writes."""
    path = scratch_path(w.spark, "counted")
    written = [
        (name, tb.write_counted(rows, f"{path}/{name}"))
        for name, rows in (("fact_orders", w.orders()), ("fact_order_items", w.items()), ("quarantine_orders", w.quarantine()))
    ]
    return w.spark.createDataFrame(written, "table_name string, rows_written long")


@query
def catalog_columns(w: Warehouse) -> DataFrame:
    """Stored columns of all tables with their types, defaults, row and NULL counts."""

    def profile(name: str, rows: DataFrame) -> DataFrame:
        columns = [f.name for f in TABLES[name].fields]
        counts = rows.agg(
            F.count("*").alias("row_count"), *[F.count(c).alias(c) for c in columns]
        )
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])
        return counts.select(F.lit(name).alias("table_name"), "row_count", F.inline(pairs)).select(
            "table_name", "column_name", "row_count", (F.col("row_count") - F.col("filled")).alias("null_count")
        )

    others = {
        "dim_dates": dim_dates(w),
        results.AUDITS: _audit_log(w),
        results.METRICS: w.metrics(),
        results.MART: w.store().hourly_mart(),
    }
    counts = reduce(DataFrame.unionByName, [profile(n, t) for n, t in (w.tables() | others).items()])
    return counts.join(tb.catalog_columns(w.spark).drop("nullable"), ["table_name", "column_name"])


@query
def quarantine_rows_query(w: Warehouse) -> DataFrame:
    """Quarantine rows as stored, payloads kept whole."""
    return w.quarantine().select(
        *PLACE,
        "event_id",
        "order_id",
        "error_code",
        "rejection_reason",
        "failed_validation_rule",
        "quarantined_at",
        F.col("raw_payload").isNotNull().alias("has_payload"),
    )


QUERIES["quarantine_rows"] = QUERIES.pop("quarantine_rows_query")


# --- validation and routing ---------------------------------------------------------------


@query
def validate_events(w: Warehouse) -> DataFrame:
    """The verdict on every event under the rules alone."""
    judged = classify(decoded(w), w.as_of, check_constraints=False)
    return judged.select(
        *PLACE, F.coalesce("error_code", F.lit("VALID")).alias("verdict"), F.col("error_code").isNull().alias("is_valid")
    )


@query
def first_item_error(w: Warehouse) -> DataFrame:
    """The first bad line item of each event that has one."""
    found = counted(objects(w).withColumn("fault", first_item_fault()))
    return found.where(F.col("fault").isNotNull()).select(
        *PLACE,
        F.col("fault.item_index").alias("item_index"),
        F.col("fault.code").alias("error_code"),
        F.col("fault.reason").alias("reason"),
    )


@query
def rejection_reasons(w: Warehouse) -> DataFrame:
    """Reason texts of all rejected events."""
    log = w.log()
    return log.where(F.col("error_code").isNotNull()).select(*PLACE, "rejection_reason")


@query
def route_valid(w: Warehouse) -> DataFrame:
    """Events routed to the facts."""
    return w.log().where(F.col("outcome") == "valid").select(*PLACE, "order_id", "event_id", "net_amount")


@query
def route_quarantine(w: Warehouse) -> DataFrame:
    """Events routed to quarantine by the rules."""
    return quarantine_rows(w.log()).select(
        *PLACE, "event_id", "order_id", "error_code", "failed_validation_rule"
    )


@query
def contract_violations(w: Warehouse) -> DataFrame:
    """Fields of each event that break the producer's contract."""
    return contract.contract_violations(objects(w)).select(*PLACE, "violations")


@query
def contract_defaults(w: Warehouse) -> DataFrame:
    """Events after the producer's defaults; derived identifiers are only checked for presence."""
    filled = contract.apply_contract_defaults(objects(w), F.col("received_at"))
    return filled.select(
        *PLACE,
        (F.col("event_id").isNotNull() & F.col("order_id").isNotNull()).alias("identified"),
        "order_status",
        "discount_amount",
        "tax_amount",
        "order_timestamp",
        F.size("metadata").alias("metadata_entries"),
    )


@query
def constraint_violations(w: Warehouse) -> DataFrame:
    """Events that the rules let pass and a table constraint stopped, by code."""
    return audits.constraint_violations(w.quarantine(), CONSTRAINT_PREFIX, [DUPLICATE_EVENT_ID])


@query
def uniqueness_violations(w: Warehouse) -> DataFrame:
    """Repeated order and event ids among all valid deliveries."""
    log = w.log().where(F.col("outcome") == "valid")
    parts = [
        audits.uniqueness_violations(log, key).select(F.lit(key).alias("key_name"), F.col(key).alias("key_value"), "copies")
        for key in ("order_id", "event_id")
    ]
    return parts[0].unionByName(parts[1])


# --- projections and enrichment -----------------------------------------------------------


@query
def fact_orders(w: Warehouse) -> DataFrame:
    return w.orders().select(*ORDER_COLUMNS)


@query
def fact_order_items(w: Warehouse) -> DataFrame:
    return w.items().select(
        "order_id", "line_no", "product_id", "quantity", "unit_price", "total_item_price", "discount_applied", "created_at"
    )


@query
def parse_event_time(w: Warehouse) -> DataFrame:
    """Event times, falling back to the processing time where none can be read."""
    return decoded(w).select(
        *PLACE, F.coalesce(event_time("order_timestamp"), w.as_of).alias("event_time")
    )


@query
def ingest_latency(w: Warehouse) -> DataFrame:
    """Milliseconds from event to arrival, for events with a readable time."""
    instant = event_time("order_timestamp")
    timed = decoded(w).select(*PLACE, instant.alias("event_time"), "received_at")
    timed = counted(timed).where("event_time IS NOT NULL")
    return timed.select(*PLACE, latency_ms("event_time", "received_at").alias("latency_ms"))


@query
def order_totals_from_items(w: Warehouse) -> DataFrame:
    """Totals of each order recomputed from its line items."""
    return facts.order_totals(w.items())


@query
def order_totals_in_place(w: Warehouse) -> DataFrame:
    """The same totals taken inside each event, without a shuffle."""
    log = w.log().where(F.col("outcome") == "valid").select(*PLACE, "order_id", "items")
    return facts.order_totals_in_place(log).drop("items")


@query
def line_prices(w: Warehouse) -> DataFrame:
    """List price of each line, a tenth off for lines of 25 units and more."""
    lines = w.items().select("order_id", "line_no", "quantity", "unit_price")
    return facts.price_lines(lines, F.col("quantity") >= 25)


@query
def infer_customers(w: Warehouse) -> DataFrame:
    return dims.infer_customers(w.orders(), w.seeds()["dim_customers"])


@query
def infer_locations(w: Warehouse) -> DataFrame:
    return dims.infer_locations(w.orders(), w.seeds()["dim_locations"])


@query
def infer_payment_methods(w: Warehouse) -> DataFrame:
    return dims.infer_payment_methods(w.orders(), w.seeds()["dim_payment_methods"])


@query
def infer_products(w: Warehouse) -> DataFrame:
    return dims.infer_products(w.items(), w.seeds()["dim_products"])


@query
def dim_dates(w: Warehouse) -> DataFrame:
    """The calendar over the range of order dates."""
    day = F.col("order_timestamp").cast("date")
    bounds = w.orders().agg(F.min(day).alias("first"), F.max(day).alias("last")).where("first IS NOT NULL")
    return dims.calendar(bounds, "first", "last")


@query
def seed_dim_upsert(w: Warehouse) -> DataFrame:
    """All five dimensions loaded again with changed values: each refreshes its own columns, new keys come whole."""
    seeds, now = w.seeds(), w.as_of
    price = (F.col("p_retailprice").cast("decimal(12,2)") + 1).cast("decimal(12,2)")
    nation = w.given("nation")
    again = {
        "dim_customers": w.given("customer").select(
            F.concat(F.lit("CUST-"), F.col("c_custkey")).alias("customer_id"),
            F.concat(F.lit("Reloaded "), F.col("c_custkey")).alias("customer_name"),
            F.concat(F.lit("r"), F.col("c_custkey"), F.lit("@customers.invalid")).alias("email"),
            F.lower("c_mktsegment").alias("segment"),
        ),
        "dim_products": w.given("part").select(
            F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"),
            F.concat(F.lit("Reloaded "), F.col("p_partkey")).alias("product_name"),
            F.col("p_type").alias("category"),
            price.alias("base_price"),
            dims.cost_of(price).alias("cost_price"),
            F.lit(500).alias("inventory_count"),
        ),
        "dim_locations": nation.select(
            F.concat(F.lit("LOC-"), F.col("n_nationkey")).alias("location_id"),
            F.concat(F.lit("New "), F.col("n_name")).alias("city"),
            F.lit("S").alias("state"),
            F.lower("n_name").alias("country"),
            F.lit("Elsewhere").alias("region"),
        ),
        "dim_payment_methods": w.spark.createDataFrame(PAYMENT_METHOD_ROWS, "payment_method_id string, method_type string, provider string").select(
            "payment_method_id", F.lower("method_type").alias("method_type"), F.concat(F.lit("by "), F.col("provider")).alias("provider"), F.lit(False).alias("is_active")
        ),
    }
    stored = {n: dims.conform(seeds[n], n, now) for n in again}
    merged = {n: ver.upsert(stored[n], dims.conform(again[n], n, now), PRIMARY_KEYS[n], DIMENSION_UPDATES[n]) for n in again}
    # The calendar of the order dates, then a month more of it: days that are there stay as they are.
    days = dim_dates(w)
    end = F.max("full_date")
    more = dims.calendar(days.agg(F.date_sub(end, 9).alias("first"), F.date_add(end, 30).alias("last")), "first", "last").withColumn("day_name", F.lit("again"))
    merged["dim_dates"] = ver.upsert(days, more, "date_key", DIMENSION_UPDATES["dim_dates"])

    def shown(table: str, name: Column, label: Column, detail: Column, amount: Column | None = None) -> DataFrame:
        return merged[table].select(
            F.lit(table).alias("table_name"),
            F.col(PRIMARY_KEYS[table]).cast("string").alias("key"),
            name.alias("name"),
            label.alias("label"),
            detail.cast("string").alias("detail"),
            (F.lit(None) if amount is None else amount).cast("decimal(12,2)").alias("price"),
        )

    col = F.col
    parts = [
        shown("dim_customers", col("customer_name"), col("segment"), col("email")),
        shown("dim_products", col("product_name"), col("category"), col("inventory_count"), col("base_price")),
        shown("dim_locations", col("city"), col("country"), F.concat_ws("/", "state", "region")),
        shown("dim_payment_methods", col("method_type"), col("provider"), col("is_active")),
        shown("dim_dates", col("day_name"), col("month_name"), col("is_weekend")),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- joins --------------------------------------------------------------------------------


@query
def recent_orders_feed(w: Warehouse) -> DataFrame:
    return reports.recent_orders_feed(w.orders(), *w.order_dimensions())


@query
def order_status_lookup(w: Warehouse) -> DataFrame:
    """The state of every order the tables know of, of some they do not, and of an empty id."""
    known = w.given("orders").select(F.concat(F.lit("ORD-"), F.col("o_orderkey")).alias("order_id"))
    unknown = w.given("supplier").select(F.concat(F.lit("ORD-S"), F.col("s_suppkey")).alias("order_id"))
    empty = w.given("region").select(F.lit("").alias("order_id"))
    requested = known.unionByName(unknown).unionByName(empty)
    found = lookup.order_status(requested, w.orders(), w.quarantine(), *w.order_dimensions())
    return found.select(
        "order_id",
        "found",
        "status",
        "destination",
        "event_id",
        "order_status",
        "net_amount",
        "item_count",
        "customer_name",
        "city",
        "country",
        "payment_method",
        "error_code",
        "rejection_reason",
    )


@query
def dq_referential_integrity(w: Warehouse) -> DataFrame:
    """Orphaned references against the seeds alone, and against all dimensions after ingest."""
    seeds = w.seeds()
    names = ("dim_customers", "dim_locations", "dim_payment_methods")
    before = audits.referential_checks(w.orders(), *[seeds[n] for n in names])
    after = audits.referential_checks(w.orders(), *w.order_dimensions())
    return before.withColumn("dimensions", F.lit("seeds")).unionByName(
        after.withColumn("dimensions", F.lit("after_ingest"))
    )


@query
def revenue_by_category(w: Warehouse) -> DataFrame:
    return reports.revenue_by_category(w.items(), w.dimension("dim_products"))


@query
def payment_distribution(w: Warehouse) -> DataFrame:
    return reports.payment_distribution(w.orders(), w.dimension("dim_payment_methods"))


@query
def geo_distribution(w: Warehouse) -> DataFrame:
    return reports.geo_distribution(w.orders(), w.dimension("dim_locations"))


@query
def existing_orders(w: Warehouse) -> DataFrame:
    """Orders of the second batch that the first one already stored."""
    valid = w.log().where(F.col("outcome") == "valid")
    incoming = valid.where(F.col("batch_id") == 1).select("order_id", "seq")
    return lookup.existing_orders(incoming, valid.where(F.col("batch_id") == 0))


@query
def new_dimension_keys(w: Warehouse) -> DataFrame:
    """How many keys each dimension lacks before ingest."""
    seeds = w.seeds()
    wanted = {
        "dim_customers": ("customer_id", w.orders()),
        "dim_locations": ("location_id", w.orders()),
        "dim_payment_methods": ("payment_method_id", w.orders()),
        "dim_products": ("product_id", w.items()),
    }

    def fresh(name: str) -> DataFrame:
        key, rows = wanted[name]
        missing = ver.insert_if_absent(seeds[name], rows.select(key).distinct(), key)
        return missing.agg(F.count("*").alias("new_keys")).select(F.lit(name).alias("table_name"), "new_keys")

    return reduce(DataFrame.unionByName, [fresh(n) for n in wanted])


@query
def fk_orphans(w: Warehouse) -> DataFrame:
    """Rows without a parent, per foreign key, against the seeded dimensions."""
    return audits.foreign_key_orphans(w.tables() | w.seeds())


@query
def cascade_delete(w: Warehouse) -> DataFrame:
    """Line items per order that remain when the customers of one segment are removed."""
    removed = w.dimension("dim_customers").where(F.col("segment") == "BUILDING")
    gone = w.orders().join(removed.select("customer_id"), "customer_id", "left_semi")
    left = ver.cascade_delete(w.items(), gone, "order_id")
    return left.groupBy("order_id").agg(F.count("*").alias("lines_left"))


# --- aggregations -------------------------------------------------------------------------


@query
def executive_kpis(w: Warehouse) -> DataFrame:
    return reports.executive_kpis(w.orders(), w.quarantine())


@query
def live_ingest_rate(w: Warehouse) -> DataFrame:
    """The rate at the time of the newest order, and the fallback long after it."""
    newest = w.orders().agg(F.max("processed_at")).scalar()
    much_later = w.as_of + F.expr("INTERVAL 100 DAYS")

    def rate(moment: Column) -> DataFrame:
        recent = w.store().orders_since(moment - F.expr("INTERVAL 30 SECONDS"))
        return reports.live_ingest_rate(recent, w.metrics(), moment)

    now, later = rate(newest), rate(much_later)
    return now.withColumn("moment", F.lit("newest order")).unionByName(later.withColumn("moment", F.lit("idle")))


@query
def quarantine_summary(w: Warehouse) -> DataFrame:
    return reports.quarantine_summary(w.quarantine())


@query
def quarantine_by_code(w: Warehouse) -> DataFrame:
    return reports.quarantine_by_code(w.quarantine())


@query
def validation_pass_rate(w: Warehouse) -> DataFrame:
    return reports.validation_pass_rate(w.orders(), w.quarantine())


@query
def table_stats(w: Warehouse) -> DataFrame:
    return monitoring.table_stats(w.tables())


@query
def warehouse_heartbeat(w: Warehouse) -> DataFrame:
    store = results.ResultStore(w.spark, scratch_path(w.spark, "heartbeat"))
    store.append(results.METRICS, monitoring.warehouse_heartbeat(w.tables(), w.as_of), w.as_of)
    return store.metrics().drop("metric_id")


@query
def dq_null_checks(w: Warehouse) -> DataFrame:
    return audits.null_checks(w.orders())


@query
def dq_financial_reconciliation(w: Warehouse) -> DataFrame:
    return audits.financial_checks(w.orders())


@query
def dq_suite(w: Warehouse) -> DataFrame:
    return audits.audit_suite(w.orders(), *w.order_dimensions())


def _audit_log(w: Warehouse) -> DataFrame:
    """The stored log after eight runs, each of which audits the tables and appends; all at once."""

    def build() -> results.ResultStore:
        store = results.ResultStore(w.spark, f"{w.root}/audits")
        # Made before: only one thread at a time may make tables.
        orders, dimensions = w.orders(), w.order_dimensions()

        def audit(hour: int) -> None:
            suite = audits.audit_suite(orders, *dimensions)
            stamp = w.as_of - F.lit(hour) * F.expr("INTERVAL 1 HOUR")
            store.append(results.AUDITS, audits.audit_log_rows(suite, stamp), stamp)

        together(w.spark, *[partial(audit, hour) for hour in range(8)])
        return store

    return w.once("audit_log", build).audit_log()


@query
def dq_audit_log(w: Warehouse) -> DataFrame:
    """The audit log after eight hourly runs."""
    return _audit_log(w).drop("audit_id")


@query
def dq_audit_history(w: Warehouse) -> DataFrame:
    return monitoring.audit_history(_audit_log(w))


@query
def hourly_rollup(w: Warehouse) -> DataFrame:
    return marts.hourly_rollup(w.orders(), w.quarantine(), w.as_of)


@query
def rollup_snapshot(w: Warehouse) -> DataFrame:
    return marts.rollup_snapshot(w.orders(), w.quarantine(), w.as_of)


@query
def hourly_mart_upsert(w: Warehouse) -> DataFrame:
    """The stored mart of the first batch after the hours that the second one touched were replaced.

    Only orders and rejections of the touched hours are summed up for the replacement.
    """
    orders, quarantine = w.orders(), w.quarantine()
    changes = w.store().store.read(CHANGES)
    touched = changes.where(F.col("batch_id") == 1).select(F.col("start").alias("hour"))
    fresh = marts.hourly_rollup(
        orders.withColumn("hour", F.date_trunc("hour", "order_timestamp")).join(touched, "hour", "left_semi"),
        quarantine.withColumn("hour", F.date_trunc("hour", "quarantined_at")).join(touched, "hour", "left_semi"),
        w.as_of,
    )
    w.results().replace_hours(marts.mart_of_changes(changes.where(F.col("batch_id") == 0)), w.as_of)
    w.results().replace_hours(fresh, w.as_of)
    return w.results().mart()


@query
def mart_month(w: Warehouse) -> DataFrame:
    """Hours of the stored mart in the month of the newest order, from that month's folders."""
    newest = w.orders().agg(F.date_format(F.max("order_timestamp"), "yyyy-MM")).first()[0]
    store = results.ResultStore(w.spark, scratch_path(w.spark, "month"))
    store.replace_hours(marts.hourly_rollup(w.orders(), w.quarantine(), w.as_of), w.as_of)
    return store.mart([newest])


@query
def orders_after_merge(w: Warehouse) -> DataFrame:
    """Orders compacted after the first batch, with the second one merged into their buckets."""
    return w.merged("fact_orders").select(*ORDER_COLUMNS, "versions")


@query
def items_after_merge(w: Warehouse) -> DataFrame:
    """Line items of the same, by order."""
    return w.merged("fact_order_items").groupBy("order_id").agg(
        F.count("*").alias("lines"), F.sum("total_item_price").alias("total"), F.sum("quantity").cast("long").alias("units")
    )


@query
def batch_stats(w: Warehouse) -> DataFrame:
    log = w.log()
    return monitoring.batch_stats(log, ver.batch_duplicates(log)).drop("latency_total")


@query
def batch_health_metric(w: Warehouse) -> DataFrame:
    return w.metrics().drop("metric_id")


@query
def latency_histogram(w: Warehouse) -> DataFrame:
    return reports.latency_histogram(w.orders())


@query
def payment_share(w: Warehouse) -> DataFrame:
    return reports.payment_share(w.orders(), w.dimension("dim_payment_methods"))


# --- windows, limits, set operations ------------------------------------------------------


@query
def cumulative_revenue(w: Warehouse) -> DataFrame:
    return reports.cumulative_revenue(w.orders())


@query
def order_versions(w: Warehouse) -> DataFrame:
    """Every valid delivery with its version number."""
    return ver.numbered_versions(w.versions().select("order_id", *PLACE, "order_status"))


@query
def quarantine_latest(w: Warehouse) -> DataFrame:
    return reports.quarantine_latest(w.quarantine()).select(
        *PLACE, "event_id", "order_id", "error_code", "rejection_reason", "quarantined_at"
    )


@query
def recent_batch_metrics(w: Warehouse) -> DataFrame:
    return monitoring.recent_batch_metrics(w.metrics())


@query
def latest_batch_metric(w: Warehouse) -> DataFrame:
    return reports.latest_batch_metric(w.metrics())


@query
def worker_active(w: Warehouse) -> DataFrame:
    """Activity at the newest metric and a minute after it."""
    newest = w.metrics().where(F.col("metric_name") == BATCH_METRIC).agg(F.max("timestamp")).scalar()
    at = monitoring.worker_active(w.metrics(), newest).withColumn("moment", F.lit("newest"))
    after = monitoring.worker_active(w.metrics(), newest + F.expr("INTERVAL 1 MINUTE"))
    return at.unionByName(after.withColumn("moment", F.lit("minute later")))


@query
def combined_batch(w: Warehouse) -> DataFrame:
    """Verdicts on manual and automatic events taken in as one batch."""
    manual = w.raw_batch(1).withColumn("origin", F.lit("manual"))
    automatic = w.raw_batch(0).withColumn("origin", F.lit("automatic"))
    judged = classify(decode_events(ev.combined(manual, automatic)), w.as_of)
    return judged.groupBy("origin").agg(
        F.count("*").alias("processed"),
        F.sum(F.col("error_code").isNull().cast("long")).alias("valid"),
        F.sum(F.col("error_code").isNotNull().cast("long")).alias("quarantined"),
    )


# --- keyed writes -------------------------------------------------------------------------


@query
def dims_after_ingest(w: Warehouse) -> DataFrame:
    """Rows per dimension after ingest, by whether they were inferred."""
    keys = {
        "dim_customers": ("customer_id", F.col("customer_name").startswith("Customer CUST-")),
        "dim_locations": ("location_id", F.col("city") == dims.UNKNOWN_PLACE),
        "dim_payment_methods": ("payment_method_id", F.col("method_type") == F.col("provider")),
        "dim_products": ("product_id", F.col("supplier_id").isNotNull()),
    }
    parts = [
        w.dimension(name).select(F.lit(name).alias("table_name"), F.col(key).alias("key"), inferred.alias("inferred"))
        for name, (key, inferred) in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def orders_upsert_latest(w: Warehouse) -> DataFrame:
    """Orders delivered more than once, as stored."""
    return ver.current_orders(w.versions()).where(F.col("versions") > 1).select(
        "order_id", "order_status", "total_amount", "net_amount", "processed_at", "ingest_latency_ms", "versions"
    )


@query
def items_replace_latest(w: Warehouse) -> DataFrame:
    """Line items of orders delivered more than once: those of the last delivery."""
    repeated = w.orders().where(F.col("versions") > 1).select("order_id")
    return w.items().join(repeated, "order_id", "left_semi").select(
        "order_id", "line_no", "product_id", "quantity", "total_item_price", *PLACE
    )


@query
def duplicate_counts(w: Warehouse) -> DataFrame:
    return ver.batch_duplicates(w.log())


@query
def replay_idempotent(w: Warehouse) -> DataFrame:
    """Row counts of a store whose first batch was written twice."""

    def build() -> OrderStore:
        store = OrderStore(w.spark, f"{w.root}/replayed")
        for batch_id in (0, 1, 0):
            store.write_batch(w.raw_batch(batch_id), batch_id, w.as_of)
        return store

    store = w.once("replayed", build)
    orders = store.fact_orders()
    return orders.agg(
        F.count("*").alias("orders"),
        F.sum("net_amount").alias("revenue"),
        F.sum("versions").alias("versions"),
    ).select("orders", "revenue", "versions", store.log().agg(F.count("*")).scalar().alias("log_rows"))


@query
def committed_batches(w: Warehouse) -> DataFrame:
    """Batches readers see; one whose marker is missing stays hidden."""

    def build() -> OrderStore:
        store = OrderStore(w.spark, f"{w.root}/half-written")
        store.write_batch(w.raw_batch(0), 0, w.as_of)
        unfinished = w.log().where(F.col("batch_id") == 1).drop("batch_id")
        store.store.write(LOG, unfinished, 1, store.store.new_attempt(), ["outcome"])
        return store

    store = w.once("half-written", build)
    return store.log().groupBy("batch_id").agg(F.count("*").alias("visible_rows"))


@query
def surrogate_keys(w: Warehouse) -> DataFrame:
    """Surrogate keys are as many as rows, and the same when derived again."""
    again = facts.line_items_of(ver.keep_latest(w.log().where(F.col("outcome") == "valid"), w.orders()))
    matched = w.items().select("order_item_id").join(again.select("order_item_id"), "order_item_id", "left_semi")
    total = w.items().agg(F.count("*")).scalar()
    return matched.agg(F.count("*").alias("stable_keys"), F.count_distinct("order_item_id").alias("distinct_keys")).select(
        "stable_keys", "distinct_keys", total.alias("line_items")
    )


# --- scalar functions ---------------------------------------------------------------------


@query
def scalar_functions(w: Warehouse) -> DataFrame:
    """Scalar expressions over all orders."""
    stamp = F.col("order_timestamp")
    return w.orders().select(
        "order_id",
        F.coalesce(F.nullif("discount_amount", F.lit(0)), F.lit(-1)).cast("double").alias("coalesced"),
        F.when(F.col("net_amount") > 100000, "large").otherwise("small").alias("size_class"),
        F.abs(F.col("net_amount") - F.col("total_amount")).alias("absolute"),
        F.round(F.col("net_amount") * F.lit("0.7").cast("decimal(2,1)"), 2).alias("rounded"),
        F.greatest(F.lit(0), F.col("item_count") - 100).alias("clamped"),
        F.lower("customer_id").alias("lowered"),
        F.regexp_extract("order_id", r"^ORD-(\d+)", 1).cast("long").alias("order_number"),
        F.date_format(stamp, "yyyyMMdd").cast("int").alias("date_key"),
        (F.weekday(stamp) + 1).alias("iso_weekday"),
        F.quarter(stamp).alias("quarter"),
        F.date_trunc("hour", stamp).alias("hour_start"),
        (F.date_trunc("hour", stamp) - F.expr("INTERVAL 1 HOUR")).alias("previous_hour"),
        F.format_string("Customer %s", "customer_id").alias("label"),
        F.get_json_object(F.to_json(F.struct("order_id", "item_count")), "$.item_count").cast("int").alias("json_count"),
    )


# --- streams ------------------------------------------------------------------------------


@query
def stream_dedup(w: Warehouse) -> DataFrame:
    """Users seen on the event stream, each let through once."""
    path = scratch_path(w.spark, "dedup")
    once = windows.distinct_within(_event_stream(w), ["user_id"], "ts", SPAN)
    windows.append_stream(once.select("user_id"), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return w.spark.read.parquet(f"{path}/table")


@query
def stream_hourly_rollup(w: Warehouse) -> DataFrame:
    """The hourly mart as stream ingest keeps it, repeated deliveries taken back."""
    return w.streamed().hourly_mart()


@query
def stream_hourly_once(w: Warehouse) -> DataFrame:
    """Hourly orders kept by a windowed stream of all raw order events, each order counted once."""
    w.raw()
    path = scratch_path(w.spark, "hourly")
    raw = ev.read_order_stream(w.spark, f"{w.root}/raw_events/*")
    orders = windows.valid_order_stream(raw, w.as_of)
    windows.update_stream(windows.hourly_orders(orders, SPAN), f"{path}/updates", f"{path}/checkpoint").awaitTermination()
    return windows.latest_groups(w.spark, f"{path}/updates", ["hourly_window_start", "hourly_window_end"])


@query
def stream_event_rate(w: Warehouse) -> DataFrame:
    """Events per second in half-minute windows of the event stream."""
    path = scratch_path(w.spark, "rate")
    rates = windows.rate_per_window(_event_stream(w), "ts", SPAN)
    windows.update_stream(rates, f"{path}/updates", f"{path}/checkpoint").awaitTermination()
    return windows.latest_groups(w.spark, f"{path}/updates", ["window_start"])


@query
def stream_progress(w: Warehouse) -> DataFrame:
    """Rows that the triggers of a stream took in, from the metric rows that its progress was stored as."""
    path = scratch_path(w.spark, "progress")
    heard, kept = ProgressMetrics(w.spark), results.ResultStore(w.spark, f"{path}/results")
    w.spark.streams.addListener(heard)
    try:
        stream = windows.append_stream(_event_stream(w).select("event_id"), f"{path}/table", f"{path}/checkpoint")
        stream.awaitTermination()
        heard.wait_for(stream)
    finally:
        w.spark.streams.removeListener(heard)
    heard.store(kept, w.as_of)
    rows = kept.metrics().where(F.col("metric_name") == ROWS_METRIC)
    return rows.groupBy("component", "metric_name", "metric_unit").agg(F.sum("metric_value").alias("rows"))


# --- further reports ----------------------------------------------------------------------


@query
def segment_spending(w: Warehouse) -> DataFrame:
    return reports.segment_spending(w.orders(), w.dimension("dim_customers"))


@query
def status_breakdown(w: Warehouse) -> DataFrame:
    return reports.status_breakdown(w.orders())


@query
def hourly_volume(w: Warehouse) -> DataFrame:
    return reports.hourly_volume(w.orders())


@query
def order_line_items(w: Warehouse) -> DataFrame:
    """Line items with product names for all delivered orders."""
    requested = w.orders().where(F.col("order_status") == "DELIVERED")
    return reports.order_line_items(requested, w.items(), w.dimension("dim_products")).select(
        "order_id", "line_no", "product_id", "product_name", "category", "quantity", "unit_price", "total_item_price"
    )


@query
def table_freshness(w: Warehouse) -> DataFrame:
    stamps = {
        "fact_orders": (w.orders(), "processed_at"),
        "fact_order_items": (w.items(), "created_at"),
        "quarantine_orders": (w.quarantine(), "quarantined_at"),
        "pipeline_health_metrics": (w.metrics(), "timestamp"),
    }
    return monitoring.table_freshness(stamps, w.as_of)
