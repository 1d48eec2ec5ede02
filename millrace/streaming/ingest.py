"""Micro-batch ingest: one wide pass to the event log, then narrow tables from its columns."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.functions.rules import DEFAULT_TOLERANCE
from millrace.model import FACT_ITEM, ORDER_STATUSES, TABLES
from millrace.operators import dimensions as dims
from millrace.operators.facts import line_items_of
from millrace.operators.few import within, without
from millrace.operators.validation import QUARANTINED, ingest_plan, order_versions_of, quarantine_rows, valid_events
from millrace.operators.versions import (
    VERSION_KEYS,
    current_orders,
    current_orders_given,
    event_keys,
    keep_latest,
    merged_orders,
    met_event_ids,
    repeated_orders,
    reused_event_ids,
    settled,
    settled_valid,
    superseded_versions,
)
from millrace.plans.marts import MART_CHANGE, mart_changes, mart_of_changes
from millrace.plans.monitoring import batch_metrics, batch_stats, no_events
from millrace.session import together
from millrace.sources.tables import ATTEMPT, BATCH, BatchStore, clock_number, no_rows, read_table

ORDERS, ITEMS, REJECTED = "fact_orders", "fact_order_items", "quarantine_orders"
LOG, MET, REUSED, CHANGES = "event_log", "met_event_ids", "reused_event_ids", "hourly_mart_changes"
EVENT_KEYS, ORDER_KEYS = "event_index", "order_index"
DIMENSIONS = ["dim_customers", "dim_locations", "dim_payment_methods", "dim_products"]
SEED_BATCH = -1
#: Folders that ids are dealt to, by their hash. A store keeps its number for good; choose it so that a folder of all batches
#: stays near a gigabyte or two of ids.
BUCKETS = 16
BUCKET = "bucket"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        *[T.StructField(f.name, f.dataType) for f in TABLES["fact_orders"].fields],
        T.StructField("items", T.ArrayType(FACT_ITEM)),
        T.StructField("raw_payload", T.StringType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("rejection_reason", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)

#: Event ids that several events have, of the batch or earlier ones.
MET_SCHEMA = T.StructType([T.StructField("event_id", T.StringType())])

#: Event ids that another order used first, the order that used them again, and their owner.
REUSED_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("event_id", "order_id", "owner")])

#: The key index: event ids a batch has brought, with each order that sent them;
EVENT_SCHEMA = T.StructType(
    [*[T.StructField(n, T.StringType()) for n in ("event_id", "order_id")], T.StructField("seq", T.LongType()), T.StructField(BUCKET, T.IntegerType())]
)
#: and orders of which a batch left a valid event, with the number of these, whether an earlier batch knew the order, what its first event
#: ever fixed, and its status before and after the batch.
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("events", T.LongType()),
        T.StructField("known", T.BooleanType()),
        *[f for f in TABLES["fact_orders"].fields if f.name in ("order_timestamp", "net_amount", "item_count", "order_status")],
        T.StructField("status_before", T.StringType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)
#: Columns of an order that its first event fixes and that the mart is made of.
FIXED = ["order_timestamp", "net_amount", "item_count"]

#: Statistics of a batch, kept with its marker.
STATS_SCHEMA = T.StructType(
    [
        *[T.StructField(n, T.LongType()) for n in ("processed", "valid", "quarantined", "duplicates", "latency_total")],
        T.StructField("finished_at", T.TimestampType()),
    ]
)


class OrderStore:
    """The order warehouse: an event log per batch and what is derived from it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        schemas = {LOG: LOG_SCHEMA, MET: MET_SCHEMA, REUSED: REUSED_SCHEMA, EVENT_KEYS: EVENT_SCHEMA, ORDER_KEYS: ORDER_SCHEMA, CHANGES: MART_CHANGE, **{d: TABLES[d] for d in DIMENSIONS}}
        self.spark = spark
        self.buckets = buckets
        self.store = BatchStore(spark, root, schemas)

    # --- writing ------------------------------------------------------------------------

    def seed_dimensions(self, seeds: Mapping[str, DataFrame], loaded_at: Column) -> None:
        """Load known dimension rows ahead of the first batch."""
        attempt = self.store.new_attempt()
        together(
            self.spark,
            *[
                partial(self.store.write, name, dims.conform(rows, name, loaded_at), SEED_BATCH, attempt)
                for name, rows in seeds.items()
            ],
        )
        self.store.commit(SEED_BATCH, attempt, loaded_at, 0)

    def write_batch(
        self,
        raw: DataFrame,
        batch_id: int,
        as_of: Column | None = None,
        tolerance: str = DEFAULT_TOLERANCE,
        infer_dimensions: bool = True,
        source: str | None = None,
        source_batch: int | None = None,
    ) -> dict[str, int]:
        """Ingest one batch of raw messages and return its statistics.

        Messages are decoded and checked once, on their way into the log. Everything else
        reads a few columns of the log folder just written. Running it again with the same
        ``batch_id`` replaces the batch once the new attempt is whole.
        """
        now = F.current_timestamp() if as_of is None else as_of
        attempt = self.store.new_attempt()
        attempts = self.store.attempts_before(batch_id)
        # Seeds bring no events.
        earlier = [name for number, name in attempts.items() if number != SEED_BATCH]
        self.store.write(LOG, ingest_plan(raw, now, tolerance), batch_id, attempt, ["outcome"])
        arrived = self.store.batch(LOG, batch_id, attempt)
        self.store.write(EVENT_KEYS, self._bucketed(event_keys(arrived), "event_id", EVENT_SCHEMA), batch_id, attempt, [BUCKET])
        # Grouped and written once, read from then on.
        own = self.store.batch(EVENT_KEYS, batch_id, attempt).select("event_id", *VERSION_KEYS)
        repeated_ids = self._write_reused(own, earlier, batch_id, attempt)
        if repeated_ids:
            reused = self.store.batch(REUSED, batch_id, attempt)
            log, valid = settled(arrived, reused), settled_valid(arrived, reused)
        else:  # as in a consistent source
            log, valid = arrived, valid_events(arrived)
        inferred = self._new_dimension_rows(valid, attempts.values(), now) if infer_dimensions else {}
        orders = self._bucketed(self._order_keys(valid, earlier), "order_id", ORDER_SCHEMA)
        together(
            self.spark,
            partial(self.store.write, ORDER_KEYS, orders, batch_id, attempt, [BUCKET]),
            *[partial(self.store.write, name, rows, batch_id, attempt) for name, rows in inferred.items()],
        )
        # What the batch did to its orders is in its part of the index.
        orders = self.store.batch(ORDER_KEYS, batch_id, attempt)
        repeats = F.coalesce(F.sum(F.col("events") - (~F.col("known")).cast("long")), F.lit(0)).alias("duplicates")
        stats = batch_stats(log, orders.agg(repeats).withColumn(BATCH, F.lit(batch_id).cast("long")))
        # The statistics are one row per batch, none for an empty batch.
        summary, *_ = together(
            self.spark,
            partial(stats.select(*STATS_SCHEMA.fieldNames(), F.to_json(F.struct(*STATS_SCHEMA.fieldNames())).alias("details")).take, 1),
            partial(self.store.write, CHANGES, mart_changes(orders, log, now).repartition(1), batch_id, attempt),
        )
        result = {k: summary[0][k] if summary else n for k, n in no_events().items()}
        details = summary[0]["details"] if summary else None
        self.store.commit(batch_id, attempt, now, result["processed"], source, source_batch, details)
        return result

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _bucketed(self, rows: DataFrame, key: str = "order_id", schema: T.StructType | None = None) -> DataFrame:
        """rows by bucket of their key; large buckets are written by several tasks, small ones share one."""
        placed = rows.withColumn(BUCKET, self._bucket(key))
        return (placed.select(*schema.fieldNames()) if schema else placed).hint("rebalance", BUCKET)

    def _bucketed_items(self, events: DataFrame) -> DataFrame:
        """Line items by bucket of their order; events move with their arrays, which are taken apart after that."""
        moved = self._bucketed(events.select("order_id", "batch_id", "seq", "processed_at", "items"))
        return line_items_of(moved).withColumn(BUCKET, self._bucket("order_id"))

    def earlier_keys(self, table: str, keys: DataFrame, attempts: list[str]) -> DataFrame:
        """Index rows of earlier batches in the buckets that ``keys`` (one column) fall in.

        The buckets (no more rows than the index has folders) are broadcast, and Spark prunes the
        scan to their folders while the query runs. Of an index of any age a small batch thus reads a few folders.
        """
        touched = keys.select(self._bucket(keys.columns[0]).alias(BUCKET)).distinct()
        return self.store.of_attempts(table, attempts).join(F.broadcast(touched), BUCKET, "left_semi")

    def _write_reused(self, own: DataFrame, earlier: list[str], batch_id: int, attempt: str) -> int:
        """Write the event ids of the batch that an earlier event of another order has; returns their number.

        Ids met more than once are written first, so that Spark knows their size when the others are left out; most sources have none.
        """
        index = self.earlier_keys(EVENT_KEYS, own.select("event_id"), earlier) if earlier else None
        if self.store.write_counted(MET, met_event_ids(own, index), batch_id, attempt):
            met = self.store.batch(MET, batch_id, attempt).select("event_id")
            own, index = (rows if rows is None else rows.join(met, "event_id", "left_semi") for rows in (own, index))
            reused = reused_event_ids(own, index).select(*REUSED_SCHEMA.fieldNames())
        else:
            reused = no_rows(self.spark, REUSED_SCHEMA)
        return self.store.write_counted(REUSED, reused, batch_id, attempt)

    def _order_keys(self, valid: DataFrame, earlier: list[str]) -> DataFrame:
        """Each order of the batch with its state before and after. Earlier batches have one row of it each, of which the last one counts."""
        # Each value is of fixed width, the status as its number, so that rows are grouped by hash and not sorted. Valid events have a known status.
        codes = F.array(*[F.lit(s) for s in ORDER_STATUSES])
        status = F.array_position(codes, F.col("order_status")).cast("int")
        own = valid.groupBy("order_id").agg(
            F.count("*").alias("events"),
            F.min("seq").alias("seq"),
            *[F.min_by(c, "seq").alias(f"_{c}") for c in FIXED],
            F.max_by(status, F.col("seq")).alias("_code"),
        ).select(
            "order_id", "events", "seq", F.struct(*[F.col(f"_{c}").alias(c) for c in FIXED]).alias("first"), F.try_element_at(codes, F.col("_code")).alias("order_status")
        )
        if not earlier:
            return own.select(
                "order_id", "seq", "events", F.lit(False).alias("known"), "first.*", "order_status", F.lit(None).cast("string").alias("status_before")
            )
        index = self.earlier_keys(ORDER_KEYS, valid.select("order_id"), earlier)
        # The batch is the small side: if Spark can broadcast its ids, the index isn't shuffled.
        met = index.select("order_id", F.col(BATCH).alias("_batch"), *FIXED, F.col("order_status").alias("_status")).join(
            own.select("order_id"), "order_id", "left_semi"
        )
        before = met.groupBy("order_id").agg(F.max_by(F.struct(*FIXED, "_status"), "_batch").alias("before"))
        known = F.col("before").isNotNull()
        return own.join(before, "order_id", "left").select(
            "order_id",
            "seq",
            "events",
            known.alias("known"),
            *[F.when(known, F.col("before")[c]).otherwise(F.col("first")[c]).alias(c) for c in FIXED],
            "order_status",
            F.col("before._status").alias("status_before"),
        )

    def _new_dimension_rows(self, valid: DataFrame, attempts: Collection[str], now: Column) -> dict[str, DataFrame]:
        """Rows for keys that orders bring along; events that end in quarantine bring none."""
        orders, items = order_versions_of(valid), line_items_of(valid)
        known = {name: self.store.of_attempts(name, attempts) for name in DIMENSIONS}
        inferred = {
            "dim_customers": dims.infer_customers(orders, known["dim_customers"]),
            "dim_locations": dims.infer_locations(orders, known["dim_locations"]),
            "dim_payment_methods": dims.infer_payment_methods(orders, known["dim_payment_methods"]),
            "dim_products": dims.infer_products(items, known["dim_products"]),
        }
        return {name: dims.conform(rows, name, now) for name, rows in inferred.items()}

    # --- reading ------------------------------------------------------------------------

    def log(self) -> DataFrame:
        """All events of finished batches with their final outcome."""
        return settled(self.store.read(LOG), self.store.read(REUSED))

    def dimension(self, name: str) -> DataFrame:
        return self.store.read(name)

    def metrics(self) -> DataFrame:
        """One health metric per batch that had events, from the statistics in its marker."""
        stats = F.from_json("details", STATS_SCHEMA).alias("stats")
        marked = self.store.committed().where(F.col("details").isNotNull()).select(BATCH, stats).select(BATCH, "stats.*")
        return batch_metrics(marked)

    def hourly_mart(self) -> DataFrame:
        """The hourly mart as the batches have kept it, one small row per batch and hour it touched."""
        return mart_of_changes(self.store.read(CHANGES))

    def orders_since(self, moment: Column) -> DataFrame:
        """Orders with a valid event processed at the moment or later, and the last such time.

        The markers know the latest time of each batch, so only folders of batches that reach the moment are scanned.
        """
        finished = F.from_json("details", STATS_SCHEMA)["finished_at"]
        recent = self.store.committed().where(finished >= moment).select(BATCH, ATTEMPT)
        log, reused = (self.store.raw(t).join(F.broadcast(recent), [BATCH, ATTEMPT], "left_semi").drop(ATTEMPT) for t in (LOG, REUSED))
        events = settled_valid(log, reused).where(F.col("processed_at") >= moment)
        return events.groupBy("order_id").agg(F.max("processed_at").alias("processed_at"))

    def order_log(self) -> DataFrame:
        """Valid events of the log."""
        return settled_valid(self.store.read(LOG), self.store.read(REUSED))

    def fact_orders(self) -> DataFrame:
        return current_orders(order_versions_of(self.order_log()))

    def fact_order_items(self, orders: DataFrame | None = None) -> DataFrame:
        """Line items of the current version of each order."""
        current = self.fact_orders() if orders is None else orders
        return line_items_of(keep_latest(self.order_log(), current.select(*VERSION_KEYS)))

    def quarantine(self) -> DataFrame:
        return quarantine_rows(self.log())

    # --- compaction ---------------------------------------------------------------------

    def _compacted_schemas(self) -> dict[str, T.StructType]:
        log = no_rows(self.spark, T.StructType([*LOG_SCHEMA.fields, T.StructField(BATCH, T.LongType())]))
        orders, items = current_orders(order_versions_of(log)), line_items_of(log)
        tables = {ORDERS: self._bucketed(orders), ITEMS: self._bucketed(items), REJECTED: quarantine_rows(log)}
        return {name: rows.schema for name, rows in tables.items()}

    def compacted(self, target: str, name: str) -> DataFrame:
        """A table below a compaction target, empty if it has no rows yet."""
        return read_table(self.spark, f"{target.rstrip('/')}/{name}", self._compacted_schemas()[name])

    def compact(self, target: str, through: int | None = None) -> dict[str, object]:
        """Bring the plain tables below ``target`` up to date: current orders, line items and quarantine.

        Orders and line items lie in folders by bucket of the order id, quarantine by batch. The first call writes all
        of it. Later ones read only the batches since then and the buckets of the orders these touched, and replace just those folders
        (dynamic partition overwrite). What is replaced is written aside first, so a call that fails while it
        replaces folders is taken up by the next one. A batch that was written again, or one with a number below those already
        compacted, has everything written anew. Readers of a folder that is being replaced may have to
        run again; one that must not be disturbed takes a target of its own. ``through`` leaves out later batches.

        Returns the mode ("full", "delta" or "none") and the number of buckets written.
        """
        state = _CompactionState(self.spark, target.rstrip("/"), self._compacted_schemas())
        state.finish_staged()
        now = self.store.committed().select(BATCH, ATTEMPT)
        if through is not None:
            now = now.where(F.col(BATCH) <= through)
        number, now = state.begin(now)
        known = state.included()
        if known is not None:
            new = now.join(known, [BATCH, ATTEMPT], "left_anti").collect()
            gone = known.join(now, [BATCH, ATTEMPT], "left_anti").count()
            last = known.agg(F.max(BATCH)).first()[0]
            if not gone and not new:
                return {"mode": "none", "buckets": 0}
            if not gone and min(r[BATCH] for r in new) > last:
                return self._compact_delta(state, number, [tuple(r) for r in new])
        self._compact_all(state, number, now)
        return {"mode": "full", "buckets": self.buckets}

    def _compact_all(self, state: "_CompactionState", number: int, batches: DataFrame) -> None:
        """All tables from the log.

        The exceptions in the log (repeated orders, superseded deliveries) are found first,
        from its id columns, and written down. Spark knows the size of what is written, and
        streams the log past a broadcast of it or shuffles both.
        """
        arrived, reused = (
            self.store.raw(t).join(F.broadcast(batches), [BATCH, ATTEMPT], "left_semi").drop(ATTEMPT) for t in (LOG, REUSED)
        )
        events = settled_valid(arrived, reused)
        versions = order_versions_of(events)
        repeated = state.save(number, "repeated_orders", repeated_orders(versions))
        orders = state.replace(ORDERS, self._bucketed(current_orders_given(versions, repeated)), BUCKET, whole=True)
        old = state.save(number, "superseded", superseded_versions(versions, repeated, orders))
        current = without(events, old, VERSION_KEYS)
        # Payloads of valid events are read only from batches with reused ids (one number per batch).
        met = [r[0] for r in reused.select(BATCH).distinct().collect()]
        rejected = arrived.where((F.col("outcome") == QUARANTINED) | F.col(BATCH).isin(met))
        together(
            self.spark,
            partial(state.replace, ITEMS, self._bucketed_items(current), BUCKET, whole=True),
            partial(state.replace, REJECTED, quarantine_rows(settled(rejected, reused)), BATCH, whole=True),
        )
        state.done(number)

    def _compact_delta(self, state: "_CompactionState", number: int, batches: list[tuple[int, str]]) -> dict[str, object]:
        """The buckets of the orders in later batches, merged with what they hold."""
        mine = F.col(BATCH).isin([b for b, _ in batches]) & F.col(ATTEMPT).isin([a for _, a in batches])
        arrived, reused = (self.store.raw(t).where(mine).drop(ATTEMPT) for t in (LOG, REUSED))
        events = settled_valid(arrived, reused)
        changed = state.save(number, "changed_orders", self._bucketed(current_orders(order_versions_of(events))))
        # No more rows than the tables have buckets.
        touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]
        kept = {t: state.table(t).where(F.col(BUCKET).isin(touched)) for t in (ORDERS, ITEMS)}
        # Rows that stay as they are lie in their buckets already.
        same = {t: without(rows, changed.select("order_id"), ["order_id"]) for t, rows in kept.items()}
        met = within(kept[ORDERS].drop(BUCKET), changed.select("order_id"), ["order_id"])
        orders = self._bucketed(merged_orders(met, changed.drop(BUCKET)))
        fresh = self._bucketed_items(keep_latest(events, changed))
        together(
            self.spark,
            partial(state.stage, number, ORDERS, same[ORDERS].select(orders.columns).unionByName(orders), BUCKET),
            partial(state.stage, number, ITEMS, same[ITEMS].select(fresh.columns).unionByName(fresh), BUCKET),
            partial(state.stage, number, REJECTED, quarantine_rows(settled(arrived, reused)), BATCH),
        )
        state.staged(number)
        state.finish_staged()
        return {"mode": "delta", "buckets": len(touched)}


class _CompactionState:
    """What a compaction target holds: its tables, the batches in them, and changes that are written but not yet in place."""

    DONE, STAGED = "done", "staged"
    STEP = T.StructType([T.StructField("number", T.LongType()), T.StructField("step", T.StringType())])
    INCLUDED = T.StructType([T.StructField(BATCH, T.LongType()), T.StructField(ATTEMPT, T.StringType())])
    KEYS = {ORDERS: BUCKET, ITEMS: BUCKET, REJECTED: BATCH}

    def __init__(self, spark: SparkSession, target: str, schemas: Mapping[str, T.StructType]):
        self.spark, self.target, self.root, self.schemas = spark, target, f"{target}/_state", schemas

    def _mark(self, number: int, step: str) -> None:
        row = self.spark.range(1).select(F.lit(number).cast("long").alias("number"))
        row.write.mode("overwrite").parquet(f"{self.root}/steps/step={step}/at={number}")

    def _last(self, *steps: str) -> int | None:
        rows = read_table(self.spark, f"{self.root}/steps", self.STEP)
        return rows.where(F.col("step").isin(*steps)).agg(F.max("number")).first()[0]

    def begin(self, batches: DataFrame) -> tuple[int, DataFrame]:
        """The number of a new compaction, and the batches that it is to hold, written down."""
        number = clock_number()
        return number, self.save(number, "included", batches)

    def included(self) -> DataFrame | None:
        last = self._last(self.DONE)
        return None if last is None else self.spark.read.schema(self.INCLUDED).parquet(f"{self.root}/{last}/included")

    def save(self, number: int, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/{number}/{name}"
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.target}/{name}", self.schemas[name])

    def replace(self, name: str, rows: DataFrame, key: str, whole: bool = False) -> DataFrame:
        """Write rows over the folders of their keys, or over the whole table."""
        mode = "static" if whole else "dynamic"
        path = f"{self.target}/{name}"
        rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(key).parquet(path)
        return self.table(name)

    def stage(self, number: int, name: str, rows: DataFrame, key: str) -> None:
        rows.write.mode("errorifexists").partitionBy(key).parquet(f"{self.root}/{number}/{name}")

    def staged(self, number: int) -> None:
        self._mark(number, self.STAGED)

    def done(self, number: int) -> None:
        self._mark(number, self.DONE)

    def finish_staged(self) -> None:
        """Put changes in place that were written aside whole; doing so twice changes nothing."""
        number = self._last(self.STAGED)
        if number is None or number <= (self._last(self.DONE) or 0):
            return

        def put(name: str) -> None:
            rows = read_table(self.spark, f"{self.root}/{number}/{name}", self.schemas[name])
            self.replace(name, rows, self.KEYS[name])

        together(self.spark, *[partial(put, name) for name in self.KEYS])
        self.done(number)


def batch_handler(
    store: OrderStore,
    source: str,
    as_of: Column | None = None,
    tolerance: str = DEFAULT_TOLERANCE,
    infer_dimensions: bool = True,
) -> Callable:
    """The ``foreachBatch`` function that feeds an order store from the named stream.

    A stream that has committed batches keeps their numbers; a new one begins after all
    that the store holds, so a lost checkpoint never overwrites older batches.
    """
    first = store.store.first_batch_of(source)

    def handle(raw: DataFrame, batch_id: int) -> None:
        store.write_batch(raw, first + batch_id, as_of, tolerance, infer_dimensions, source, batch_id)

    return handle


def ingest_stream(
    raw: DataFrame,
    store: OrderStore,
    checkpoint: str,
    as_of: Column | None = None,
    every: str | None = None,
    tolerance: str = DEFAULT_TOLERANCE,
    infer_dimensions: bool = True,
    source: str | None = None,
):
    """Start ingest of a raw event stream.

    ``every`` sets a processing-time trigger for an endless run; without it the query takes
    all data that is available, in micro-batches as the source caps them, and ends.
    ``source`` names the stream in the store, by its checkpoint unless given. Give a new name with a new
    checkpoint: its batches are counted from 0 again and must not replace those of the old one.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        raw.writeStream.foreachBatch(batch_handler(store, source or checkpoint, as_of, tolerance, infer_dimensions))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
