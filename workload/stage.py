"""The order warehouse built from the given tables: each written table is made once per session.

Registered queries read these tables as a user's queries read a warehouse that ingest keeps
filled. All of them lie in the shared folder of the session, so they outlive executors.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.model import RAW_EVENT
from millrace.operators.validation import order_versions_of
from millrace.plans.results import ResultStore
from millrace.session import prepare, scratch_path, together
from millrace.sources.events import read_order_stream
from millrace.streaming.ingest import BUCKET, DIMENSIONS, OrderStore, ingest_stream
from workload import derive

#: Files that a micro-batch of the order stream takes in.
STREAM_FILES = 4

_cache: dict[tuple[str, str], "Warehouse"] = {}
_lock = threading.RLock()


def warehouse(spark: SparkSession, sf_dir: str) -> "Warehouse":
    """The warehouse of a data folder, shared by all queries of the session."""
    prepare(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        if key not in _cache:
            _cache[key] = Warehouse(spark, sf_dir)
        return _cache[key]


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.root = scratch_path(spark, "warehouse")
        self._made: dict[str, object] = {}

    def once(self, name: str, make: Callable[[], object]):
        with _lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    def given(self, name: str) -> DataFrame:
        return derive.table(self.spark, self.sf_dir, name)

    @property
    def as_of(self) -> Column:
        return derive.as_of()

    # --- raw messages -------------------------------------------------------------------

    def raw(self) -> DataFrame:
        """(value, seq, received_at, batch_id) as it lies on the topic.

        Each batch is a folder of its own, whose files grow with the input before their number does, so that a
        stream which takes a number of files at a time isn't cut into ever more of them.
        """

        def write(batch_id: int) -> None:
            lineitem, orders, least = self.given("lineitem"), self.given("orders"), self.spark.sparkContext.defaultParallelism
            if batch_id == 1:
                lineitem, orders = lineitem.where(derive.sent_again(F.col("l_orderkey"))), orders.where(derive.sent_again(F.col("o_orderkey")))
                least = STREAM_FILES
            parts = max(least, -(-lineitem.count() // derive.FILE_LINES))
            items = derive.order_items(derive.order_lines(lineitem, self.given("part"), parts))
            messages = derive.raw_messages(derive.base_orders(orders, self.given("customer"), items, parts))
            messages.where(F.col("batch_id") == batch_id).drop("batch_id").write.mode("overwrite").parquet(f"{self.root}/raw_events/batch_id={batch_id}")

        def build() -> str:
            together(self.spark, *[partial(write, batch_id) for batch_id in (0, 1)])
            return f"{self.root}/raw_events"

        return self.spark.read.parquet(self.once("raw_events", build))

    def raw_batch(self, batch_id: int) -> DataFrame:
        names = [f.name for f in RAW_EVENT.fields]
        return self.raw().where(F.col("batch_id") == batch_id).select(*names)

    def seeds(self) -> dict[str, DataFrame]:
        return derive.seeds(self.spark, self.sf_dir)

    # --- batch ingest -------------------------------------------------------------------

    def store(self) -> OrderStore:
        """Both batches ingested, with dimensions inferred."""

        def build() -> OrderStore:
            store = OrderStore(self.spark, f"{self.root}/store")
            store.seed_dimensions(self.seeds(), self.as_of)
            for batch_id in (0, 1):
                store.write_batch(self.raw_batch(batch_id), batch_id, self.as_of)
            return store

        return self.once("store", build)

    def log(self) -> DataFrame:
        return self.store().log()

    def versions(self) -> DataFrame:
        return order_versions_of(self.store().order_log())

    def compacted(self, name: str) -> DataFrame:
        """A table of the compacted store; compaction runs once."""

        def build() -> str:
            self.store().compact(f"{self.root}/compacted")
            return f"{self.root}/compacted"

        return self.store().compacted(self.once("compacted", build), name).drop(BUCKET)

    def merged(self, name: str) -> DataFrame:
        """The same where the first batch was compacted and the second one merged in."""

        def build() -> str:
            for through in (0, None):
                self.store().compact(f"{self.root}/merged", through)
            return f"{self.root}/merged"

        return self.store().compacted(self.once("merged", build), name).drop(BUCKET)

    def results(self) -> ResultStore:
        """Stored results."""
        return ResultStore(self.spark, f"{self.root}/results")

    def orders(self) -> DataFrame:
        return self.compacted("fact_orders")

    def items(self) -> DataFrame:
        return self.compacted("fact_order_items")

    def quarantine(self) -> DataFrame:
        return self.compacted("quarantine_orders")

    def dimension(self, name: str) -> DataFrame:
        return self.store().dimension(name)

    def order_dimensions(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        names = ("dim_customers", "dim_locations", "dim_payment_methods")
        return tuple(self.dimension(n) for n in names)

    def metrics(self) -> DataFrame:
        return self.store().metrics()

    def tables(self) -> dict[str, DataFrame]:
        stored = {n: self.dimension(n) for n in DIMENSIONS}
        return stored | {
            "fact_orders": self.orders(),
            "fact_order_items": self.items(),
            "quarantine_orders": self.quarantine(),
        }

    # --- stream ingest ------------------------------------------------------------------

    def streamed(self) -> OrderStore:
        """The same messages ingested as a capped stream; dimensions start empty."""

        def build() -> OrderStore:
            self.raw()
            store = OrderStore(self.spark, f"{self.root}/streamed")
            for part in (0, 1):
                # A later delivery must come after the earlier ones, so the second batch is
                # only taken up once the first has been read to its end.
                stream = read_order_stream(self.spark, f"{self.root}/raw_events/batch_id={part}", max_files=STREAM_FILES)
                ingest_stream(stream, store, f"{self.root}/checkpoint-{part}", self.as_of).awaitTermination()
            return store

        return self.once("streamed", build)
