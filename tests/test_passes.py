"""How the wide steps run: compiled rules, rows grouped without sorting, scans left out."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import item, order_event
from millrace.operators import dimensions
from millrace.operators.few import within, without
from millrace.operators.validation import VALID, ingest_plan, valid_events
from millrace.operators.versions import event_keys, met_event_ids, reused_event_ids
from millrace.session import scratch_path
from millrace.streaming import ingest
from millrace.streaming.ingest import LOG, MET, REUSED, OrderStore
from workload import derive


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def store(spark):
    return OrderStore(spark, scratch_path(spark, "test-passes"))


def test_no_lambda_runs_on_the_items_of_good_events(messages, as_of):
    plan = plan_of(ingest_plan(messages(order_event()), as_of))
    assert "exists(" not in plan


def test_items_without_an_absent_discount_are_cast_alike(messages, as_of):
    lines = [item(unit_price=1.005, total_item_price=2.675, discount_applied=0.125), item(product_id="P2", unit_price=9999999999.99)]
    with_absent = [*lines, item(product_id="P3", discount_applied=None)]
    both = ingest_plan(messages(order_event(1, items=lines), order_event(2, items=with_absent)), as_of).orderBy("seq").collect()
    assert [r["outcome"] for r in both] == [VALID, VALID]
    assert both[0]["items"] == both[1]["items"][:2]
    assert str(both[0]["items"][0]["unit_price"]) == "1.01" and both[1]["items"][2]["discount_applied"] == 0


def test_amounts_that_fit_no_column_are_found_in_any_element(messages, as_of):
    cases = [("unit_price", 1e10), ("total_item_price", None), ("total_item_price", -0.01), ("total_item_price", float("nan")), ("discount_applied", -1e10)]
    raw = messages(*[order_event(i, items=[item(), item(**{name: value}), item()]) for i, (name, value) in enumerate(cases)])
    codes = [r["error_code"] for r in ingest_plan(raw, as_of).orderBy("seq").collect()]
    assert codes == [f"CONSTRAINT_{name.upper()}" for name, _ in cases]


def test_the_log_is_written_without_a_sort(spark, store, messages, as_of, monkeypatch):
    plans = {}
    write = store.store.write

    def seen(table, rows, batch_id, attempt, partition_by=None):
        write(table, rows, batch_id, attempt, partition_by)
        plans[table] = int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))

    monkeypatch.setattr(store.store, "write", seen)
    store.write_batch(messages(order_event(1), "not json"), 0, as_of)
    # A task sorts once it has opened as many files as this; the log has two folders.
    assert plans[LOG] > 2
    assert {r["outcome"] for r in store.log().select("outcome").collect()} == {"valid", "quarantined"}


def test_orders_of_a_batch_are_grouped_by_hash(store, messages, as_of):
    raw = messages(order_event(1), order_event(1, event_id="evt-9", order_status="shipped", net_amount=5.0), order_event(2))
    log = ingest_plan(raw, as_of).withColumn("batch_id", F.lit(0).cast("long"))
    keys = store._order_keys(valid_events(log), [])
    assert "SortAggregate" not in plan_of(keys) and "HashAggregate" in plan_of(keys)
    first = {r["order_id"]: r for r in keys.collect()}["ORD-1"]
    assert (first["events"], float(first["net_amount"]), first["order_status"]) == (2, 20.52, "SHIPPED")


def test_only_ids_met_again_are_looked_into(store, messages, as_of):
    store.write_batch(messages(order_event(1), order_event(2)), 0, as_of)
    assert store.store.read(MET).count() == 0 and store.store.read(REUSED).count() == 0
    store.write_batch(messages(order_event(2), order_event(3, event_id="evt-1"), order_event(4), start=10), 1, as_of)
    assert sorted(r["event_id"] for r in store.store.read(MET).collect()) == ["evt-1", "evt-2"]
    assert [(r["event_id"], r["order_id"], r["owner"]) for r in store.store.read(REUSED).collect()] == [("evt-1", "ORD-3", "ORD-1")]


def test_met_ids_hold_all_reused_ones(messages, as_of):
    raw = messages(order_event(1), order_event(2, event_id="evt-1"), order_event(3), order_event(3))
    own = event_keys(ingest_plan(raw, as_of).withColumn("batch_id", F.lit(0).cast("long")))
    assert [r[0] for r in met_event_ids(own).collect()] == ["evt-1"] == [r["event_id"] for r in reused_event_ids(own).collect()]


def test_lines_are_sorted_once_and_grouped_as_they_come(spark):
    lineitem = spark.createDataFrame(
        [(k, n, n * 3, 1, 2.0, 10.0 * n, 0.1, 0.05) for k in (2, 1, None, 2) for n in (10, 9, 1)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
    )
    part = spark.createDataFrame([(3, 1.5), (27, 2.25)], "p_partkey long, p_retailprice double")
    items = derive.order_items(derive.order_lines(lineitem, part, 2))
    items.collect()
    plan = plan_of(items)
    assert "ObjectHashAggregate" not in plan and "SortAggregate" in plan
    rows = {r["l_orderkey"]: r for r in items.collect()}
    assert [x["product_id"] for x in rows[1]["items"]] == ["PROD-3", "PROD-27", "PROD-30"]
    assert [x["product_id"] for x in rows[2]["items"]] == ["PROD-3", "PROD-3", "PROD-27", "PROD-27", "PROD-30", "PROD-30"]
    assert [str(x["unit_price"]) for x in rows[1]["items"]] == ["1.50", "2.25", "None"]
    assert rows[None]["item_count"] == 6 and str(rows[2]["total"]) == "400.00"


def test_payloads_of_batches_without_reused_ids_are_not_scanned(store, messages, as_of, monkeypatch):
    store.write_batch(messages(order_event(1), "broken"), 0, as_of)
    store.write_batch(messages(order_event(2, event_id="evt-1"), order_event(3), start=10), 1, as_of)
    plans = {}
    replace = ingest._CompactionState.replace

    def seen(self, name, rows, key, whole=False):
        plans[name] = plan_of(rows)
        return replace(self, name, rows, key, whole)

    monkeypatch.setattr(ingest._CompactionState, "replace", seen)
    target = f"{store.store.root}-compacted"
    store.compact(target)
    assert "batch_id#" in plans[ingest.REJECTED].split("PartitionFilters: [", 1)[1].split("]")[0] and "= 1)" in plans[ingest.REJECTED]
    codes = sorted(r["error_code"] for r in store.compacted(target, ingest.REJECTED).collect())
    assert codes == ["CORRUPT_PAYLOAD", "DUPLICATE_EVENT_ID"]
    assert codes == sorted(r["error_code"] for r in store.quarantine().collect())


def test_a_long_table_that_packs_well_is_not_broadcast(spark):
    path = scratch_path(spark, "known")
    # A million keys in a few megabytes; Spark takes the packed bytes of the columns read for their size.
    spark.range(1_000_000).select(F.concat(F.lit("CUST-"), "id").alias("customer_id"), F.concat(F.lit("c"), "id").alias("email"), F.lit("a").alias("segment")).write.parquet(path)
    orders = spark.createDataFrame([("CUST-7",), ("CUST-X",)], "customer_id string")
    new = dimensions.infer_customers(orders, spark.read.parquet(path))
    assert "Broadcast" not in plan_of(new)
    assert [r["customer_id"] for r in new.collect()] == ["CUST-X"]
    numbers = spark.range(600_000).select(F.col("id").alias("p_partkey"), F.lit(1.5).alias("p_retailprice"))
    numbers.write.parquet(f"{path}-numbers")
    lines = spark.createDataFrame([(1, 1, 599_999, 1, 2.0, 3.0, 0.0, 0.0)], "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    priced = derive.order_lines(lines, spark.read.parquet(f"{path}-numbers"), 2)
    assert "Broadcast" not in plan_of(priced)
    assert [float(r["unit_price"]) for r in priced.collect()] == [1.5]


@pytest.mark.parametrize("short", [1000, 0])
def test_rows_are_parted_by_few_keys(spark, short):
    path = scratch_path(spark, "few")
    rows = spark.range(5000).select(F.when(F.col("id") % 7 != 0, F.concat(F.lit("K"), F.col("id") % 900)).alias("key"), (F.col("id") % 11).alias("place"), "id")
    keyed = spark.range(100).select(F.concat(F.lit("K"), F.col("id") * 3).alias("key"), (F.col("id") % 11).alias("place"))
    keyed.unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS key, 1L AS place")).write.parquet(path)
    for keys in (["key"], ["key", "place"]):
        stored = spark.read.parquet(path).select(*keys)
        for parted, how in ((within, "left_semi"), (without, "left_anti")):
            found = parted(rows, stored, keys, short)
            assert found.columns == rows.columns
            assert sorted(map(str, found.collect())) == sorted(map(str, rows.join(stored, keys, how).select(rows.columns).collect()))
            assert ("SortMergeJoin" in plan_of(found)) == (not short)


def test_compaction_by_a_map_of_repeated_orders(spark, store, messages, as_of, monkeypatch):
    for parted in (within, without):
        monkeypatch.setattr(parted, "__defaults__", (0,))
    first = [order_event(n) for n in range(1, 30)] + [order_event(n, order_status="SHIPPED", items=[item(product_id="P9")]) for n in range(1, 8)]
    store.write_batch(messages(*first), 0, as_of)
    target, whole = scratch_path(spark, "merged"), scratch_path(spark, "whole")
    store.compact(target)
    store.write_batch(messages(*[order_event(n, order_status="DELIVERED", items=[item(), item()]) for n in (3, 20, 40)], start=100), 1, as_of)
    assert store.compact(target)["mode"] == "delta"
    assert store.compact(whole)["mode"] == "full"
    for name, live in (("fact_orders", store.fact_orders()), ("fact_order_items", store.fact_order_items())):
        for at in (target, whole):
            assert sorted(map(str, store.compacted(at, name).select(live.columns).collect())) == sorted(map(str, live.collect()))
