"""Batches, replays and streams through the order store."""

from __future__ import annotations

import json
from functools import partial

import pytest
from pyspark.sql import DataFrame, functions as F

from conftest import item, order_event
from millrace.model import RAW_EVENT, TABLES
from millrace.operators import audits, lookup
from millrace.plans import marts, monitoring, reports, results
from millrace.session import scratch_path, shared_root, together
from millrace.sources import events as ev
from millrace.streaming import ingest
from millrace.streaming.telemetry import RATE_METRIC, ROWS_METRIC, ProgressMetrics
from millrace.streaming.ingest import LOG, OrderStore, ingest_stream


@pytest.fixture()
def store(spark):
    return OrderStore(spark, scratch_path(spark, "test-store"))


def dimensions(store):
    return [store.dimension(n) for n in ("dim_customers", "dim_locations", "dim_payment_methods")]


def status_of(spark, store, *ids):
    requested = spark.createDataFrame([(i,) for i in ids], "order_id string")
    rows = lookup.order_status(requested, store.fact_orders(), store.quarantine(), *dimensions(store)).collect()
    return {r["order_id"]: r for r in rows}


def test_manual_order_is_persisted(spark, store, messages, as_of):
    manual = order_event(
        7,
        customer_id="CUST-1099",
        location_id="LOC-CA01",
        payment_method_id="PAY-APPLE",
        order_status="PROCESSING",
        items=[item(product_id="PROD-E104", quantity=1, unit_price=1199.0, total_item_price=1199.0)],
        item_count=1,
        total_amount=1199.0,
        discount_amount=0.0,
        tax_amount=95.92,
        net_amount=1294.92,
    )
    stats = store.write_batch(messages(manual), 0, as_of)
    assert stats == {"processed": 1, "valid": 1, "quarantined": 0, "duplicates": 0}
    row = status_of(spark, store, "ORD-7")["ORD-7"]
    assert (row["found"], row["status"], row["destination"]) == (True, "PERSISTED", "fact_orders")
    assert float(row["net_amount"]) == 1294.92
    assert row["customer_name"] == "Customer CUST-1099"
    assert row["payment_method"] == "APPLE"


def test_negative_order_is_quarantined(spark, store, messages, as_of):
    bad = order_event(8, total_amount=-50.0, net_amount=-50.0, items=[item(unit_price=-50.0)])
    stats = store.write_batch(messages(bad, order_event(1)), 0, as_of)
    assert (stats["valid"], stats["quarantined"]) == (1, 1)
    rows = status_of(spark, store, "ORD-8", "ORD-404", "")
    assert rows["ORD-8"]["status"] == "QUARANTINED"
    assert rows["ORD-8"]["error_code"] == "NEGATIVE_OR_NULL_TOTAL"
    assert rows["ORD-404"]["status"] == "PENDING_INGESTION" and not rows["ORD-404"]["found"]
    assert rows[""]["status"] == "UNKNOWN"


def test_corrupt_event_is_quarantined(store, messages, as_of):
    corrupt = {"event_id": "ERR-TEST", "order_id": "ORD-CORRUPT", "customer_id": None, "total_amount": -50.0}
    assert store.write_batch(messages(corrupt, "]["), 0, as_of)["quarantined"] == 2
    codes = {r["event_id"]: r["error_code"] for r in store.quarantine().collect()}
    assert codes == {"ERR-TEST": "NULL_CUSTOMER_ID", None: "CORRUPT_PAYLOAD"}


def test_same_event_in_two_batches_is_one_order(store, messages, as_of):
    assert store.write_batch(messages(order_event(1)), 0, as_of)["duplicates"] == 0
    assert store.write_batch(messages(order_event(1), start=50), 1, as_of)["duplicates"] == 1
    assert store.fact_orders().count() == 1
    assert store.fact_order_items().count() == 1


def test_writing_a_batch_again_changes_nothing(store, messages, as_of):
    first, second = messages(order_event(1), order_event(2), "x"), messages(order_event(2), start=50)
    stats = [store.write_batch(first, 0, as_of), store.write_batch(second, 1, as_of)]
    before = [sorted(map(str, t.collect())) for t in (store.log(), store.fact_orders(), store.metrics(), *dimensions(store))]
    assert store.write_batch(first, 0, as_of) == stats[0]
    assert store.write_batch(second, 1, as_of) == stats[1]
    after = [sorted(map(str, t.collect())) for t in (store.log(), store.fact_orders(), store.metrics(), *dimensions(store))]
    assert before == after


def test_batch_without_marker_is_invisible(store, messages, as_of):
    store.write_batch(messages(order_event(1)), 0, as_of)
    rows = store.log().drop("batch_id")
    attempt = store.store.new_attempt()
    store.store.write(LOG, rows, 5, attempt, ["outcome"])
    assert store.log().count() == 1
    store.store.commit(5, attempt, as_of, 1)
    assert store.log().count() == 2


def test_failed_replay_leaves_the_committed_rows(store, messages, as_of):
    store.write_batch(messages(*[order_event(n) for n in range(1, 11)]), 0, as_of)
    broken = messages(*[order_event(n) for n in range(1, 11)]).withColumn("value", F.expr("if(seq = 7, raise_error('no'), value)"))
    with pytest.raises(Exception, match="no"):
        store.write_batch(broken, 0, as_of)
    assert store.fact_orders().count() == 10
    assert store.write_batch(messages(order_event(1)), 0, as_of)["processed"] == 1
    assert store.fact_orders().count() == 1


def test_readers_see_the_old_rows_while_a_batch_is_written_again(store, messages, as_of):
    store.write_batch(messages(order_event(1), order_event(2)), 0, as_of)
    attempt = store.store.new_attempt()
    store.store.write(LOG, store.log().drop("batch_id").limit(1), 0, attempt, ["outcome"])
    assert store.fact_orders().count() == 2


def test_replay_under_dynamic_overwrite(spark, store, messages, as_of):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        assert store.write_batch(messages(order_event(1), "bad"), 0, as_of)["quarantined"] == 1
        stats = store.write_batch(messages(order_event(1)), 0, as_of)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert stats == {"processed": 1, "valid": 1, "quarantined": 0, "duplicates": 0}
    assert store.quarantine().count() == 0


def test_new_stream_on_an_old_store_adds_to_it(spark, store, messages, as_of):
    folder = scratch_path(spark, "landing")
    for n in (1, 2):  # the second stream has lost its checkpoint and reads all again
        messages(order_event(n), start=10 * n).coalesce(1).write.mode("append").parquet(folder)
        stream = ev.read_order_stream(spark, folder, max_files=1)
        ingest_stream(stream, store, scratch_path(spark, "checkpoint"), as_of).awaitTermination()
    assert sorted(r["batch_id"] for r in store.store.committed().collect()) == [0, 1, 2]
    assert store.fact_orders().count() == 2
    assert {r["order_id"]: r["versions"] for r in store.fact_orders().collect()} == {"ORD-1": 2, "ORD-2": 1}


def test_reused_event_id_agrees_everywhere(store, messages, as_of):
    store.write_batch(messages(order_event(1)), 0, as_of)
    stolen = order_event(2, event_id="evt-1", customer_id="GHOST", metadata={"device": "web", "own": "x"})
    stats = store.write_batch(messages(stolen, order_event(3), start=50), 1, as_of)
    assert stats == {"processed": 2, "valid": 1, "quarantined": 1, "duplicates": 0}
    assert "GHOST" not in {r["customer_id"] for r in store.dimension("dim_customers").collect()}
    row = store.quarantine().first()
    assert (row["error_code"], json.loads(row["raw_payload"])) == ("DUPLICATE_EVENT_ID", stolen)
    assert {r["order_id"]: r["outcome"] for r in store.log().collect()} == {"ORD-1": "valid", "ORD-2": "quarantined", "ORD-3": "valid"}


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())


def test_empty_batch(store, messages, as_of):
    assert store.write_batch(messages(order_event(1)).limit(0), 0, as_of) == monitoring.no_events()
    assert store.fact_orders().count() == 0


def test_known_dimension_rows_are_kept(spark, store, messages, as_of):
    seed = spark.createDataFrame([("CUST-1042", "Known", "k@x", "VIP")], "customer_id string, customer_name string, email string, segment string")
    store.seed_dimensions({"dim_customers": seed}, as_of)
    store.write_batch(messages(order_event(1), order_event(2, customer_id="CUST-NEW")), 0, as_of)
    store.write_batch(messages(order_event(3, customer_id="CUST-NEW"), start=50), 1, as_of)
    rows = {r["customer_id"]: r for r in store.dimension("dim_customers").collect()}
    assert len(rows) == store.dimension("dim_customers").count() == 2
    assert rows["CUST-1042"]["segment"] == "VIP"
    assert (rows["CUST-NEW"]["segment"], rows["CUST-NEW"]["email"]) == ("Standard", "cust-new@customers.invalid")
    product = store.dimension("dim_products").first()
    assert (product["category"], str(product["base_price"]), str(product["cost_price"])) == ("General", "10.00", "7.00")


def test_whole_pipeline(store, messages, as_of):
    events = [order_event(n, order_status="DELIVERED" if n % 3 else "CANCELLED") for n in range(1, 28)]
    stats = store.write_batch(messages(*events, order_event(90, items=[]), "bad", order_event(1)), 0, as_of)
    assert stats == {"processed": 30, "valid": 28, "quarantined": 2, "duplicates": 1}
    orders, quarantine = store.fact_orders().cache(), store.quarantine().cache()
    kpis = reports.executive_kpis(orders, quarantine).first()
    assert (kpis["total_orders"], kpis["quarantined_count"], kpis["delivered_orders"]) == (27, 2, 17)
    assert kpis["delivery_rate"] == 63.0
    assert round(kpis["total_revenue"], 2) == round(27 * 20.52, 2)
    suite = {r["check_type"]: r["status"] for r in audits.audit_suite(orders, *dimensions(store), strict=True).collect()}
    assert set(suite.values()) == {"PASSED"} and len(suite) == 3
    mart = marts.rollup_snapshot(orders, quarantine, as_of).first()
    assert (mart["total_orders"], mart["quarantined_orders"]) == (27, 2)
    assert str(mart["hourly_window_start"]) == "2026-01-15 11:00:00"
    feed = reports.recent_orders_feed(orders, *dimensions(store), limit=10).collect()
    assert len(feed) == 10 and feed[0]["customer_name"] == "Customer CUST-1042"
    rate = reports.validation_pass_rate(orders, quarantine).first()
    assert rate["pass_rate"] == 93.1
    details = json.loads(store.metrics().first()["details"])
    assert details == {"valid": 28, "quarantined": 2, "duplicates_detected": 1, "avg_latency_ms": 1500.0}


def test_strict_suite_raises(store, messages, as_of):
    store.write_batch(messages(order_event(1, net_amount=99.0)), 0, as_of)
    with pytest.raises(audits.AuditFailure, match="1 of 1"):
        audits.audit_suite(store.fact_orders(), *dimensions(store), strict=True)


def test_stream_matches_batch(spark, messages, as_of):
    folder = scratch_path(spark, "landing")
    parts = [
        messages(order_event(1), order_event(2), "bad"),
        messages(order_event(1, order_status="SHIPPED"), order_event(3), start=100),
    ]
    streamed = OrderStore(spark, scratch_path(spark, "streamed"))
    checkpoint = scratch_path(spark, "checkpoint")
    for part in parts:  # the second run resumes from the checkpoint of the first
        part.coalesce(1).write.mode("append").parquet(folder)
        query = ingest_stream(ev.read_order_stream(spark, folder, max_files=1), streamed, checkpoint, as_of)
        query.awaitTermination()
    batch = OrderStore(spark, scratch_path(spark, "batch"))
    for number, part in enumerate(parts):
        batch.write_batch(part, number, as_of)
    assert streamed.store.committed().count() == 2
    for table in ("fact_orders", "quarantine", "metrics"):
        ours, theirs = getattr(streamed, table)(), getattr(batch, table)()
        assert sorted(map(str, ours.select(theirs.columns).collect())) == sorted(map(str, theirs.collect()))


def test_published_events_come_back_as_messages(spark, messages, as_of, store):
    path = scratch_path(spark, "topic")
    outgoing = spark.read.json(messages(order_event(1), order_event(2)).rdd.map(lambda r: r["value"]))
    ev.publish(outgoing, "parquet", {}, path)
    received = spark.read.parquet(path).select(
        F.col("value"), F.monotonically_increasing_id().alias("seq"), F.lit("2026-01-15 11:00:01").cast("timestamp").alias("received_at")
    )
    assert {f.name for f in RAW_EVENT.fields} == set(received.columns)
    assert sorted(r["key"] for r in spark.read.parquet(path).collect()) == ["ORD-1", "ORD-2"]
    assert store.write_batch(received, 0, as_of)["valid"] == 2


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_compaction_equals_the_live_views(spark, store, messages, as_of, threshold):
    first = [order_event(n) for n in range(1, 9)] + [order_event(2, order_status="SHIPPED"), "bad"]
    second = [
        order_event(3, order_status="DELIVERED", items=[item(product_id="P7"), item(product_id="P8")]),
        order_event(50, event_id="evt-4"),
        order_event(9),
    ]
    store.write_batch(messages(*first), 0, as_of)
    store.write_batch(messages(*second, start=100), 1, as_of)
    target = scratch_path(spark, "compacted")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        store.compact(target)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    live = {
        "fact_orders": store.fact_orders(),
        "fact_order_items": store.fact_order_items(),
        "quarantine_orders": store.quarantine(),
    }
    for name, rows in live.items():
        stored = store.compacted(target, name).select(rows.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect())), name
    assert live["fact_orders"].count() == 9
    codes = sorted(r["error_code"] for r in live["quarantine_orders"].collect())
    assert codes == ["CORRUPT_PAYLOAD", "DUPLICATE_EVENT_ID"]


def test_stored_results_are_appended_and_hours_replaced(spark, store, messages, as_of):
    store.write_batch(messages(order_event(1), order_event(2, order_timestamp="2026-01-15T09:10:00+00:00")), 0, as_of)
    kept = results.ResultStore(spark, scratch_path(spark, "results"))
    orders, rejected = store.fact_orders(), store.quarantine()
    kept.replace_hours(marts.hourly_rollup(orders, rejected, as_of), as_of)
    fresh = marts.hourly_rollup(orders.where("order_id = 'ORD-1'"), rejected, as_of).withColumn("total_orders", F.lit(7).cast("long"))
    kept.replace_hours(fresh, as_of)
    assert sorted(r["total_orders"] for r in kept.mart().collect()) == [1, 7]
    suite = audits.audit_suite(orders, *dimensions(store))
    for run in range(2):
        stamp = as_of + F.lit(run) * F.expr("INTERVAL 1 HOUR")
        kept.append(results.AUDITS, audits.audit_log_rows(suite, stamp), stamp)
    assert kept.audit_log().count() == 2 * suite.count()
    assert kept.mart().count() == 2 and kept.metrics().count() == 0


def same_as_live(spark, store, target):
    live = {"fact_orders": store.fact_orders(), "fact_order_items": store.fact_order_items(), "quarantine_orders": store.quarantine()}
    for name, rows in live.items():
        stored = store.compacted(target, name).select(rows.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect())), name


def folders(spark, target, table):
    """Files of a table's partition folders."""
    rows = spark.read.parquet(f"{target}/{table}").select("bucket", F.col("_metadata.file_path").alias("file")).distinct().collect()
    return {(r["bucket"], r["file"]) for r in rows}


def test_second_compaction_touches_only_the_buckets_of_new_batches(spark, messages, as_of):
    store, target = OrderStore(spark, scratch_path(spark, "store"), buckets=64), scratch_path(spark, "compacted")
    store.write_batch(messages(*[order_event(n) for n in range(1, 201)], "bad"), 0, as_of)
    assert store.compact(target) == {"mode": "full", "buckets": 64}
    same_as_live(spark, store, target)
    before = folders(spark, target, "fact_orders")
    changed = order_event(5, order_status="SHIPPED", items=[item(product_id="P7"), item(product_id="P8")])
    store.write_batch(messages(changed, order_event(900), order_event(901, event_id="evt-9"), "bad", start=500), 1, as_of)
    done = store.compact(target)
    assert done["mode"] == "delta" and 1 <= done["buckets"] <= 2
    same_as_live(spark, store, target)
    after = folders(spark, target, "fact_orders")
    assert len({b for b, _ in before}) > 50
    assert {b for b, _ in after - before} == {b for b, _ in before - after} and len({b for b, _ in after - before}) == done["buckets"]
    assert store.compact(target) == {"mode": "none", "buckets": 0}
    # A batch written again has everything written anew.
    store.write_batch(messages(order_event(900), start=500), 1, as_of)
    assert store.compact(target)["mode"] == "full"
    same_as_live(spark, store, target)


def test_compaction_that_failed_half_way_is_taken_up(spark, store, messages, as_of, monkeypatch):
    target = scratch_path(spark, "compacted")
    store.write_batch(messages(*[order_event(n) for n in range(1, 30)]), 0, as_of)
    store.compact(target)
    store.write_batch(messages(order_event(3, order_status="SHIPPED"), order_event(99), start=100), 1, as_of)
    replace = ingest._CompactionState.replace

    def failing(self, name, *args, **options):
        if name == "fact_order_items":
            raise RuntimeError("lost")
        return replace(self, name, *args, **options)

    monkeypatch.setattr(ingest._CompactionState, "replace", failing)
    with pytest.raises(RuntimeError, match="lost"):
        store.compact(target)
    monkeypatch.undo()
    assert store.compact(target)["mode"] == "none"  # after the staged changes were put in place
    same_as_live(spark, store, target)
    assert {r["order_id"]: r["versions"] for r in spark.read.parquet(f"{target}/fact_orders").collect()}["ORD-3"] == 2


def test_late_batch_number_has_everything_written_anew(spark, store, messages, as_of):
    target = scratch_path(spark, "compacted")
    store.write_batch(messages(order_event(1, order_status="SHIPPED"), start=50), 5, as_of)
    store.compact(target)
    store.write_batch(messages(order_event(1), order_event(2)), 3, as_of)
    assert store.compact(target)["mode"] == "full"
    same_as_live(spark, store, target)


def files_read(rows):
    """Files opened by the scans of a query that has run."""
    plan, found = rows._jdf.queryExecution().executedPlan(), 0
    pending = [plan]
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            pending.append(node.executedPlan())
        elif "QueryStage" in name:
            pending.append(node.plan())
        else:
            if name.startswith("Scan parquet"):
                found += node.metrics().apply("numFiles").value()
            children = node.children()
            pending += [children.apply(i) for i in range(children.size())]
    return found


def test_key_probe_reads_the_touched_buckets_alone(spark, messages, as_of):
    store = OrderStore(spark, scratch_path(spark, "store"), buckets=64)
    store.write_batch(messages(*[order_event(n) for n in range(1, 401)]), 0, as_of)
    ids = messages(order_event(7)).select(F.lit("ORD-7").alias("order_id")).where(F.col("order_id") == "ORD-7")
    attempts = list(store.store.attempts_before(1).values())
    all_rows = store.store.of_attempts(ingest.ORDER_KEYS, attempts)
    all_rows.collect()
    assert files_read(all_rows) > 50
    path = scratch_path(spark, "ids")
    ids.write.parquet(path)
    probe = store.earlier_keys(ingest.ORDER_KEYS, spark.read.parquet(path).where(F.col("order_id") == "ORD-7"), attempts)
    found = {r["order_id"] for r in probe.collect()}
    assert "ORD-7" in found and len(found) < 40
    # One bucket of the index and the ids themselves.
    assert files_read(probe) <= 2


def test_mart_of_changes_is_the_mart_of_all_orders(store, messages, as_of):
    early = "2026-01-15T09:10:00+00:00"
    first = [order_event(n, order_status="DELIVERED" if n % 2 else "PENDING") for n in range(1, 6)]
    batches = [
        [*first, "bad", order_event(1, order_status="CANCELLED")],
        # Taken back and given anew, in the hour of the first event; what else is said later doesn't count.
        [order_event(1, order_status="DELIVERED"), order_event(2, order_status="CANCELLED", order_timestamp=early, net_amount=1.0)],
        [order_event(3, order_status="RETURNED"), order_event(7, order_timestamp=early), order_event(8, event_id="evt-4")],
        [order_event(2, order_status="DELIVERED"), order_event(2, order_status="CANCELLED")],
    ]
    for number, events in enumerate(batches):
        store.write_batch(messages(*events, start=100 * number), number, as_of)
        kept, fresh = store.hourly_mart(), marts.hourly_rollup(store.fact_orders(), store.quarantine(), as_of)
        assert sorted(map(str, kept.collect())) == sorted(map(str, fresh.collect()))
    store.write_batch(messages(*batches[1], start=100), 1, as_of)
    assert sorted(map(str, store.hourly_mart().collect())) == sorted(map(str, fresh.collect()))


def test_orders_since_reads_the_recent_batches_alone(spark, store, messages, as_of):
    store.write_batch(messages(order_event(1), order_event(2)), 0, as_of)
    store.write_batch(messages(order_event(2), order_event(3), start=50, received="2026-01-15 11:30:00"), 1, as_of)
    recent = store.orders_since(F.lit("2026-01-15 11:29:50").cast("timestamp"))
    assert sorted(r["order_id"] for r in recent.collect()) == ["ORD-2", "ORD-3"]
    plan = recent._jdf.queryExecution().toString()
    assert "dynamicpruningexpression(batch_id" in plan
    none = store.orders_since(F.lit("2026-01-15 12:00:00").cast("timestamp"))
    assert none.count() == 0


def test_runs_written_at_once_are_all_seen(spark, as_of):
    root = scratch_path(spark, "results")
    suite = spark.createDataFrame([("c", "t", "f", 1, 1, 0, 100.0, "PASSED", "{}")], "check_name string, check_type string, table_audited string, records_evaluated long, records_passed long, records_failed long, pass_rate double, status string, details string")

    def append(run):
        stamp = as_of + F.lit(run) * F.expr("INTERVAL 1 DAY")
        # Each with a store of its own, as separate drivers have.
        return results.ResultStore(spark, root).append(results.AUDITS, audits.audit_log_rows(suite, stamp), stamp)

    runs = together(spark, *[partial(append, run) for run in range(40)][:8])
    assert len(set(runs)) == 8
    log = results.ResultStore(spark, root).audit_log()
    assert log.count() == 8 and log.select("audit_timestamp").distinct().count() == 8


def test_mart_months_are_pruned(spark, as_of):
    kept = results.ResultStore(spark, scratch_path(spark, "results"))
    hours = spark.range(3).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("hourly_window_start", "total_orders") else
          (F.add_months(F.lit("2026-01-15"), F.col("id").cast("int")).cast("timestamp").alias(f.name) if f.name == "hourly_window_start" else F.col("id").alias(f.name))
          for f in TABLES[results.MART].fields]
    )
    kept.replace_hours(hours, as_of)
    kept.replace_hours(hours.withColumn("total_orders", F.col("total_orders") + 10), as_of)
    one = kept.mart(["2026-02"])
    assert [r["total_orders"] for r in one.collect()] == [11]
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().toString() or "month#" in one._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r["total_orders"] for r in kept.mart().collect()) == [10, 11, 12]


def test_progress_of_a_stream_is_stored(spark, messages, as_of):
    folder, store = scratch_path(spark, "landing"), OrderStore(spark, scratch_path(spark, "store"))
    for n in (1, 2):
        messages(order_event(n), "bad", start=10 * n).coalesce(1).write.mode("append").parquet(folder)
    heard, kept = ProgressMetrics(spark), results.ResultStore(spark, scratch_path(spark, "results"))
    spark.streams.addListener(heard)
    try:
        query = ingest_stream(ev.read_order_stream(spark, folder, max_files=1), store, scratch_path(spark, "checkpoint"), as_of)
        query.awaitTermination()
        heard.wait_for(query)
    finally:
        spark.streams.removeListener(heard)
    assert heard.store(kept, as_of) >= 4 and heard.store(kept, as_of) == 0
    rows = kept.metrics().collect()
    taken = {json.loads(r["details"])["trigger"]: r["metric_value"] for r in rows if r["metric_name"] == ROWS_METRIC and r["metric_value"]}
    assert taken == {0: 2.0, 1: 2.0}
    assert all(r["metric_value"] > 0 for r in rows if r["metric_name"] == RATE_METRIC and json.loads(r["details"])["trigger"] in taken)
    assert len({r["metric_id"] for r in rows}) == len(rows)


def test_changes_of_the_mart_are_summed_up_in_many_tasks(store, messages, as_of, monkeypatch):
    plans, write = {}, store.store.write

    def noted(table, rows, *more):
        plans[table] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(table, rows, *more)

    monkeypatch.setattr(store.store, "write", noted)
    store.write_batch(messages(order_event(1), "bad"), 0, as_of)
    # One file, but not one task for the groups and joins before it.
    assert plans[ingest.CHANGES].startswith("Repartition 1, true")


def test_compaction_shuffles_events_rather_than_lines_and_leaves_kept_rows_in_place(spark, store, messages, as_of, monkeypatch):
    plans, target = {}, scratch_path(spark, "plans")

    def noted(step, wrapped):
        def run(self, *given, **more):
            name, rows = [g for g in given if isinstance(g, (str, DataFrame))][:2]
            plans[step, name] = rows._jdf.queryExecution().optimizedPlan().toString()
            return wrapped(self, *given, **more)

        return run

    for step in ("replace", "stage"):
        monkeypatch.setattr(ingest._CompactionState, step, noted(step, getattr(ingest._CompactionState, step)))
    store.write_batch(messages(order_event(1), order_event(2)), 0, as_of)
    assert store.compact(target)["mode"] == "full"
    whole = plans["replace", ingest.ITEMS]
    assert 0 <= whole.index("Generate") < whole.index("RebalancePartitions")
    store.write_batch(messages(order_event(2), order_event(3), start=50), 1, as_of)
    assert store.compact(target)["mode"] == "delta"
    for name in (ingest.ORDERS, ingest.ITEMS):
        assert plans["stage", name].startswith("Union")
    orders, items = (store.compacted(target, t) for t in (ingest.ORDERS, ingest.ITEMS))
    assert sorted((r["order_id"], r["versions"]) for r in orders.collect()) == [("ORD-1", 1), ("ORD-2", 2), ("ORD-3", 1)]
    assert sorted((r["order_id"], r["batch_id"]) for r in items.collect()) == [("ORD-1", 0), ("ORD-2", 1), ("ORD-3", 1)]


def test_stored_tables_are_packed_with_zstd(spark, store, messages, as_of):
    store.write_batch(messages(order_event(1)), 0, as_of)
    files = store.store.raw(LOG).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
