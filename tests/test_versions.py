"""Keyed writes, version numbers and the running total, against plain Python."""

from __future__ import annotations

import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import item, order_event
from millrace.operators import versions as ver
from millrace.operators.running import running_total
from millrace.operators.validation import quarantine_rows, ingest_plan, order_versions_of
from millrace.operators.facts import line_items_of


def log_of(messages, as_of, *batches):
    frames = [
        ingest_plan(messages(*events, start=100 * number), as_of).withColumn("batch_id", F.lit(number).cast("long"))
        for number, events in enumerate(batches)
    ]
    log = frames[0]
    for frame in frames[1:]:
        log = log.unionByName(frame)
    return log


def test_later_versions_change_status_only_and_replace_items(messages, as_of):
    changed = order_event(1, order_status="SHIPPED", total_amount=99.0, items=[item(product_id="P9")])
    log = log_of(messages, as_of, [order_event(1), order_event(2)], [changed])
    orders = ver.current_orders(order_versions_of(log)).cache()
    row = orders.where("order_id = 'ORD-1'").first()
    assert row["order_status"] == "SHIPPED"
    assert row["total_amount"] == Decimal("20.00")
    assert (row["versions"], row["batch_id"]) == (2, 1)
    items = line_items_of(ver.keep_latest(log, orders)).collect()
    assert sorted((i["order_id"], i["product_id"]) for i in items) == [("ORD-1", "P9"), ("ORD-2", "P1")]


def test_repeats_inside_one_batch_do_not_double_items(messages, as_of):
    log = log_of(messages, as_of, [order_event(1), order_event(1), order_event(1)])
    orders = ver.current_orders(order_versions_of(log))
    assert orders.count() == 1
    assert line_items_of(ver.keep_latest(log, orders)).count() == 1
    assert ver.batch_duplicates(log).collect()[0]["duplicates"] == 2


def test_duplicates_are_counted_in_the_batch_they_arrive_in(messages, as_of):
    log = log_of(messages, as_of, [order_event(1), order_event(2)], [order_event(1), order_event(3)], [order_event(3)])
    counts = {r["batch_id"]: r["duplicates"] for r in ver.batch_duplicates(log).collect()}
    assert counts == {0: 0, 1: 1, 2: 1}


def test_event_id_of_another_order_is_quarantined(messages, as_of):
    stolen = order_event(2, event_id="evt-1")
    log = log_of(messages, as_of, [order_event(1), order_event(3)], [stolen, order_event(1)])
    reused = ver.reused_event_ids(ver.event_keys(log))
    assert [(r["order_id"], r["owner"]) for r in reused.collect()] == [("ORD-2", "ORD-1")]
    done = ver.settled(log, reused)
    kept = ver.current_orders(order_versions_of(done))
    assert sorted(r["order_id"] for r in kept.collect()) == ["ORD-1", "ORD-3"]
    row = quarantine_rows(done).first()
    assert json.loads(row["raw_payload"]) == stolen
    assert row["error_code"] == "DUPLICATE_EVENT_ID"
    assert row["rejection_reason"] == "Event id 'evt-1' already belongs to order 'ORD-1'."


def test_version_numbers_across_slices(spark):
    rng = random.Random(7)
    rows, seq = [], 0
    for batch in range(3):
        for _ in range(400):
            seq += rng.randint(1, 3)
            order = "hot" if rng.random() < 0.4 else f"o{rng.randint(1, 40)}"
            rows.append((order, batch, seq))
    frame = spark.createDataFrame(rows, "order_id string, batch_id long, seq long")
    expected, seen = {}, {}
    for order, batch, place in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[order] = seen.get(order, 0) + 1
        expected[(order, batch, place)] = seen[order]
    got = {
        (r["order_id"], r["batch_id"], r["seq"]): r["version_no"]
        for r in ver.numbered_versions(frame, slice_width=50).collect()
    }
    assert got == expected


def test_running_total_with_heavy_ties(spark):
    rng = random.Random(3)
    rows = [(f"o{i:04d}", 5 if rng.random() < 0.5 else rng.randint(0, 9), Decimal(rng.randint(0, 9999)) / 100) for i in range(1500)]
    frame = spark.createDataFrame(rows, "id string, t int, v decimal(12,2)")
    total, expected = Decimal(0), {}
    for key, t, v in sorted(rows, key=lambda r: (r[1], r[0])):
        total += v
        expected[key] = total
    got = running_total(frame, ["t", "id"], "v", "running", slices=7).collect()
    assert {r["id"]: r["running"] for r in got} == expected


def test_upsert_updates_listed_columns_only(spark):
    stored = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], "k string, name string, n int")
    fresh = spark.createDataFrame([("b", "X", 9), ("c", "C", 3)], "k string, name string, n int")
    rows = {r["k"]: (r["name"], r["n"]) for r in ver.upsert(stored, fresh, "k", ["n"]).collect()}
    assert rows == {"a": ("A", 1), "b": ("B", 9), "c": ("C", 3)}


def test_upsert_of_repeated_keys_inserts_the_first_and_updates_with_the_last(spark):
    stored = spark.createDataFrame([("a", "A", 1)], "k string, name string, n int")
    fresh = spark.createDataFrame(
        [("a", "X", 5, 1), ("a", "Y", 6, 2), ("z", "P", 7, 3), ("z", "Q", 8, 4)], "k string, name string, n int, seq long"
    )
    rows = {r["k"]: (r["name"], r["n"]) for r in ver.upsert(stored, fresh, "k", ["n"]).collect()}
    assert rows == {"a": ("A", 6), "z": ("P", 8)}


def test_cascade_delete_and_insert_if_absent(spark):
    children = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, parent string")
    gone = spark.createDataFrame([("a",)], "parent string")
    assert [r["id"] for r in ver.cascade_delete(children, gone, "parent").collect()] == [2]
    assert [r["id"] for r in ver.insert_if_absent(gone, children, "parent").collect()] == [2]
