"""Keyed writes on an append-only log: the current state is derived, never updated in place.

A version of an order is placed by (batch_id, seq). The first version supplies most columns,
the last one those that a repeated delivery may change, and the line items of the last
version replace all earlier ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.rules import DUPLICATE_EVENT_ID, REASON_DUPLICATE_EVENT, text
from millrace.model import ORDER_FIXED, ORDER_UPDATES, TABLES
from millrace.operators.few import within, without
from millrace.operators.validation import QUARANTINED, VALID, valid_events

VERSION_KEYS = ["order_id", "batch_id", "seq"]


def version(*names: str) -> Column:
    return F.struct(*[F.col(n) for n in (names or ("batch_id", "seq"))])


def current_orders(versions: DataFrame) -> DataFrame:
    """One row per order. Versions combine on the map side, so a much repeated order is no hot spot.

    ``batch_id`` and ``seq`` name the last version, ``versions`` counts them.
    """
    place = version()
    grouped = versions.groupBy("order_id").agg(
        F.min_by(F.struct(*ORDER_FIXED), place).alias("first"),
        F.max_by(F.struct(*ORDER_UPDATES, "batch_id", "seq"), place).alias("last"),
        F.count("*").alias("versions"),
    )
    names = [f.name for f in TABLES["fact_orders"].fields]
    source = {n: F.col(f"first.{n}") for n in ORDER_FIXED} | {n: F.col(f"last.{n}") for n in ORDER_UPDATES}
    return grouped.select(
        *[F.col("order_id") if n == "order_id" else source[n].alias(n) for n in names],
        F.col("last.batch_id").alias("batch_id"),
        F.col("last.seq").alias("seq"),
        "versions",
    )


def repeated_orders(versions: DataFrame) -> DataFrame:
    """Ids of orders with more than one version; only this column is shuffled."""
    return (
        versions.groupBy("order_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("order_id")
    )


def current_orders_given(versions: DataFrame, repeated: DataFrame) -> DataFrame:
    """``current_orders`` for a log in which few orders repeat.

    Orders with a single version, nearly all of the log, pass by the repeated ones. Give
    ``repeated`` as a written table: its rows are counted.
    """
    names = [f.name for f in TABLES["fact_orders"].fields]
    single = without(versions, repeated, ["order_id"]).select(
        *names, "batch_id", "seq", F.lit(1).cast("long").alias("versions")
    )
    return single.unionByName(current_orders(within(versions, repeated, ["order_id"])))


def superseded_versions(versions: DataFrame, repeated: DataFrame, orders: DataFrame) -> DataFrame:
    """Deliveries that a later one of the same order replaced."""
    latest = orders.where(F.col("versions") > 1).select("order_id", version().alias("_latest"))
    candidates = within(versions.select(*VERSION_KEYS), repeated, ["order_id"])
    return candidates.join(latest, "order_id").where(version() < F.col("_latest")).select(*VERSION_KEYS)


def merged_orders(stored: DataFrame, later: DataFrame) -> DataFrame:
    """Rows of ``current_orders`` for two logs of which the second came after the first whole.

    A known order keeps its fixed columns and takes status, times and place of the later log; versions add up.
    """
    last = [*ORDER_UPDATES, "batch_id", "seq"]
    rest = [c for c in stored.columns if c != "order_id"]
    both = stored.select("order_id", F.struct(*rest).alias("_old")).join(
        later.select("order_id", F.struct(*rest).alias("_new")), "order_id", "full_outer"
    )
    known, offered = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def value(name: str) -> Column:
        old, new = F.col("_old")[name], F.col("_new")[name]
        if name == "versions":
            return F.coalesce(old, F.lit(0).cast("long")) + F.coalesce(new, F.lit(0).cast("long"))
        return F.when(offered, new).otherwise(old) if name in last else F.when(known, old).otherwise(new)

    return both.select(*[F.col(c) if c == "order_id" else value(c).alias(c) for c in stored.columns])


def keep_latest(rows: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of the log that belong to the last version of their order."""
    return rows.join(orders.select(*VERSION_KEYS), VERSION_KEYS, "left_semi")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, update_columns: list[str]) -> DataFrame:
    """Full outer keyed merge: new keys are added, known keys take only ``update_columns``.

    ``incoming`` may repeat a key; its rows then need a ``seq`` column, and each key is
    inserted with its first row and updated with its last one.
    """
    columns = [c for c in stored.columns if c != key]
    if "seq" in incoming.columns:
        grouped = incoming.groupBy(key).agg(
            *[
                (F.max_by(F.col(c), F.col("seq")) if c in update_columns else F.min_by(F.col(c), F.col("seq"))).alias(c)
                for c in columns
            ]
        )
        incoming = grouped
    left = stored.select(key, F.struct(*columns).alias("_old"))
    right = incoming.select(key, F.struct(*columns).alias("_new"))
    merged = left.join(right, key, "full_outer")
    known, offered = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def pick(column: str) -> Column:
        if column in update_columns:
            return F.when(offered, F.col("_new")[column]).otherwise(F.col("_old")[column])
        return F.when(known, F.col("_old")[column]).otherwise(F.col("_new")[column])

    return merged.select(key, *[pick(c).alias(c) for c in columns]).select(*stored.columns)


def insert_if_absent(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Only those incoming rows whose key is not stored yet."""
    return incoming.join(stored.select(key), key, "left_anti")


def numbered_versions(versions: DataFrame, slice_width: int = 100_000) -> DataFrame:
    """``version_no`` of every delivery of an order, in arrival order.

    Ranks are taken inside slices of the sequence range, which hold at most ``slice_width``
    rows of an order, and shifted by the row counts of the order's earlier slices. An order
    delivered billions of times is thus spread over many tasks.
    """
    slice_keys = ["order_id", "batch_id", "slice"]
    sliced = versions.withColumn(
        "slice", F.call_function("div", F.col("seq"), F.lit(slice_width).cast("long"))
    )
    sizes = sliced.groupBy(*slice_keys).agg(F.count("*").alias("size"))
    before = Window.partitionBy("order_id").orderBy("batch_id", "slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Only orders that span several slices have an offset to carry.
    offsets = (
        sizes.withColumn("offset", F.sum("size").over(before))
        .where(F.col("offset").isNotNull())
        .drop("size")
    )
    inside = Window.partitionBy(*slice_keys).orderBy("seq")
    ranked = sliced.withColumn("_rank", F.row_number().over(inside))
    return ranked.join(offsets, slice_keys, "left").select(
        *versions.columns,
        (F.col("_rank") + F.coalesce(F.col("offset"), F.lit(0))).cast("long").alias("version_no"),
    )


def batch_duplicates(log: DataFrame) -> DataFrame:
    """Per batch: valid events whose order was already stored when they arrived.

    Everything but the very first version of an order counts. Versions are first counted per
    (order, batch), so only one small row per pair meets the per-order minimum.
    """
    per_batch = (
        valid_events(log)
        .groupBy("order_id", "batch_id")
        .agg(F.count("*").alias("events"))
    )
    first = per_batch.groupBy("order_id").agg(F.min("batch_id").alias("first_batch"))
    return (
        per_batch.join(first, "order_id")
        .select(
            "batch_id",
            (F.col("events") - (F.col("batch_id") == F.col("first_batch")).cast("long")).alias("repeats"),
        )
        .groupBy("batch_id")
        .agg(F.sum("repeats").alias("duplicates"))
    )


def event_keys(log: DataFrame) -> DataFrame:
    """Each event id of a batch with each order that used it, and the first place it did."""
    ids = valid_events(log).groupBy("batch_id", "event_id", "order_id").agg(F.min("seq").alias("seq"))
    return ids.select("event_id", *VERSION_KEYS)


def _seen(own: DataFrame, earlier: DataFrame | None) -> DataFrame:
    """Rows of ``own`` and those of earlier batches with one of its event ids."""
    names = ["event_id", *VERSION_KEYS]
    seen = own.select(*names)
    if earlier is None:
        return seen
    return earlier.join(own.select("event_id").distinct(), "event_id", "left_semi").select(*names).unionByName(seen)


def met_event_ids(own: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Event ids of ``own`` with several rows (of orders or batches): all that can be reused, found by a count, without comparing texts."""
    return _seen(own, earlier).groupBy("event_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("event_id")


def reused_event_ids(own: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Those of ``own`` (rows of ``event_keys``) whose event id another order used first, and that order.

    Owners are kept only for ids seen with more than one order, which a consistent source never sends.
    """
    owners = (
        _seen(own, earlier)
        .groupBy("event_id")
        .agg(F.min_by("order_id", version()).alias("owner"), F.min("order_id").alias("low"), F.max("order_id").alias("high"))
        .where(F.col("low") != F.col("high"))
        .select("event_id", "owner")
    )
    return own.join(owners, "event_id").where(F.col("order_id") != F.col("owner"))


def settled(log: DataFrame, reused: DataFrame) -> DataFrame:
    """The log with events of a reused id moved to quarantine, payload and all; every row is read once.

    ``reused`` has (batch_id, event_id, order_id, owner). Rejected events pass by it, so that a filter on their outcome
    still prunes the scan. To read valid events alone take ``settled_valid``.
    """
    keys = ["batch_id", "event_id", "order_id"]
    hit = F.col("owner").isNotNull()
    moved = {
        "outcome": F.when(hit, QUARANTINED).otherwise(VALID),
        "error_code": F.when(hit, DUPLICATE_EVENT_ID),
        "rejection_reason": F.when(hit, text(REASON_DUPLICATE_EVENT, F.col("event_id"), F.col("owner"))),
    }
    passed = valid_events(log).join(reused.select(*keys, "owner"), keys, "left").withColumns(moved).select(*log.columns)
    other = log.where(F.col("outcome") == QUARANTINED).withColumn("outcome", F.lit(QUARANTINED))
    return passed.unionByName(other).select(*log.columns)


def settled_valid(log: DataFrame, reused: DataFrame) -> DataFrame:
    """The valid events that ``settled`` leaves valid, from the folders of valid events alone."""
    return valid_events(log).join(reused.select("batch_id", "event_id", "order_id"), ["batch_id", "event_id", "order_id"], "left_anti")


def cascade_delete(children: DataFrame, removed_parents: DataFrame, key: str) -> DataFrame:
    """Children left after their parents are removed."""
    return children.join(removed_parents.select(key), key, "left_anti")
