"""The producer's contract: range checks and defaults of an event before it is published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.model import DEFAULT_STATUS, ORDER_STATUSES


def _below(column: Column, limit: int, required: bool) -> Column:
    """True when the value is under the limit, not a number, or absent although required."""
    return F.coalesce((column < limit) | F.isnan(column.cast("double")), F.lit(required))


def _some_item(check) -> Column:
    return F.coalesce(F.exists("items", lambda i: F.coalesce(check(i), F.lit(True))), F.lit(False))


def contract_checks() -> list[tuple[str, Column]]:
    """(field, violated) pairs in field order."""
    col = F.col
    status = F.upper(F.coalesce(col("order_status"), F.lit(DEFAULT_STATUS)))
    return [
        ("customer_id", col("customer_id").isNull()),
        ("location_id", col("location_id").isNull()),
        ("payment_method_id", col("payment_method_id").isNull()),
        ("order_status", ~status.isin(ORDER_STATUSES)),
        ("items", F.coalesce(F.size("items"), F.lit(0)) <= 0),
        ("items.product_id", _some_item(lambda i: i["product_id"].isNull())),
        ("items.quantity", _some_item(lambda i: _below(i["quantity"], 1, True))),
        ("items.unit_price", _some_item(lambda i: _below(i["unit_price"], 0, True))),
        ("items.total_item_price", _some_item(lambda i: _below(i["total_item_price"], 0, True))),
        ("items.discount_applied", _some_item(lambda i: _below(i["discount_applied"], 0, False))),
        ("item_count", _below(col("item_count"), 1, True)),
        ("total_amount", _below(col("total_amount"), 0, True)),
        ("discount_amount", _below(col("discount_amount"), 0, False)),
        ("tax_amount", _below(col("tax_amount"), 0, False)),
        ("net_amount", _below(col("net_amount"), 0, True)),
    ]


def contract_violations(decoded: DataFrame) -> DataFrame:
    """Add ``violations``: the names of all fields that break the contract, in field order."""
    named = [F.when(violated, F.lit(field)) for field, violated in contract_checks()]
    return decoded.withColumn("violations", F.array_compact(F.array(*named)))


def apply_contract_defaults(decoded: DataFrame, published_at: Column, random_ids: bool = False) -> DataFrame:
    """Fill what a producer may leave out.

    Missing identifiers are derived from the payload, so that publishing the same event
    again gives the same ones; ``random_ids`` makes fresh ones instead.
    """
    digest = F.sha2(F.concat(F.col("value"), F.col("seq").cast("string")), 256)
    event_key = F.uuid() if random_ids else digest
    order_key = F.upper(F.substring(F.replace(F.uuid(), F.lit("-")) if random_ids else digest, 1, 10))
    defaults = {
        "event_id": F.coalesce("event_id", event_key),
        "order_id": F.coalesce("order_id", F.concat(F.lit("ORD-"), order_key)),
        "order_status": F.upper(F.coalesce("order_status", F.lit(DEFAULT_STATUS))),
        "discount_amount": F.coalesce("discount_amount", F.lit(0.0)),
        "tax_amount": F.coalesce("tax_amount", F.lit(0.0)),
        "order_timestamp": F.coalesce(
            "order_timestamp", F.date_format(published_at, "yyyy-MM-dd'T'HH:mm:ssXXX")
        ),
        "metadata": F.coalesce("metadata", F.create_map().cast("map<string,string>")),
        "items": F.transform(
            "items",
            lambda i: i.withField("discount_applied", F.coalesce(i["discount_applied"], F.lit(0.0))),
        ),
    }
    return decoded.withColumns(defaults)
