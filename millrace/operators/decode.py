"""JSON payload to typed event columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from millrace.model import WIRE_EVENT, WIRE_ITEM

_ELEMENTS = T.StructType([T.StructField("items", T.ArrayType(T.StringType()))])


def _items_element_wise(value: Column) -> Column:
    """Items parsed one element at a time; an element that is not an object becomes NULL."""
    return F.transform(
        F.from_json(value, _ELEMENTS)["items"],
        lambda element: F.when(
            F.json_object_keys(element).isNotNull(), F.from_json(element, WIRE_ITEM)
        ),
    )


def decode_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Add the wire columns and ``is_object`` to messages that hold JSON text.

    The payload is parsed once. Only where that leaves no item list (one malformed element
    voids the whole array) or no identifiers is it looked at again.
    """
    payload = F.col(value).cast("string")
    parsed = raw.withColumn(value, payload).withColumn("_event", F.from_json(payload, WIRE_EVENT))
    event = F.col("_event")
    columns = [event[f.name].alias(f.name) for f in WIRE_EVENT.fields if f.name != "items"]
    items = F.when(event["items"].isNotNull(), event["items"]).otherwise(_items_element_wise(payload))
    has_identity = F.coalesce(event["event_id"], event["order_id"], event["customer_id"]).isNotNull()
    is_object = F.when(has_identity, F.lit(True)).otherwise(F.json_object_keys(payload).isNotNull())
    return parsed.select(
        *[c for c in raw.columns],
        *columns,
        items.alias("items"),
        F.coalesce(is_object, F.lit(False)).alias("is_object"),
    )


def counted(rows: DataFrame, *metrics: Column, name: str | None = None) -> DataFrame:
    """Rows with their number (and other metrics) observed as they pass.

    Use it between a costly projection and a filter on its result. An optimizer that pushes
    the filter below the projection repeats the projection's expressions in it, here the
    JSON parse and all rules; an observed row count has to be taken before the filter.
    """
    label = name or f"rows-{uuid.uuid4().hex}"
    return rows.observe(label, F.count(F.lit(1)).alias("rows"), *metrics)
