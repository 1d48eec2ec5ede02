"""Order-event streams and batches in, keyed messages out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from millrace.model import RAW_EVENT


def read_stream(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    schema: T.StructType | None = None,
    path: str | None = None,
) -> DataFrame:
    """A stream from any source; rate caps such as ``maxOffsetsPerTrigger`` are options of it."""
    reader = spark.readStream.format(source).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def from_kafka(messages: DataFrame) -> DataFrame:
    """Topic messages as raw events: text payload, a sequence number and the processing time.

    The processing time is that of the micro-batch. Spark keeps it in the checkpoint, so a
    batch that runs again gets the same one.

    Offsets count up within a topic partition, and a key always goes to the same one, so
    they order the versions of an order. The partition number fills the high bits, which
    keeps sequence numbers unique and those of one partition dense.
    """
    return messages.select(
        F.col("value").cast("string").alias("value"),
        (F.col("partition").cast("long") * F.lit(1 << 48) + F.col("offset")).alias("seq"),
        F.current_timestamp().alias("received_at"),
    )


def read_order_stream(
    spark: SparkSession, path: str, max_files: int | None = None, source: str = "parquet"
) -> DataFrame:
    """Raw order events from a folder that files are added to."""
    options = {"maxFilesPerTrigger": str(max_files)} if max_files else {}
    return read_stream(spark, source, options, RAW_EVENT, path)


def keyed_messages(events: DataFrame, key: str = "order_id") -> DataFrame:
    """Key and JSON value of each event, ready for any message sink."""
    columns = [c for c in events.columns]
    return events.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value")
    )


def publish(events: DataFrame, sink: str, options: Mapping[str, str], path: str | None = None) -> None:
    """Write keyed messages to a sink such as Kafka or files."""
    writer = keyed_messages(events).write.format(sink).options(**options).mode("append")
    writer.save(path) if path else writer.save()


def _name_of(value: Column) -> list[Column]:
    """Two digests that stand for a message, so that payloads needn't travel."""
    return [F.xxhash64(value).alias("_one"), F.xxhash64(F.lit(1), value).alias("_two")]


def publish_report(events: DataFrame, topic: str, mode: str, received: DataFrame, key: str = "order_id") -> DataFrame:
    """What became of each event, given what the sink holds: success is whether its message has come back.

    ``received`` has (key, value), as a reader of the topic or of the written files gives them.
    """
    value = F.to_json(F.struct(*events.columns))
    named = events.withColumns({"_key": F.col(key).cast("string"), "_one": F.xxhash64(value), "_two": F.xxhash64(F.lit(1), value)})
    held = received.select(F.col("key").cast("string").alias("_held_key"), *_name_of(F.col("value").cast("string"))).distinct()
    held = held.withColumn("_back", F.lit(True))
    same = (named["_one"] == held["_one"]) & (named["_two"] == held["_two"]) & named["_key"].eqNullSafe(held["_held_key"])
    return named.join(held, same, "left").select(
        F.coalesce("_back", F.lit(False)).alias("success"),
        F.lit(mode).alias("mode"),
        F.lit(topic).alias("topic"),
        "order_id",
        "event_id",
        F.col("order_timestamp").alias("timestamp"),
    )


def combined(*batches: DataFrame) -> DataFrame:
    """Several raw batches, such as manual and automatic events, as one."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch)
    return first
