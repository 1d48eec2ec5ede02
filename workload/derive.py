"""Raw order events and dimension seeds from the given tables.

Every order becomes one JSON event with all its line items. A fixed share of orders (by key modulo 200) is broken in one way each, so that every
rule has work to do, and some orders are delivered more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.model import ORDER_STATUSES, PAYMENT_METHOD_IDS, PAYMENT_METHOD_ROWS
from millrace.operators.dimensions import cost_of
from millrace.operators.few import lookup

AS_OF = "2001-09-01 00:00:00"
ANOMALY_CYCLE = 200
#: Line items in a file of raw messages, some 100 MB; a stream that is capped by files takes as many in at a time.
FILE_LINES = 4_000_000


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sent_again(order_key: Column) -> Column:
    """Whether an order is delivered once more in the second batch."""
    return (order_key % ANOMALY_CYCLE).between(50, 55)


def order_lines(lineitem: DataFrame, part: DataFrame, parts: int) -> DataFrame:
    """Every given line as an item with exact money and its unit price, in so many parts by order.

    What follows from other columns is added once the lines lie there.
    """
    lines = lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("total_item_price"),
        F.col("l_discount").cast("decimal(4,2)").alias("rate"),
        F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),
    )
    discount = F.round(F.col("total_item_price") * F.col("rate"), 2).cast("decimal(12,2)")
    tax = F.round((F.col("total_item_price") - discount) * F.col("tax_rate"), 2).cast("decimal(12,2)")
    priced = lines.join(lookup(part.select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")), "l_partkey", "left").select(
        *lines.columns, F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price")
    )
    # Sorted once, while rows are short: lines are grouped as they come, and what they are grouped to is joined in that order.
    placed = priced.repartition(parts, "l_orderkey").sortWithinPartitions("l_orderkey")
    return placed.withColumns({"discount_applied": discount, "line_tax": tax, "product_id": F.concat(F.lit("PROD-"), "l_partkey")})


def order_items(lines: DataFrame) -> DataFrame:
    """Line items of each order as a sorted array, with totals."""
    rank = ["l_linenumber", "l_partkey", "l_suppkey", "quantity", "total_item_price", "rate", "tax_rate"]
    more = ["unit_price", "discount_applied", "product_id"]
    item = ["product_id", "quantity", "unit_price", "total_item_price", "discount_applied"]
    return (
        lines.groupBy("l_orderkey")
        .agg(
            F.sort_array(F.collect_list(F.struct(*rank, *more))).alias("sorted"),
            F.sum("quantity").cast("int").alias("item_count"),
            F.sum("total_item_price").cast("decimal(12,2)").alias("total"),
            F.sum("discount_applied").cast("decimal(12,2)").alias("discount"),
            F.sum("line_tax").cast("decimal(12,2)").alias("tax"),
        )
        .withColumn("items", F.expr(f"arrays_zip({', '.join(f'sorted.{f}' for f in item)})"))
        .drop("sorted")
    )


def base_orders(orders: DataFrame, customer: DataFrame, items: DataFrame, parts: int) -> DataFrame:
    """One row per order before anomalies: its header, items (NULL where it has none) and totals, in the same parts."""
    headers = orders.join(
        lookup(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")), "o_custkey", "left"
    ).select("o_orderkey", "o_custkey", "c_nationkey", "o_orderdate", "o_orderpriority")
    joined = headers.repartition(parts, "o_orderkey").join(items.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    zero = F.lit(0).cast("decimal(12,2)")
    return joined.withColumns(
        {"item_count": F.coalesce("item_count", F.lit(0))} | {c: F.coalesce(c, zero) for c in ("total", "discount", "tax")}
    )


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def events(base: DataFrame) -> DataFrame:
    """Wire fields of every delivery: the first of each event, its repeats and one misuse of an id."""
    key = F.col("o_orderkey")
    k = key % ANOMALY_CYCLE
    empty = F.col("items").isNull()
    name = key.cast("string")
    place = F.floor(key / 7) % 6
    status, lower = _pick(ORDER_STATUSES, place), _pick([s.lower() for s in ORDER_STATUSES], place)
    ordered_at = (F.col("o_orderdate").cast("timestamp").cast("long") + (key * 37) % 86400).cast("timestamp")
    arrived = F.timestamp_millis(F.unix_millis(ordered_at) + key % 5000)
    net = (F.col("total") - F.col("discount") + F.col("tax")).cast("decimal(12,2)")

    def at(n: int) -> Column:
        return k == n

    def on_last(change) -> Column:
        last = F.size("items") - 1
        return F.transform("items", lambda x, i: F.when(i == last, change(x)).otherwise(x))

    def money(value: str) -> Column:
        return F.lit(value).cast("decimal(12,2)")

    items = (
        F.when(at(11) | empty, F.array().cast("array<struct<product_id:string,quantity:int,unit_price:decimal(12,2),total_item_price:decimal(12,2),discount_applied:decimal(12,2)>>"))
        .when(at(13), on_last(lambda x: x.withField("product_id", F.lit(None).cast("string"))))
        .when(at(14), on_last(lambda x: x.withField("quantity", F.lit(0))))
        .when(at(15), on_last(lambda x: x.withField("unit_price", (-x["unit_price"]).cast("decimal(12,2)"))))
        .when(at(23), on_last(lambda x: x.withField("total_item_price", F.lit(None).cast("decimal(12,2)"))))
        .otherwise(F.col("items"))
    )
    base_event = base.select(
        "o_orderkey",
        k.alias("k"),
        empty.alias("is_empty"),
        F.when(~at(2), F.concat(F.lit("EVT-"), name)).alias("event_id"),
        F.when(~at(3), F.concat(F.lit("ORD-"), name)).alias("order_id"),
        F.when(at(4), "").otherwise(F.concat(F.lit("CUST-"), F.col("o_custkey"))).alias("customer_id"),
        F.when(~at(5), F.concat(F.lit("LOC-"), F.col("c_nationkey"))).alias("location_id"),
        F.when(at(7), "PAY-UNRECOGNIZED-X").when(~at(6), _pick(PAYMENT_METHOD_IDS, key % 9)).alias("payment_method_id"),
        F.when(at(8), "MAGIC_DELIVERY").when(key % 2 == 1, lower).otherwise(status).alias("order_status"),
        items.alias("items"),
        F.when(at(21), F.lit(0)).otherwise(F.col("item_count")).alias("item_count"),
        F.when(at(9), money("-150.00")).otherwise(F.col("total")).alias("total_amount"),
        F.when(at(22), money("-1.00")).when(~at(24), F.col("discount")).alias("discount_amount"),
        F.when(~at(24), F.col("tax")).alias("tax_amount"),
        F.when(at(10), money("-1.00")).when(at(20), (net + 1).cast("decimal(12,2)")).otherwise(net).alias("net_amount"),
        F.when(at(17), "2002-12-01T00:00:00Z")
        .when(at(18), "not-a-date")
        .when(~at(16), F.date_format(ordered_at, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("order_timestamp"),
        F.create_map(
            F.lit("device"), F.concat(F.lit("d"), key % 5), F.lit("channel"), F.col("o_orderpriority")
        ).alias("metadata"),
        arrived.alias("received_at"),
    )
    # delivery number -> (batch, place in the order's sequence)
    repeat = (
        F.when(F.col("k") == 60, F.array(F.lit(0), F.lit(1)))
        .when(F.col("k").between(50, 54), F.array(F.lit(0), F.lit(2)))
        .when(F.col("k") == 55, F.array(F.lit(0), F.lit(3)))
        .otherwise(F.array(F.lit(0)))
    )
    sent = base_event.withColumn("copy", F.explode(repeat))
    copy, kk = F.col("copy"), F.col("k")
    later = copy >= 2
    resend = sent.withColumns(
        {
            "batch_id": later.cast("int"),
            "seq": F.col("o_orderkey") * 10 + F.when(copy == 1, 1).when(later, 5).otherwise(0),
            "order_id": F.when(copy == 3, F.concat(F.col("order_id"), F.lit("-R"))).otherwise(F.col("order_id")),
            "order_status": F.when(copy == 1, "PROCESSING")
            .when((copy == 2) & (kk <= 53), "SHIPPED")
            .otherwise(F.col("order_status")),
            "total_amount": F.when((copy == 2) & (kk == 54), F.col("total_amount") + 10)
            .otherwise(F.col("total_amount"))
            .cast("decimal(12,2)"),
            "items": F.when((copy == 2) & (kk == 54), F.slice("items", 1, 1)).otherwise(F.col("items")),
            "received_at": F.when(later, F.col("received_at") + F.expr("INTERVAL 1 SECOND")).otherwise(
                F.col("received_at")
            ),
        }
    )
    return resend


def raw_messages(base: DataFrame) -> DataFrame:
    """(value, seq, received_at, batch_id): JSON text as it would arrive on a topic."""
    wire = [
        "event_id",
        "order_id",
        "customer_id",
        "location_id",
        "payment_method_id",
        "order_status",
        "items",
        "item_count",
        "total_amount",
        "discount_amount",
        "tax_amount",
        "net_amount",
        "order_timestamp",
        "metadata",
    ]
    text = F.to_json(F.struct(*wire))
    value = (
        F.when(F.col("k") == 1, "not json")
        .when(
            (F.col("k") == 12) & ~F.col("is_empty"),
            F.replace(text, F.lit('"items":['), F.lit('"items":[5,')),
        )
        .when(
            F.col("k") == 24,
            F.concat(F.lit('{"discount_amount":null,"tax_amount":null,'), F.substr(text, F.lit(2))),
        )
        .otherwise(text)
    )
    return events(base).select(value.alias("value"), "seq", "received_at", "batch_id")


# --- dimension seeds ----------------------------------------------------------------------


def seeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Known dimension rows; some keys are left out so that they are inferred or orphaned."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customers = (
        table(spark, sf_dir, "customer")
        .where(F.col("c_custkey") % 97 != 0)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.concat(F.lit("CUST-"), F.col("c_custkey")).alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@customers.invalid")).alias("email"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("country"),
        )
    )
    price = F.col("p_retailprice").cast("decimal(12,2)")
    products = table(spark, sf_dir, "part").where(F.col("p_partkey") % 97 != 0).select(
        F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("base_price"),
        cost_of(price).alias("cost_price"),
    )
    locations = (
        nation.where(F.col("n_nationkey") != 24)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.concat(F.lit("LOC-"), F.col("n_nationkey")).alias("location_id"),
            F.col("n_name").alias("city"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            (F.col("n_nationkey") * 3 - 36).cast("decimal(9,6)").alias("latitude"),
            (F.col("n_nationkey") * 14 - 170).cast("decimal(9,6)").alias("longitude"),
        )
    )
    rows = ", ".join(str(r) for r in PAYMENT_METHOD_ROWS if r[0] != "PAY-CRYPTO")
    payments = spark.sql(f"SELECT * FROM VALUES {rows} AS t(payment_method_id, method_type, provider)")
    return {
        "dim_customers": customers,
        "dim_products": products,
        "dim_locations": locations,
        "dim_payment_methods": payments,
    }
