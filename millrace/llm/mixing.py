"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are counts of words. Sources, in code-point order with null last, weigh 1, 2, 3, 1, ... and share the sum of all
sizes; a target stops at CAP times its source's size and the excess is shared again by weight. That is the
water level L with sum(min(weight * L, cap)) = total, found from running sums over the sources ordered by
cap / weight. A target holds as many complete epochs of its source as fit; the rest is a sample without replacement:
each document has the key -ln(u) / quality, u from a digest of its doc_id, and the documents of lowest keys are taken until
their sizes reach the rest. The one that crosses it is taken if that comes nearer.

Keys are not sorted source by source, since a source may hold most of the rows. They fall into buckets, about
one for BUCKET documents; sums of the buckets show the one that crosses the rest, and only its documents are
sorted. The outcome is one cut per source, (bucket, key, doc_id), that every document is held against.

Quality is 2 or 0.5 for labels 1 or 0 and 1 without a label. Rows: a null text has size 0; a null source is a
source; rows of the same source and doc_id are taken or left together, null doc_ids as one; of several labels of a document the
highest counts. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import SPACE_WORD, stored

CAP = 3
BUCKET = 1000
_SCALE = float(1 << 52)


def _key() -> Column:
    """-ln(u) / quality, u in (0, 1) from the first 52 bits of md5(doc_id)."""
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / _SCALE) / F.col("quality")


def _keyed(docs: DataFrame, labels: DataFrame, columns: list[Column | str]) -> DataFrame:
    best = labels.groupBy(F.col("doc_id").alias("__of")).agg(F.max("quality").alias("__label"))
    joined = docs.select("doc_id", "source", *columns).join(best, F.col("doc_id") == F.col("__of"), "left")
    quality = F.when(F.col("__label") == 1, 2.0).when(F.col("__label") == 0, 0.5).otherwise(1.0)
    return joined.withColumn("quality", quality).withColumn("key", _key()).drop("__of", "__label", "quality")


def targets(sizes: DataFrame) -> DataFrame:
    """source, n, source_size, target, epochs and rest; one row per source of sizes(source, size)."""
    totals = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    # One row per source meets in these windows, never one per document.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = totals.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1).withColumn("cap", CAP * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "weight", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    levelled = (
        named.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("full")) / (F.col("weights") - F.col("spent")))
        .withColumn("above", F.col("level") * F.col("weight") > F.col("cap"))
        # The level of the first source that isn't above it holds for all that follow.
        .withColumn("final", F.min(F.when(~F.col("above"), F.struct("spent", "level"))).over(everything)["level"])
        .withColumn("target", F.when(F.col("above"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("final")))
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    return levelled.withColumn("epochs", epochs).select("source", "n", "source_size", "target", "epochs", (F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest"))


def _bucket(n: Column) -> Column:
    """Keys in order, dealt to about n / BUCKET buckets."""
    return F.floor((1 - F.exp(-F.col("key"))) * F.ceil(n / BUCKET))


def _with_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    plan = plan.withColumnRenamed("source", "__source")
    return rows.join(plan, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")


def cuts(sizes: DataFrame) -> DataFrame:
    """targets(), with the bucket, key and id of each source's last sampled document; from sizes(source, doc_id, size, key)."""
    plan = stored(targets(sizes), "mix-targets")
    rows = _with_source(sizes, plan.select("source", "n", "rest")).withColumn("bucket", _bucket(F.col("n")))
    sums = rows.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("bucket")
    sums = sums.withColumn("after", F.sum("words").over(running)).withColumn("below", F.col("after") - F.col("words"))
    # Of a source whose rest takes in all buckets there is no crossing one: rest < source_size, so there always is, but for empty sources.
    crossing = stored(sums.filter("below <= rest AND after > rest").select("source", F.col("bucket").alias("at"), "below"), "mix-crossing")
    inside = rows.join(crossing.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("at"))).drop("__source")
    inside = inside.groupBy("source", "rest", "below", "key", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id")).agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("source").orderBy("key", "id")
    inside = inside.withColumn("after", F.col("below") + F.sum("words").over(in_order))
    taken = (F.col("after") <= F.col("rest")) | ((F.col("after") - F.col("words") < F.col("rest")) & (F.col("after") - F.col("rest") < F.col("rest") - F.col("after") + F.col("words")))
    last = inside.filter(taken).groupBy("source").agg(F.max(F.struct("key", "id")).alias("last"))
    ends = _with_source(crossing.select("source", "at"), last)
    return stored(_with_source(plan, ends), "mix-cuts")


def _times(rows: DataFrame) -> Column:
    """How often a document is taken, by its source's epochs and cut."""
    bucket, last = _bucket(F.col("n")), F.col("last")
    here = F.struct(F.col("key").alias("key"), F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"))
    sampled = F.coalesce(bucket < F.col("at"), F.lit(False)) | F.coalesce((bucket == F.col("at")) & (here <= last), F.lit(False))
    return F.col("epochs") + sampled.cast("long")


def sized(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size and key of every document, stored: texts are scanned once."""
    size = F.coalesce(F.regexp_count("text", F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size")
    return stored(_keyed(docs, labels, [size]), "mix-sizes")


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (words, repeats counted) of every document."""
    sizes = sized(docs, labels)
    rows = _with_source(sizes, cuts(sizes))
    return rows.select("doc_id", "size", "source_size", "target", (_times(rows) * F.col("size")).alias("taken"))


def drawn(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    columns = docs.columns
    plan = cuts(sized(docs, labels))
    rest = [c for c in columns if c not in ("doc_id", "source")]
    rows = _keyed(docs, labels, [F.struct(*rest).alias("__rest")])
    rows = _with_source(rows, plan)
    rows = rows.withColumn("__time", F.explode(F.sequence(F.lit(1), F.greatest(_times(rows), F.lit(1)).cast("int")))).filter(_times(rows) > 0)
    return rows.select(*[F.col(c) if c in ("doc_id", "source") else F.col("__rest")[c].alias(c) for c in columns])


SQL = f"""
WITH labelled AS (SELECT doc_id, max(quality) AS label FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || md5(coalesce(d.doc_id::VARCHAR, ''))[1:13])::BIGINT + 0.5) / {_SCALE:.1f}::DOUBLE)
      / CASE label WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS key
  FROM documents d LEFT JOIN labelled l ON d.doc_id = l.doc_id),
totals AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
named AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM totals),
level AS (
  SELECT *, sum(s) OVER ()::BIGINT AS total, sum(w) OVER ()::BIGINT AS ws,
    coalesce(sum(3 * s) OVER o, 0)::BIGINT AS full_, coalesce(sum(w) OVER o, 0)::BIGINT AS spent
  FROM named WINDOW o AS (ORDER BY (3 * s)::DOUBLE / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, (total - full_)::DOUBLE / (ws - spent) AS lv FROM level),
leveled AS (SELECT *, lv * w > 3 * s AS above FROM marked),
target AS (
  SELECT source, s, CASE WHEN above THEN (3 * s)::DOUBLE ELSE w * (SELECT arg_min(lv, spent) FROM leveled WHERE NOT above) END AS target
  FROM leveled),
plan AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s)::BIGINT ELSE 0 END AS epochs FROM target),
ordered AS (
  SELECT d.*, p.s, p.target, p.epochs, p.target - p.epochs * p.s AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY key, d.doc_id) AS after_,
    sum(d.size) OVER (PARTITION BY d.source, key, d.doc_id) AS own
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s AS source_size, target,
  (size * (epochs + CASE WHEN after_ <= rest AND rest > 0 OR (after_ - own < rest AND after_ - rest < rest - after_ + own) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered
"""
