"""Near-duplicate vectors by int8 tile products with error bounds.

Equal vectors are one from the start. The others are dealt to tiles, and every tile meets itself and all others; tiles of two groups come to a task
one after another, so that it holds one group. Each vector,
of length 1, is quantised to its own scale times int8 numbers; the length of what that leaves out is known, so a product of two
quantised vectors tells the cosine up to e1 + (1 + e1) * e2. Tile products are matrix products of the int8 numbers,
exact in the floating-point type used. Only pairs that may reach the threshold within that bound are computed again in double
precision. A pair of tiles passes on, for each of its vectors, the number of its links and one link to the smallest vector it is connected with
inside the pair, not the links themselves; components follow from those.

Rows: vectors that are null, zero or hold null or non-finite components link with nothing. Vectors link only with vectors of as many
components. Repeated rows are vectors of their own. A null vec_id is compared like others; where no vec_id is known, component_id is null and
the row is not kept. An empty table gives an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mapped, stored
from .components import components
from .topk_search import unpacked, usable

THRESHOLD = 0.95
#: Vectors of a tile, rows of a tile multiplied at a time, pairs computed again at a time.
TILE, STRIP, AGAIN = 4096, 512, 100_000
#: Tiles of a group at most; groups at least, while there are as many tiles.
GROUP, PARTS = 16, 6
#: Components up to which a product of int8 vectors is exact in float32.
EXACT = (1 << 24) // (127 * 127)


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 numbers (as floats), scale and length of the error of each vector."""
    scale = np.maximum(np.abs(unit).max(axis=1), 1e-300) / 127
    numbers = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - numbers * scale[:, None]) ** 2).sum(axis=1))
    return numbers.astype(np.float32 if unit.shape[1] <= EXACT else np.float64), scale, error


def linked(a: np.ndarray, b: np.ndarray, same: bool, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs with cosine >= threshold; for the same tile twice, each pair once."""
    one, two = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
    (qa, sa, ea), (qb, sb, eb) = quantised(one), quantised(two)
    left, right = [], []
    for k in range(0, len(a), STRIP):
        about = (qa[k : k + STRIP] @ qb.T) * sa[k : k + STRIP, None].astype(qa.dtype)
        about *= sb.astype(qa.dtype)
        # 1e-5 covers the rounding of scales and products.
        about += ((1 + ea[k : k + STRIP, None]) * eb).astype(qa.dtype)
        i, j = np.nonzero(about >= (threshold - 1e-5 - ea[k : k + STRIP, None]).astype(qa.dtype))
        i += k
        if same:
            i, j = i[i < j], j[i < j]
        for c in range(0, len(i), AGAIN):
            x, y = a[i[c : c + AGAIN]], b[j[c : c + AGAIN]]
            cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
            sure = cosine >= threshold
            left.append(i[c : c + AGAIN][sure])
            right.append(j[c : c + AGAIN][sure])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _smallest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places is connected with by the pairs."""
    at = np.arange(n)
    while True:
        now = at.copy()
        np.minimum.at(now, i, at[j])
        np.minimum.at(now, j, at[i])
        now = now[now]
        if (now == at).all():
            return at
        at = now


def _links(vectors: DataFrame) -> DataFrame:
    """vec_id, links (copies counted) and other, a smaller vector it is connected with or itself; of vectors(vec_id, copies, vector), stored."""
    tiles = -(-vectors.count() // TILE) or 1
    rows = vectors.withColumn("n", F.size("vector")).withColumn("tile", F.pmod(F.xxhash64("vec_id"), F.lit(tiles)).cast("int"))
    one = F.collect_list(F.struct("vec_id", "vector", "copies"))
    packed = rows.repartition("n", "tile").groupBy("n", "tile").agg(one["vec_id"].alias("id"), one["vector"].alias("v"), one["copies"].alias("m"))
    packed = stored(packed, "vector-tiles")
    # Tiles meet by groups: a tile travels once for each group, and a task holds the tiles of one group and one more.
    size = max(1, min(GROUP, tiles // PARTS))
    groups = -(-tiles // size)
    group = F.floor(F.col("tile") / size).cast("int")
    first = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other")
    pairs = packed.withColumn("group", group).select("n", "tile", "group", first, "id", "v", "m")
    pairs = pairs.select("n", F.least("group", "other").alias("low"), F.greatest("group", "other").alias("high"), (F.col("group") > F.col("other")).alias("second"), "tile", "id", "v", "m")
    pairs = pairs.repartition("n", "low", "high").sortWithinPartitions("n", "low", "high", "second", "tile")

    def met(ids: np.ndarray, a: np.ndarray, copies: np.ndarray, ids2: np.ndarray, b: np.ndarray, copies2: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        i, j = linked(a, b, same)
        if not len(i):
            return
        if not same:
            ids, copies, j = np.concatenate([ids, ids2]), np.concatenate([copies, copies2]), j + len(ids)
        # Places in the order of the ids: the smallest place is the smallest id.
        place = np.argsort(np.argsort(ids))
        by_id = np.sort(ids)
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        root = by_id[_smallest(len(ids), place[i], place[j])][place]
        some = links > 0
        yield pa.record_batch([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some])], ["vec_id", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                n, low, high, second = (batch.column(c)[k].as_py() for c in range(4))
                ids, vectors_ = unpacked(batch.column(5), batch.column(6), k)
                # Copies, as the batch goes before its tiles are done with.
                tile = ids.copy(), vectors_.copy(), batch.column(7)[k].values.to_numpy(zero_copy_only=False).copy()
                if at != (n, low, high):
                    at, held = (n, low, high), []
                if second or low == high:
                    for earlier in held:
                        yield from met(*earlier, *tile, False)
                if low == high:
                    yield from met(*tile, *tile, True)
                if not second:
                    held.append(tile)

    return stored(mapped(pairs, run, "vec_id long, links long, other long"), "vector-links")


def deduplicated(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding")
    usable_ = usable(vectors).filter(F.exists("vector", lambda x: x != 0))
    # A name for each distinct vector: its smallest vec_id, or a number below all ids where none is known.
    distinct = usable_.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    distinct = stored(distinct.withColumn("name", F.coalesce("first", F.shiftleft(F.xxhash64("vector"), 1).bitwiseOR(F.lit(-(1 << 63))))), "vectors")
    links = _links(distinct.select(F.col("name").alias("vec_id"), "copies", "vector"))
    sums = links.groupBy(F.col("vec_id").alias("name")).agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("vec_id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "name")
    named = distinct.join(sums, "name", "left").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(least, "root").select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = usable_.join(named, "vector", "left").select("vec_id", "n_links", "component_id")
    fine = F.transform("embedding", lambda x: x.cast("double"))
    other = vectors.withColumn("v", fine).filter(F.col("v").isNull() | F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | F.forall("v", lambda x: x.isNotNull() & (x == 0)))
    other = other.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(other).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, [x::DOUBLE for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reached AS (
  SELECT vec_id AS n, vec_id AS r FROM embeddings
  UNION SELECT l.a, x.r FROM reached x JOIN links l ON l.b = x.n),
components AS (SELECT n, min(r) AS c FROM reached GROUP BY n),
degrees AS (SELECT a, count(*) AS d FROM links GROUP BY a)
SELECT vec_id, coalesce(d, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN components ON n = vec_id LEFT JOIN degrees ON a = vec_id
"""
