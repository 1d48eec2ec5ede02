"""Exact top-k search by columnar branch and bound.

Components become integers, floor(SCALE * x), so inner products are exact. Rows are packed into blocks in vertical
layout, one array per dimension. For a query, products are added up one group of dimensions after another; what the
dimensions still to come can add is at most the product of both vectors' remaining lengths (Cauchy-Schwarz), so a
candidate whose sum plus that bound stays under the k-th best of the sums minus it is dropped, and the survivors are compacted
before the next group. Queries are packed too and meet every block of rows, which a task holds while blocks of queries pass; each pair of blocks
gives k rows per query, of which the best k are kept.

Rows: vectors that are null or hold null or non-finite components take no part, nor do rows with a null vec_id. Rows are told apart by
a number of their own, so rows with the same vec_id are all candidates, meet each other, and each asks for itself if its vec_id is a query's.
Vectors meet only vectors of as many components. Equal scores go to the smaller vec_id. A query alone, or an empty table, gives no rows. Only vec_id and embedding are read. |SCALE * x| must stay
below 2 ** 31 and the sum of products below 2 ** 53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import mapped, stored

SCALE, K = 256, 5
#: Rows of a block, queries of a block, dimensions added between two cuts.
ROWS, QUERIES, DIMS = 4096, 512, 16


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (double) of the rows whose components are all there and finite."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select("vec_id", vector.alias("vector")).filter(F.col("vector").isNotNull() & fine)


def unpacked(ids: pa.ListArray, vectors: pa.ListArray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors (rows) of the k-th block."""
    i = ids[k].values.to_numpy(zero_copy_only=False)
    v = vectors[k].values
    return i, v.flatten().to_numpy(zero_copy_only=False).reshape(len(i), -1)


def best(query: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, columns: np.ndarray, left: list[np.ndarray], first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows of a block for one query, but for the row numbered own.

    columns: dimension x row. left[g]: lengths of the rows without the first g groups of dimensions. first: sums over the first group.
    """
    at = np.flatnonzero(rows != own)
    sums = first[at]
    for g, d in enumerate(range(DIMS, len(query), DIMS), 1):
        if len(at) > k:
            slack = np.sqrt((query[d:] ** 2).sum()) * left[g][at] * (1 + 1e-9) + 1e-6
            floor = np.partition(sums - slack, len(at) - k)[len(at) - k]
            on = sums + slack >= floor
            at, sums = at[on], sums[on]
        sums = sums + query[d : d + DIMS] @ columns[d : d + DIMS, at]
    order = np.lexsort((ids[at], -sums))[:k]
    return ids[at[order]], sums[order]


def search(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows that score highest with each row whose vec_id is divisible by every."""
    rows = usable(vectors).filter("vec_id IS NOT NULL")
    whole = F.transform("vector", lambda x: F.floor(x * SCALE).cast("double")).alias("vector")
    rows = rows.select(F.col("vec_id").cast("long"), F.size("vector").alias("n"), whole, F.monotonically_increasing_id().alias("row"))
    # Written down, so that a row keeps its number.
    rows = stored(rows, "search-rows")
    size = rows.agg(F.count("*").alias("rows"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("queries")).first()
    blocks, query_blocks = -(-size["rows"] // ROWS) or 1, -(-size["queries"] // QUERIES) or 1
    place = F.xxhash64("row")
    packed = _packed(rows.withColumn("block", F.pmod(place, F.lit(blocks))).withColumn("part", F.lit(-1).cast("long")))
    asked = _packed(rows.filter(F.col("vec_id") % every == 0).withColumn("part", F.pmod(place, F.lit(query_blocks))).withColumn("block", F.lit(0).cast("long")))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    # A block of rows, then the queries' blocks one after another: none is joined, so none is broadcast or held with others.
    pairs = packed.unionByName(asked).repartition("n", "block").sortWithinPartitions("n", "block", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for b in range(batch.num_rows):
                n, block, part = (batch.column(c)[b].as_py() for c in range(3))
                numbers, (ids, data) = batch.column(3)[b].values.to_numpy(zero_copy_only=False), unpacked(batch.column(4), batch.column(5), b)
                if part < 0:
                    columns = np.ascontiguousarray(data.T)
                    squares = columns**2
                    left = [np.sqrt(squares[d:].sum(axis=0)) for d in range(0, len(columns), DIMS)]
                    # Copies, as the batch goes before its block is done with.
                    held = (n, block), numbers.copy(), ids.copy(), columns, left
                    continue
                if held is None or held[0] != (n, block):
                    continue
                _, rows_, ids_, columns, left = held
                sums = data[:, :DIMS] @ columns[:DIMS]
                made = []
                for q, own, name, first in zip(data, numbers, ids, sums):
                    found, scores = best(q, own, rows_, ids_, columns, left, first, k)
                    made.append([np.full(len(found), own), np.full(len(found), name), found, scores.astype(np.int64)])
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*made)], ["query_row", "query_id", "vec_id", "score"])

    found = mapped(pairs, run, "query_row long, query_id long, vec_id long, score long")
    in_order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(in_order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _packed(rows: DataFrame) -> DataFrame:
    """Rows of a block with their numbers, ids and vectors in the same order; rows are dealt to blocks before they are put into lists."""
    both = F.collect_list(F.struct("row", "vec_id", "vector"))
    lists = rows.repartition("n", "block", "part").groupBy("n", "block", "part").agg(both.alias("rows"))
    return lists.select("n", "block", "part", *[F.col("rows")[c].alias(c) for c in ("row", "vec_id", "vector")])


SQL = f"""
WITH rows_ AS (
  SELECT vec_id, [x::DOUBLE for x in embedding] AS e, row_number() OVER () AS row_no FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
v AS (SELECT vec_id, row_no, [floor({SCALE} * x) for x in e] AS e FROM rows_),
scores AS (
  SELECT q.vec_id AS query_id, q.row_no, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.row_no <> c.row_no AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
