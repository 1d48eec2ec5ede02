"""Importance resampling towards a target distribution.

Features of a text are its runs of one and two consecutive words, hashed into BUCKETS buckets. How much more often a bucket occurs in the target
than in the corpus is its gain; a text weighs the mean gain of its features. Both passes over the texts work on whole arrays: the checksum of a
pair of words is put together from those of the words, so only distinct words are hashed one by one.

A Gumbel variable, taken from a digest of doc_id, is added to the weight, and the PERCENT highest of the eligible texts are drawn. The k-th key
is found by distributed quickselect: random pivots out of the open range, exact counts of the rows below and at each of them, and the range between
the two pivots around k is the next one. Only its rows are looked at again. Rows up to the k-th key alone are sorted, in ranges, and numbered.

Nothing grows on the driver but a round's pivots (PIVOTS) and the gains (BUCKETS), which are also what is broadcast.

Rows: a null text has no words, so its features and weight are 0. A null doc_id hashes as the empty text and comes after all others.
Repeated rows count each; of rows with the same score and doc_id those with fewer features, then a smaller weight, then the earlier in the table
come first. Without a target, or without a corpus, the rule stands with zero counts. An empty table gives an empty result. Only doc_id
and text of the documents and text of the target are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import mapped, stored
from .text_arrays import chunks
from .word_codes import byte_class, coded

BUCKETS, LEAST_WORDS, PERCENT, SALT = 10_000, 20, 25, "7"
#: Keys that split the open range in one round.
PIVOTS = 32
#: Bytes between words: all ASCII but digits and small letters.
BETWEEN = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: Names of the parts of a key.
PLACES = ["a", "b", "c", "d", "e", "f"]
#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_ONE = _byte_table()


def _next(crc: np.ndarray) -> np.ndarray:
    """The linear map that one more zero byte makes of a checksum."""
    return _ONE[crc & 255] ^ crc >> np.uint32(8)


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """The map of 0 to 63 zero bytes, and of 64, 128, ... of them, each by the four bytes of a checksum."""
    table = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    short = [table]
    for _ in range(63):
        short.append(_next(short[-1]))
    long = [_next(short[-1])]
    for _ in range(34):
        long.append(_applied(long[-1][None], np.zeros(long[-1].shape, np.int64), long[-1]))
    return np.stack(short), long


def _applied(tables: np.ndarray, which: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = tables[which, 0, crc & 255]
    for j in (1, 2, 3):
        out = out ^ tables[which, j, crc >> np.uint32(8 * j) & 255]
    return out


_SHORT, _LONG = _tables()


def joined_crc(crc: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings one after the other, from their own and the length of the second."""
    out = _applied(_SHORT, size & 63, crc)
    high = size >> 6
    for table in _LONG:
        if not high.any():
            break
        on = high & 1 == 1
        out[on] = _applied(table[None], np.zeros(int(on.sum()), np.int64), out[on])
        high = high >> 1
    return out ^ other


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words, those of each word and the next, whether these two are of one text, and each text's first word."""
    words = coded(texts, BETWEEN)
    crc = np.array([zlib.crc32(w) for w in words.distinct], np.uint32)
    led = np.array([zlib.crc32(w + b" ") for w in words.distinct], np.uint32)
    size = np.array([len(w) for w in words.distinct], np.int64)
    at, then = words.codes[:-1], words.codes[1:]
    same = np.ones(max(0, len(words.codes) - 1), bool)
    cuts = words.first[1:-1]
    same[cuts[(cuts > 0) & (cuts < len(words.codes))] - 1] = False
    pairs = joined_crc(led[at], crc[then], size[then]) % buckets
    return crc[words.codes] % buckets, pairs, same, words.first


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts lie in each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in chunks(batch.column(0).to_pylist()):
                single, pairs, same, _ = features(some, buckets)
                n += np.bincount(single, minlength=buckets) + np.bincount(pairs[same], minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.record_batch([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    rows = mapped(texts.select("text"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of each bucket's smoothed share in the target over that in the corpus."""
    s_all, t_all, m = int(corpus.sum()), int(target.sum()), len(corpus)
    above = [float(t + 1) * float(s_all + m) for t in target.tolist()]
    below = [float(s + 1) * float(t_all + m) for s in corpus.tolist()]
    return np.array([math.floor(1000 * math.log(a / b)) for a, b in zip(above, below)], np.int64)


def chance(doc_id: int | None, salt: str = SALT) -> int:
    """The floored thousandths of the Gumbel variable of a document."""
    h = int(hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(docs: DataFrame, gain: np.ndarray, salt: str = SALT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and row, a number of its own, of every document; stored."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    buckets = len(gain)
    names = ["doc_id", "n_words", "n_features", "weight", "score", "row"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, row = shared.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            n_words, sums = [], []
            for some in chunks(batch.column(1).to_pylist()):
                single, pairs, same, first = features(some, buckets)
                total = np.concatenate([[0], np.cumsum(by[single])])
                both = np.concatenate([[0], np.cumsum(np.where(same, by[pairs], 0)), [0]])
                both[-1] = both[-2] if len(both) > 1 else 0
                n_words.append(np.diff(first))
                sums.append(np.diff(total[first]) + np.diff(both[first]))
            n, of = np.concatenate(n_words), np.concatenate(sums)
            n_features = np.maximum(0, 2 * n - 1)
            weight = np.floor_divide(of, np.maximum(1, n_features))
            luck = np.array([chance(i, salt) for i in batch.column(0).to_pylist()], np.int64)
            columns = [pa.array(n), pa.array(n_features), pa.array(weight), pa.array(weight + luck), pa.array(row + np.arange(len(n)))]
            yield pa.record_batch([batch.column(0), *columns], names)
            row += len(n)

    shape = ", ".join(f"{c} long" for c in names)
    return stored(mapped(docs.select(F.col("doc_id").cast("long"), "text"), run, shape), "resampling-weights")


def _key() -> Column:
    """What rows are drawn by, the first ones first; row makes all keys differ."""
    places = [-F.col("score"), F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), F.col("n_features"), F.col("weight"), F.col("row")]
    return F.struct(*[p.alias(n) for n, p in zip(PLACES, places)])


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("boolean" if n == "b" else "long").alias(n) for n, v in zip(PLACES, key)])


def kth_key(keys: DataFrame, k: int) -> tuple:
    """The k-th smallest of the column key, whose values all differ; k from 1 to their number."""
    low = high = None
    round_ = 0
    while True:
        inside = keys
        if low is not None:
            inside = inside.filter(F.col("key") > _literal(low))
        if high is not None:
            inside = inside.filter(F.col("key") < _literal(high))
        drawn = inside.orderBy(F.xxhash64(F.col("key.f"), F.lit(round_)), "key").limit(PIVOTS).collect()
        pivots = sorted(tuple(r["key"]) for r in drawn)
        places = F.array(*[_literal(p) for p in pivots])
        below = F.size(F.filter(places, lambda p: p < F.col("key"))).alias("place")
        counts = inside.groupBy(below, F.array_contains(places, F.col("key")).alias("at")).count().collect()
        sizes = {(r["place"], r["at"]): r["count"] for r in counts}
        passed = 0
        for i, pivot in enumerate(pivots):
            if passed + sizes.get((i, False), 0) >= k:
                high = pivot
                break
            passed += sizes.get((i, False), 0) + sizes.get((i, True), 0)
            if passed >= k:
                return pivot
            low = pivot
        k -= passed
        round_ += 1


def numbered(rows: DataFrame) -> DataFrame:
    """rows(key, ...) with rank, 1 for the smallest key: sorted in ranges, whose sizes give where each begins."""
    names = [c for c in rows.columns if c != "key"]
    keyed = rows.select(*names, *[F.col(f"key.{c}").alias(f"__{c}") for c in PLACES])
    order = [f"__{c}" for c in PLACES]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.record_batch([pa.array(np.full(n, part, np.int64)), pa.array(done + 1 + np.arange(n)), *batch.columns], ["part", "place", *names])
            done += n

    shape = "part long, place long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    placed = stored(mapped(dealt, run, shape), "resampling-winners")
    # One row per range of rows.
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select(*names, (F.col("offset") + F.col("place")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, salt: str = SALT) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those that aren't drawn."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = weighted(docs, gain, salt).withColumn("key", _key())
    out = ["doc_id", "n_features", "weight", "score"]
    eligible = F.col("n_words") >= least_words
    k = rows.filter(eligible).count() * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*out, none)
    last = _literal(kth_key(rows.filter(eligible).select("key"), k))
    drawn = eligible & (F.col("key") <= last)
    winners = numbered(rows.filter(drawn).select(*out, "key"))
    return winners.select(*out, F.col("rank").cast("long")).union(rows.filter(~drawn).select(*out, none))
