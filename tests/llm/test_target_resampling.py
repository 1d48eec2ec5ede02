"""Importance resampling against a plain loop over documents."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import target_resampling as tr

from .conftest import EDGES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute(docs, target, buckets=10_000, least=20, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    rows = []
    for place, (doc_id, text) in enumerate(docs):
        n, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), place))
    order = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3], r[5]))
    rank = {r[5]: k for k, r in enumerate(order[: len(order) * percent // 100], 1)}
    return [(r[0], r[2], r[3], r[4], rank.get(r[5])) for r in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v or 0) for v in r))


def test_joined_checksums():
    r = np.random.default_rng(1)
    sizes = [0, 1, 5, 63, 64, 65, 127, 128, 1000, 70_000]
    parts = [(r.bytes(9), r.bytes(n)) for n in sizes]
    ours = tr.joined_crc(*(np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1)), np.array(sizes))
    assert ours.tolist() == [zlib.crc32(a + b) for a, b in parts]


def test_given_tables(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert ordered(tr.resampled(docs.repartition(5), target).collect()) == ordered(brute(rows, [r["text"] for r in target.collect()]))


def test_edge_rows(edges, docs):
    target = docs(["one two three", None, "é ß", "a b c"])
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    assert ordered(tr.resampled(edges, target).collect()) == ordered(brute(rows, [r["text"] for r in target.collect()]))


def test_ties_and_repeated_rows(docs):
    r = random.Random(3)
    texts = [" ".join(r.choice("a b c d e".split()) for _ in range(r.choice([5, 19, 20, 30]))) for _ in range(90)] + ["same words here " * 9] * 60
    ids = [k if k < 90 else 7 for k in range(150)]
    table, target = docs(texts, ids=ids), docs(["a b", "same words"])
    rows = tr.resampled(table.repartition(3), target).collect()
    assert ordered(rows) == ordered(brute(list(zip(ids, texts)), ["a b", "same words"]))


def test_no_target_no_documents(docs):
    table, none = docs(["a b c " * 10, "d"]), docs(["x"]).limit(0)
    assert ordered(tr.resampled(table, none).collect()) == ordered(brute([(0, "a b c " * 10), (1, "d")], []))
    assert tr.resampled(none, table).collect() == []


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_quickselect(spark, k):
    values = random.Random(k).sample(range(10**6), 1000)
    keys = spark.createDataFrame([(v,) for v in values], "score long").select(
        F.struct(*[F.lit(False).alias(n) if n == "b" else (F.col("score") if n == "a" else F.lit(1).cast("long")).alias(n) for n in tr.PLACES]).alias("key")
    )
    assert tr.kth_key(keys, k)[0] == sorted(values)[k - 1]
