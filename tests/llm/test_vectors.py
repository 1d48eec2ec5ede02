"""Vector search and near-duplicate vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from millrace.llm import topk_search, vector_dedup


def table(spark, vectors, ids=None):
    rows = [((ids or range(len(vectors)))[k], v, 0, "x", 1.0) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, vector string, score double")


def clusters(seed: int, n: int, dims: int) -> list:
    r = np.random.default_rng(seed)
    base = r.normal(size=(n // 6, dims))
    near = base[r.integers(0, len(base), n - len(base))] + r.normal(size=(n - len(base), dims)) * 0.17
    both = np.concatenate([base, near]).astype(np.float32)
    return [v.tolist() for v in np.concatenate([both, both[:5], both[:5]])]


ODD = [None, [0.0] * 9, [float("nan")] + [0.1] * 8, [float("inf")] * 9, [None] + [0.1] * 8, [], [1.0] * 4, [1.0] * 4, [-0.0] * 9]


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "ROWS", 90)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    vectors = clusters(1, 400, 40)
    got = {}
    for r in topk_search.search(table(spark, vectors + ODD)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * np.array(vectors, np.float32).astype(float)).astype(int)
    ids = np.arange(len(vectors))
    for q in ids[ids % 50 == 0]:
        score = whole @ whole[q]
        order = [i for i in np.lexsort((ids, -score)) if i != q][:5]
        assert sorted(got[q]) == [(k, i, score[i]) for k, i in enumerate(order, 1)]
    assert set(got) == set(ids[ids % 50 == 0].tolist())


def test_top_k_edges(spark):
    same = table(spark, [[1.0, 2.0], [3.0, 1.0], [9.0, 9.0], [1.0, 2.0]], ids=[0, 7, None, 0])
    # Each row of a repeated id is a candidate and asks for itself.
    assert sorted(tuple(r) for r in topk_search.search(same).collect()) == sorted(2 * [(0, 1, 0, 256 * 256 * 5), (0, 2, 7, 256 * 256 * 5)])
    twice = table(spark, [[1.0, 1.0], [2.0, 2.0], [9.0, 9.0], [5.0, 0.0]], ids=[50, 8, 8, 9])
    assert [(r["rank"], r["vec_id"], r["score"]) for r in topk_search.search(twice).orderBy("rank").collect()] == [(1, 8, 18 * 65536), (2, 9, 5 * 65536), (3, 8, 4 * 65536)]
    assert topk_search.search(same.limit(0)).collect() == []
    assert topk_search.search(table(spark, [None, [float("nan")]])).collect() == []


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def test_query_blocks_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "ROWS", 50)
    # Copies of the queries for every block are never joined: Spark would take them for as few as they were before the copies, and broadcast them.
    found = topk_search.search(table(spark, clusters(3, 400, 20) + [[1.0] * 4] * 60))
    found.collect()
    assert "Join" not in plan_of(found)
    assert found.groupBy("query_id").count().where("count != 5").count() == 0


def brute(vectors, threshold):
    n = len(vectors)
    x = [None if v is None or any(c is None or not np.isfinite(c) for c in v) or not any(v) else np.array(v, np.float32).astype(float) for v in vectors]
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]):
                link[i, j] = x[i] @ x[j] / (np.sqrt(x[i] @ x[i]) * np.sqrt(x[j] @ x[j])) >= threshold
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == root:
            break
        root = new
    return {i: (int(link[i].sum()), root[i], root[i] == i) for i in range(n)}


@pytest.mark.parametrize("tile", [4096, 40])
def test_near_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    vectors = clusters(2, 300, 9) + ODD
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.deduplicated(table(spark, vectors)).collect()}
    expected = brute(vectors, 0.95)
    assert got == expected
    assert max(e[0] for e in expected.values()) > 5


def test_tiles_travel_by_groups(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "TILE", 10)
    seen, mapped = [], vector_dedup.mapped
    monkeypatch.setattr(vector_dedup, "mapped", lambda rows, run, schema: (seen.append(rows), mapped(rows, run, schema))[1])
    vectors = clusters(4, 300, 9) + ODD
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.deduplicated(table(spark, vectors)).collect()}
    assert got == brute(vectors, 0.95)
    # Some 30 tiles of nine components in groups of five: each travels six or seven times, and no row holds two.
    tiles = seen[0].where("n = 9").groupBy("tile").count().collect()
    assert len(tiles) >= 28 and {r["count"] for r in tiles} <= {6, 7}
    assert "Join" not in plan_of(seen[0])


def test_quantisation_bound_is_rigorous():
    r = np.random.default_rng(5)
    a, b = r.normal(size=(300, 12)), r.normal(size=(300, 12))
    b[:150] = a[:150] + r.normal(size=(150, 12)) * 0.2
    one, two = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
    (qa, sa, ea), (qb, sb, eb) = vector_dedup.quantised(one), vector_dedup.quantised(two)
    about = (qa.astype(float) @ qb.T.astype(float)) * sa[:, None] * sb
    assert (np.abs(about - one @ two.T) <= ea[:, None] + (1 + ea[:, None]) * eb + 1e-12).all()
    i, j = vector_dedup.linked(a, b, False, 0.9)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(one @ two.T >= 0.9))))


def test_near_vectors_edges(spark):
    rows = table(spark, [[1.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1.0, 0.01]], ids=[None, 4, None, 2])
    got = sorted((tuple(r) for r in vector_dedup.deduplicated(rows).collect()), key=str)
    assert got == sorted([(None, 2, 2, False), (4, 2, 2, False), (None, 0, None, False), (2, 2, 2, True)], key=str)
    assert vector_dedup.deduplicated(rows.limit(0)).collect() == []
