"""The mix against its SQL and its own promises."""

from __future__ import annotations

import random

import duckdb
import pytest

from millrace.llm import mixing, queries


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def answers(spark, docs_frame, labels_frame, tmp_path):
    docs_frame.select("doc_id", "text", "source").write.parquet(f"{tmp_path}/documents.parquet")
    labels_frame.write.parquet(f"{tmp_path}/labels.parquet")
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    return sorted(map(str, duck.execute(mixing.SQL).fetchall()))


@pytest.mark.parametrize("bucket", [1000, 7])
def test_mix_of_uneven_sources(spark, docs, tmp_path, monkeypatch, bucket):
    monkeypatch.setattr(mixing, "BUCKET", bucket)
    r = random.Random(4)
    texts = [None if r.random() < 0.05 else "w " * r.choice([0, 1, 5, 20, 20, 20, 400]) for _ in range(600)]
    # One source with a third of the rows, small ones that reach three times their size, one of nothing but empty texts, a null one.
    sources = [r.choice(["big", "big", "big", "a", "b", "b", "tiny" if r.random() < 0.1 else "c", None, "é"]) for _ in texts]
    texts += ["", None, "x " * 50, "x " * 50]
    sources += ["void", "void", "b", "b"]
    frame = docs(texts, sources, ids=[*range(602), 602, 602])
    marks = labels(spark, [(k, k % 2, 0) for k in range(0, 600, 3)] + [(0, 1, 0), (6, None, 0)])
    got = mixing.mixed(frame, marks).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(str(tuple(x)) for x in got) == answers(spark, frame, marks, tmp_path)
    again = mixing.mixed(frame.repartition(7), marks).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))

    by_source = {}
    for row in got:
        by_source.setdefault(sources[min(row["doc_id"], 602)], []).append(row)
    total = sum(x["size"] for x in got)
    assert sum(rows[0]["target"] for rows in by_source.values()) == pytest.approx(total)
    for rows in by_source.values():
        assert sum(x["size"] for x in rows) == rows[0]["source_size"]
        assert rows[0]["target"] <= 3 * rows[0]["source_size"] + 1e-6
        assert abs(sum(x["taken"] for x in rows) - rows[0]["target"]) <= 2 * max(x["size"] for x in rows)
        assert all(x["taken"] <= 3 * x["size"] for x in rows)
        epochs = int(rows[0]["target"] // max(1, rows[0]["source_size"]))
        assert all(x["taken"] in (epochs * x["size"], (epochs + 1) * x["size"]) for x in rows)


def test_drawn_documents_are_those_taken(spark, docs):
    frame = docs(["a b c"] * 40 + ["d"] * 9 + ["", None], ["x"] * 40 + [None] * 9 + ["y", "y"])
    taken = {r["doc_id"]: (r["taken"], r["size"]) for r in mixing.mixed(frame, labels(spark)).collect()}
    drawn = mixing.drawn(frame, labels(spark))
    assert drawn.columns == frame.columns
    n = {r["doc_id"]: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
    assert {k: n.get(k, 0) * size for k, (_, size) in taken.items()} == {k: t for k, (t, _) in taken.items()}


def test_quality_is_preferred(spark, docs):
    n = 3000
    frame = docs(["w w w w"] * n + ["v"] * n, ["s"] * n + ["t"] * n)
    marks = labels(spark, [(k, k % 2, 0) for k in range(n)])
    taken = {r["doc_id"]: r["taken"] for r in mixing.mixed(frame, marks).filter("doc_id < 3000").collect()}
    good, bad = (sum(taken[k] > 4 * (min(taken.values()) // 4) for k in range(n) if k % 2 == q) for q in (1, 0))
    assert good > 1.5 * bad


def test_edges(spark, edges, docs):
    assert mixing.mixed(edges, labels(spark)).count() == edges.count()
    assert mixing.mixed(edges.limit(0), labels(spark)).collect() == []
    nothing = mixing.mixed(docs([None, ""], [None, "a"]), labels(spark)).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_queries_give_what_sql_gives(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "labels", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    answer = duck.execute(queries.statements()[name])
    columns = [d[0] for d in answer.description]
    got = queries.registered()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in got.select(*columns).collect()) == sorted(map(str, answer.fetchall()))
