"""The Jaccard join against all pairs."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from millrace.llm import jaccard_join
from millrace.llm.components import components

from .conftest import EDGES


def sets(texts):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        out.append({tuple(words[k : k + 3]) for k in range(len(words) - 2)} or ({tuple(words)} if words else set()))
    return out


def brute(texts):
    own = sets(texts)
    root = list(range(len(texts)))
    links = [(i, j) for i, j in combinations(range(len(texts)), 2) if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 90 * len(own[i] | own[j])]
    while True:
        before = list(root)
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            return {i: (len(own[i]), root[i]) for i in range(len(texts))}, links


def near_copies(seed: int) -> list[str]:
    """Groups of near copies of many sizes, chains of edits, a passage that most texts share, and loose texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = []
    for n in [*range(1, 40), 60, 90, 150, 300]:
        words = [word() for _ in range(n)] + (passage if n > 20 and r.random() < 0.6 else [])
        for _ in range(r.choice([1, 2, 4, 9])):
            texts.append(" ".join(words))
            if r.random() < 0.5:  # edits pile up along the chain
                words = list(words)
            copy = list(words)
            for _ in range(r.randint(0, max(1, n // 40))):
                copy[r.randrange(len(copy))] = word()
            if r.random() < 0.4:
                copy.insert(r.randint(0, len(copy)), word())
            if r.random() < 0.5:
                words = copy
            texts.append(" ".join(copy).upper() if r.random() < 0.1 else "  ".join(copy))
    star = [word() for _ in range(120)]
    for _ in range(60):  # each near the first alone
        copy = list(star)
        for _ in range(3):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(docs, seed):
    texts = near_copies(seed) + EDGES
    got = {r[0]: (r[1], r[2]) for r in jaccard_join.joined(docs(texts)).collect()}
    expected, links = brute(texts)
    assert len(links) > 100
    assert got == expected


@pytest.mark.parametrize("large", [9, 41])
def test_either_side_of_the_boundary_finds_all(docs, large):
    r = random.Random(9)
    texts = []
    for n in range(8, 40):
        words = [f"w{r.randrange(10**6)}" for _ in range(n + 2)]
        texts += [" ".join(words), " ".join(words[:-1]), " ".join(words + ["new"]), " ".join(words[1:] + ["end"])]
    frame = docs(texts)
    names = {r["doc_id"]: r["set"] for r in jaccard_join.sets(frame).collect()}
    found = {(r["node"], r["root"]) for r in components(jaccard_join.links(frame, large)).collect()}
    root = dict(found)
    expected, _ = brute(texts)
    together = {}
    for i, (_, c) in expected.items():
        together.setdefault(c, set()).add(root.get(names[i], names[i]))
    assert all(len(v) == 1 for v in together.values())
    assert len({next(iter(v)) for v in together.values()}) == len(together)


def across_edges(r: random.Random) -> list[str]:
    """Linked pairs of texts whose sizes lie on both sides of each class edge, near it and as far apart as links allow."""
    texts = []
    for edge in jaccard_join.edges_of_classes(150)[1:]:
        for n, m in {(edge - 1, edge), (-(-edge * 9 // 10), edge), (edge - 1, (edge - 1) * 10 // 9)}:
            if n < edge <= m:
                words = [f"w{r.randrange(10**9)}" for _ in range(m + 2)]
                texts += [" ".join(words[: n + 2]), " ".join(words)]
    return texts


def test_sets_alone_in_their_runs_share_lists():
    texts = across_edges(random.Random(4))
    for a, b in zip(texts[::2], texts[1::2]):
        keys = []
        for text in (a, b):
            digests, offsets = jaccard_join.shingle_sets([text])
            keys.append({int(s) for sig, *_ in jaccard_join._keys(digests, offsets, np.zeros(1, np.int64), 9) for s in sig})
        assert len(keys[0] & keys[1]) >= 2


@pytest.mark.parametrize("large", [None, 9])
def test_pairs_across_class_edges_link_from_partitions_of_their_own(spark, large):
    texts = across_edges(random.Random(5))
    rows = spark.sparkContext.parallelize(list(enumerate(texts)), len(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    if large:
        names = {r["doc_id"]: r["set"] for r in jaccard_join.sets(frame).collect()}
        root = {r["node"]: r["root"] for r in components(jaccard_join.links(frame, large)).collect()}
        got = {k: root.get(names[k], names[k]) for k in names}
    else:
        got = {r["doc_id"]: r["component_id"] for r in jaccard_join.joined(frame).collect()}
    assert len(set(got.values())) == len(texts) // 2
    assert all(got[k] == got[k + 1] for k in range(0, len(texts), 2))


def test_blocks_suffice():
    for n in range(9, 400):
        for m in range(n, int(n / 0.9) + 1):
            edges = jaccard_join.edges_of_classes(m)
            high = next(e for e in edges if e > m)
            assert (n + m) // 19 == jaccard_join.unshared(n + m) <= jaccard_join.blocks(high) - 2


def test_subset_sizes():
    for n in range(9, 60):
        most = max(m for m in range(n) if any(10 * (n - m) >= 9 * (n + extra) for extra in range(9)))
        assert jaccard_join.dropped(n) >= most


def test_edges(edges, docs):
    rows = {(r[0], r[1], r[2]) for r in jaccard_join.joined(edges).collect()}
    assert {(5, 1, 5), (6, 1, 5), (0, 0, 0), (1, 0, 1), (None, 1, None)} <= rows
    assert jaccard_join.joined(edges.limit(0)).collect() == []
    kept = jaccard_join.one_of_each(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect()) == [k for k in range(len(EDGES)) if k not in (3, 6)]
    assert kept.filter("doc_id IS NULL").count() == 1


def test_one_row_of_each_component_whatever_the_ids(docs):
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu " * 2
    near = long + "nu"
    texts = [long, "totally other words that nobody else has here", near, long, long, None, None, "", "x y z one two three four five six seven"]
    ids = [1, 1, 2, 1, None, 3, 3, None, 1]
    table = docs(texts, ids=ids)
    rows = [(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(table.repartition(4)).collect()]
    again = [(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(table.repartition(3)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(rows, key=key) == sorted(again, key=key)
    # One of the four near copies; each other text under the same id; every row without a shingle.
    assert [r for r in rows if r[1] in (long, near)] == [(1, long)]
    assert {(1, texts[1]), (1, texts[8])} <= set(rows)
    assert sum(r[1] in (None, "") for r in rows) == 3 and len(rows) == 6


def test_parities_bound_the_difference():
    r = np.random.default_rng(3)
    pool = r.integers(0, 1 << 62, 400).astype(np.uint64)
    for _ in range(50):
        a, b = (np.unique(r.choice(pool, r.integers(1, 300))) for _ in range(2))
        both = np.concatenate([a, b])
        bits = np.array(jaccard_join._parities(both, np.array([0, len(a), len(both)])))
        apart = sum(bin(int(x) & (2**64 - 1)).count("1") for x in bits[:, 0] ^ bits[:, 1])
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
