from __future__ import annotations

import os

import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts, with columns whose names clash with those of results."""

    def make(texts, sources=None, langs=None, ids=None):
        n = len(texts)
        rows = [
            ((ids or range(n))[k], texts[k], (langs or ["en"] * n)[k], (sources or ["s"] * n)[k], len(texts[k] or ""), 1.5, "x", [k], None)
            for k in range(n)
        ]
        shape = "doc_id long, text string, lang string, source string, n_chars long, score double, size string, key array<int>, set string"
        return spark.createDataFrame(rows, shape)

    return make


#: Texts at the edges: missing, empty, blank, without letters, without white space, repeated, not ASCII.
EDGES = [None, "", " \t\n\r\x0b\x0c ", "12 34 !!", "one", "one two", "one two", "One TWO three", "é ß Σας İ ﬁ 日本 語", "x" * 3000, "\x00\x1c\x85 ", "a b c " * 800]


@pytest.fixture(scope="session")
def edges(docs):
    n = len(EDGES)
    ids = [None if k == 3 else k for k in range(n)]
    return docs(EDGES, [None if k % 4 == 0 else f"s{k % 3}" for k in range(n)], [None if k % 5 == 0 else "en" for k in range(n)], ids)
