"""Token files: frames round trip, and documents against the library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import bit_planes

from .conftest import EDGES
from .test_tokens import random_texts

WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", [bit_planes.BYTES, bit_planes.BITS])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 1000, bit_planes.BLOCK])
def test_frames_give_their_ids_back(kind, n):
    r = np.random.default_rng(n)
    for high in (1, 50_000, 1 << 32):
        ids = r.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        frame = bit_planes.packed(ids, kind)
        assert bit_planes.unpacked(frame).tolist() == ids.tolist()
    if n == bit_planes.BLOCK:  # the high planes of small ids take next to nothing
        assert len(bit_planes.packed(r.integers(0, 256, n).astype(np.uint32), kind)) < 1.05 * n


def test_other_data_is_no_frame():
    with pytest.raises(ValueError):
        bit_planes.unpacked(b"PLN0" + bytes(12))


def expected(rows):
    """(doc_id, start, n_tokens, ids_crc32) by the library; rows in order."""
    library, at, out = Tokenizer.from_file(WORDS), 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, bit_planes.END_ID]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_texts_are_encoded_as_whole_texts_are():
    library, texts = Tokenizer.from_file(WORDS), random_texts(5, 1500)
    ids, bounds = bit_planes.Encoder(WORDS).ids([t.encode() for t in texts])
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[bounds[k] : bounds[k + 1]].tolist() == [*e.ids, bit_planes.END_ID], texts[k]


@pytest.mark.parametrize("block", [64, bit_planes.BLOCK])
def test_documents_against_the_library(spark, sf_dir, block):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in bit_planes.written(docs.repartition(7), WORDS, block=block).collect()]
    assert sorted(rows) == expected(sorted((r["doc_id"], r["text"]) for r in docs.collect()))


def test_edge_rows_repeated_and_null_ids(docs):
    texts = [t for t in EDGES for _ in range(2)]
    ids = [None if k >= len(texts) - 3 else k // 4 for k in range(len(texts))]
    table = docs(texts, ids=ids)
    rows = [tuple(r) for r in bit_planes.written(table, WORDS).collect()]
    assert len(rows) == len(texts)
    # Documents lie one after the other, those of an id together, nulls last.
    rows.sort(key=lambda r: r[1])
    assert [r[1] for r in rows] == np.cumsum([0, *(r[2] for r in rows)])[:-1].tolist()
    order = [(r[0] is None, r[0] or 0) for r in rows]
    assert order == sorted(order)
    alone = sorted((i is None, i or 0, n, crc) for i, _, n, crc in expected(zip(ids, texts)))
    assert sorted((i is None, i or 0, n, crc) for i, _, n, crc in rows) == alone


def test_ids_of_some_documents(spark, docs):
    library = Tokenizer.from_file(WORDS)
    texts = [f"text number {k} " * (k % 9) for k in range(60)]
    frames = bit_planes.write(docs(texts), WORDS, bit_planes.BITS, block=16)
    wanted = spark.createDataFrame([(3,), (44,), (999,)], "doc_id long")
    found = {3: [], 44: []}
    for r in sorted(bit_planes.ids_of(frames, wanted).collect(), key=lambda r: r["start"]):
        found[r["doc_id"]] += r["ids"]
    for k in (3, 44):
        assert found[k] == [*library.encode(texts[k], add_special_tokens=False).ids, 1]


def test_empty_table(docs):
    assert bit_planes.written(docs(["x"]).limit(0), WORDS).collect() == []
