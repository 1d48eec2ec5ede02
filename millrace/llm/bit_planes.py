"""Token ids of documents in files of compressed bit or byte planes, and back.

A frame holds up to BLOCK ids, 32 bits each. They are transposed into planes: plane p of byte planes holds byte p of every id, plane p of bit planes bit p
of every id, eight to a byte. Each plane is compressed with zstandard on its own, so the high planes, which are nearly constant,
take next to nothing. A frame is

    "PLN1", kind (1 byte: 8 byte planes, 1 bit planes), 3 zero bytes, number of ids and of planes (4 bytes each, little-endian),
    the compressed sizes of the planes (4 bytes each), the planes.

Ids of all documents in ascending doc_id order, each document's followed by an end id, are one sequence. Documents are dealt to shards
by ranges of doc_id, so a shard is a run of the sequence; within a shard ids are cut into frames wherever BLOCK are full, whatever the
documents. Frames are rows of a Parquet table with the shard, the frame's number, the place of its first id in the shard and, as the chunk index,
the documents that have ids in it and where these begin and end. Spark's committer writes them, so an executor that is lost leaves no half
a file. Readers need just the frames they want: read() takes all, ids_of() those of some documents.

The library encodes distinct words only. White space parts words for it (it drops blanks, and neither its normalizer nor its pattern
goes across them), and so do the borders of ASCII digits and those between ASCII letters and stops (no pre-token has both sides). So the ids of
a text are those of its words, one after the other. Ids of about KEPT words are kept in a worker.

Rows: a null text counts as empty; an empty text has the end id alone. Repeated rows are documents of their own. Of rows with the same doc_id the one
whose text has the smaller hash comes first, then the earlier in the table; null ids come last. An empty table gives no frames and an empty result. Only
doc_id and text are read. A text is held in memory whole, its ids are not held beyond a frame.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain
from string import ascii_letters

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import kept_in_worker, mapped, stored
from .target_resampling import joined_crc
from .text_arrays import SPACE
from .word_codes import byte_class, coded

#: Ids of a frame, words whose ids a worker keeps, frames that a task passes on at a time.
BLOCK, KEPT, FRAMES = 1 << 16, 600_000, 16
#: Bytes of text that are encoded at a time.
RUN = 1 << 22
END_ID = 1
MAGIC, HEAD = b"PLN1", struct.Struct("<4sB3xII")
BYTES, BITS = 8, 1
LEVEL = 3
PIECES = "array<struct<row: long, doc_id: long, first: int, last: int, begins: boolean, ends: boolean>>"
FRAME_SCHEMA = f"shard long, frame long, first long, n int, frame_bytes int, data binary, documents {PIECES}"


def packed(ids: np.ndarray, kind: int = BYTES) -> bytes:
    """The frame of the ids."""
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    planes = rows.T if kind == BYTES else np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1, bitorder="little")
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    parts = [squeeze.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    return HEAD.pack(MAGIC, kind, len(ids), len(parts)) + struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def unpacked(frame: bytes) -> np.ndarray:
    """The ids of a frame."""
    magic, kind, n, planes = HEAD.unpack_from(frame)
    if magic != MAGIC or kind not in (BYTES, BITS):
        raise ValueError("not a frame of planes")
    sizes = struct.unpack_from(f"<{planes}I", frame, HEAD.size)
    at, grow = HEAD.size + 4 * planes, zstandard.ZstdDecompressor()
    parts = []
    for size in sizes:
        parts.append(np.frombuffer(grow.decompress(frame[at : at + size]), np.uint8))
        at += size
    if kind == BYTES:
        rows = np.stack(parts, axis=1)
    else:
        bits = np.unpackbits(np.stack(parts), axis=1, count=n, bitorder="little") if n else np.zeros((32, 0), np.uint8)
        rows = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(rows).reshape(-1).view("<u4") if n else np.zeros(0, "<u4")


def _apart() -> np.ndarray:
    """Pairs of ASCII bytes that are never in one pre-token: a digit and anything, a letter and a stop."""
    pairs = np.zeros((256, 256), bool)
    digit, letter, stop = (byte_class([(ord(c), ord(c)) for c in some]) for some in ("0123456789", ascii_letters, ".,;:!?"))
    pairs[digit, :128] = pairs[:128, digit] = True
    pairs |= letter[:, None] & stop | stop[:, None] & letter
    return pairs


APART = _apart()


class Encoder:
    """Ids of texts by the tokenizers library, each distinct word once.

    Ids of the words met lie one after the other in pool, those of word k from begin[k] on, size[k] of them; slot has k by word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        # Slot 0 is the end of a text.
        self.slot: dict[bytes, int] = {}
        self.pool, self.begin, self.size = np.array([END_ID], np.uint32), np.zeros(1, np.int64), np.ones(1, np.int64)

    def _forget(self, first: int) -> None:
        """Keep the slots below first alone: frequent words are met early."""
        self.slot = {w: k for w, k in self.slot.items() if k < first}
        self.pool, self.begin, self.size = self.pool[: self.begin[first]].copy(), self.begin[:first], self.size[:first]

    def _slots(self, words: list[bytes]) -> np.ndarray:
        if len(self.size) > KEPT:
            self._forget(KEPT // 2)
        slots = np.array([self.slot.get(w, 0) for w in words], np.int64)
        new = np.flatnonzero(slots == 0)
        if len(new):
            unknown = [words[k] for k in new.tolist()]
            each = [e.ids for e in self.library.encode_batch_fast([w.decode("utf-8", "surrogatepass") for w in unknown], add_special_tokens=False)]
            sizes = np.array([len(ids) for ids in each], np.int64)
            slots[new] = len(self.size) + np.arange(len(new))
            self.slot.update(zip(unknown, slots[new].tolist()))
            self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(sizes) - sizes])
            self.pool = np.concatenate([self.pool, np.fromiter(chain.from_iterable(each), np.uint32, int(sizes.sum()))])
            self.size = np.concatenate([self.size, sizes])
        return slots

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, an end id after each, and where each text's begin (one more at the end)."""
        # A-Z may be lower-cased beforehand but in the names of special tokens.
        words = coded([t if any(s[:1] in t for s in self.special) else t.lower() for t in texts], SPACE, APART)
        slots = self._slots(words.distinct)
        # The end of a text is one more word, of one id.
        word = np.insert(slots[words.codes], words.first[1:], 0)
        n = self.size[word]
        ends = np.cumsum(n)
        ids = self.pool[np.repeat(self.begin[word] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.concatenate([[0], ends])[words.first + np.arange(len(texts) + 1)]


@kept_in_worker
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _framed(shard: int, encoded: Iterator[tuple[list, list, np.ndarray, np.ndarray]], kind: int, block: int) -> Iterator[pa.RecordBatch]:
    """Frames of a shard, from (rows, doc_ids, ids, bounds) of its texts in order."""
    held: list[np.ndarray] = []
    pieces: list[dict] = []
    size = frame = first = 0
    out: list[tuple] = []

    def cut() -> None:
        nonlocal size, frame, first
        ids = np.concatenate(held)
        data = packed(ids, kind)
        out.append((shard, frame, first, len(ids), len(data), data, list(pieces)))
        held.clear()
        pieces.clear()
        frame, first, size = frame + 1, first + len(ids), 0

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), FRAME_ARROW)], schema=FRAME_ARROW)
        out.clear()
        return made

    for rows, doc_ids, ids, bounds in encoded:
        for row, doc_id, a, b in zip(rows, doc_ids, bounds[:-1].tolist(), bounds[1:].tolist()):
            at = a
            while at < b:
                take = min(b - at, block - size)
                held.append(ids[at : at + take])
                pieces.append({"row": row, "doc_id": doc_id, "first": size, "last": size + take, "begins": at == a, "ends": at + take == b})
                at, size = at + take, size + take
                if size == block:
                    cut()
                    if len(out) == FRAMES:
                        yield batch()
    if size:
        cut()
    if out:
        yield batch()


_PIECE = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("begins", pa.bool_()), ("ends", pa.bool_())])
FRAME_ARROW = pa.schema(
    [("shard", pa.int64()), ("frame", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("frame_bytes", pa.int32()), ("data", pa.binary()), ("documents", pa.list_(_PIECE))]
)


def write(docs: DataFrame, tokenizer: str, kind: int = BYTES, block: int = BLOCK) -> DataFrame:
    """The frames of all documents, written to the shared folder; texts are dealt by ranges of doc_id, encoded and framed in one go."""
    named = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_last("doc_id"), F.asc_nulls_first(F.xxhash64("text")), F.asc("row")]
    dealt = named.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(tokenizer)

        def encoded() -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
            held: list[list] = [[], [], []]
            weight = 0
            for batch in batches:
                for doc_id, text, row in zip(*(c.to_pylist() for c in batch.columns)):
                    for some, value in zip(held, (doc_id, (text or "").encode("utf-8", "surrogatepass"), row)):
                        some.append(value)
                    weight += len(held[1][-1])
                    if weight >= RUN:
                        yield held[2], held[0], *library.ids(held[1])
                        held, weight = [[], [], []], 0
            if held[0]:
                yield held[2], held[0], *library.ids(held[1])

        yield from _framed(TaskContext.get().partitionId(), encoded(), kind, block)

    return stored(mapped(dealt, run, FRAME_SCHEMA), "token-frames")


def read(frames: DataFrame) -> DataFrame:
    """row, doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, out of its frames."""
    names = ["row", "doc_id", "shard", "at", "n", "crc", "begins", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, first, data, documents in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpacked(data)
                raw = memoryview(ids.tobytes())
                rows = [
                    (d["row"], d["doc_id"], shard, first + d["first"], d["last"] - d["first"], zlib.crc32(raw[4 * d["first"] : 4 * d["last"]]), d["begins"], d["ends"])
                    for d in documents
                ]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 6 + [pa.bool_()] * 2)], names)

    shape = "row long, doc_id long, shard long, at long, n long, crc long, begins boolean, ends boolean"
    pieces = mapped(frames.select("shard", "first", "data", "documents"), run, shape)
    # One row per range of rows: shards follow each other.
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = frames.groupBy("shard").agg(F.sum("n").alias("size"))
    offsets = sizes.select("shard", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
    placed = stored(pieces.join(F.broadcast(offsets), "shard").withColumn("start", F.col("offset") + F.col("at")), "token-pieces")
    whole = placed.filter("begins AND ends").select("row", "doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))

    def join(group: pa.Table) -> pa.Table:
        order = np.argsort(group["start"].to_numpy())
        n, crc = group["n"].to_numpy()[order], group["crc"].to_numpy()[order].astype(np.uint32)
        one = crc[:1]
        for k in range(1, len(n)):
            one = joined_crc(one, crc[k : k + 1], 4 * n[k : k + 1])
        return pa.table({"row": group["row"][:1], "doc_id": group["doc_id"][:1], "start": [group["start"].to_numpy()[order[0]]], "n_tokens": [int(n.sum())], "ids_crc32": [int(one[0])]})

    # The pieces of a text that goes on in other frames: one row per BLOCK ids.
    cut = placed.filter("NOT (begins AND ends)").select("row", "doc_id", "start", "n", "crc")
    met = cut.groupBy("row").applyInArrow(join, "row long, doc_id long, start long, n_tokens long, ids_crc32 long")
    return whole.union(met)


def ids_of(frames: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """doc_id, row, start (within its shard) and ids of each piece of the given documents; only frames with one of them are unpacked."""
    pieces = frames.select("shard", "frame", "first", F.explode("documents").alias("d")).join(doc_ids, F.col("d.doc_id") == doc_ids["doc_id"], "left_semi")
    wanted = pieces.groupBy("shard", "frame").agg(F.collect_list("d").alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, documents in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpacked(data).astype(np.int64)
                rows = [(d["doc_id"], d["row"], first + d["first"], ids[d["first"] : d["last"]]) for d in documents]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], ["doc_id", "row", "start", "ids"])

    some = frames.join(wanted, ["shard", "frame"]).select("first", "data", "wanted")
    return mapped(some, run, "doc_id long, row long, start long, ids array<long>")


def written(docs: DataFrame, tokenizer: str, kind: int = BYTES, block: int = BLOCK) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, written and read back."""
    return read(write(docs, tokenizer, kind, block)).select("doc_id", "start", "n_tokens", "ids_crc32")
