"""Scoring of texts by context-tree weighting over bytes.

A byte is eight binary decisions, each with its own tree over the bytes before it. A node of depth d of
such a tree, for a context of d bytes, holds the numbers of zeros and ones seen there and so the probability that a
Krichevsky-Trofimov estimator gives them. Its weighted probability is half that estimate plus half the product of its
children's, so all depths up to DEPTH are mixed by how well they have described the corpus. Scoring keeps the
trees as they were learned: the chance of the next bit is the same mixture of estimates along the path of its context.

Grams of DEPTH bytes and the next are counted over all training texts. A context that occurs LEAST times has a node, however large
the corpus; the others of one node share a single child, "rest". So the tree grows with the corpus, and it isn't gathered anywhere:
grams are dealt by the nearest TOP + 1 bytes of their context, whose subtrees are built on the executors, as far as the decisions
that were met. Only depths up to TOP, at most 65,793 contexts of the alphabet, are put together on the driver and broadcast. The
log probabilities of all grams of all texts are a stored table, in buckets by a hash of the context. Each run of about RUN characters of
text sends its distinct grams, sorted and compressed, to these buckets and gets them back with their logs, so that a gram travels once a
run and not as a row. A bucket's logs come first and the runs' grams stream past them; contexts spread evenly over buckets, however common one is.

A text begins after DEPTH marks and ends with one; the mark is the byte 0xFF, which UTF-8 never has. The score is the base-10 logarithm
of the probability of all bytes and the end mark.

The base score of words needs the count of every word. Counts of words that make up at least one in HEAVY
of the corpus, HEAVY words at most, are broadcast; occurrences of the others meet their counts in a join.

Rows: a null text counts as empty, which is just an end. Repeated rows count and score each; a null doc_id hashes as the empty
text. With nothing to learn from, every bit has probability 1/2 and every count is 0. An empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import mapped, share_of, stored
from .text_arrays import chunks, mixed, words

DEPTH = 5
#: A context has a node of its own if it occurs LEAST times or, if CONTEXTS is set, makes up one in CONTEXTS of the corpus; a
#: word is heavy from one in HEAVY on.
LEAST, CONTEXTS, HEAVY = 2, None, 1 << 20
#: Depth to which the tree is in all workers, distinct grams that a task works on at a time, characters of a run of texts.
TOP, BLOCK, RUN = 2, 100_000, 1 << 24
#: Fewest buckets of log probabilities, distinct grams of a bucket beyond that, bytes that a task passes on at a time.
BUCKETS, BUCKET, PASSED = 64, 500_000, 1 << 23
MARK = 0xFF
#: Bytes of text in the arrays of a task, distinct grams that it holds before they are passed on.
CHUNK, HELD = 1 << 21, 3_000_000
#: The digest that stands for the end of a text among words.
END = np.int64(-1)


def _stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts between marks, and where each text and its end mark begin and end."""
    gap = bytes([MARK]) * DEPTH
    data = np.frombuffer(gap + b"".join([t + gap for t in texts]), np.uint8)
    n = np.array([len(t) for t in texts], np.int64)
    start = DEPTH + np.concatenate([[0], np.cumsum(n + DEPTH)[:-1]]).astype(np.int64)
    return data, start, start + n + 1


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.diff(np.concatenate([first, [len(values)]]))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """A code for each byte and end mark: the byte in the low eight bits, the depth bytes before it above, the nearest lowest."""
    data, start, stop = _stream(texts)
    code = data[DEPTH:].astype(np.int64)
    for d in range(1, depth + 1):
        code |= data[DEPTH - d : len(data) - d].astype(np.int64) << (8 * d)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, stop, -1)
    return code[np.cumsum(inside[:-1], dtype=np.int8)[DEPTH:] > 0]


def corpus_counts(docs: DataFrame) -> DataFrame:
    """word (boolean), key and n: how often each word and each gram of a byte and the DEPTH bytes before it occurs in the
    rows of docs(text, train) that are to be learned from, stored. Grams of the others are there as well, with 0 at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list] = {False: [], True: []}

        def out(word: bool) -> Iterator[pa.RecordBatch]:
            if held[word]:
                keys, n = _merged(held[word])
                held[word] = []
                for k in range(0, len(keys), 100_000):
                    part = slice(k, k + 100_000)
                    yield pa.record_batch([pa.array(np.full(len(keys[part]), word)), pa.array(keys[part]), pa.array(n[part].astype(np.int64))], ["word", "key", "n"])

        for batch in batches:
            for train in (True, False):
                for some in chunks(batch.column(0).filter(pc.equal(batch.column(1), train)).to_pylist(), CHUNK):
                    keys, n = _counted(grams(some, DEPTH))
                    new = {False: (keys, n if train else np.zeros_like(n))}
                    if train:
                        new[True] = _counted(np.concatenate([words(some)[0].view(np.int64), np.full(len(some), END)]))
                    for word, pair in new.items():
                        parts = held[word]
                        parts.append(pair)
                        if len(parts) > 4 and sum(len(p[0]) for p in parts) > 2 * len(parts[0][0]):
                            held[word] = [_merged(parts)]
                        if sum(len(p[0]) for p in held[word]) > HELD:
                            yield from out(word)
        yield from out(False)
        yield from out(True)

    found = mapped(docs.select("text", "train"), run, "word boolean, key long, n long")
    return stored(found.groupBy("word", "key").agg(F.sum("n").alias("n")), "text-counts")


@dataclass
class Level:
    """The contexts of a depth that have a node, and the decisions met there: context << 8 | decision, sorted."""

    kept: np.ndarray
    ids: np.ndarray
    counts: np.ndarray  # zeros and ones, and those of contexts below without a node
    stop: np.ndarray | None  # the share of this depth's own estimate


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x), x > 0, by Stirling's series from x + 8 on."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the estimator's probability of the counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


def _one(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return (ones + 0.5) / (zeros + ones + 1)


def _context(depth: int) -> int:
    return (1 << (8 * depth)) - 1


def _decisions(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the decisions of the grams, and zeros and ones there."""
    ids, bits = _asked(keys)
    ids, at = np.unique(ids.reshape(-1), return_inverse=True)
    n = np.repeat(n.astype(np.float64), 8)
    counts = _summed(at, np.stack([n, n * bits.reshape(-1)], axis=1), len(ids))
    return ids, np.stack([counts[:, 0] - counts[:, 1], counts[:, 1]], axis=1)


def _asked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eight decisions of each gram: ids and bits."""
    level = np.arange(8)
    byte = (keys & 255)[:, None]
    return keys[:, None] >> 8 << 8 | (1 << level) + (byte >> (8 - level)), byte >> (7 - level) & 1


def _summed(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, v, size).astype(np.float64) for v in values.T], axis=1)


def _up(ids: np.ndarray, columns: np.ndarray, depth: int, least: float) -> tuple[Level, np.ndarray, np.ndarray]:
    """The level of a depth, and ids and columns of the one above.

    Columns are zeros, ones, those of the nodes below, and the sum of the ln weighted probabilities of these.
    """
    counts, below, split = columns[:, :2], columns[:, 2:4], columns[:, 4]
    own = _kt(*counts.T)
    rest = counts - below
    if depth == DEPTH:
        stop, both = None, own
    else:
        both = np.logaddexp(own, split + _kt(*rest.T)) + np.log(0.5)
        stop = np.exp(own + np.log(0.5) - both)
    root = ids & 255 == 1
    kept = ids[root][counts[root].sum(axis=1) >= least] >> 8 if depth else np.zeros(1, np.int64)
    node = np.isin(ids >> 8, kept)
    above, at = np.unique((ids >> 8 & _context(max(0, depth - 1))) << 8 | ids & 255, return_inverse=True)
    passed = np.column_stack([counts, counts * node[:, None], both * node])
    return Level(kept, ids, np.column_stack([counts, rest]), stop), above, _summed(at, passed, len(above))


def _deep(keys: np.ndarray, n: np.ndarray, least: float) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Levels of the depths beyond TOP, and ids and columns of depth TOP, from all grams of some contexts of TOP + 1 bytes."""
    seen = n > 0
    ids, counts = _decisions(keys[seen], n[seen])
    columns = np.column_stack([counts, np.zeros((len(ids), 3))])
    levels = []
    for depth in range(DEPTH, TOP, -1):
        level, ids, columns = _up(ids, columns, depth, least)
        levels.insert(0, level)
    return levels, ids, columns


def _gram_logs(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of the chance of each gram's byte after its context."""
    ids, bits = _asked(keys)
    ids, bits = ids.reshape(-1), bits.reshape(-1)
    sum_, left, on = np.zeros(len(ids)), np.ones(len(ids)), np.arange(len(ids))
    for depth, level in enumerate(levels):
        own = (ids[on] >> 8 & _context(depth)) << 8 | ids[on] & 255
        at = np.minimum(np.searchsorted(level.ids, own), max(0, len(level.ids) - 1))
        met = level.ids[at] == own if len(level.ids) else np.zeros(len(own), bool)
        counts = np.zeros((len(own), 4))
        counts[met] = level.counts[at[met]]
        one = _one(counts[:, 0], counts[:, 1])
        if level.stop is None:
            sum_[on] += left[on] * one
            break
        stop = np.full(len(own), 0.5)
        stop[met] = level.stop[at[met]]
        sum_[on] += left[on] * stop * one
        left[on] *= 1 - stop
        deeper = np.isin(ids[on] >> 8 & _context(depth + 1), levels[depth + 1].kept)
        sum_[on[~deeper]] += left[on[~deeper]] * _one(counts[~deeper, 2], counts[~deeper, 3])
        on = on[deeper]
    return np.log10(np.where(bits == 1, sum_, 1 - sum_)).reshape(-1, 8).sum(axis=1)


def _by_subtree(counts: DataFrame, work: Callable[[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """work on keys and n of counts, all of a context of TOP + 1 bytes at once; distinct grams of one are bounded by the alphabet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > BLOCK:
                keys, n = (np.concatenate(c) for c in zip(*parts))
                of = keys >> 8 & _context(TOP + 1)
                end = int(np.searchsorted(of, of[-1]))
                if end:
                    yield from work(keys[:end], n[:end])
                # A subtree of more than that is held until it ends, and looked at again after another BLOCK.
                parts, size = [(keys[end:], n[end:])], (len(keys) - end if end else 0)
        if parts:
            yield from work(*(np.concatenate(c) for c in zip(*parts)))

    subtree = F.shiftright("key", 8).bitwiseAND(F.lit(_context(TOP + 1)))
    return mapped(counts.select("key", "n").repartition(subtree).sortWithinPartitions(subtree), run, schema)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed byte planes of their differences."""
    return zstandard.compress(np.diff(keys, prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.int64))


PACKED = "bucket int, run long, keys binary, logs binary"


def _dealt(run: int, keys: np.ndarray, buckets: int, logs: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Sorted keys, and their logs if given, as a PACKED row a bucket."""
    of = (mixed((keys >> 8).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(of, kind="stable")
    names, first = np.unique(of[order], return_index=True)
    held, size = [], 0
    for name, at in zip(names.tolist(), np.split(order, first[1:])):
        held.append((name, run, _packed(keys[at]), None if logs is None else logs[at].tobytes()))
        size += len(at) * 9
        if size > PASSED:
            yield _rows(held)
            held, size = [], 0
    if held:
        yield _rows(held)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["bucket", "run", "keys", "logs"])


def gram_logs(counts: DataFrame, buckets: int) -> DataFrame:
    """PACKED rows of run -1: log10 of the chance of each gram of corpus_counts(), by the tree of these counts, stored."""
    counts = counts.filter("NOT word")
    least = LEAST if CONTEXTS is None else (counts.agg(F.sum("n")).first()[0] or 0) / CONTEXTS
    names = ["id", "c0", "c1", "c2", "c3", "c4"]

    def upper(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, ids, columns = _deep(keys, n, least)
        yield pa.record_batch([pa.array(ids), *(pa.array(c) for c in columns.T.copy())], names)

    top = _by_subtree(counts, upper, "id long, " + ", ".join(f"{c} double" for c in names[1:]))
    rows = top.groupBy("id").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow().sort_by("id")
    ids, columns = rows["id"].to_numpy(), np.column_stack([rows[c].to_numpy() for c in names[1:]])
    levels: list[Level] = []
    for depth in range(TOP, -1, -1):
        level, ids, columns = _up(ids, columns, depth, least)
        levels.insert(0, level)
    shared = counts.sparkSession.sparkContext.broadcast(levels)

    def logs(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        deep, _, _ = _deep(keys, n, least)
        found, order = _gram_logs(keys, [*shared.value, *deep]), np.argsort(keys)
        yield from _dealt(-1, keys[order], buckets, found[order])

    return stored(_by_subtree(counts, logs, PACKED), "gram-logs")


def text_runs(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, held_out) with run, the same for neighbours of about RUN characters, and row, a number of its own; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        name, weight = row, 0
        for batch in batches:
            names = []
            for size in pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist():
                if weight > RUN:
                    name, weight = name + 1, 0
                names.append(name)
                weight += size + 1
            yield pa.record_batch([pa.array(names, pa.int64()), pa.array(row + np.arange(len(names))), *batch.columns], ["run", "row", "doc_id", "text", "held_out"])
            row += len(names)

    return stored(mapped(docs.select(F.col("doc_id").cast("long"), "text", "held_out"), run, "run long, row long, doc_id long, text string, held_out boolean"), "text-runs", "zstd")


def run_grams(texts: DataFrame, buckets: int) -> DataFrame:
    """PACKED rows without logs: the grams of text_runs(), each once a run and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, pa.array([], pa.int64())
        for batch in batches:
            names = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(names)) + 1).tolist(), len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a < b and names[a] != now:
                    yield from _dealt(now, np.sort(found.to_numpy()), buckets)
                    now, found = int(names[a]), pa.array([], pa.int64())
                for some in chunks(batch.column(1).slice(a, b - a).to_pylist(), CHUNK):
                    found = pc.unique(pa.concat_arrays([found, pa.array(grams(some, DEPTH))]))
        yield from _dealt(now, np.sort(found.to_numpy()), buckets)

    return mapped(texts.select("run", "text"), run, PACKED)


def looked_up(logs: DataFrame, asked: DataFrame) -> DataFrame:
    """asked, PACKED rows of runs, with the logs of their keys; a bucket's logs are held while the runs' keys pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known, chance = None, [], np.zeros(0, np.int64), np.zeros(0)
        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                bucket, name, sent, logs = (batch.column(c)[k].as_py() for c in range(4))
                if bucket != now:
                    now, parts = bucket, []
                keys = _unpacked(sent)
                if name < 0:
                    parts.append((keys, np.frombuffer(logs)))
                    continue
                if parts:
                    known, chance = (np.concatenate(c) for c in zip(*parts))
                    order, parts = np.argsort(known), []
                    known, chance = known[order], chance[order]
                held.append((bucket, name, sent, chance[np.searchsorted(known, keys)].tobytes()))
                size += len(keys) * 9
                if size > PASSED:
                    yield _rows(held)
                    held, size = [], 0
        if held:
            yield _rows(held)

    return mapped(logs.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "run"), run, PACKED)


def byte_scores(texts: list[bytes], keys: pd.Index, logs: np.ndarray) -> np.ndarray:
    """log10 of each text's probability, from the logs of its grams."""
    sums = np.concatenate([[0.0], np.cumsum(logs[keys.get_indexer(grams(texts, DEPTH))])])
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return sums[ends[1:]] - sums[ends[:-1]]


def scored(docs: DataFrame, held_out: int = 1, folds: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bytes of every document."""
    fold = share_of(F.col("doc_id"), folds)
    counts = corpus_counts(docs.select("text", (fold != held_out).alias("train")))
    buckets = max(BUCKETS, counts.filter("NOT word").count() // BUCKET)
    logs_of = gram_logs(counts, buckets)
    texts = text_runs(docs.select("doc_id", "text", (fold == held_out).alias("held_out")))
    word_counts = counts.filter("word")
    sums = word_counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"]
    heavy = word_counts.filter(F.col("n") * HEAVY >= n).select("key", "n").toArrow()
    order = np.argsort(heavy["key"].to_numpy())
    keys, heavy_n = heavy["key"].to_numpy()[order], heavy["n"].to_numpy()[order]
    shared = docs.sparkSession.sparkContext.broadcast((keys, np.log10(heavy_n + 0.5)))
    norm = float(np.log10(n + 0.5 * (v + 1)))

    def run(rows: pa.Table, chances: pa.Table) -> pa.Table:
        keys, logs = shared.value
        own = pd.Index(np.concatenate([_unpacked(k) for k in chances["keys"].to_pylist()]))
        chance = np.concatenate([np.frombuffer(x) for x in chances["logs"].to_pylist()])
        out = []
        done = 0
        for some in chunks(rows["text"].to_pylist(), CHUNK):
            found, first = words(some)
            found, first = found.view(np.int64), first[: len(some) + 1]
            # The end is a token of each text; it is heavy if there is a training text at all.
            ends = np.searchsorted(keys, END)
            end = ends < len(keys) and keys[ends] == END
            at = np.minimum(np.searchsorted(keys, found), max(0, len(keys) - 1))
            known = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            part = np.concatenate([[0.0], np.cumsum(np.where(known, logs[at], 0.0))]) if len(keys) else np.zeros(len(found) + 1)
            sure = np.concatenate([[0], np.cumsum(known)])
            size = np.diff(first)
            rare = found[~known]
            places = (first - sure[first]).astype(np.int32)
            one = {
                "row": rows["row"].slice(done, len(some)),
                "doc_id": rows["doc_id"].slice(done, len(some)),
                "held_out": rows["held_out"].slice(done, len(some)),
                "n_tokens": pa.array(size + 1),
                "known": pa.array(np.diff(sure[first]) + int(end)),
                "part": pa.array(np.diff(part[first]) + (logs[ends] if end else 0.0)),
                "ends": pa.array(np.full(len(some), 0 if end else 1)),
                "score": pa.array(byte_scores(some, own, chance)),
                "bytes": pa.array(np.array([len(t) for t in some], np.int64)),
                "rare": pa.ListArray.from_arrays(pa.array(places), pa.array(rare)),
            }
            out.append(pa.table(one))
            done += len(some)
        return pa.concat_tables(out)

    shape = "row long, doc_id long, held_out boolean, n_tokens long, known long, part double, ends long, score double, bytes long, rare array<long>"
    chances = looked_up(logs_of, run_grams(texts, buckets)).select("run", "keys", "logs")
    rows = stored(texts.groupBy("run").cogroup(chances.groupBy("run")).applyInArrow(run, shape), "text-scores")
    rare = rows.select("row", F.explode("rare").alias("key")).join(word_counts.select("key", "n"), "key", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count("n").alias("found"))
    out = rows.drop("rare").join(rare, "row", "left")
    base = F.col("part") + F.coalesce("more", F.lit(0.0)) + F.col("ends") * F.lit(float(np.log10(0.5))) - F.col("n_tokens") * F.lit(norm)
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score", "bytes")
