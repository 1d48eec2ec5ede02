"""Jaccard join of word n-gram sets, size-aware.

Sets A and B link when 100 * |A & B| >= PERCENT * |A | B|, that is, when at most (|A| + |B|) / 19 of their elements are
not shared (for 90%). Equal sets are one set from the start. Small sets enumerate their subsets of the fixed sizes that
a partner could share with them; sets that meet in a subset of size o link if o is enough for their sizes, with no look
at the sets. Large sets go to inverted lists. A list of a single frequent shingle would grow with the corpus,
so the lists are kept for blocks: a set of the size class with at most t unshared elements is dealt by hash into
t + 2 blocks, two of which at least are then the same in both sets. The members of a list are checked by their sets.
The boundary between small and large is the size at which the bytes moved, summed over the sizes that occur, are
fewest.

Members of a list are compared with the list's leader first, over several rounds with other leaders, and joined
into components on the way; what is left at the end are pairs of a list in different components, and all of those are checked. So no
link between different components is lost, while a group of near copies is not compared pair by pair.

Rows: a null or wordless text has the empty set, links with nothing and is its own component; a text of one or two words has one
shingle, its whole sequence. Repeated rows are equal sets. Rows with a null doc_id are compared too; component_id is the
smallest doc_id that isn't null. An empty table gives an empty result. Only doc_id and text are read. Shingles are kept as 64-bit
digests of their words, and a set as two sums of digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import mapped, stored
from .components import components
from .text_arrays import BASE, chunks, mixed, runs, words

WORDS, PERCENT = 3, 90
#: Size classes of the lists: from 9 elements on (smaller sets have no partner but equal ones), each wider by GROWTH.
LEAST, GROWTH = 9, 1.25
#: Sizes up to which subsets are considered, bytes of a key, rounds with leaders.
SMALL, KEY_BYTES, ROUNDS = 40, 24, 2
#: Columns of a sketch of each set.
PARITIES = ["p0", "p1", "p2", "p3"]
#: Bits of the table of sets that are looked up; others pass unseen. A full table lets all pass.
BITS = 1 << 24

def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the distinct shingles of all texts, sorted within each text, and where each text's begin (one more at the end)."""
    parts, sizes = [], []
    for some in chunks(texts):
        digests, n = _shingles(some)
        parts.append(digests)
        sizes += n
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _shingles(texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
    word, first = words(texts)
    three = np.zeros(0, np.uint64)
    if len(word) >= WORDS:
        total = np.zeros(len(word) - WORDS + 1, np.uint64)
        for j in range(WORDS):
            total = mixed(total + word[j : len(word) - WORDS + 1 + j], j + 1)
        three = total
    out, n = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= WORDS:
            found = np.sort(three[a : b - WORDS + 1])
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        elif b > a:
            whole = np.zeros(1, np.uint64)
            for j in range(a, b):
                whole = mixed(whole + word[j], 16 + j - a)
            found = mixed(whole, b - a + 32)
        else:
            found = np.zeros(0, np.uint64)
        out.append(found)
        n.append(len(found))
    return np.concatenate(out) if out else np.zeros(0, np.uint64), n


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the runs between offsets, modulo 2 ** 64."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _names(digests: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two digests of each set."""
    n = np.diff(offsets).astype(np.uint64)
    return mixed(_sums(mixed(digests, 101), offsets) + n).view(np.int64), mixed(_sums(mixed(digests, 102), offsets) + n).view(np.int64)


def unshared(total: int) -> int:
    """Elements that linked sets of that many elements together can have beside the shared ones."""
    return total * (100 - PERCENT) // (100 + PERCENT)


def dropped(n: int) -> int:
    """Elements of a set of n that a linked partner may lack."""
    m = 0
    while (n - m - 1) > 0 and (m + 1) * PERCENT <= (n - m - 1) * (100 - PERCENT):
        m += 1
    return m


def edges_of_classes(most: int) -> list[int]:
    out = [LEAST]
    while out[-1] <= most:
        out.append(ceil(out[-1] * GROWTH))
    return out


def blocks(high: int) -> int:
    """Blocks of a class whose sizes stay below high."""
    return unshared(2 * (high - 1)) + 2


def costs(n: int) -> tuple[int, int]:
    """Bytes moved for a set of n elements: as subsets, and as list entries with one check."""
    edges = edges_of_classes(n)
    subsets = KEY_BYTES * sum(comb(n, m) for m in range(dropped(n) + 1))
    return subsets, KEY_BYTES * blocks(edges[-1]) + 16 * n


def boundary(sizes: dict[int, int]) -> int:
    """The size from which sets are large: where the cost over the given numbers of sets is lowest."""
    possible = range(LEAST, SMALL + 1)

    def cost(at: int) -> int:
        return sum(k * costs(n)[n >= at] for n, k in sizes.items() if n in possible)

    return min(possible, key=lambda at: (cost(at), at))


def _keys(digests: np.ndarray, offsets: np.ndarray, names: np.ndarray, large: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Signature, set, size and shared size (0: a list's) of all keys of the sets."""
    n = np.diff(offsets)
    own = mixed(digests, 103)
    total = _sums(own, offsets)
    for k in np.flatnonzero((n >= LEAST) & (n < large)).tolist():
        values = own[offsets[k] : offsets[k + 1]]
        for m in range(dropped(int(n[k])) + 1):
            gone = np.array(list(combinations(range(int(n[k])), m)), np.int64)
            sums = total[k] - values[gone].sum(axis=1, dtype=np.uint64) if m else total[k : k + 1]
            yield mixed(sums, 1000 + int(n[k]) - m).view(np.int64), np.full(len(sums), names[k]), np.full(len(sums), n[k]), int(n[k]) - m
    # Up to the class above the largest set's own: partners there may be in other runs.
    edges = edges_of_classes(int(n.max(initial=0)) * 100 // PERCENT)
    for j, (low, high) in enumerate(zip(edges, edges[1:])):
        # Sets of the class, and smaller ones that a set of the class may link with.
        here = np.flatnonzero((n < high) & (n >= max(LEAST, ceil(low * PERCENT / 100))) & (n >= ceil(large * PERCENT / 100)))
        if not len(here):
            continue
        k = blocks(high)
        at = np.concatenate([np.arange(offsets[s], offsets[s + 1]) for s in here])
        row = np.repeat(np.arange(len(here)), n[here])
        dealt = mixed(digests[at], 2000 + j)
        cell = row * k + ((dealt >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        # Halves add up exactly as doubles.
        value = mixed(digests[at], 104)
        filled = np.bincount(cell, minlength=len(here) * k)
        halves = [np.bincount(cell, v.astype(np.float64), len(here) * k).astype(np.uint64) for v in (value >> np.uint64(32), value & np.uint64(0xFFFFFFFF))]
        sig = mixed(halves[0] * np.uint64(BASE) + halves[1] + np.tile(np.arange(k, dtype=np.uint64), len(here)) * np.uint64(0xC2B2AE3D27D4EB4F), 3000 + j)
        # Two equal blocks are sure; empty ones matter only where a set has two of them.
        empties = (filled.reshape(len(here), k) == 0).sum(axis=1)
        use = np.flatnonzero((filled > 0) | np.repeat(empties >= 2, k))
        yield sig[use].view(np.int64), names[here[use // k]], n[here[use // k]], 0


def _new(names: np.ndarray, seen: set[int]) -> np.ndarray:
    """Places of the first of each name that isn't in seen yet; seen is emptied when full."""
    out = []
    if len(seen) > 100_000:
        seen.clear()
    for k, name in enumerate(names.tolist()):
        if name not in seen:
            seen.add(name)
            out.append(k)
    return np.array(out, np.int64)


def _pick(digests: np.ndarray, offsets: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(offsets)[places]
    at = np.concatenate([np.arange(offsets[p], offsets[p + 1]) for p in places]) if len(places) else np.zeros(0, np.int64)
    return digests[at], np.concatenate([[0], np.cumsum(n)]).astype(np.int64)


def _parities(digests: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """64 bits for each of PARITIES: whether a set has an odd number of elements in each of all those cells.

    Two sets differ in as many elements, at least, as their bits.
    """
    cells = 64 * len(PARITIES)
    n = len(offsets) - 1
    cell = np.repeat(np.arange(n), np.diff(offsets)) * cells + (mixed(digests, 105) % np.uint64(cells)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * cells) & 1).astype(np.uint8)
    bits = np.packbits(odd.reshape(n, cells), axis=1, bitorder="little")
    return list(np.ascontiguousarray(bits).view(np.int64).reshape(n, len(PARITIES)).T)


def sets(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, the two names (set, set2) of every document's set, and columns of longs that go along; stored."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in runs(texts):
                digests, offsets = shingle_sets(texts[first:end])
                one, two = _names(digests, offsets)
                rest = [batch.column(2 + k).slice(first, end - first) for k in range(len(also))]
                columns = [batch.column(0).slice(first, end - first), pa.array(np.diff(offsets), pa.int64()), pa.array(one), pa.array(two), *rest]
                yield pa.record_batch(columns, ["doc_id", "n_shingles", "set", "set2", *also])

    shape = ", ".join(f"{c} long" for c in ["doc_id", "n_shingles", "set", "set2", *also])
    return stored(mapped(docs.select(F.col("doc_id").cast("long"), "text", *also), run, shape), "shingle-sets")


def lists(docs: DataFrame, large: int) -> DataFrame:
    """sig, set, n and shared of all list and subset entries that sets share with others, stored."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end in runs(texts):
                digests, offsets = shingle_sets(texts[first:end])
                names = _names(digests, offsets)[0]
                new = _new(names, seen)
                digests, offsets = _pick(digests, offsets, new)
                for sig, name, n, shared in _keys(digests, offsets, names[new], large):
                    yield pa.record_batch([pa.array(sig), pa.array(name), pa.array(n.astype(np.int32)), pa.array(np.full(len(sig), shared, np.int32))], ["sig", "set", "n", "shared"])

    keys = mapped(docs.select("text"), run, "sig long, set long, n int, shared int")
    of = Window.partitionBy("sig")
    met = keys.withColumn("low", F.min("set").over(of)).withColumn("high", F.max("set").over(of)).filter("low <> high")
    return stored(met.select("sig", "set", "n", "shared").distinct(), "shingle-lists")


def _looked_up(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """set and its digests for the wanted sets, stored. Texts of others are passed over by a table of BITS bits."""
    bit = F.pmod(F.col("set"), F.lit(BITS))
    rows = wanted.select(F.floor(bit / 32768).alias("part"), (bit % 32768).alias("bit")).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()
    table = np.zeros(BITS // 8, np.uint8)
    for r in rows:
        table[r["part"] * 4096 : r["part"] * 4096 + 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end in runs(texts):
                digests, offsets = shingle_sets(texts[first:end])
                names = _names(digests, offsets)[0]
                at = names % BITS
                hit = np.flatnonzero(shared.value[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                hit = hit[_new(names[hit], seen)]
                found, ends = _pick(digests, offsets, hit)
                columns = [pa.array(names[hit]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.view(np.int64)))]
                yield pa.record_batch([*columns, *map(pa.array, _parities(found, ends))], ["set", "digests", *PARITIES])

    found = mapped(docs.select("text"), run, "set long, digests array<long>, " + ", ".join(f"{p} long" for p in PARITIES))
    return stored(found.join(wanted.select("set"), "set", "left_semi").dropDuplicates(["set"]), "shingle-digests")


def _checked(pairs: DataFrame, digests: DataFrame) -> DataFrame:
    """The pairs(a, b) that link, by their sets."""
    one, two = (digests.select(F.col("set").alias(c), F.col("digests").alias(f"{c}_set")) for c in "ab")
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    return both.filter(100 * shared >= PERCENT * (F.size("a_set") + F.size("b_set") - shared)).select("a", "b")


def _close(n: str, m: str) -> str:
    """Whether the sizes admit a link."""
    return f"100 * least({n}, {m}) >= {PERCENT} * greatest({n}, {m})"


def links(docs: DataFrame, large: int) -> DataFrame:
    """Pairs (a, b) of sets that link, enough of them to connect all sets that links connect."""
    spark = docs.sparkSession
    met = lists(docs, large)
    # In a list of a shared subset the smallest set links with every set that links with any.
    of = Window.partitionBy("sig", "shared").orderBy("n", "set")
    small = met.filter("shared > 0").withColumn("first", F.first(F.struct("n", "set")).over(of))
    found = small.filter(f"set <> first.set AND 100 * shared >= {PERCENT} * (n + first.n - shared)").select(F.col("set").alias("a"), F.col("first.set").alias("b"))
    met = met.filter("shared = 0").select("sig", "set", "n")
    wanted = met.select("set").distinct()
    digests = _looked_up(docs, wanted)
    found = stored(found.distinct(), "links-0")
    none = spark.createDataFrame([], "a long, b long")
    tested = none
    for turn in range(1, ROUNDS + 1):
        now = _rooted(met, found)
        leader = now.groupBy("sig").agg(F.min(F.struct(F.xxhash64("set", F.lit(turn)).alias("order"), "set", "n", "root")).alias("first"))
        pairs = now.join(leader, "sig").filter(f"root <> first.root AND {_close('n', 'first.n')}").select("set", F.col("first.set").alias("other"))
        pairs = pairs.select(F.greatest("set", "other").alias("a"), F.least("set", "other").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"pairs-{turn}")
        found = found.union(stored(_checked(pairs, digests), f"links-{turn}"))
        tested = tested.union(pairs)
    now = _rooted(met, found)
    mixed_lists = now.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    left = now.join(mixed_lists.select("sig"), "sig", "left_semi").select("set", "root").distinct()
    pairs = stored(_sharing_rare(left.join(digests, "set")), "pairs-rare")
    return found.union(stored(_checked(pairs, digests), "links-rare"))


def _rooted(met: DataFrame, found: DataFrame) -> DataFrame:
    roots = components(found).withColumnRenamed("node", "set")
    return met.join(roots, "set", "left").select("sig", "set", "n", F.coalesce("root", "set").alias("root"))


def _sharing_rare(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different roots that may link, of left(set, root, digests).

    Ordered by how few of these sets have them, one of the first n - ceil(PERCENT * n / 100) + 1 elements of a set is among
    those of each set that links with it. What near copies have in common comes last in that order, and elements of one
    set alone make no list.
    """
    left = left.withColumn("n", F.size("digests"))
    each = left.select("set", "n", F.explode("digests").alias("digest"))
    many = each.groupBy("digest").agg(F.count("*").alias("sets"))
    in_order = Window.partitionBy("set").orderBy("sets", "digest")
    ranked = each.join(many, "digest").withColumn("place", F.row_number().over(in_order))
    first = ranked.filter(f"sets > 1 AND place <= n - ceil({PERCENT} * n / 100) + 1").select("digest", "set", "place")
    first = stored(first.join(left.drop("digests"), "set"), "rare-lists")
    other = first.select("digest", *[F.col(c).alias(f"o_{c}") for c in first.columns if c != "digest"])
    # Elements before the first common one are not shared, nor are those that the sketches tell apart.
    most = f"floor((n + o_n) * {100 - PERCENT} / {100 + PERCENT})"
    apart = " + ".join(f"bit_count({p} ^ o_{p})" for p in PARITIES)
    pairs = first.join(other, "digest").filter(f"root < o_root AND {_close('n', 'o_n')} AND place + o_place - 2 <= {most} AND {apart} <= {most}")
    return pairs.select(F.greatest("set", "o_set").alias("a"), F.least("set", "o_set").alias("b")).distinct()


def _roots(docs: DataFrame, named: DataFrame) -> DataFrame:
    """node and root of the sets that link with others."""
    sizes = named.filter(f"n_shingles BETWEEN {LEAST} AND {SMALL}").groupBy("n_shingles").count().collect()
    large = boundary({r["n_shingles"]: r["count"] for r in sizes})
    return components(links(docs, large))


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    named = sets(docs)
    roots = _roots(docs, named)
    equal = named.filter("n_shingles > 0").groupBy("set", "set2", "n_shingles").agg(F.min("doc_id").alias("first"))
    equal = equal.join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    linked = roots.select("root").distinct()
    least = equal.join(linked, "root", "left_semi").groupBy("root").agg(F.min("first").alias("least"))
    equal = equal.join(least, "root", "left").select("set", "set2", "n_shingles", F.coalesce(F.least("least", "first"), "first").alias("component_id"))
    out = named.filter("n_shingles > 0").join(equal, ["set", "set2", "n_shingles"], "left")
    alone = named.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return out.select("doc_id", "n_shingles", "component_id").union(alone.select("doc_id", "n_shingles", "component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without the near copies: one row of each component, that of the smallest doc_id.

    Of rows with that doc_id (nulls come last) the one with the smallest digest of all its columns stays, so reruns agree; of rows that are the same in
    every column one stays. Rows that link with nothing all stay, whatever their doc_id, and so do those without a shingle.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    names = ("__row", "__row2")
    rows = docs.withColumns({"__row": F.xxhash64(*columns), "__row2": F.xxhash64(F.lit(1), *columns)})
    named = sets(rows, names)
    alone = named.filter("n_shingles = 0").select(*names)
    roots = _roots(docs, named)
    of = named.filter("n_shingles > 0").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    of = of.join(roots.select("root", F.lit(True).alias("linked")).distinct(), "root", "left")
    # Equal sets are a component of their own where no other set links with them.
    single = F.col("linked").isNull()
    group = [F.col("root").alias("g"), F.when(single, F.col("set2")).alias("g2"), F.when(single, F.col("n_shingles")).alias("g3")]
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *names)).alias("first")
    kept = of.groupBy(*group).agg(first).select(*[F.col(f"first.{n}") for n in names])
    stay = rows.join(kept, list(names), "left_semi").dropDuplicates(list(names))
    return stay.union(rows.join(alone.distinct(), list(names), "left_semi")).select(*columns)
