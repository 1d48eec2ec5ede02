"""Token counts by rank-synchronous merging of ragged arrays.

A text is cut into pre-tokens where no piece of the vocabulary reaches across: before a run of blanks
that follows other characters, and around line feeds and other characters that occur in no longer
piece. The pre-tokens that a batch sees for the first time are laid out as one ragged numpy array of
piece ids. In every round each sequence merges its pair of lowest rank (its leftmost one), all sequences
at once, until no pair is a piece; the symbols that survive are counted. Pairs are looked up as
(left id, right id) in a sorted table of all ways to cut a piece in two. A sequence of more than
LONG symbols goes through the same merges alone, on a linked list held in arrays, so that a round costs one
scan for its lowest rank.

Rows: a null text counts as empty: no bytes, no tokens, not over the limit. Repeated rows give repeated
results, an empty table an empty one; other columns of the input are ignored, whatever their names. Memory
is bounded by the batch, the longest text, and a table of counts that is emptied when full.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .base import by_text, kept_in_worker

#: Pre-tokens whose counts a worker keeps.
CACHE = 1_000_000
#: Symbols above which a pre-token is merged alone.
LONG = 400
LIMIT = 4096
BLANK = "▁"
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
NONE = np.iinfo(np.int32).max


class Counter:
    """Counts the pieces of texts by the vocabulary and scores of a sentencepiece BPE model."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        spelled = {model.id_to_piece(i): i for i in ids}
        order = sorted(ids, key=lambda i: (-model.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        # Ties of score are ties of rank: the leftmost goes first whichever piece it is.
        for before, i in zip(order, order[1:]):
            if model.get_score(i) == model.get_score(before):
                rank[i] = rank[before]
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in spelled):
            raise ValueError("pieces reach across blanks")
        if model.normalize("Ａ x") != f"{BLANK}Ａ{BLANK}x":
            raise ValueError("only models that keep characters and blanks and put a blank first are counted")
        # Characters of no piece are symbols too; their count is the bytes they take.
        self.char = {p: i for p, i in spelled.items() if len(p) == 1}
        pairs: dict[int, tuple[int, int]] = {}
        symbol = dict(spelled)
        extra = model.get_piece_size()
        for p in spelled:
            for c in p:
                if c not in symbol:
                    symbol[c] = extra  # only a part of pieces: as bytes if it stays alone
                    extra += 1
        for p, i in spelled.items():
            for k in range(1, len(p)):
                if (a := symbol.get(p[:k])) is not None and (b := symbol.get(p[k:])) is not None:
                    pairs[a << 32 | b] = (rank[i], i)
        self.symbol = {c: i for c, i in symbol.items() if len(c) == 1}
        keys = np.array(sorted(pairs), np.int64)
        self.keys = keys
        self.rank = np.array([pairs[k][0] for k in keys.tolist()], np.int32)
        self.joined = np.array([pairs[k][1] for k in keys.tolist()], np.int32)
        inside = {c for p in spelled if len(p) > 1 for c in p}
        joinable = re.escape("".join(sorted(inside - {BLANK})))
        # Blanks then joinable characters; or one character that joins nothing, whose cost is fixed.
        self.cut = re.compile(f" +[{joinable}]*|[{joinable}]+|[^ {joinable}]")
        self.known: dict[str, int] = {}

    def alone(self, c: str) -> int:
        return 1 if c in self.char else len(c.encode("utf-8"))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and its place in the table of pairs; NONE where the pair is no piece."""
        want = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
        return np.where(self.keys[at] == want, self.rank[at], NONE), at

    def _symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all characters, and their bytes if they stay alone (1 for pieces). Unknown ones get negative ids."""
        text = "".join(words)
        table = {c: (self.symbol.get(c, -1 - ord(c)), self.alone(c)) for c in set(text)}
        both = np.array([table[c] for c in text], np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def merge(self, words: list[str]) -> np.ndarray:
        """Tokens of each word (blanks already as U+2581)."""
        out = np.zeros(len(words), np.int64)
        short = [k for k, w in enumerate(words) if len(w) <= LONG]
        if short:
            out[short] = self._merge_together([words[k] for k in short])
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self._merge_alone(w)
        return out

    def _merge_together(self, words: list[str]) -> np.ndarray:
        ids, cost = self._symbols(words)
        lengths = np.array([len(w) for w in words], np.int64)
        seq = np.repeat(np.arange(len(words)), lengths)
        total = np.zeros(len(words), np.int64)
        while len(ids):
            same = seq[:-1] == seq[1:]
            rank, at = self._ranks(ids[:-1], ids[1:])
            rank = np.where(same & (ids[:-1] >= 0) & (ids[1:] >= 0), rank, NONE)
            rank = np.append(rank, NONE).astype(np.int64)  # the last symbol has no pair
            starts = np.flatnonzero(np.append(True, ~same))
            low = np.minimum.reduceat(rank * len(rank) + np.arange(len(rank)), starts)
            live = low // len(rank) < NONE
            first = (low % len(rank))[live]
            # Sequences without a pair are done.
            done = np.repeat(~live, np.diff(np.append(starts, len(ids))))
            total += np.bincount(seq[done], weights=cost[done], minlength=len(total)).astype(np.int64)
            ids[first] = self.joined[at[first]]
            cost[first] = 1
            keep = ~done
            keep[first + 1] = False
            ids, cost, seq = ids[keep], cost[keep], seq[keep]
        return total

    def _merge_alone(self, word: str) -> int:
        ids, cost = self._symbols([word])
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        at = np.zeros(n, np.int64)
        rank = np.full(n, NONE, np.int64)
        found, at[:-1] = self._ranks(ids[:-1], ids[1:])
        rank[:-1] = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), found, NONE)

        def pair(i: int) -> None:
            j = int(after[i])
            rank[i] = NONE
            if j < n and ids[i] >= 0 and ids[j] >= 0:
                r, a = self._ranks(ids[i : i + 1], ids[j : j + 1])
                rank[i], at[i] = r[0], a[0]

        while rank[i := int(rank.argmin())] < NONE:
            j = int(after[i])
            ids[i], cost[i], cost[j], rank[j] = self.joined[at[i]], 1, 0, NONE
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            pair(i)
            if before[i] >= 0:
                pair(int(before[i]))
        return int(cost.sum())

    def counts(self, texts: list[str]) -> list[int]:
        known, cut = self.known, self.cut.findall
        cuts = [cut(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
        new = list({w for words in cuts for w in words if w not in known})
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list({w for words in cuts for w in words})
        for k in range(0, len(new), 100_000):
            part = new[k : k + 100_000]
            known.update(zip(part, self.merge([w.replace(" ", BLANK) for w in part]).tolist()))
        return [sum([known[w] for w in words]) for words in cuts]


@kept_in_worker
def counter(path: str) -> Counter:
    return Counter(path)


def counted(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every text."""

    def work(rows: pa.Table) -> pa.Table:
        c = counter(model)
        texts = [t or "" for t in rows["text"].to_pylist()]
        n: list[int] = []
        for k in range(0, len(texts), 500):
            n += c.counts(texts[k : k + 500])
        return pa.table(
            {
                "doc_id": rows["doc_id"],
                "n_bytes": pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                "n_tokens": pa.array(n, pa.int64()),
                "over_limit": pa.array([k > limit for k in n], pa.bool_()),
            }
        )

    return by_text(docs, ["doc_id", "text"], SCHEMA, work)
