"""Licence scan with a generalised suffix automaton of licence words.

The templates, as sequences of words, make one suffix automaton. A text is streamed through it: at every word the
automaton holds the longest run of words ending there that occurs in some template, and by its links the longest one of
each template (matching statistics). Words that form no pair of neighbours of any template are passed over in bulk, since no
run of two words goes across them. A template's runs that go on no further, at all places it has them, are chained into the
chain that covers most: a run may follow another if it lies after it in text and template with at most GAP words between;
words they share count once. A chain is a span when it covers SHARE of the template; of a template's chains that
overlap in the text, the one that covers most stays, then the first.
Places of the base phrases, which are templates too, are read from the automaton's state at each word; a phrase inside a
longer run of another template is no span of its own.

Rows: a null text counts as empty: no words, no labels, score 0, null places. Labels are distinct, sorted, joined by commas,
empty if none. The score is the largest covered share of a template, 1 at most. Repeated rows give
repeated results, an empty table an empty one. Only doc_id and text are read. Memory is bounded by the longest text.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .base import by_text, kept_in_worker
from .license_templates import PHRASES, TEMPLATES
from .text_arrays import chunks, words

#: Words of the shortest run that spans are chained from, words between two runs of a span, share of a template that a span covers.
LEAST, GAP, SHARE = 3, 8, 0.6
#: All ASCII but digits and small letters stands between words.
BETWEEN = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, template: string, first_word: long, last_word: long, covered: long>>"
)


class Automaton:
    """Suffix automaton of several sequences of word ids."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: For each state, the sequences its runs occur in, each with the places after all of them.
        self.places: list[dict[int, set[int]]] = [{}]
        for k, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence, 1):
                last = self._extend(last, word)
                self.places[last].setdefault(k, set()).add(at)
        #: For each state, the sequences that some of its suffixes occur in, each with the state of the longest.
        self.suffixes: list[dict[int, int]] = [{} for _ in self.next]
        order = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        for state in order:
            up = self.places[self.link[state]]
            for k, ends in self.places[state].items():
                up.setdefault(k, set()).update(ends)
        for state in reversed(order):
            self.suffixes[state] = {**self.suffixes[self.link[state]], **dict.fromkeys(self.places[state], state)}

    def _add(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt), self.length.append(length), self.link.append(link), self.places.append({})
        return len(self.next) - 1

    def _clone(self, p: int, word: int) -> int:
        """The state for the runs of p's length plus word, split off where longer runs shared it."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._clone(last, word)
        new = self._add(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._clone(p, word)
        return new

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """State and length of the longest run after one more word."""
        while word not in self.next[state]:
            if state == 0:
                return 0, 0
            state = self.link[state]
            length = self.length[state]
        return self.next[state][word], length + 1


class Scanner:
    def __init__(self, templates: list[tuple[str, str, str]], phrases: list[tuple[str, str]]):
        named = [*templates, *((label, phrase, phrase) for label, phrase in phrases)]
        self.labels, self.names = [t[0] for t in named], [t[1] for t in named]
        digests, first = words([t[2].encode().lower() for t in named], BETWEEN)
        self.known = np.unique(digests)
        ids = np.searchsorted(self.known, digests) + 1
        sequences = [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])]
        self.sizes = [len(s) for s in sequences]
        self.least = [min(LEAST, n) for n in self.sizes]
        self.automaton = Automaton(sequences)
        self.pairs = np.zeros((len(self.known) + 1,) * 2, bool)
        for s in sequences:
            self.pairs[s[:-1], s[1:]] = True
        # The phrases that end wherever the automaton is in a state, with their words.
        at = {}
        for (label, _), s in zip(phrases, sequences[len(templates) :]):
            state, length = 0, 0
            for word in s:
                state, length = self.automaton.step(state, length, word)
            at[state] = (label, len(s))
        self.phrases: list[list[tuple[str, int]]] = []
        for state in range(len(self.automaton.next)):
            own = []
            while state > 0:
                own += [at[state]] if state in at else []
                state = self.automaton.link[state]
            self.phrases.append(own)
        self.plain = len(templates)

    def runs(self, ids: np.ndarray) -> tuple[dict[int, list[tuple[int, int, int]]], list[tuple[int, str]]]:
        """By template, its runs (first word, words, state) that go on no further, and places (first word, label) of phrases."""
        pair = np.flatnonzero(self.pairs[ids[:-1], ids[1:]])
        found: dict[int, list[tuple[int, int, int]]] = {}
        places: list[tuple[int, str]] = []
        if not len(pair):
            return found, places
        breaks = np.flatnonzero(np.diff(pair) > 1) + 1
        starts, stops = pair[np.concatenate([[0], breaks])], pair[np.concatenate([breaks - 1, [len(pair) - 1]])] + 2
        step, phrases, lengths, suffixes = self.automaton.step, self.phrases, self.automaton.length, self.automaton.suffixes
        least, plain = self.least, self.plain
        for a, b in zip(starts.tolist(), stops.tolist()):
            state = length = 0
            open_: dict[int, tuple[int, int]] = {}
            for i, word in enumerate(ids[a:b].tolist(), a):
                before = length
                state, length = step(state, length, word)
                for label, size in phrases[state]:
                    if size <= length:
                        places.append((i + 1 - size, label))
                now = {}
                if length >= 2:
                    for k, at in suffixes[state].items():
                        own = length if at == state else lengths[at]
                        if own >= least[k]:
                            now[k] = (own, at)
                for k, (own, at) in open_.items():
                    if (k not in now or now[k][0] != own + 1) and (k < plain or own == before >= length):
                        found.setdefault(k, []).append((i - own, own, at))
                open_ = now
            for k, (own, at) in open_.items():
                if k < plain or own == length:
                    found.setdefault(k, []).append((b - own, own, at))
        return found, places

    def chains(self, k: int, runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """First word, last word and covered words of the chains of a template's runs that cover enough of it."""
        # Runs come by first and last word, both ascending; those too far before the current one are left behind.
        recent: list[tuple[int, int, int, int, int]] = []  # first word, word after, place after, chain's first word, covered
        ends = []
        for first, length, state in runs:
            stop = first + length
            recent = [r for r in recent if r[1] >= first - GAP]
            new = []
            for end in self.automaton.places[state][k]:
                start, covered = first, length
                for _, after, place, since, before in recent:
                    lap = max(0, after - first, place - (end - length))
                    if lap < length and end - length - place <= GAP and (before + length - lap, -since) > (covered, -start):
                        start, covered = since, before + length - lap
                new.append((first, stop, end, start, covered))
            recent += new
            ends += [(-covered, start, stop) for _, stop, _, start, covered in new if covered >= SHARE * self.sizes[k]]
        taken: list[tuple[int, int]] = []
        out = []
        for covered, start, stop in sorted(ends):
            at = bisect.bisect(taken, (start, stop))
            if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= stop):
                taken.insert(at, (start, stop))
                out.append((start, stop - 1, -covered))
        return out

    def spans(self, runs: dict[int, list[tuple[int, int, int]]]) -> list[tuple[int, int, int, int]]:
        """Covered template spans: template, first and last word, covered words."""
        return sorted(((k, *chain) for k, own in runs.items() for chain in self.chains(k, own)), key=lambda s: (s[1], s[2], s[0]))

    def scan(self, texts: list[bytes]) -> list[tuple]:
        """n_words and the columns after it, for each text in lower case."""
        digests, first = words(texts, BETWEEN)
        at = np.minimum(np.searchsorted(self.known, digests), len(self.known) - 1)
        ids = np.where(self.known[at] == digests, at + 1, 0)
        rows = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            found, places = self.runs(ids[a:b]) if b - a > 1 else ({}, [])
            spans = self.spans(found)
            base = sorted({label for _, label in places})
            labels = sorted({*base, *(self.labels[s[0]] for s in spans)})
            score = max((min(1.0, s[3] / self.sizes[s[0]]) for s in spans), default=0.0)
            named = [{"label": self.labels[k], "template": self.names[k], "first_word": f, "last_word": l, "covered": c} for k, f, l, c in spans]
            starts = [p for p, _ in places]
            rows.append((b - a, len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), score, named))
        return rows


@kept_in_worker
def scanner(templates: tuple, phrases: tuple) -> Scanner:
    return Scanner(list(templates), list(phrases))


def scanned(docs: DataFrame, templates: list[tuple[str, str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and the covered spans of every text."""
    all_templates, all_phrases = tuple(templates), tuple(phrases)

    def work(rows: pa.Table) -> pa.Table:
        scan = scanner(all_templates, all_phrases).scan
        found = [row for some in chunks(rows["text"].to_pylist()) for row in scan(some)]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        span = pa.struct([("label", pa.string()), ("template", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int64())])
        columns = [pa.array([row[k] for row in found], t) for k, t in enumerate([*types, pa.list_(span)])]
        return pa.Table.from_arrays([rows["doc_id"], *columns], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])

    return by_text(docs, ["doc_id", "text"], SCHEMA, work)
