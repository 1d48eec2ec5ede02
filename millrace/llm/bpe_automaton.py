"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, rank by rank, into a deterministic automaton whose arcs are labelled with
tokens and whose accepted label sequences are exactly the correct tokenizations. The gadget of a
merge (u, v) -> w gives every state with an arc u an arc w to the place where v led, and sends u to a
copy of its target that lacks the arc v. An arc's target depends on its label alone, so a state is
kept as "after token t"; a copy is kept as its original, the rank at which it was made and the arc it
lacks, instead of as a full row of arcs. A word is encoded by walking arcs whose labels spell it,
longest label first, with dead places remembered; the path is unique. Arcs once asked for stay in a transition table.
Decoding emits the labels. Which characters beyond ASCII are letters, numbers or blanks is taken from the
tokenizer's own pre-split, character by character as they are met, since Unicode versions differ on it; so is the lower
case of characters that Python's tables don't know.

Rows: a null text counts as empty; an empty text has no tokens, an empty decoded text and the digests
of the empty string. Repeated rows give repeated results, an empty table an empty one; other columns of
the input are ignored, whatever their names. Words are encoded once per worker and kept in a table
that is emptied when full, so memory stays bounded by it and by the longest text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .base import by_text, kept_in_worker

#: Words kept per worker, arcs kept in its transition table.
CACHE, ARCS = 300_000, 2_000_000
#: Letters with cases lie below.
UNKNOWN = 0x20000
#: Texts encoded at a time.
ROWS = 200
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Automaton:
    """Tokenization automaton over the symbols of a vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.label = {i: t for t, i in vocab.items()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.born: dict[int, int] = {}
        self.lacks: dict[int, dict[int, int]] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        for rank, (left, right) in enumerate(merges, 1):
            u, v, w = vocab[left], vocab[right], vocab[left + right]
            if w in self.born or not self._arc(u, v, rank, False):
                continue  # w exists by an earlier merge, or v never follows u any more
            self.parts[w], self.born[w] = (u, v), rank
            self.lacks.setdefault(u, {})[v] = rank
        self._spell({t: i for t, i in vocab.items() if i not in self.parts}, vocab)

    def _arc(self, t: int, label: int, rank: int, made: bool) -> bool:
        """Whether the state after t has the arc label once the merges below rank are compiled.

        made: the gadget of rank itself counts too. The newer of both tokens got its arcs from a part
        of its own: arcs labelled w stand beside those labelled u, and w leads where v led.
        """
        born, parts, lacks = self.born, self.parts, self.lacks
        while True:
            at = lacks.get(t)
            if at is not None and (r := at.get(label)) is not None and (r < rank or made and r == rank):
                return False
            a, b = born.get(t, 0), born.get(label, 0)
            if b > a:
                label, rank, made = parts[label][0], b, True
            elif a > b:
                t, rank, made = parts[t][1], a, False
            elif a == 0:
                return True
            else:  # the same token twice
                label, rank, made = parts[label][0], b, True

    def follows(self, t: int, label: int) -> bool:
        """Whether label may follow t in a correct tokenization."""
        found = self.arcs.get((t, label))
        if found is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            found = self.arcs[t, label] = self._arc(t, label, 1 << 60, True)
        return found

    def _spell(self, base: dict[str, int], vocab: dict[str, int]) -> None:
        """Paths of base symbols to tokens, as one transition table."""
        self.base = base
        self.step: dict[tuple[int, int], int] = {}
        self.token_at: dict[int, int] = {}
        spelled = {i: (i,) for i in base.values()}
        for w, (u, v) in self.parts.items():
            spelled[w] = spelled[u] + spelled[v]
        nodes = 1
        for token, symbols in spelled.items():
            node = 0
            for s in symbols:
                if (nxt := self.step.get((node, s))) is None:
                    nxt = self.step[node, s] = nodes
                    nodes += 1
                node = nxt
            self.token_at[node] = token

    def encode(self, symbols: list[int]) -> list[int]:
        """The one path of labels that spells the symbols."""
        n, step, token_at = len(symbols), self.step, self.token_at

        def labels(i: int) -> list[tuple[int, int]]:
            node, found = 0, []
            while i < n and (node := step.get((node, symbols[i]), -1)) >= 0:
                i += 1
                if node in token_at:
                    found.append((i, token_at[node]))
            return found

        if n == 0:
            return []
        path: list[int] = []
        ends = [0]
        open_ = [labels(0)]
        dead: set[tuple[int, int]] = set()
        while True:
            here = open_[-1]
            while here:
                end, token = here.pop()
                if (end, token) not in dead and (not path or self.follows(path[-1], token)):
                    path.append(token)
                    if end == n:
                        return path
                    ends.append(end)
                    open_.append(labels(end))
                    break
            else:
                open_.pop()
                dead.add((ends.pop(), path.pop()))


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: Latin-1 where visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class Classes(dict):
    """str.translate table: a character beyond ASCII to one that the pattern takes as the tokenizer's pre-split takes it."""

    LETTER, NUMBER, BLANK, OTHER = "é", "²", "\u2003", "…"

    def __init__(self, path: str):
        split = Tokenizer.from_file(path).pre_tokenizer
        self.cuts = lambda text: len(split.pre_tokenize_str(text))
        super().__init__({c: chr(c) for c in range(128)})

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if self.cuts(f"a{c}a") == 1:
            found = self.LETTER
        elif self.cuts(f"!{c}!") == 1:
            found = self.OTHER
        else:
            found = self.NUMBER if self.cuts(c) else self.BLANK
        self[code] = found
        return found


class Word(NamedTuple):
    ids: str
    labels: str
    n: int


class Codec:
    """Encoder and decoder of one tokenizer file: NFC, white space to blanks, lower case, pre-split, byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.vocab: dict[str, int] = model["vocab"]
        self.automaton = Automaton(self.vocab, merges, suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label = self.automaton.label | {i: t for t, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.classes = Classes(path)
        lower = Tokenizer.from_file(path).normalizer.normalize_str
        unknown = (chr(c) for c in range(0x80, UNKNOWN) if unicodedata.category(chr(c)) == "Cn")
        self.newer = {ord(c): low for c in unknown if (low := lower(c)) != c}
        self.has_newer = re.compile("[" + "".join(map(chr, self.newer)) + "]" if self.newer else r"(?!)")
        # The same cuts for texts of letters below U+0250, digits, and marks and blanks below U+0080.
        self.plain = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\sa-z0-9ß-öø-ɏ]+")
        self.not_plain = re.compile(r"[^\t-\r -~ß-öø-ſ]")
        letters = byte_alphabet()
        self.inner = [self.vocab[letters[b]] for b in range(256)]
        self.last = [self.vocab[letters[b] + suffix] for b in range(256)]
        self.known: dict[str, Word] = {}

    def normal(self, text: str) -> str:
        """NFC and lower case character by character (no rule for a final sigma)."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text.translate(self.newer) if self.has_newer.search(text) else text

    def word(self, word: str) -> Word:
        found = self.known.get(word)
        if found is None:
            data = word.encode("utf-8")
            ids = self.automaton.encode([self.inner[b] for b in data[:-1]] + [self.last[data[-1]]])
            found = Word(" ".join(map(str, ids)), " ".join([self.label[i] for i in ids]), len(ids))
            if len(self.known) >= CACHE:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def pieces(self, text: str) -> list[Word]:
        out: list[Word] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if (i := self.special.get(part)) is not None:
                out.append(Word(str(i), self.label[i], 1))
            elif part:
                part = self.normal(part)
                if self.not_plain.search(part):
                    words = [part[m.start() : m.end()] for m in self.words.finditer(part.translate(self.classes))]
                else:
                    words = self.plain.findall(part)
                known = self.known.get
                out += [known(w) or self.word(w) for w in words]
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for p in self.pieces(text) for i in p.ids.split(" ")]

    def decode(self, ids: list[int]) -> str:
        """The labels of the ids' arcs, joined by blanks; ids without a label are left out."""
        return " ".join([self.label[i] for i in ids if i in self.label])


@kept_in_worker
def codec(path: str) -> Codec:
    return Codec(path)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def _encoded(docs: DataFrame, tokenizer: str, ids: bool) -> DataFrame:
    def work(rows: pa.Table) -> pa.Table:
        c = codec(tokenizer)
        found = [c.pieces(text.as_py() or "") for text in rows["text"]]
        spelled = [" ".join([w.ids for w in words]) for words in found]
        out = {
            "doc_id": rows["doc_id"],
            "n_tokens": pa.array([sum([w.n for w in words]) for words in found], pa.int64()),
            "ids_sha256": pa.array([_digest(s) for s in spelled], pa.string()),
            "decoded_sha256": pa.array([_digest(" ".join([w.labels for w in words])) for words in found], pa.string()),
        }
        if ids:
            out["ids"] = pa.array([[int(i) for i in s.split()] for s in spelled], pa.list_(pa.int32()))
        return pa.table(out)

    def run(rows: pa.Table) -> pa.Table:
        return pa.concat_tables([work(rows.slice(k, ROWS)) for k in range(0, max(1, rows.num_rows), ROWS)])

    return by_text(docs, ["doc_id", "text"], SCHEMA + ", ids array<int>" * ids, run)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""
    return _encoded(docs, tokenizer, False)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """digests() and the token ids themselves."""
    return _encoded(docs, tokenizer, True)
