"""Language identification, licence scan and context-tree scores against brute force and held-out rows."""

from __future__ import annotations

import os
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import context_tree, language_id, license_scan, queries
from millrace.llm.license_templates import PHRASES, TEMPLATES
from millrace.llm.text_arrays import words as digests

from .conftest import EDGES

LOWER = {c: c + 32 for c in range(65, 91)}


# Language identification


def test_held_out_accuracy(spark, sf_dir):
    rows = queries.registered()["op8_language_id"](spark, sf_dir).collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").collect()}
    assert {r["doc_id"] for r in rows} == set(langs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in out) >= 0.97 * len(out)


def test_nearest_centroid_and_limits_by_hand(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.fit(given)
    rows = language_id.judged(given, model, ["doc_id", "text"]).collect()
    salts = (0x9E3779B1, 0x85EBCA6B)
    for r in rows[:60]:
        data = b" " + bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in (r["text"] or "").lower().encode()) + b" "
        vector = [0.0] * language_id.DIMS
        for n, salt in ((2, salts[0]), (3, salts[1])):
            for i in range(len(data) - n + 1):
                if data[i + n - 2 : i + n] != b"  ":
                    vector[(int.from_bytes(data[i : i + n], "big") * salt % (1 << 32)) >> 19] += 1
        weighed = np.array(vector) * model.idf
        cosine = weighed @ model.centroids / (np.linalg.norm(weighed) or 1)
        best = int(cosine.argmax())
        if r["lang_pred"] != "und":
            assert r["lang_pred"] == model.languages[best] and abs(r["score"] - min(1, max(0, cosine[best]))) < 1e-4
            reached = [k for k, n in enumerate(language_id.LENGTHS) if sum(vector) >= n]
            limit = model.limits[best][reached[-1]] if reached else 0
            assert r["rejected"] == (r["score"] < limit) or abs(r["score"] - limit) < 1e-4


def test_random_letters_and_other_languages_are_rejected(spark, docs):
    folder = "/root/testdata/sf0.01"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    given = spark.read.parquet(f"{folder}/documents.parquet")
    model = language_id.fit(given)
    r = random.Random(1)
    odd = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(n)) for n in (10, 20, 40, 100, 200, 500)]
    odd += [
        "Wczoraj wieczorem poszliśmy do lasu, aby zobaczyć stare drzewa, które rosną tam od bardzo dawna i nikt ich nie ścina.",
        "Eilen illalla menimme metsään katsomaan vanhoja puita, jotka ovat kasvaneet siellä hyvin kauan eikä kukaan kaada niitä.",
    ]
    assert all(x["rejected"] for x in language_id.judged(docs(odd), model, ["doc_id"]).collect())
    kept = language_id.judged(given, model, ["doc_id"]).filter("NOT rejected").count()
    assert kept >= 0.995 * given.count()


def test_numbers_and_marks_are_no_letters(docs):
    table = docs(["der die das und ist nicht ein eine zu von " * 20, "½ ² Ⅷ ①", "١٢٣", "a"], langs=["de"] * 4)
    rows = {r["doc_id"]: r for r in language_id.judged(table, language_id.fit(table), ["doc_id"]).collect()}
    assert [rows[k]["lang_pred"] for k in range(4)] == ["de", "und", "und", "de"]
    assert rows[1]["rejected"] and not rows[0]["rejected"]


def test_languages_at_the_edges(edges, docs):
    rows = language_id.predicted(edges).collect()
    assert len(rows) == len(EDGES)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc_id"], []).append((r["lang_pred"], r["rejected"]))
    for k in (0, 1, 2, None):
        assert by_text[k] == [("und", True)]
    assert by_text[5] == by_text[6] != [("und", True)]
    assert language_id.predicted(edges.limit(0)).collect() == []
    unlabelled = docs(["some words"] * 3, langs=[None] * 3)
    assert {(r["lang_pred"], r["score"], r["rejected"]) for r in language_id.predicted(unlabelled).collect()} == {("und", 0.0, True)}
    kept = language_id.kept(edges)
    assert kept.columns == edges.columns


def test_far_texts_are_rejected_and_short_ones_kept(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    more = spark.createDataFrame([(10**6, "日本語の文章です。" * 20, "en", "s", 0), (10**6 + 1, "The and of.", "en", "s", 0)], given.schema)
    kept = {r["doc_id"] for r in language_id.kept(given.union(more)).select("doc_id").collect()}
    assert 10**6 not in kept and 10**6 + 1 in kept
    assert len(kept) >= given.count()


# Licence scan


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def licence_texts() -> list[str | None]:
    r = random.Random(8)
    pool = "mit license apache general public the of x MIT License, GNU software permission granted is".split()
    texts = [" ".join(r.choice(pool) for _ in range(r.randint(0, 40))) for _ in range(300)]
    for _, _, text in TEMPLATES:
        own = text.split()
        cut = r.randrange(len(own))
        texts += [text, f"before {text.upper()} after", " ".join(own[cut:]), " ".join(w if r.random() < 0.95 else "changed" for w in own)]
    return texts + EDGES


def test_base_columns():
    texts = licence_texts()
    scanner = license_scan.Scanner(TEMPLATES, PHRASES)
    rows = scanner.scan([(t or "").encode().lower() for t in texts])
    for text, row in zip(texts, rows):
        own = words(text)
        places = [(i, label) for i in range(len(own)) for label, phrase in PHRASES if own[i : i + len(phrase.split())] == phrase.split()]
        starts = [i for i, _ in places]
        labels = {label for _, label in places}
        assert row[:5] == (len(own), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert labels <= set(row[5].split(",")) - {""} | labels and 0 <= row[6] <= 1


def test_matching_statistics():
    scanner = license_scan.Scanner(TEMPLATES, PHRASES)
    named = [words(t) for _, _, t in TEMPLATES] + [p.split() for _, p in PHRASES]
    runs = [{tuple(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)} for s in named]
    for text in licence_texts()[:120]:
        own = words(text)
        found = scanner.runs(ids_of(scanner, text))[0] if len(own) > 1 else {}
        statistics = [[max((n for n in range(1, i + 2) if tuple(own[i + 1 - n : i + 1]) in known), default=0) for i in range(len(own))] for known in runs]
        top = [max(m) for m in zip(*statistics)] + [0]
        for k, longest in enumerate(statistics):
            ends = [i for i in range(len(own)) if longest[i] >= scanner.least[k] and (i + 1 == len(own) or longest[i + 1] <= longest[i])]
            if k >= len(TEMPLATES):
                ends = [i for i in ends if longest[i] == top[i] >= top[i + 1]]
            assert [(i, n) for i, n, _ in found.get(k, [])] == [(i + 1 - longest[i], longest[i]) for i in ends]


def ids_of(scanner: license_scan.Scanner, text: str | None) -> np.ndarray:
    known, _ = digests([(text or "").encode().lower()], license_scan.BETWEEN)
    return np.where(np.isin(known, scanner.known), np.searchsorted(scanner.known, known) + 1, 0)


def best_chain(template: list[str], text: list[str], least: int) -> int:
    """Most words of the template that a chain of runs covers, each run against all before it."""
    longest = [[0] * (len(template) + 1) for _ in range(len(text) + 1)]
    for i, word in enumerate(text):
        for j, own in enumerate(template):
            longest[i + 1][j + 1] = longest[i][j] + 1 if word == own else 0
    top = [max(row) for row in longest] + [0]
    runs = [(i, j, top[i]) for i in range(1, len(text) + 1) if top[i] >= least and top[i + 1] <= top[i] for j in range(1, len(template) + 1) if longest[i][j] == top[i]]
    covered = []
    for n, (i, j, size) in enumerate(runs):
        best = size
        for m, (a, b, _) in enumerate(runs[:n]):
            lap = max(0, a - (i - size), b - (j - size))
            if a < i and lap < size and i - size - a <= license_scan.GAP and j - size - b <= license_scan.GAP:
                best = max(best, covered[m] + size - lap)
        covered.append(best)
    return max(covered, default=0)


def test_chains_cover_as_much_as_by_brute_force():
    scanner = license_scan.Scanner(TEMPLATES, PHRASES)
    r = random.Random(3)
    for k, (label, _, text) in enumerate(TEMPLATES):
        own = words(text)
        for every in range(4, 13):
            for shift in range(0, every, 3):
                changed = [f"changed{n}" if n % every == shift else w for n, w in enumerate(own)]
                given = " ".join(["before", "it", *changed, "after", *r.sample(own, min(9, len(own)))])
                found = scanner.runs(ids_of(scanner, given))[0]
                best = best_chain(own, words(given), scanner.least[k])
                spans = scanner.chains(k, found.get(k, []))
                assert max((s[2] for s in spans), default=0) == (best if best >= license_scan.SHARE * len(own) else 0)
                if len(own) > 30:
                    assert label in scanner.scan([given.encode()])[0][5].split(",")


def test_copies_of_a_template_are_spans_of_their_own():
    scanner = license_scan.Scanner(TEMPLATES, PHRASES)
    k = next(k for k, t in enumerate(TEMPLATES) if t[1] == "bsd-conditions")
    size = len(words(TEMPLATES[k][2]))
    found = scanner.chains(k, scanner.runs(ids_of(scanner, " ".join([TEMPLATES[k][2]] * 40)))[0][k])
    assert sorted(found) == [(n * size, (n + 1) * size - 1, size) for n in range(40)]


def test_spans_of_whole_and_edited_templates(docs):
    texts = [TEMPLATES[1][2], f"x y {TEMPLATES[4][2]} z", TEMPLATES[6][2].replace("hope", "wish"), "the software is here", "All rights reserved."]
    rows = {r["doc_id"]: r for r in license_scan.scanned(docs(texts)).collect()}
    assert [rows[k]["labels"] for k in range(5)] == ["mit", "apache", "gpl", "", "all-rights-reserved"]
    assert rows[0]["score"] == 1.0 and 0.9 < rows[2]["score"] < 1 and rows[3]["score"] == 0.0
    span = next(s for s in rows[1]["spans"] if s["template"] == "apache-notice")
    assert (span["first_word"], span["last_word"]) == (2, 1 + len(words(TEMPLATES[4][2])))


def test_scan_of_edge_rows(edges):
    rows = license_scan.scanned(edges).collect()
    assert sorted(r["n_words"] for r in rows) == sorted(len(words(t)) for t in EDGES)
    assert license_scan.scanned(edges.limit(0)).collect() == []


# Context-tree weighting


class Naive:
    """The same tree by recursion over dictionaries."""

    def __init__(self, texts: list[bytes], contexts: float):
        self.depth = context_tree.DEPTH
        self.counts: dict[bytes, Counter] = defaultdict(Counter)
        for text in texts:
            data = b"\xff" * self.depth + text + b"\xff"
            for i in range(self.depth, len(data)):
                for d in range(self.depth + 1):
                    self.counts[data[i - d : i]][data[i]] += 1
        total = sum(self.counts[b""].values())
        self.kept = {c for c, n in self.counts.items() if sum(n.values()) * contexts >= total}
        self.children = defaultdict(list)
        for c in self.kept:
            if c:
                self.children[c[1:]].append(c)
        self.memo: dict = {}

    def bits(self, counts: Counter, prefix: str) -> tuple[int, int]:
        out = [0, 0]
        for byte, n in counts.items():
            bits = f"{byte:08b}"
            if bits.startswith(prefix):
                out[int(bits[len(prefix)])] += n
        return out[0], out[1]

    @staticmethod
    def kt(a: int, b: int) -> float:
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def rest(self, c: bytes) -> Counter:
        out = Counter(self.counts[c])
        for child in self.children[c]:
            out.subtract(self.counts[child])
        return out

    def weighted(self, c: bytes, prefix: str) -> tuple[float, float]:
        """ln of the weighted probability, and the share of this depth's own estimate in it."""
        if (c, prefix) not in self.memo:
            own = self.kt(*self.bits(self.counts[c], prefix))
            if len(c) == self.depth:
                self.memo[c, prefix] = own, 1.0
            else:
                split = self.kt(*self.bits(self.rest(c), prefix)) + sum(self.weighted(child, prefix)[0] for child in self.children[c])
                both = np.logaddexp(own, split) + math.log(0.5)
                self.memo[c, prefix] = both, math.exp(own + math.log(0.5) - both)
        return self.memo[c, prefix]

    def one(self, history: bytes, prefix: str, d: int = 0) -> float:
        c = history[len(history) - d :]
        estimate = lambda counts: (lambda z, o: (o + 0.5) / (z + o + 1))(*self.bits(counts, prefix))
        share = self.weighted(c, prefix)[1]
        if d == self.depth:
            return estimate(self.counts[c])
        deeper = history[len(history) - d - 1 :]
        below = self.one(history, prefix, d + 1) if deeper in self.kept else estimate(self.rest(c))
        return share * estimate(self.counts[c]) + (1 - share) * below

    def byte(self, history: bytes, byte: int) -> float:
        p, bits = 1.0, f"{byte:08b}"
        for k in range(8):
            one = self.one(history, bits[:k])
            p *= one if bits[k] == "1" else 1 - one
        return p

    def score(self, text: bytes) -> float:
        data = b"\xff" * self.depth + text + b"\xff"
        return sum(math.log10(self.byte(data[i - self.depth : i], data[i])) for i in range(self.depth, len(data)))


@pytest.mark.parametrize("contexts", [1 << 16, 40])
def test_scores_are_the_trees(docs, monkeypatch, contexts):
    monkeypatch.setattr(context_tree, "CONTEXTS", contexts)
    monkeypatch.setattr(context_tree, "HEAVY", 20)
    r = random.Random(6)
    texts = [" ".join(r.choice(["abra", "Cad", "é", "abra.", "x"]) for _ in range(r.randint(0, 12))) for _ in range(40)] + [None, "", "unseen ZZZ ÿ", "\x00\x7f"]
    rows = {x["doc_id"]: x for x in context_tree.scored(docs(texts)).collect()}
    lower = [(t or "").translate(LOWER) for t in texts]
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    assert any(held) and not all(held)
    naive = Naive([t.encode() for t, h in zip(lower, held) if not h], contexts)
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", t) + [None] for t in lower]
    known = Counter(w for own, h in zip(tokens, held) if not h for w in own)
    n, v = sum(known.values()), len(known)
    for k in range(len(texts)):
        assert rows[k]["held_out"] == held[k]
        assert (rows[k]["n_tokens"], rows[k]["n_known"], rows[k]["train_tokens"]) == (len(tokens[k]), sum(known[w] > 0 for w in tokens[k]), n)
        assert rows[k]["base_score"] == pytest.approx(sum(math.log10((known[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[k]))
        assert rows[k]["score"] == pytest.approx(naive.score(lower[k].encode()), rel=1e-4, abs=1e-4)
    history = b"\xff\xff\xffab"
    assert sum(naive.byte(history, b) for b in range(256)) == pytest.approx(1)


def test_rare_contexts_have_nodes_in_a_large_corpus(docs):
    texts = ["abra cad " * 4000] * 30 + ["xylophone quiz"] * 8 + ["quiz xylophone"]
    rows = {x["doc_id"]: x["score"] for x in context_tree.scored(docs(texts)).collect()}
    held = [zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))]
    training = [t.encode() for t, h in zip(texts, held) if not h]
    total = sum(len(t) + 1 for t in training)
    rare = sum(t.count(b"xylophone") for t in training)
    assert 2 <= rare < total / (1 << 16)
    naive = Naive(training, total / 2)
    for k in (30, len(texts) - 1):
        assert rows[k] == pytest.approx(naive.score(texts[k].encode()), rel=1e-4)


def test_scores_at_the_edges(edges, docs):
    rows = context_tree.scored(edges).collect()
    assert len(rows) == len(EDGES) and all(math.isfinite(r["score"]) for r in rows)
    assert context_tree.scored(edges.limit(0)).collect() == []
    alone = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    row = context_tree.scored(docs(["ab"], ids=[alone])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (2, 0, 0)
    assert row["score"] == pytest.approx(3 * math.log10(1 / 256)) and row["base_score"] == pytest.approx(0.0)


def test_held_out_texts_cost_less_than_by_words(spark, sf_dir):
    rows = [r for r in queries.registered()["op2_context_tree_score"](spark, sf_dir).collect() if r["held_out"]]
    assert -sum(r["score"] for r in rows) / math.log10(2) / sum(r["bytes"] for r in rows) < 2.6
