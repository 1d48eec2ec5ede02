"""Both tokenizers against their libraries."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import bpe_automaton, token_counts

from .conftest import EDGES

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = (
    "a e t h aa 's 'LL Σ ς İ é ﬁ ½ １ 一 日本 # $$ % <|endoftext|> <|startoftext|> <s> </s> <unk> <0x0A> ß ẞ ǅ ² Ⅷ _ - ŉ 😀 ʼ uuu uuuuu ª µ × ÷ ſ K ▁ ▁▁ \\ ] ^ == 梦".split()
    + ["", " ", "  ", "\n", " ", "　", "​", "́", "\x00", "\x1c", "\x85", "\t"]
)


def random_texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 30))) for _ in range(n)]
    texts += ["".join(r.choice("etaoinshr ") for _ in range(r.randint(1, 60))) for _ in range(n)]
    return texts + ["a" * k for k in range(1, 120, 7)] + ["ab" * k for k in range(1, 60, 5)]


def given_texts(spark, sf_dir) -> list[str]:
    return [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def test_ids_and_decoded_text_are_the_librarys(spark, sf_dir):
    codec, library = bpe_automaton.Codec(WORDS), Tokenizer.from_file(WORDS)
    texts = random_texts(1, 1500) + given_texts(spark, sf_dir)
    for text, expected in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = codec.encode(text)
        assert ids == expected.ids, text
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False), text


def test_every_character_is_taken_as_the_library_takes_it():
    own, library = bpe_automaton.Codec(WORDS), Tokenizer.from_file(WORDS)
    texts = [f"ab{chr(c)}cd {chr(c)} !{chr(c)}!" for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text) == found.ids, ascii(text)


def test_long_words_end():
    own, library = bpe_automaton.Codec(WORDS), Tokenizer.from_file(WORDS)
    r = random.Random(2)
    for alphabet in ("a", "ab", "etaoinshr", "é日"):
        word = "".join(r.choice(alphabet) for _ in range(20_000))
        assert own.encode(word) == library.encode(word, add_special_tokens=False).ids


def test_automaton_accepts_the_correct_tokenization_alone():
    merges = [("a", "a"), ("a", "b"), ("aa", "ab"), ("b", "aa"), ("b", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", *("".join(m) for m in merges)])}
    automaton = bpe_automaton.Automaton(vocab, merges)

    def merged(word: str) -> list[str]:
        parts = list(word)
        for left, right in merges:
            k = 0
            while k < len(parts) - 1:
                if (parts[k], parts[k + 1]) == (left, right):
                    parts[k : k + 2] = [left + right]
                k += 1
        return parts

    def accepted(word: str, before: int | None = None):
        if not word:
            yield []
        for token, i in vocab.items():
            if word.startswith(token) and (before is None or automaton.follows(before, i)):
                yield from ([token, *rest] for rest in accepted(word[len(token) :], i))

    for n in range(1, 9):
        for k in range(1 << n):
            word = "".join("ab"[k >> b & 1] for b in range(n))
            assert list(accepted(word)) == [merged(word)]
            assert [automaton.label[i] for i in automaton.encode([vocab[c] for c in word])] == merged(word)


def test_digests_of_edge_rows(edges):
    library = Tokenizer.from_file(WORDS)
    rows = bpe_automaton.encoded(edges, WORDS).collect()
    assert len(rows) == len(EDGES)
    expected = []
    for k, text in enumerate(EDGES):
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((None if k == 3 else k, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)), ids))
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([tuple(r) for r in rows], key=order) == sorted(expected, key=order)


def test_counts_are_the_librarys(spark, sf_dir):
    counter, library = token_counts.Counter(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    r = random.Random(2)
    texts = random_texts(3, 1500) + given_texts(spark, sf_dir)
    texts += ["".join(r.choice("etaoinshr") for _ in range(n)) for n in (399, 400, 401, 402, 1500)] + ["=" * n for n in (400, 401, 1000)] + [" " * n for n in (1, 16, 17, 900)]
    assert counter.counts(texts) == [len(x) for x in library.encode(texts, num_threads=1)]


def test_counts_of_edge_rows(edges):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = {tuple(r) for r in token_counts.counted(edges, PIECES, limit=10).collect()}
    expected = set()
    for k, text in enumerate(EDGES):
        n = len(library.encode(text or ""))
        expected.add((None if k == 3 else k, len((text or "").encode()), n, n > 10))
    assert rows == expected


def test_empty_tables(docs):
    assert bpe_automaton.digests(docs(["x"]).limit(0), WORDS).collect() == []
    assert token_counts.counted(docs(["x"]).limit(0), PIECES).collect() == []
