"""Main text of pages, and the stages of the pipeline one after another."""

from __future__ import annotations

import html
import re
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import language_id, main_text, queries
from millrace.llm.page_samples import MARK, Writer
from millrace.llm.page_tree import features, flat, parse


def article(page: str) -> str:
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_given_pages(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.registered()["op10_main_text"](spark, sf_dir).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {k: article(v) for k, v in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


@pytest.fixture(scope="module")
def forest():
    return main_text.learned([])


def extract(forest, page: str) -> str:
    nodes = flat(parse(page))
    return "\n".join(main_text.chosen(nodes, forest.scores(np.array(features(nodes))).tolist()))


STORY = "<h1>A title, here</h1><p>One sentence of the story. Another &amp; more\n  of it.</p><p>Second <b>bold</b> part.<br>It goes on, &eacute;t&#233;.</p>"
TEXT = "A title, here\nOne sentence of the story. Another & more of it.\nSecond bold part. It goes on, été."


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="main"><div class="post">{}</div></div>'])
def test_parts_around_the_article_go(forest, around):
    page = f"""<html><head><title>No</title><style>p{{}}</style></head><body><header><a href="/">Site</a></header>
    <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li></ul></nav><div class="cookie-notice">We use cookies to improve. <button>OK</button></div>
    <script>var x = "<p>not text</p>";</script><!-- <p>nor this</p> -->{around.format(STORY)}<div class="ad">Buy this now. It is great.</div>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href="/c">Other story</a></li></ul></aside>
    <form><label>Your mail</label><input><button>Send</button></form>
    <section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this story. Thanks for it.</p></div></section><footer>&copy; Site 2020</footer></body></html>"""
    assert extract(forest, page) == TEXT


@pytest.mark.parametrize(
    "inside, text",
    [
        ("<p>Formula <math><mi>x</mi><mo>=</mo><mn>3</mn></math> holds.</p>", ["Formula x=3 holds."]),
        ("<p>one</p><object data=x>two</object><p>three</p>", ["one", "two", "three"]),
        ("<p>one</p><noscript><p>two</p><p>three</p>", ["one", "two", "three"]),
        ("<p>one</p><select><option>two<p>three</p>", ["one", "two", "three"]),
        ("<p>a &lt; b < c</p>", ["a < b < c"]),
        ('<p class="x>one</p><p>two</p>', ["one", "two"]),
    ],
)
def test_nothing_is_dropped_inside_an_article(inside, text):
    blocks = [n.text for n in flat(parse(f"<article>{inside}</article>")) if not n.tag]
    assert [b for b in blocks if b] == text


@pytest.mark.parametrize("part", ["<a ", "<a", '<a "', "<a '", '<a ">" ', "<!-", "</", "<div>", "<li>", "<textarea>", "<select>", "<a <b> ", "</div>", "<td><p>", "<!"])
def test_pages_take_time_in_proportion(part):
    start = time.process_time()
    parse(part * (1_000_000 // len(part)))
    assert time.process_time() - start < 15


def test_malformed_pages(forest):
    for page in ["", "   ", "<", "<p", "<!-- never closed <p>x</p>", "<script>never closed", "</p></div>", "<a <b> c", "a < b", "<p><b>x<br><p>y", "<table><tr><td>1<tr><td>2", "<div>" * 3000 + "deep", "&#xD800; &nosuch; &amp"]:
        text = extract(forest, page)
        assert "<p" not in text or page == "<p"
    assert extract(forest, "") == ""


def test_labels_of_ancestors_and_descendants_agree(forest):
    for k in range(60):
        nodes = flat(parse(Writer(k).page().replace(MARK, "")))
        odds = forest.scores(np.array(features(nodes))).tolist()
        got = main_text.chosen(nodes, odds)

        def best(node):
            """The best labelling with main text in it, by trying all subsets of children up to a limit."""
            odd = odds[nodes.index(node)]
            if not node.tag:
                return odd, [node.text]
            options = [best(c) for c in node.children]
            chosen = [o for o in options if o[0] > 0] or [max(options, key=lambda o: o[0])]
            return odd + sum(o[0] for o in chosen), [t for o in chosen for t in o[1]]

        score, texts = best(nodes[0])
        assert got == (texts if score > 0 else [])


def test_made_pages_held_out(forest):
    right = 0
    for k in range(10**6, 10**6 + 150):
        nodes = flat(parse(Writer(k).page()))
        expected = [n.text for n in nodes if MARK in n.text]
        right += main_text.chosen(nodes, forest.scores(np.array(features(nodes))).tolist()) == expected
    assert right >= 135


def test_page_rows(spark):
    shape = "page_id long, url string, html string, text string, n_chars string"
    page = f"<article>{STORY}</article>"
    rows = spark.createDataFrame([(1, "u", page, "x", "y"), (1, "u", page, "x", "y"), (None, None, None, None, None), (3, "v", "", "", "")], shape)
    got = sorted((tuple(r) for r in main_text.extracted(rows).collect()), key=str)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0), (3, "v", "", 0)], key=str)
    assert main_text.extracted(rows.limit(0)).collect() == []


def test_pipeline_stage_by_stage(spark, sf_dir):
    from .test_jaccard_join import brute

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, steps[-1], sf_dir)
        assert out.columns == columns, name
        steps.append(out.cache())
    ids = [sorted(r["doc_id"] for r in s.select("doc_id").collect()) for s in steps]
    rejected = language_id.judged(docs, language_id.fit(docs), ["doc_id"]).filter("rejected").count()
    assert len(ids[1]) == len(ids[0]) - rejected
    rows = sorted((r["doc_id"], r["text"]) for r in steps[1].select("doc_id", "text").collect())
    expected, _ = brute([t for _, t in rows])
    assert ids[2] == [rows[i][0] for i, (_, root) in expected.items() if root == i]
    assert set(ids[3]) <= set(ids[2])
    texts = {r["doc_id"]: r["text"] for r in steps[3].select("doc_id", "text").collect()}
    last = corpus_pipeline.STAGES[-1][1](spark, steps[3], sf_dir).collect()
    assert sorted(r["doc_id"] for r in last) == ids[3]
    library = Tokenizer.from_file(corpus_pipeline.TOKENIZER)
    for r in last:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
    assert sorted(map(str, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(str, last))


@pytest.mark.parametrize(
    "inside",
    [
        '<div class="ad">Xbuy the best thing now. Only today.</div>',
        '<div class="notice">Xthis was updated. See the terms.</div>',
        "<aside><h2>Xrelated</h2><p>Xside text of some length. Yes it is.</p></aside>",
        "<form><p>Xsubscribe to it. It is good.</p><input></form>",
        '<section id="comments"><h3>Xcomments</h3><div class="comment"><p>Xgood story. I liked it.</p></div></section>',
    ],
)
def test_parts_inside_the_article_go(forest, inside):
    page = f"<body><nav><ul><li><a href=/>Home</a></li></ul></nav><article>{STORY}{inside}</article><footer>&copy; x</footer></body>"
    assert extract(forest, page) == TEXT


def test_places_among_many_siblings_are_their_own():
    nodes = flat(parse("<html><body>" + "".join(f"<p>block {k} here</p>" for k in range(300)) + "</body></html>"))
    parent = max(nodes, key=lambda node: len(node.children))
    assert len(parent.children) >= 300
    rows = {id(node): row for node, row in zip(nodes, features(nodes))}
    last = len(parent.children) - 1
    assert [rows[id(child)][8] for child in parent.children] == pytest.approx([k / last for k in range(last + 1)])
