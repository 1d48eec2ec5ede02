"""Main text of HTML pages by gradient-boosted trees over DOM nodes, decoded along the hierarchy.

Every block-level element and every block of text of a page is a node with features: density of text, links and
punctuation in its subtree, depth, siblings, place in the page, kind of element, and words of class, id and role, its own and
those above. Boosted trees give the chance that a node holds main text. Decoding takes the most likely labelling of the whole
tree in which nothing below a node without main text has any, and each node with main text has a child with some, so
that ancestors and descendants never contradict each other. Blocks labelled as main text are the result.

The trees learn from pages made from a seed (SYNTHETIC of them) with known main text, of many layouts, and from a sample of
the given pages, SAMPLE of them as expected, chosen by a hash of page_id: those with one article or main element. There, what lies in it counts as
main text, but for parts that call themselves something else.

Rows: a null page counts as empty; pages without main text give an empty text. Malformed markup is read as far as it
goes: open elements end with their parent, an unclosed comment or script with the page. Script, style and head never count as text. A line
break inside a block is white space. Repeated rows give repeated results, an empty table an empty one. Only page_id, url and html are
read. Equal chances go to no main text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import by_text
from .page_samples import MARK, Writer
from .page_tree import OTHER_GROUPS, OTHER_TOKENS, Node, features, flat, parse

#: Pages learned from, trees, their depth, bins of a feature, share of each tree's step, smoothing of leaves.
SYNTHETIC, TREES, LEVELS, BINS, STEP, SMOOTH = 1000, 60, 5, 32, 0.3, 1.0
#: Given pages learned from.
SAMPLE = 200
#: Pages whose nodes are judged at a time.
PAGES = 200
SCHEMA = "page_id long, url string, text string, n_chars long"


@dataclass
class Forest:
    start: float
    feature: np.ndarray  # tree x inner node
    cut: np.ndarray  # tree x inner node: up to it goes left
    value: np.ndarray  # tree x leaf

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(rows), np.int64)
            for _ in range(LEVELS):
                at = 2 * at + 1 + (rows[every, feature[at]] > cut[at])
            out += value[at - len(feature)]
        return out


def boosted(rows: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Forest:
    """Trees of logistic loss, grown level by level over binned features."""
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, rows.T)], axis=1)
    width = rows.shape[1]
    cell = binned + np.arange(width) * BINS
    mean = np.average(label, weights=weight)
    start = float(np.log(mean / (1 - mean)))
    score = np.full(len(rows), start)
    inner = (1 << LEVELS) - 1
    forest = Forest(start, np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1)))
    for t in range(TREES):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = weight * (label - chance), weight * chance * (1 - chance)
        at = np.zeros(len(rows), np.int64)
        for level in range(LEVELS):
            nodes = 1 << level
            place = ((at - (nodes - 1))[:, None] * (width * BINS) + cell).ravel()
            g, h = (np.bincount(place, np.repeat(x, width), nodes * width * BINS).reshape(nodes, width, BINS).cumsum(axis=2) for x in (slope, bend))
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + SMOOTH) + (all_g - g) ** 2 / (all_h - h + SMOOTH)
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for k, b in enumerate(best.tolist()):
                f, c = divmod(b, BINS)
                forest.feature[t, nodes - 1 + k] = f
                forest.cut[t, nodes - 1 + k] = cuts[f][c] if c < len(cuts[f]) else np.inf
            at = 2 * at + 1 + (rows[np.arange(len(rows)), forest.feature[t, at]] > forest.cut[t, at])
        leaf = at - inner
        forest.value[t] = STEP * np.bincount(leaf, slope, inner + 1) / (np.bincount(leaf, bend, inner + 1) + SMOOTH)
        score += forest.value[t, leaf]
    return forest


def _labelled(nodes: list[Node], main: set[int]) -> tuple[list[list[float]], list[float], list[float]]:
    """Features, labels and weights of a page's nodes, given its blocks of main text; each page weighs about the same."""
    main = set(main)
    for n in reversed(nodes):
        if id(n) in main and n.parent:
            main.add(id(n.parent))
    return features(nodes), [float(id(n) in main) for n in nodes], [len(nodes) ** -0.5] * len(nodes)


def named_main(nodes: list[Node]) -> set[int] | None:
    """Blocks inside a page's one article or main element, but for parts of another kind; None if there isn't one."""
    for kind in ("article", "main"):
        inside = [n for n in nodes if n.tag == kind]
        if len(inside) == 1:
            out, todo = set(), [inside[0]]
            while todo:
                node = todo.pop()
                if node.group in OTHER_GROUPS or node.own & OTHER_TOKENS and node.tag != kind:
                    continue
                if not node.tag:
                    out.add(id(node))
                todo += node.children
            return out
    return None


def learned(sample: list[str], synthetic: int = SYNTHETIC, seed: int = 7) -> Forest:
    """Trees from made pages and the given ones."""
    parts = []
    for k in range(synthetic):
        nodes = flat(parse(Writer(seed * 1_000_003 + k).page()))
        parts.append(_labelled(nodes, {id(n) for n in nodes if MARK in n.text}))
    for page in sample:
        nodes = flat(parse(page))
        if (main := named_main(nodes)) is not None:
            parts.append(_labelled(nodes, main))
    rows, labels, weights = (np.array([x for p in parts for x in p[k]]) for k in range(3))
    return boosted(rows, labels, weights / weights.mean())


def chosen(nodes: list[Node], odds: list[float]) -> list[str]:
    """Texts of the blocks that the most likely consistent labelling of the tree gives to the main text."""
    # Log likelihood of a subtree without main text is 0 by definition; yes[n] is the best with some, relative to it.
    yes: dict[int, float] = {}
    for node, odd in zip(reversed(nodes), reversed(odds)):
        if node.tag:
            gains = [yes[id(c)] for c in node.children]
            odd += sum(g for g in gains if g > 0) if any(g > 0 for g in gains) else max(gains, default=-np.inf)
        yes[id(node)] = odd
    out, todo = [], [nodes[0]] if yes[id(nodes[0])] > 0 else []
    while todo:
        node = todo.pop()
        if not node.tag:
            out.append(node.text)
            continue
        taken = [c for c in node.children if yes[id(c)] > 0] or [max(node.children, key=lambda c: yes[id(c)])]
        todo += reversed(taken)
    return out


def extracted(pages: DataFrame, html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    n = pages.count()
    place = F.pmod(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit(""))), F.lit(1 << 30)) / (1 << 30)
    sample = pages.filter((place < SAMPLE / max(1, n)) & F.col(html).isNotNull()).select(html).collect()
    forest = learned(sorted(r[0] for r in sample))

    def work(rows: pa.Table) -> pa.Table:
        texts: list[str] = []
        column = rows[html]
        for k in range(0, rows.num_rows, PAGES):
            trees = [flat(parse(page.as_py() or "")) for page in column[k : k + PAGES]]
            odds = forest.scores(np.array([row for nodes in trees for row in features(nodes)])).tolist()
            at = 0
            for nodes in trees:
                texts.append("\n".join(chosen(nodes, odds[at : at + len(nodes)])))
                at += len(nodes)
        return pa.table({"page_id": rows["page_id"], "url": rows["url"], "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    return by_text(pages, ["page_id", "url", html], SCHEMA, work)
