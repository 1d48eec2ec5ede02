"""A small tree of the block-level elements and text blocks of an HTML page, with features of each."""

from __future__ import annotations

import html
import re
from collections import Counter
from math import log1p

# Element names of HTML by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea select title head".split())
#: Of these a page that ends within one has nothing more to say; other unclosed ones go on after their start tag.
TO_THE_END = frozenset("script style".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q ruby rp rt s samp small span strike strong "
    "sub sup time tt u var wbr br button input nobr picture progress "
    "noscript iframe object embed canvas audio video map slot "
    "math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mspace mstyle mpadded semantics annotation "
    "svg g path rect circle ellipse line polygon polyline text tspan defs use symbol".split()
)
#: Elements that end open ones of the kinds named when they begin.
CLOSES = {
    "li": {"li", "p"},
    "dt": {"dt", "dd", "p"},
    "dd": {"dt", "dd", "p"},
    "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"},
    "th": {"td", "th", "p"},
}
#: What an element of CLOSES doesn't reach beyond.
SCOPE = frozenset("ul ol dl table body article section div".split())
GROUPS = [
    "p blockquote pre",
    "h1 h2 h3 h4 h5 h6",
    "li ul ol dl dd dt menu",
    "table tbody thead tr td th",
    "div section center body html",
    "article main",
    "nav",
    "header hgroup",
    "footer address",
    "aside",
    "form fieldset legend dialog",
    "figure figcaption details summary",
]
#: Words of class, id and role by what they tell.
TOKENS = [
    "article content main post body entry story text page blog",
    "nav menu navbar navigation breadcrumb breadcrumbs tabs toc pagination pager links",
    "header masthead head top banner logo branding",
    "footer foot bottom copyright legal contentinfo",
    "sidebar side aside rail widget widgets complementary related recommended trending popular more",
    "ad ads advert advertisement advertisment sponsor sponsored promo promotion promoted adsense dfp",
    "notice cookie cookies consent gdpr alert message popup modal overlay warning privacy banner",
    "comment comments reply replies discussion respond disqus reader feedback thread",
    "form search login signup subscribe newsletter register contact input",
    "share social sharing twitter facebook follow tags meta byline author",
]
_GROUP = {tag: g for g, tags in enumerate(GROUPS) for tag in tags.split()}
_TOKEN = {}
for _g, _names in enumerate(TOKENS):
    for _name in _names.split():
        _TOKEN[_name] = _TOKEN.get(_name, 0) | 1 << _g
_SEMANTIC = range(5, 11)
#: Groups and tokens of what isn't main text: menus, headers, footers, asides, forms; adverts, notices, comments and the like.
OTHER_GROUPS = frozenset((6, 7, 8, 9, 10))
OTHER_TOKENS = sum(1 << t for t in (1, 4, 5, 6, 7, 8, 9))

_NAME = re.compile(r"</?([a-zA-Z][^\s/<>]*)")
_STOP = re.compile("[>\"']")
_NAMED = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"\shidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_END = re.compile(r"[.!?,;:…](?=\s|$)")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    """A block-level element, or (tag "") a block of text."""

    __slots__ = ("tag", "group", "own", "parent", "children", "depth", "text", "words", "linked", "ends", "blocks", "elements", "inputs", "start", "hidden")

    def __init__(self, tag: str, parent: Node | None, tokens: int = 0):
        self.tag, self.parent, self.own = tag, parent, tokens
        self.group = _GROUP.get(tag, 4) if tag else (parent.group if parent else 4)
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node] = []
        self.text = ""
        self.words = self.linked = self.ends = self.blocks = self.elements = self.inputs = self.start = 0
        self.hidden = False
        if parent:
            parent.children.append(self)


def _tokens(attributes: str) -> int:
    if "=" not in attributes:
        return 0
    out = 0
    for m in _NAMED.finditer(attributes):
        for part in _PART.findall(_CAMEL.sub(" ", m[1] or m[2] or m[3] or "").lower()):
            out |= _TOKEN.get(part, 0)
    return out


class _Tags:
    """Where the tags of a page end; each part of the page is looked at once, however many tags never end."""

    def __init__(self, page: str):
        self.page = page
        self.barren = len(page) + 1  # from here on there is neither a quote nor a >
        self.lone: dict[str, int] = {}  # from here on the quote has no partner
        self.dead: set[int] = set()  # quotes after which no tag ends

    def end(self, at: int) -> int:
        """The place after the > that ends the tag whose name ends at at, or -1. Quoted parts don't count; a quote without a partner is a sign like others."""
        seen: list[int] = []
        while at < self.barren:
            stop = _STOP.search(self.page, at)
            if stop is None:
                self.barren = at
                break
            k, sign = stop.start(), stop[0]
            if sign == ">":
                return k + 1
            if k in self.dead:
                break
            seen.append(k)
            close = self.page.find(sign, k + 1) if k < self.lone.get(sign, len(self.page)) else -1
            if close < 0:
                self.lone[sign] = min(k, self.lone.get(sign, k))
            at = (close if close >= 0 else k) + 1
        self.dead.update(seen)
        return -1


def parse(page: str) -> Node:
    """The tree of a page; elements without text are left out. Blocks are in page order."""
    root = Node("html", None)
    here, stack = root, [root]
    pieces: list[str] = []
    link_words = [0]
    in_link = 0

    def flush() -> None:
        if pieces:
            # A reference may be cut in pieces by markup, so each piece is decoded on its own.
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            pieces.clear()
            if text:
                block = Node("", here)
                block.text, block.words, block.blocks = text, text.count(" ") + 1, 1
                block.linked = min(link_words[0], block.words)
                block.ends = len(_END.findall(text))
            link_words[0] = 0

    def say(text: str) -> None:
        if text:
            text = html.unescape(text)
            pieces.append(text)
            if in_link:
                link_words[0] += len(text.split())

    at, end = 0, len(page)
    tags, unclosed, open_ = _Tags(page), set(), Counter()

    def cut(k: int) -> None:
        """Elements from the k-th on end."""
        for node in stack[k:]:
            open_[node.tag] -= 1
        del stack[k:]

    while at < end:
        less = page.find("<", at)
        if less < 0:
            say(page[at:])
            break
        say(page[at:less])
        if page.startswith("<!--", less):
            close = page.find("-->", less + 4)
            at = close + 3 if close >= 0 else end
            continue
        if page.startswith("<![CDATA[", less):
            close = page.find("]]>", less)
            say(page[less + 9 : close if close >= 0 else end])
            at = close + 3 if close >= 0 else end
            continue
        if page.startswith(("<!", "<?"), less):
            close = page.find(">", less)
            at = close + 1 if close >= 0 else end
            continue
        m = _NAME.match(page, less)
        at = tags.end(m.end()) if m else -1
        if at < 0:  # no tag
            say("<")
            at = less + 1
            continue
        name = m[1].lower()
        if page[less + 1] == "/":
            if name in INLINE:
                if name == "a" and in_link:
                    in_link -= 1
            elif open_[name]:
                flush()
                k = len(stack) - 1
                while stack[k].tag != name:
                    k -= 1
                cut(k)
                here, in_link = stack[-1], 0
            elif name == "p":
                flush()
            continue
        attributes = page[m.end() : at - 1]
        if name in RAW and not attributes.endswith("/"):
            close = None if name in unclosed else re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if close is None:
                # It isn't looked for again.
                unclosed.add(name)
                if name in TO_THE_END:
                    break
            else:
                at = close.end()
            if name in ("select", "textarea"):
                here.inputs += 1
            continue
        if name in INLINE or name in VOID:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                in_link += 1
            elif name in ("input", "button"):
                here.inputs += 1
            elif name == "hr":
                flush()
            continue
        if name in ("html", "body"):
            continue
        flush()
        in_link = 0
        closes = CLOSES.get(name, {"p"})
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in closes:
                cut(k)
            elif stack[k].tag in SCOPE or name not in CLOSES:
                break
        node = Node(name, stack[-1], _tokens(attributes))
        node.hidden = bool(_HIDDEN.search(attributes)) if attributes else False
        stack.append(node)
        open_[name] += 1
        here = node
    flush()
    _sum(root)
    return root


def _sum(root: Node) -> None:
    """Totals of each subtree; children without text go."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.children
    for node in reversed(order):
        if node.tag:
            inputs = sum(c.inputs for c in node.children)
            node.children = [c for c in node.children if c.words]
            for c in node.children:
                node.words += c.words
                node.linked += c.linked
                node.ends += c.ends
                node.blocks += c.blocks
                node.elements += c.elements
            node.elements += 1
            node.inputs += inputs
    start, todo = 0, [root]
    while todo:
        node = todo.pop()
        node.start = start
        if not node.tag:
            start += node.words
        todo += reversed(node.children)


def flat(root: Node) -> list[Node]:
    """All nodes, parents before children, in page order."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    return out


#: Numbers of a node before its flags: own group, own tokens, groups and tokens of those above.
MEASURES = 17
FEATURES = MEASURES + len(GROUPS) + len(TOKENS) + len(_SEMANTIC) + len(TOKENS)


def features(nodes: list[Node]) -> list[list[float]]:
    """A row for each of the nodes of one page, as flat() gives them."""
    total = max(1, nodes[0].words)
    above: dict[int, tuple[int, int]] = {}
    places = {id(child): k for node in nodes for k, child in enumerate(node.children)}
    rows = []
    for node in nodes:
        parent = node.parent
        groups, tokens = above[id(parent)] if parent else (0, 0)
        above[id(node)] = (groups | 1 << node.group, tokens | node.own)
        siblings = parent.children if parent else [node]
        n, words = len(siblings), node.words
        others = (parent.words - words) / max(1, n - 1) if parent else 0.0
        place = places.get(id(node), 0)
        row = [
            0.0 if node.tag else 1.0,
            log1p(words),
            node.linked / words if words else 0.0,
            words / max(1, node.blocks),
            log1p(node.blocks),
            node.elements / (words + 1),
            node.ends / max(1, words),
            float(node.depth),
            place / max(1, n - 1),
            log1p(n),
            log1p(others),
            words / total,
            node.start / total,
            float(min(node.inputs, 5)),
            (parent.linked / parent.words) if parent and parent.words else 0.0,
            parent.words / total if parent else 1.0,
            float(node.hidden or bool(parent and parent.hidden)),
        ]
        row += [1.0 if node.group == g else 0.0 for g in range(len(GROUPS))]
        own = node.own if node.tag else (parent.own if parent else 0)
        row += [float(own >> t & 1) for t in range(len(TOKENS))]
        row += [float(groups >> g & 1) for g in _SEMANTIC]
        row += [float(tokens >> t & 1) for t in range(len(TOKENS))]
        rows.append(row)
    return rows
