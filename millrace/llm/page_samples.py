"""Pages with known main text, made from a seed, to learn extraction from.

Layouts, element names, class names and the order of parts vary; some pages name their parts and others have bare
containers. Main text is marked by MARK, which is taken out when the page is read.
"""

from __future__ import annotations

import random

MARK = "\x01"
_SYLLABLES = "an ba ce do er fi ga ho in ka lo mi na or pe ra si ta un ve wo za the and of to que le ein der los".split()
_CONTENT = ["", "content", "article-body", "post", "entry-content", "story", "main-content", "text", "css-1a2b", "c1", "page-body"]
_NAV = ["nav", "menu", "navbar", "main-nav", "breadcrumb", "pagination", "", "css-9x"]
_HEAD = ["header", "masthead", "site-header", "top-bar", "branding", ""]
_FOOT = ["footer", "site-footer", "bottom", "copyright", "legal", ""]
_SIDE = ["sidebar", "side", "widget", "related", "rail", "trending", "more-stories"]
_AD = ["ad", "ads", "advert", "sponsored", "promo", "ad-slot", "banner-ad"]
_NOTICE = ["cookie-notice", "notice", "alert", "consent", "popup", "gdpr", "message"]
_COMMENT = ["comments", "comment-list", "replies", "discussion", "reader-comments", "respond"]
_FORM = ["search", "newsletter", "login", "subscribe", "contact-form", ""]
_SHARE = ["share", "social", "tags", "follow-us"]


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(2, 18).capitalize() + self.r.choice("....!?") for _ in range(self.r.randint(low, high)))

    def attributes(self, names: list[str], bare: float = 0.0) -> str:
        name = self.r.choice(names)
        if not name or self.r.random() < bare:
            return ""
        return f' {self.r.choice(["class", "class", "id"])}="{name}"'

    def element(self, tags: list[str], names: list[str], inside: str, bare: float = 0.0) -> str:
        tag = self.r.choice(tags)
        if tag in ("nav", "header", "footer", "aside") and self.r.random() < 0.6:
            bare = 1.0
        return f"<{tag}{self.attributes(names, bare)}>{inside}</{tag}>"

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 4)}{self.r.choice(["", "", "", ".", ","])}</a>' for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", "", "<br>"]).join(items)

    def boiler(self) -> dict[str, str]:
        r = self.r
        comment = "".join(f"<div{self.attributes(['comment', 'reply', ''])}><p>{self.sentences(1, 5)}</p></div>" for _ in range(r.randint(1, 5)))
        return {
            "nav": self.element(["nav", "nav", "div"], _NAV, self.links(3, 9)),
            "header": self.element(["header", "div"], _HEAD[:-1], r.choice([self.words(1, 4), f"<h1>{self.words(1, 4)}</h1>", f'<a href="/">{self.word()}</a>{self.links(2, 5)}', f"<p>{self.sentences(1, 2)}</p>"])),
            "footer": self.element(["footer", "footer", "div"], _FOOT[:-1], r.choice([f"&copy; {self.words(1, 3)}", f"&copy; {self.word()}.{self.word()}.example &middot; {self.sentences(1, 2)}", self.links(3, 6), f"<p>{self.sentences(1, 3)}</p>"])),
            "side": self.element(["aside", "div", "section"], _SIDE, f"<h3>{self.words(1, 3)}</h3>" + r.choice([self.links(3, 8), f"<p>{self.sentences(1, 3)}</p>"])),
            "ad": self.element(["div", "div", "aside", "p", "section"], _AD, r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 2)}</p>", f'<a href="/x">{self.words(2, 8)}</a>'])),
            "notice": self.element(["div", "section", "p"], _NOTICE, r.choice([self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p><button>{self.word()}</button>"])),
            "comments": self.element(["section", "div"], _COMMENT, f"<h2>{self.words(1, 2)}</h2>{comment}"),
            "form": f"<form{self.attributes(_FORM)}><label>{self.words(1, 4)}</label><input name=x><button>{self.word()}</button>{r.choice(['', f'<p>{self.sentences(1, 2)}</p>'])}</form>",
            "share": self.element(["div", "ul"], _SHARE, self.links(2, 5)),
        }

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{MARK}{self.words(2, 10)}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.choice([1, 2, 3, 4, 6, 9, 15])):
            kind = r.random()
            if kind < 0.75:
                close = "</p>" if r.random() < 0.85 else ""
                text = MARK + r.choice([self.sentences(1, 8), self.sentences(1, 8), self.words(1, 4).capitalize() + "."])
                if r.random() < 0.15:
                    text += f' <a href="/y">{self.words(1, 3)}</a> ' + self.words(1, 4)
                if r.random() < 0.15:
                    text = f"<b>{text}<br>"
                parts.append(f"<p>{text}{close}")
            elif kind < 0.77:
                parts.append(f'<p><a href="/z">{MARK}{self.words(3, 9)}</a></p>')
            elif kind < 0.83:
                parts.append(f"<h{r.choice('23')}>{MARK}{self.words(1, 6)}</h2>".replace("</h2>", "</h2></h3>"))
            elif kind < 0.9:
                parts.append("<ul>" + "".join(f"<li>{MARK}{r.choice([self.words(1, 8), self.sentences(1, 2)])}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.95:
                parts.append(f"<blockquote>{MARK}{self.sentences(1, 3)}</blockquote>")
            else:
                parts.append(f"<div>{MARK}{self.sentences(1, 4)}</div>")
        own = self.boiler()
        for name in ("ad", "share", "form", "side", "notice"):
            if r.random() < 0.15:
                parts.insert(r.randint(0, len(parts)), own[name])
        if r.random() < 0.1:
            parts.append(own["comments"])
        inside = "".join(parts)
        if r.random() < 0.25:
            inside = f"<div>{inside}</div>"
        shape = r.random()
        if shape < 0.4:
            return f"<article{self.attributes(_CONTENT, 0.7)}>{inside}</article>"
        if shape < 0.6:
            return f"<main{self.attributes(_CONTENT, 0.6)}>{inside}</main>"
        return self.element(["div", "div", "section", "td"], _CONTENT, inside)

    def page(self) -> str:
        r = self.r
        before, after = [], []
        for name, text in self.boiler().items():
            if r.random() < (0.6 if name in ("nav", "footer", "ad") else 0.3):
                early = {"nav": 0.9, "header": 1.0, "footer": 0.0, "comments": 0.0, "ad": 0.6, "side": 0.4, "notice": 0.7}.get(name, 0.5)
                (before if r.random() < early else after).append(text)
        r.shuffle(before), r.shuffle(after)
        if r.random() < 0.5:
            after = [x for x in after if "<footer" not in x] + [x for x in after if "<footer" in x]
        body = "".join(before) + (self.article() if r.random() < 0.97 else "") + "".join(after)
        for _ in range(r.choice([0, 0, 1, 2])):
            body = f"<div{self.attributes(['', 'wrap', 'container', 'page', 'site'])}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 5)}</title></head><body>{body}</body></html>"
