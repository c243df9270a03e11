"""Main text of web pages by tree scoring.

A page is read once into a flat tree (each element knows its parent and comes
after it) and a list of blocks in page order.  Each paragraph gives points,
one and more for its length and its commas, to its container, half as many to
the container around it, a third to the next, and so on; a container's points are
discounted by the share of its text that stands in links.  The best container
is kept whole, lifted to the ``article`` or ``main`` around it, together with
those of its siblings that score well enough themselves.  Menus, page headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are dropped first, by element, role, or hidden state.  A whole class
that names one of them drops block elements as long as an eighth of the page's
text is left; a word in a longer class, or in an id, only if those with the
word hold less than half of it, or if an article stands elsewhere; forms are
dropped likewise.  Words on inline elements drop nothing (but a share button
that ends a block), and what is dropped inside a line does not split it.

Defined results: a NULL or empty page, and one without text, gives an empty
text; a page cut off inside a tag loses only that tag; unclosed and crossed
tags are closed where a browser would; ``br`` counts as white space.  Pages
are read whole, with no recursion, so depth and length have no limit.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html import unescape

from pyspark.sql import DataFrame

from folioflow.llm.batches import map_columns, pick

# Element names by their part in a page.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {
    "head", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video", "map",
    "nav", "footer", "aside", "menu", "dialog", "button", "select", "option", "textarea", "datalist", "noembed", "noframes", "title",
}
PARAGRAPHS = {"p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "figcaption", "address"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = PARAGRAPHS | HEADINGS | {
    "html", "body", "div", "section", "article", "main", "header", "footer", "nav", "aside", "form", "fieldset", "figure", "ul", "ol", "dl",
    "table", "thead", "tbody", "tfoot", "tr", "caption", "details", "summary", "center", "hgroup", "hr", "menu", "dialog", "legend", "head",
}
KEPT_WHOLE = {"html", "body", "article", "main"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
BAD_WORDS = {
    "ad", "ads", "adv", "advert", "advertisement", "adverts", "advertising", "adsense", "sponsor", "sponsored", "promo", "promoted", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "side", "rail", "widget", "widgets",
    "footer", "foot", "masthead", "topbar", "toolbar", "header",
    "cookie", "cookies", "consent", "gdpr", "notice", "notices", "banner", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "paywall",
    "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "discussion",
    "share", "sharing", "social", "related", "recommended", "recommendations", "outbrain", "taboola", "login", "search",
}
NO_MARKS: frozenset[str] = frozenset()
WHOLE = "="  # before a mark that is a whole class
CONTROL_WORDS = {"share", "sharing", "social"}  # on an inline element that ends a block: a button, no text
NEGATIONS = {"no", "has", "with", "without", "hide", "non"}
GOOD_WORDS = {"article", "content", "entry", "main", "post", "story", "text", "body", "blog"}
CLOSES = {  # an opening tag that ends an open element, up to the boundary
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = {"table", "td", "th", "button", "object", "html", "body"}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Page:
    """A page as a flat tree and its blocks in page order."""

    def __init__(self, html: str) -> None:
        self.tags: list[str] = ["#"]
        self.parents: list[int] = [-1]
        self.bonus: list[float] = [0.0]
        self.soft: list[bool] = [False]  # forms: dropped unless they hold most of the page
        self.marks: list[frozenset[str]] = [NO_MARKS]  # words in a class or id that say it may be no main text
        self.blocks: list[tuple[int, str, int]] = []  # block element, text, characters in links
        self._open: list[int] = [0]
        self._count: Counter[str] = Counter()  # open elements by name
        self._drop = 0  # depth on the stack at which dropping began
        self._links = 0
        self._block = 0
        self._pieces: list[str] = []
        self._link_pieces: list[str] = []
        self._controls: dict[int, int] = {}  # open inline controls, and the pieces before them
        self._cuts: list[tuple[int, int]] = []  # pieces of closed ones
        self._read(html)

    def _read(self, html: str) -> None:
        at = 0
        while True:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                break
            if lt > at:
                self._text(html[at:lt])
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = len(html) if end < 0 else end + 3
                continue
            after = html[lt + 1 : lt + 2]
            if after in ("!", "?") or (after == "/" and not html[lt + 2 : lt + 3].isalpha()):
                end = html.find(">", lt)
                at = len(html) if end < 0 else end + 1
                continue
            if not (after == "/" or (after.isascii() and after.isalpha())):
                self._text("<")
                at = lt + 1
                continue
            m = TAG.match(html, lt) or LOOSE_TAG.match(html, lt)
            if m is None:
                break  # cut off inside a tag
            at = m.end()
            name = m.group(2).lower()
            if m.group(1):
                self._end(name)
                continue
            self._start(name, m.group(3))
            if name in RAW and not m.group(3).endswith("/"):
                end = re.compile(f"</{name}", re.I).search(html, at)
                if end is None:
                    break
                at = end.start()
        self._flush()

    def _text(self, raw: str) -> None:
        if not self._drop:
            self._pieces.append(raw)
            if self._links:
                self._link_pieces.append(raw)

    def _flush(self) -> None:
        for start, end in reversed(self._cuts):
            if any(not piece.isspace() for piece in self._pieces[end:]):
                break
            del self._pieces[start:end]
        self._cuts = []
        self._controls = {}
        if self._pieces:
            text = " ".join(unescape("".join(self._pieces)).split())
            if text:
                links = len(" ".join("".join(self._link_pieces).split())) if self._link_pieces else 0
                self.blocks.append((self._block, text, min(links, len(text))))
            self._pieces = []
            self._link_pieces = []

    def _start(self, name: str, attributes: str) -> None:
        if name in ("br", "wbr", "img"):
            self._text(" " if name != "wbr" else "")
            return
        if name in BLOCKS:
            if not self._drop:  # what is dropped inside a line does not split it
                self._flush()
            self._close_open("p", SCOPES)  # a block ends an open paragraph
            if name in CLOSES:
                ended, bounds = CLOSES[name]
                for tag in ended:
                    self._close_open(tag, bounds)
        if name in VOID:
            return
        node = len(self.tags)
        self.tags.append(name)
        self.parents.append(self._open[-1])
        drop, bonus, marks = judge(name, attributes, lambda: any(self.tags[i] in ("article", "main") for i in self._open))
        self.bonus.append(bonus)
        self.marks.append(marks)
        self.soft.append(name == "form")
        self._open.append(node)
        self._count[name] += 1
        if drop and not self._drop:
            self._drop = len(self._open)
        if name == "a" and not self._drop:
            self._links += 1
        if attributes and name not in BLOCKS and not self._drop and is_control(attributes):
            self._controls[node] = len(self._pieces)
        self._settle()

    def _end(self, name: str) -> None:
        if name == "br":
            self._text(" ")
        elif name not in VOID:
            if name in BLOCKS or name in RAW:
                if name in BLOCKS and not self._drop:
                    self._flush()
                self._close_open(name, {"#"} if name in KEPT_WHOLE or name == "table" else {"html", "body", "table"} - {name})
            else:  # an inline element does not end a block
                self._close_open(name, BLOCKS)

    def _close_open(self, name: str, bounds: set[str]) -> None:
        if not self._count[name]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag == name:
                self._links -= sum(self.tags[i] == "a" for i in self._open[depth:]) if self._links else 0
                self._links = max(0, self._links)
                self._count.subtract(self.tags[i] for i in self._open[depth:])
                self._cuts += [(self._controls.pop(i), len(self._pieces)) for i in self._open[depth:] if i in self._controls]
                del self._open[depth:]
                if self._drop > depth:
                    self._drop = 0
                self._settle()
                return
            if tag in bounds:
                return

    def _settle(self) -> None:
        """The innermost open block element takes the text that follows."""
        for node in reversed(self._open):
            if self.tags[node] in BLOCKS or node == 0:
                self._block = node
                return

    def _bad_marks(self, plain: list[int]) -> frozenset[str]:
        """The marks whose elements are dropped; ``plain``: characters outside links of each element alone.

        A mark on half of the text that is left without the smaller marks is a
        name for the page's layout and drops nothing, unless there is an
        ``article`` or ``main`` of some length elsewhere.  A whole class says
        more: it drops as long as an eighth of the text is left.
        """
        n = len(self.tags)
        around = [NO_MARKS] * n  # marks of an element and of those around it
        article = [0] * n  # the innermost article or main, itself or around
        outer: dict[str, list[int]] = {}
        for node in range(1, n):
            up = self.parents[node]
            around[node] = around[up] | self.marks[node] if self.marks[node] else around[up]
            article[node] = node if self.tags[node] in ("article", "main") else article[up]
            for mark in self.marks[node] - around[up]:
                outer.setdefault(mark, []).append(node)
        bad: set[str] = set()

        def left() -> list[int]:
            """Characters in each element without those under bad marks."""
            out = [c if bad.isdisjoint(m) else 0 for c, m in zip(plain, around)]
            for node in range(n - 1, 0, -1):
                out[self.parents[node]] += out[node]
            return out

        chars = left()
        for mark in sorted(outer, key=lambda m, size=chars: (sum(size[i] for i in outer[m]), m)):
            held = sum(chars[i] for i in outer[mark])
            holding = {0}  # articles around elements with the mark
            for node in outer[mark]:
                at = article[node]
                while at not in holding:
                    holding.add(at)
                    at = article[self.parents[at]]
            elsewhere = any(i not in holding and mark not in around[i] and chars[i] * 10 >= held for i in set(article))
            enough = held * 8 <= chars[0] * 7 if mark.startswith(WHOLE) else held * 2 < chars[0]
            if enough or not held or elsewhere:
                bad.add(mark)
                chars = left()
        return frozenset(bad)

    def main_text(self) -> str:
        """The blocks of the best container and of its good siblings, one a line."""
        n = len(self.tags)
        points = [0.0] * n
        own = [0] * n
        links = [0] * n
        for node, text, linked in self.blocks:
            own[node] += len(text)
            links[node] += linked
            if self.tags[node] in HEADINGS:
                continue
            gives = (1 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
            to = self.parents[node] if self.tags[node] in PARAGRAPHS and node else node
            share = 1
            while to >= 0 and share <= 5:
                points[to] += gives / share
                to = self.parents[to]
                share += 1
        total = own[:]
        linked_in = links[:]
        for node in range(n - 1, 0, -1):
            total[self.parents[node]] += total[node]
            linked_in[self.parents[node]] += linked_in[node]
        if not total[0]:
            return ""
        bad = self._bad_marks([t - k for t, k in zip(own, links)]) if any(self.marks) else NO_MARKS
        gone = [False] * n
        for node in range(1, n):
            gone[node] = gone[self.parents[node]] or not bad.isdisjoint(self.marks[node]) or (self.soft[node] and total[node] * 2 < total[0])
        score = [
            (points[i] + self.bonus[i] * (total[i] > 0)) * (1 - linked_in[i] / max(1, total[i])) if not gone[i] else -1.0 for i in range(n)
        ]
        best = max(range(n), key=lambda i: (score[i], -i))
        if score[best] <= 0:
            best = 0
        top = best
        chain = best
        while chain > 0:
            if self.tags[chain] in ("article", "main"):
                top = chain
                if self.tags[chain] == "article":
                    break
            chain = self.parents[chain]
        taken = [False] * n
        taken[top] = True
        least = max(10.0, 0.2 * score[best])
        for node in range(1, n):
            if node != top and self.parents[node] == self.parents[top] and not gone[node] and total[node]:
                density = linked_in[node] / total[node]
                good = score[node] >= least
                if self.tags[node] in PARAGRAPHS:
                    good = good or (density < 0.25 and total[node] > 80)
                elif self.tags[node] in HEADINGS:
                    good = good or (density < 0.25 and node < top)
                taken[node] = good
        for node in range(1, n):
            taken[node] = (taken[node] or taken[self.parents[node]]) and not gone[node]
        return "\n".join(text for node, text, _ in self.blocks if taken[node])


def judge(name: str, attributes: str, inside: Callable[[], bool]) -> tuple[bool, float, frozenset[str]]:
    """Whether an element is dropped by its kind, points that its kind gives it, and words that may drop it."""
    if name in DROPPED:
        return True, 0.0, NO_MARKS
    if name == "header" and not inside():
        return True, 0.0, NO_MARKS
    marks = NO_MARKS
    bonus = 25.0 if name in ("article", "main") else 0.0
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False, bonus, NO_MARKS
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "hidden":
            if name not in KEPT_WHOLE:
                return True, 0.0, NO_MARKS
        elif key == "role":
            if value.lower() in ROLES and name not in KEPT_WHOLE:
                return True, 0.0, NO_MARKS
            bonus += 25.0 if value.lower() in ("main", "article") else 0.0
        elif key in ("class", "id") and name in BLOCKS:  # a word on an inline element says nothing of the text in its line
            for whole in value.split():
                words = [w.lower() for w in WORD.findall(whole)]
                found = frozenset(w for k, w in enumerate(words) if w in BAD_WORDS and not (k and words[k - 1] in NEGATIONS))
                if found:
                    if name in KEPT_WHOLE or (name in ("header", *HEADINGS) and inside()):
                        continue
                    # a whole class says what the element is; else it may be a name for a layout
                    marks |= {WHOLE + w for w in found} if key == "class" and whole.lower() in BAD_WORDS else found
                    continue
                if any(w in GOOD_WORDS for w in words):
                    bonus += 5.0
        elif key == "style" and name not in KEPT_WHOLE and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, 0.0, NO_MARKS
        elif key == "aria-hidden" and value.lower() == "true" and name not in KEPT_WHOLE:
            return True, 0.0, NO_MARKS
    return False, bonus, marks


def is_control(attributes: str) -> bool:
    """Whether a class of an inline element names a control such as a share button."""
    classes = " ".join(a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes) if key.lower() == "class")
    return not CONTROL_WORDS.isdisjoint(w.lower() for w in WORD.findall(classes))


def extract(html: str | None) -> str:
    """The main text of one page."""
    return Page(html).main_text() if html else ""


SCHEMA = {"page_id": "long", "url": "string", "text": "string", "n_chars": "long"}


def extract_text(pages: DataFrame) -> DataFrame:
    """The main text of each row of ``pages`` (``page_id``, ``url``, ``html``)."""

    def start():
        def work(cols):
            texts = [extract(h) for h in cols["html"]]
            return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

        return work

    return map_columns(pick(pages, page_id="long", url="string", html="string"), SCHEMA, start)
