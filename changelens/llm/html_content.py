"""Main text of web pages by a tree-structured graphical model.

A page's block elements form a tree; each has a hidden label, content or not.
The model is p(root) times p(label | parent's label, kind of element) times
p(evidence | label) for a few observations of each node: its element, hints in
its class, id and role, the length, link share and punctuation of its own
text.  Sum-product message passing, once upward and once downward, gives the
exact marginal of every node, and the text of nodes that are more likely
content than not is the page's main text, in page order.

The tables are counted with add-one smoothing from labelled pages.  The
labelled pages of ``labelled_pages`` are ``PAGES`` layouts made by rule, whose
elements carry ``data-main`` labels (the article's parts 1, all boilerplate 0);
any other labelled pages can be given instead.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelens.llm.bpe import chunks
from changelens.llm.common import table
from changelens.session import prepare_python

PAGES = 400
SEED = 11

#: Fixed values of HTML: elements without content, elements whose text is
#: never shown, elements inside a line, and which open elements a tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style noscript template title svg math iframe object canvas audio video textarea select button datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "tbody": ("tbody", "thead", "tfoot"), "tfoot": ("tbody", "thead")}
SCOPE = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)), "tr": frozenset(("table",)),
         "td": frozenset(("table", "tr")), "th": frozenset(("table", "tr")), "tbody": frozenset(("table",)), "tfoot": frozenset(("table",))}
STOPS = frozenset(".!?…:;\"'”)")
IN_HEAD = frozenset("title meta link script style base noscript template bgsound".split())
P_SCOPE = frozenset("button table td th caption object".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

#: Words of class, id and role attributes that the model looks at.
HINTS = {
    "article": "content", "content": "content", "post": "content", "entry": "content", "story": "content", "main": "content", "body": "content", "text": "content", "prose": "content",
    "nav": "menu", "navbar": "menu", "navigation": "menu", "menu": "menu", "breadcrumb": "menu", "breadcrumbs": "menu", "pagination": "menu", "pager": "menu", "toc": "menu", "skip": "menu", "toolbar": "menu", "tabs": "menu",
    "header": "header", "masthead": "header", "banner": "header", "topbar": "header", "logo": "header",
    "footer": "footer", "copyright": "footer", "legal": "footer", "colophon": "footer", "contentinfo": "footer",
    "sidebar": "side", "aside": "side", "complementary": "side", "widget": "side", "rail": "side", "related": "side", "recommended": "side", "recommendations": "side", "trending": "side", "popular": "side", "more": "side", "teaser": "side",
    "ad": "advert", "ads": "advert", "advert": "advert", "adverts": "advert", "advertisement": "advert", "sponsor": "advert", "sponsored": "advert", "promo": "advert", "promotion": "advert", "adsense": "advert", "adslot": "advert",
    "cookie": "notice", "cookies": "notice", "consent": "notice", "gdpr": "notice", "notice": "notice", "alert": "notice", "popup": "notice", "modal": "notice", "overlay": "notice", "dialog": "notice", "announcement": "notice", "notification": "notice", "paywall": "notice", "disclaimer": "notice", "warning": "notice", "privacy": "notice",
    "comment": "comment", "comments": "comment", "commentlist": "comment", "disqus": "comment", "reply": "comment", "replies": "comment", "respond": "comment", "discussion": "comment", "reviews": "comment",
    "form": "form", "search": "form", "login": "form", "signup": "form", "newsletter": "form", "subscribe": "form", "subscription": "form", "register": "form", "contact": "form",
    "share": "share", "sharing": "share", "social": "share", "follow": "share", "tags": "share",
    "hidden": "hidden",
}


class Node:
    __slots__ = ("children", "features", "hidden", "kind", "label", "links", "parent", "stops", "tag", "words")

    def __init__(self, tag: str, parent: Node | None, attrs: dict[str, str | None]) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.words, self.links, self.stops = 0, 0, False
        self.hidden = tag in HIDDEN or "hidden" in attrs or bool(re.search(r"display\s*:\s*none", attrs.get("style") or ""))
        self.hidden = self.hidden or attrs.get("aria-hidden") == "true" or bool(parent and parent.hidden)
        mark = attrs.get("data-main")
        self.label = int(mark) if mark in ("0", "1") else parent.label if parent else 0
        named = " ".join(attrs.get(k) or "" for k in ("class", "id", "role"))
        self.features = ["tag:" + (tag if tag not in HEADINGS else "h")]
        if named.strip():
            camel = re.sub(r"(?<=[a-z])(?=[A-Z])", " ", named).lower()
            self.features += sorted({"hint:" + HINTS[x] for x in re.split("[^a-z]+", camel) if x in HINTS})
        hints = [f for f in self.features if f.startswith("hint:")]
        self.kind = hints[0] if hints else self.features[0]


class Page(HTMLParser):
    """Builds the tree of block elements and the page's pieces of text, (node, text), in order."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", None, {})
        self.nodes = [self.root]
        self.open: list[tuple[str, Node]] = [("html", self.root)]  # every open element and its block
        self.count: Counter[str] = Counter()  # open elements by tag
        self.pieces: list[tuple[Node, list[str]]] = []
        self.fresh = True  # whether the next text starts a new piece
        self.feed(html)
        self.close()
        for node in self.nodes:
            node.features += observations(node)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find(">", i)  # such a section is a comment in HTML
        return end + 1 if end >= 0 else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        given = dict(attrs)
        if tag == "html":
            self.root.label = int(given.get("data-main") == "1")
            return
        if self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._end("head")
        if tag in CLOSES_P:
            self._end("p", P_SCOPE)
        for old in SIBLINGS.get(tag, ()):
            self._end(old, SCOPE[tag])
        if tag in HEADINGS and self.open[-1][0] in HEADINGS:
            self._end(self.open[-1][0])
        if tag in VOID:
            if tag == "br":
                self._text(" ")
            self.fresh |= tag == "hr"
            return
        block = self.open[-1][1]
        if tag not in INLINE or "hidden" in given:
            block = Node(tag, block, given)
            block.parent.children.append(block)
            self.nodes.append(block)
            self.fresh |= tag not in INLINE
        self.open.append((tag, block))
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash but in void elements

    def _end(self, tag: str, stop: frozenset[str] = frozenset(), inline: bool = False) -> None:
        """Close the innermost open ``tag`` and all inside it, unless an element of ``stop`` (for an inline
        element: any block) is in between."""
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            name = self.open[at][0]
            if name == tag:
                for gone, _ in self.open[at:]:
                    self.count[gone] -= 1
                    self.fresh |= gone not in INLINE
                del self.open[at:]
                return
            if name in stop or inline and name not in INLINE:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self._text(" ")
        elif tag in HEADINGS:
            tag = next((t for t, _ in reversed(self.open) if t in HEADINGS), tag)
            self._end(tag)
        elif tag in INLINE:
            self._end(tag, inline=True)
        else:
            self.fresh |= tag == "p"
            self._end(tag, SCOPE.get(tag, frozenset()))

    def handle_data(self, data: str) -> None:
        if self.open[-1][0] == "head" and data.strip():
            self._end("head")
        self._text(data)

    def _text(self, data: str) -> None:
        node = self.open[-1][1]
        if node.hidden:
            return
        if self.fresh or not self.pieces or self.pieces[-1][0] is not node:
            if not data.strip():
                return
            self.pieces.append((node, []))
            self.fresh = False
        self.pieces[-1][1].append(data)
        n = len(data.split())
        node.words += n
        node.links += n * (self.count["a"] > 0)
        node.stops |= bool(n) and data.rstrip()[-1] in STOPS


def observations(node: Node) -> list[str]:
    """What the model sees of a node's own text."""
    frame = [] if node.parent else [f"body:{any(c.tag == 'body' for c in node.children)}"]
    if not node.words:
        return ["own:none", *frame]
    length = min(5, int(math.log2(node.words) / 1.5))
    return [f"own:{length}", f"links:{int(3 * node.links / node.words)}", f"stops:{node.stops}", *frame]


class Model:
    """Tables of log-probabilities, counted from labelled pages."""

    def __init__(self, pages: Iterable[str]) -> None:
        pair: dict[tuple[str, int, int], float] = defaultdict(lambda: 1.0)
        seen: dict[tuple[str, int], float] = defaultdict(lambda: 1.0)
        total, roots = [2.0, 2.0], [1.0, 1.0]
        kinds, features = set(), set()
        for html in pages:
            for n in Page(html).nodes:
                total[n.label] += 1
                features.update(n.features)
                for f in n.features:
                    seen[f, n.label] += 1
                if not n.parent:
                    roots[n.label] += 1
                else:
                    for kind in (n.kind, "any"):
                        kinds.add(kind)
                        pair[kind, n.parent.label, n.label] += 1
        self.root = (math.log(roots[0]), math.log(roots[1]))
        self.evidence = {f: tuple(math.log(seen[f, y] / total[y]) for y in (0, 1)) for f in features}
        self.pairs = {k: tuple(tuple(math.log(pair[k, a, b] / (pair[k, a, 0] + pair[k, a, 1])) for b in (0, 1)) for a in (0, 1)) for k in kinds}

    def marginals(self, nodes: list[Node]) -> dict[Node, float]:
        """p(content) of every node; ``nodes`` has parents before their children."""
        both = (0.0, 0.0)
        up = {n: [sum(self.evidence.get(f, both)[y] for f in n.features) for y in (0, 1)] for n in nodes}
        sent: dict[Node, tuple[float, float]] = {}
        for n in reversed(nodes):  # children's messages have come in
            if n.parent:
                p = self.pairs.get(n.kind) or self.pairs["any"]
                sent[n] = tuple(_log_sum(p[a][0] + up[n][0], p[a][1] + up[n][1]) for a in (0, 1))
                for a in (0, 1):
                    up[n.parent][a] += sent[n][a]
        down = {nodes[0]: self.root}
        out = {}
        for n in nodes:
            if n.parent:
                p = self.pairs.get(n.kind) or self.pairs["any"]
                above = [down[n.parent][a] + up[n.parent][a] - sent[n][a] for a in (0, 1)]
                down[n] = tuple(_log_sum(above[0] + p[0][b], above[1] + p[1][b]) for b in (0, 1))
            no, yes = (down[n][y] + up[n][y] for y in (0, 1))
            out[n] = 1 / (1 + math.exp(min(700.0, no - yes)))
        return out

    def text(self, html: str) -> str:
        page = Page(html)
        p = self.marginals(page.nodes)
        blocks = (" ".join("".join(parts).split()) for node, parts in page.pieces if p[node] > 0.5)
        return " ".join(b for b in blocks if b)


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


# --- labelled pages -------------------------------------------------------

#: Elements of each kind of boilerplate: tag and attributes.
BOILERPLATE = {
    "menu": ("nav", 'nav class="menu"', 'div class="navbar"', 'div id="menu"', 'ul class="nav"', 'div class="breadcrumbs"', 'div class="pagination"', 'div role="navigation"'),
    "header": ("header", 'div id="header"', 'div class="masthead"', 'div class="site-header"', 'header class="topbar"', 'div class="banner"'),
    "footer": ("footer", 'div id="footer"', 'div class="site-footer"', 'footer class="legal"', 'div class="copyright"'),
    "side": ("aside", 'div class="sidebar"', 'div id="sidebar"', 'aside class="widget"', 'div class="related"', 'section class="recommended"'),
    "advert": ('div class="ad"', 'div class="ads"', 'div id="ad-top"', 'div class="advert"', 'section class="sponsored"', 'div class="promo"', 'aside class="advertisement"', 'p class="ad"'),
    "notice": ('div class="notice"', 'div class="cookie-notice"', 'div id="cookie-consent"', 'div class="alert"', 'div class="popup"', 'section class="notice"', 'div role="alert"', 'p class="notice"', "dialog"),
    "form": ("form", 'form class="search"', 'div class="newsletter"', 'div class="signup"', 'form id="login"', 'section class="subscribe"'),
    "comment": ('section class="comments"', 'div id="comments"', 'ol class="commentlist"', 'div class="comment-list"', 'section id="discussion"', 'ul class="comments"', 'div class="comments"'),
    "share": ('div class="share"', 'ul class="social"', 'div class="tags"'),
}
MAIN = ("article", 'article class="post"', "main", 'main id="content"', 'div id="content"', 'div class="content"', 'div class="article"',
        'div class="entry-content"', 'section class="story"', 'div class="post"', 'div id="main"', 'div class="text"', "div", "section", "td", "body")


def labelled_pages(n: int = PAGES, seed: int = SEED) -> Iterator[str]:
    """Pages of many layouts, made by rule, with ``data-main`` on the elements where a label begins."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("aeiounrstlmdk") for _ in range(r.randint(1, 9)))
    words = lambda n: " ".join(word() for _ in range(n))
    prose = lambda top=80: " ".join(words(r.randint(1, 16)).capitalize() + r.choice("....!?") for _ in range(r.randint(1, max(1, top // 10))))
    link = lambda: f'<a href="/{word()}">{words(r.randint(1, 3))}</a>'
    put = lambda el, inner, y="": f"<{el}{y}>{inner}</{el.split()[0]}>"

    def boilerplate(kind: str) -> str:
        el = r.choice(BOILERPLATE[kind])
        items = [link() for _ in range(r.randint(1, 8))]
        if kind in ("menu", "share") or kind in ("side", "header", "footer") and r.random() < 0.4:
            inner = "".join(f"<li>{x}</li>" for x in items)
            inner = inner if el.startswith("ul") else put("ul", inner) if r.random() < 0.7 else " | ".join(items)
        elif kind == "comment":
            one = lambda: put(r.choice(("p", "div", 'div class="comment"')), prose(60))
            inner = "".join((f"<li>{one()}</li>" if el[:2] in ("ol", "ul") else one()) for _ in range(r.randint(1, 6)))
            if r.random() < 0.5 and el[:2] not in ("ol", "ul"):
                inner = put("h3", words(2)) + inner
        elif kind == "form":
            inner = put("label", words(2)) + '<input name="q">' + put(r.choice(("p", "div", "span")), prose(20)) + put("button", word())
        else:
            body = prose(40) if kind in ("advert", "notice", "side") else "&copy; " + prose(20)
            inner = body if r.random() < 0.6 or el.startswith("p") else put("p", body)
            if kind == "side" or r.random() < 0.2:
                inner = inner if el.startswith("p") else put("h3", words(2)) + inner
        return put(el, inner, ' data-main="0"')

    def article() -> str:
        head = put(r.choice(("h1", "h1", "h2")), words(r.randint(2, 10)))
        parts = [put("header", head) if r.random() < 0.1 else head]
        for _ in range(r.randint(1, 14)):
            kind = r.random()
            inline = f"{prose()} {link()} {prose(20)}" if r.random() < 0.2 else prose()
            if kind < 0.68:
                parts.append(put("p", inline) if r.random() < 0.9 else f"<p><b>{words(4)}<br><p>{inline}</p>")
            elif kind < 0.74:
                parts.append(put(r.choice(("h2", "h3")), words(r.randint(1, 6))))
            elif kind < 0.80:
                parts.append(put(r.choice(("ul", "ol")), "".join(put("li", prose(20)) for _ in range(r.randint(2, 5)))))
            elif kind < 0.84:
                parts.append(put("blockquote", put("p", prose(30))))
            elif kind < 0.87:
                parts.append(put("table", "".join(put("tr", put("td", words(2)) * 3) for _ in range(3))))
            elif kind < 0.90:
                parts.append(put("figure", "<img>" + put("figcaption", prose(12))))
            elif kind < 0.93:
                parts.append(put("pre", words(12)))
            elif kind < 0.97:
                parts.append(put("div", inline))
            else:
                parts.append(put("section", put("h2", words(3)) + put("p", inline)))
            if r.random() < 0.12:
                parts.append(boilerplate(r.choice(("advert", "side", "form", "share", "menu", "notice"))))
        if r.random() < 0.12:
            parts.append(boilerplate(r.choice(("comment", "footer", "share", "side"))))
        return "".join(parts)

    for _ in range(n):
        el = r.choice(MAIN)
        before = [boilerplate(k) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.5]
        after = [boilerplate(k) for k in ("side", "comment", "form", "advert", "notice", "footer") if r.random() < 0.45]
        r.shuffle(before)
        if el == "body":
            body = put("body", "".join([*before, article(), *after]), ' data-main="1"')
        else:
            core = put(el, article(), ' data-main="1"')
            if el == "td":
                core = f"<table><tr>{core}</tr></table>"
            elif r.random() < 0.3:
                core = put(r.choice(("main", "div", 'div class="container"', 'div id="page"', "form")), core)
            inner = "".join([*before, core, *after])
            body = put("body", put(r.choice(("div", 'div id="wrapper"', 'div class="page"')), inner) if r.random() < 0.3 else inner)
        yield f"<html><head><title>{words(5)}</title><script>var a;</script></head>{body}</html>"
    for _ in range(n // 20):  # text without any markup, and without a frame
        yield f'<html data-main="1">{prose()}'
        yield f'<html data-main="1">{"".join(put("p", prose()) for _ in range(r.randint(1, 9)))}'


_MODEL: list[Model] = []


def model() -> Model:
    """The model of ``labelled_pages``, trained once."""
    if not _MODEL:
        _MODEL.append(Model(labelled_pages()))
    return _MODEL[0]


def extract(pages: DataFrame, trained: Model | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    ``trained``: a model of other labelled pages.  Defined cases: null or empty
    html has an empty text; tags that are never closed or don't match are mended as browsers do in
    the common cases; rows that repeat are extracted alike; other columns are
    not read; an empty table gives an empty result.
    """
    prepare_python(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(trained or model())

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in it:
            for part in chunks(b, "html"):
                texts = [m.text(x or "") for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return (
        pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
        .mapInArrow(batches, "page_id long, url string, text string")
        .withColumn("n_chars", F.length("text").cast("long"))
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
