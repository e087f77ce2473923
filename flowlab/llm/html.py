"""Main text of web pages by a graphical model on the tree of the page.

A page is parsed into its tree of elements. Every node that holds text of its
own, and every element around it, is a variable with two states, content and
boilerplate. A node's evidence comes from features (element, words in class,
id and role, length and links of its text); each pair of parent and child has
a potential by the states of both and by the kind of the child. Messages go
once from the leaves to the root and once back (sum-product), which gives the
exact marginal of every node; a block is content if its marginal says so.

The potentials are trained from labelled pages: a page labels itself where it
marks its article (``<article>``, ``<main>`` or such a role), and a few
templates with labelled regions, below as ``TEMPLATES``, stand for the regions
that a corpus may not show. The fit is a bounded job: ``TRAIN_PAGES`` pages,
those with the least hash; applying it is one pass over all pages, without a
shuffle.

Defined results: a null or empty page, and a page without content, has the
empty text; a null id or url stays null; repeated rows give repeated rows; an
empty table an empty result. Only ``key``, ``url`` and ``html`` are read, so
other columns cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import quoted

#: self-labelled pages the potentials are fitted on
TRAIN_PAGES = 400
#: passes over the training pages
EPOCHS = 5
CONTENT_AT = 0.5

# Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style".split())
HIDDEN = RAW | set("head title noscript template iframe object svg math canvas select option textarea button datalist audio video".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSED_BY_BLOCK = {"p"}
CLOSED_BY_SAME = set("li dt dd tr td th option".split())
#: elements that an end tag of something inside does not close
BARRIER = set("article aside body div footer form header html main nav section table td th ul ol".split())
#: words in class, id and role, and the kind of region they speak of
KINDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs",
    "header": "header masthead banner topbar logo branding",
    "footer": "footer copyright colophon legal bottom",
    "sidebar": "sidebar aside rail widget related recommended trending popular complementary",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad adsense dfp",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall message disclaimer toast",
    "comments": "comment comments discussion disqus reply replies reader-comments responses respond",
    "form": "form search login signup contact",
    "share": "share sharing social follow tags meta byline-share",
    "content": "content article post entry story body main text maincontent articlebody",
}
_KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}
_TAG_KIND = {
    "nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form",
    "dialog": "notice", "article": "content", "main": "content",
}
_ARTICLE = {"article", "main"}


class Node:
    __slots__ = ("tag", "parent", "kinds", "children", "label", "text", "linked", "hidden")

    def __init__(self, tag: str, parent: Node | None, attributes=()):
        self.tag, self.parent = tag, parent
        self.children: list = []  # nodes and texts, in order
        self.hidden = tag in HIDDEN or (parent is not None and parent.hidden)
        kinds = {_TAG_KIND[tag]} if tag in _TAG_KIND else set()
        self.label = None
        for name, value in attributes:
            if name in ("class", "id", "role") and value:
                for word in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()):
                    if word in _KIND_OF:
                        kinds.add(_KIND_OF[word])
            elif name == "hidden" or name == "style" and value and re.search(r"display\s*:\s*none", value):
                self.hidden = True
            elif name == "data-label":
                self.label = value
        # what a region is for outweighs that it also holds text
        self.kinds = kinds - {"content"} if len(kinds) > 1 and tag not in _ARTICLE else kinds


class Tree(HTMLParser):
    """Elements of a page; tags left open or closed twice are tolerated."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("root", None)
        self.path = [self.root]  # from the root to the innermost open element
        self.open: dict[str, list[int]] = defaultdict(list)  # places in the path, by tag

    @property
    def here(self) -> Node:
        return self.path[-1]

    def _innermost(self, tags) -> int:
        """Place of the innermost open element with one of the tags, 0 if none
        is open. Independent of the depth, so broken pages take linear time."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _close_from(self, place: int) -> None:
        while len(self.path) > place:
            self.open[self.path.pop().tag].pop()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._close_up_to(CLOSED_BY_BLOCK, stop=BARRIER)
        if tag in CLOSED_BY_SAME:
            self._close_up_to({tag} | ({"td", "th"} if tag in ("tr", "td", "th") else set()), stop=BARRIER - {"td", "th"} | {"table"})
        node = Node(tag, self.here, attrs)
        self.here.children.append(node)
        if tag not in VOID:
            self.open[tag].append(len(self.path))
            self.path.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def _close_up_to(self, tags, stop):
        place = self._innermost(tags)
        if place > self._innermost(stop):
            self._close_from(place)

    def handle_endtag(self, tag):
        place = self._innermost((tag,))
        # a start outside the region that the end tag lies in is not its own
        if place and (tag in BARRIER or place > self._innermost(BARRIER)):
            self._close_from(place)

    def handle_data(self, data):
        self.here.children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def blocks(root: Node) -> list[tuple[Node, str, float, int]]:
    """Visible texts between block borders in page order: the element they lie
    in, the text with white space as one blank, the share of it inside links,
    and whether it follows other text of the same element."""
    out = []
    parts: list[str] = []
    linked = 0
    owner: list[Node] = [root]

    def close():
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            out.append((owner[0], text, min(1.0, linked / max(len(text), 1)), len(out)))
        parts.clear()
        linked = 0

    # explicit stack: pages may be nested deeper than Python calls
    stack: list = [(root, 0, 0)]
    while stack:
        node, at, links = stack.pop()
        if at < len(node.children):
            stack.append((node, at + 1, links))
            child = node.children[at]
            if isinstance(child, str):
                if not node.hidden:
                    if not parts:
                        owner[0] = _region(node)
                    parts.append(child)
                    linked += len(child.strip()) if links else 0
            elif child.hidden:
                continue
            elif child.tag == "br":
                parts.append(" ")
            elif child.tag in VOID and child.tag != "hr":
                continue
            else:
                if child.tag in BLOCK:
                    close()
                stack.append((child, 0, links + (child.tag == "a")))
        elif node.tag in BLOCK or node is root:
            close()
    close()
    return out


def _region(node: Node) -> Node:
    """The block element a text lies in."""
    while node.parent is not None and node.tag not in BLOCK and not node.kinds:
        node = node.parent
    return node


# --- the model

FEATURES = ["bias", "text", "heading", "paragraph", "list", "table", "short", "long", "links", "sentence", *(f"kind_{k}" for k in KINDS)]
_AT = {name: i for i, name in enumerate(FEATURES)}
#: kinds of edges: a plain child, a child that is a region of its own, a block
#: a text in a region of content follows it more closely than another text
EDGES = ["plain", "content", "other", "text", "inner"]


class Page:
    """Variables of a page: elements around texts, and the texts themselves."""

    def __init__(self, html: str | None):
        root = parse(html) if html else Node("root", None)
        self.texts = blocks(root)
        self.nodes: list = []
        self.parent: list[int] = []
        rows, edges = [], []
        index: dict[int, int] = {}
        self.text_at = []
        for element, text, links, _ in self.texts:
            path = []
            node = element
            while node is not None and id(node) not in index:
                path.append(node)
                node = node.parent
            for node in reversed(path):
                index[id(node)] = len(self.nodes)
                self.parent.append(index[id(node.parent)] if node.parent is not None else -1)
                self.nodes.append(node)
                x = np.zeros(len(FEATURES))
                x[_AT["bias"]] = 1
                for kind in node.kinds:
                    x[_AT[f"kind_{kind}"]] = 1
                rows.append(x)
                edges.append(1 if "content" in node.kinds else 2 if node.kinds else 0)
            self.text_at.append(len(self.nodes))
            self.nodes.append(element)
            self.parent.append(index[id(element)])
            x = np.zeros(len(FEATURES))
            x[_AT["text"]] = 1
            tag = element.tag
            x[_AT["heading"]] = bool(re.fullmatch("h[1-6]", tag))
            x[_AT["paragraph"]] = tag in ("p", "blockquote", "pre")
            x[_AT["list"]] = tag in ("li", "dt", "dd")
            x[_AT["table"]] = tag in ("td", "th")
            x[_AT["links"]] = links
            region = element
            while region is not None and not region.kinds:
                region = region.parent
            inner = region is not None and "content" in region.kinds
            if not inner:  # nothing but its own shape speaks for such a text
                x[_AT["short"]] = len(text) < 30
                x[_AT["long"]] = min(1.0, math.log1p(len(text)) / 7)
                x[_AT["sentence"]] = bool(re.search(r"[.!?…]['\"”»)]*$", text))
            rows.append(x)
            edges.append(4 if inner else 3)
        self.x = np.array(rows).reshape(len(rows), len(FEATURES))
        self.edge = np.array(edges, dtype=np.int64)

    def labels(self) -> np.ndarray | None:
        """1 content, 0 boilerplate, -1 unknown; None if the page shows none."""
        y = np.full(len(self.nodes), -1)
        marked = any(n.tag in _ARTICLE or n.label for n in self.nodes)
        if not marked:
            return None
        for i, node in enumerate(self.nodes):
            label = None
            walk = node
            while walk is not None and label is None:
                if walk.label:
                    label = int(walk.label == "content")
                elif walk.kinds - {"content"}:
                    label = 0
                elif walk.tag in _ARTICLE:
                    label = 1
                walk = walk.parent
            own = self.x[i, _AT["text"]] == 1
            inner = label == 1 or own or bool(node.kinds) or node.label
            # what holds an article is neither; everything else beside it is not content
            if label is not None:
                y[i] = label
            elif inner:
                y[i] = 0
        return y


class Model:
    """Weights of the features, and a potential per kind of edge and states."""

    def __init__(self):
        self.w = np.zeros(len(FEATURES))
        # a child tends to be what its parent is; regions decide for themselves
        self.pair = np.zeros((len(EDGES), 2, 2))

    def marginals(self, page: Page, evidence=None, joints: bool = False):
        """P(content) of every node, and if asked for the joint probabilities
        of every node and its parent.

        Messages are log odds, so a node costs a few scalar operations.
        ``evidence`` is added to the log odds of the nodes.
        """
        up = page.x @ self.w
        up = (up if evidence is None else up + evidence).tolist()
        parent, edge, n = page.parent, page.edge.tolist(), len(page.nodes)
        factor = [tuple(map(float, np.exp(p).reshape(-1))) for p in self.pair]  # by state of parent, then child
        exp, log = math.exp, math.log
        message = [0.0] * n
        for i in range(n - 1, -1, -1):  # children come after their parents
            u = up[i] = min(max(up[i], -80.0), 80.0)
            if parent[i] >= 0:
                a, b, c, d = factor[edge[i]]
                e = exp(u)
                m = message[i] = log((c + d * e) / (a + b * e))
                up[parent[i]] += m
        belief = list(up)
        joint = np.zeros((n, 2, 2)) if joints else None
        for i in range(n):
            p = parent[i]
            if p >= 0:
                a, b, c, d = factor[edge[i]]
                # what the rest of the tree says of the parent
                r = exp(min(max(belief[p] - message[i], -80.0), 80.0))
                belief[i] = min(max(up[i] + log((b + d * r) / (a + c * r)), -80.0), 80.0)
                if joints:
                    e = exp(up[i])
                    cells = np.array([[a, b * e], [c * r, d * r * e]])
                    joint[i] = cells / cells.sum()
        return 1 / (1 + np.exp(-np.array(belief))), joint

    def fit(self, pages: list[Page], epochs: int = EPOCHS, rate: float = 0.3) -> Model:
        """Likelihood of the known labels: its slope is the difference of the
        expectations with them as evidence and without."""
        known = [(p, y) for p in pages if (y := p.labels()) is not None and len(p.nodes)]
        square_w, square_p = np.full(len(FEATURES), 1e-3), np.full(self.pair.shape, 1e-3)
        for _ in range(epochs):
            for page, y in known:
                free, free_joint = self.marginals(page, joints=True)
                certain = np.where(y == 1, 60.0, np.where(y == 0, -60.0, 0.0))
                fixed, fixed_joint = self.marginals(page, certain, joints=True)
                w = page.x.T @ (fixed - free) - 1e-3 * self.w
                p = np.zeros_like(self.pair)
                np.add.at(p, page.edge, fixed_joint - free_joint)
                p -= 1e-3 * self.pair
                square_w += w * w
                square_p += p * p
                self.w += rate * w / np.sqrt(square_w)
                self.pair += rate * p / np.sqrt(square_p)
        return self

    def text(self, html: str | None) -> str:
        page = Page(html)
        if not page.texts:
            return ""
        p, _ = self.marginals(page)
        return "\n".join(t[1] for t, i in zip(page.texts, page.text_at) if p[i] >= CONTENT_AT)


# Labelled training pages: regions that pages of a corpus may not show.
_PROSE = "It was a long way to the coast, and the road went over the hills. Nobody knew when the rain would stop."
_REGION = {
    "menu": '<div class="{0}"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></div>',
    "header": '<div class="{0}"><h1><a href="/">The Site</a></h1><p>All the news of the day and the hour.</p></div>',
    "footer": '<div id="{0}"><p>Copyright by the owners. All rights reserved.</p><a href="/c">Contact</a></div>',
    "sidebar": '<div class="{0}"><h3>More</h3><p>Another story that you may like to read next, about the sea.</p></div>',
    "advert": '<div class="{0}"><p>Buy two pairs of shoes and pay for one. The offer ends on Sunday.</p></div>',
    "notice": '<div class="{0}"><p>We use small files to remember you. Do you agree to this use of your data?</p></div>',
    "comments": '<section id="{0}"><h2>Opinions</h2><div><p>I do not agree with the author at all. The road is short.</p></div></section>',
    "form": '<form class="{0}"><p>Write to us and we will answer.</p><label>Name</label></form>',
    "share": '<div class="{0}"><a href="/f">Send</a> <a href="/g">Print</a></div>',
}
_BODIES = [
    "<article><h1>A way</h1>{0}<p>%s</p>{1}<h2>On foot</h2><p>%s</p><ul><li>Bread</li><li>Water for the day</li></ul>{2}</article>{3}",
    '<div class="content"><h1>A way</h1><p>%s</p>{0}<blockquote>%s</blockquote><p>Short.</p>{1}</div>{2}{3}',
    "{0}<main><h1>A way</h1><p>%s</p><table><tr><td>Hills</td><td>Three</td></tr></table><p>%s</p>{1}</main>{2}{3}",
    '<div id="wrap">{0}<div><h1>A way</h1><p data-label="content">%s</p><p data-label="content">%s</p></div>{1}{2}</div>{3}',
]


def templates() -> list[str]:
    """Pages made of labelled regions: everything of a region's kind is
    boilerplate, the rest of the body is content."""
    pages = []
    kinds = list(_REGION)
    words = {k: KINDS[k].split() for k in kinds}
    for turn in range(36):
        parts = []
        for slot in range(4):
            kind = kinds[(turn + 3 * slot + turn // 9) % len(kinds)]
            word = words[kind][(turn // len(kinds) + slot) % len(words[kind])]
            parts.append(_REGION[kind].format(word))
        body = (_BODIES[turn % len(_BODIES)].replace("%s", _PROSE)).format(*parts)
        body = body.replace('<div class="content">', '<div class="content" data-label="content">')
        pages.append(f"<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav>{body}<footer>The end of it.</footer></body></html>")
    return pages


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", rows: int = TRAIN_PAGES) -> Model:
    """Fit on at most ``rows`` pages that mark their article, and the templates."""
    marked = pages.where(F.col(html).rlike("(?i)<(article|main)[\\s>]")).select(
        F.col(html).alias("html"), F.xxhash64(F.col(key).cast("string"), html).alias("h")
    )
    # long pages teach no more than others and would fill the driver
    marked = marked.where(F.length("html") < 200_000)
    # the hashes first, so that tasks send pages of the sample alone
    least = [r.h for r in marked.select("h").distinct().orderBy("h").limit(rows).collect()]
    chosen = marked.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if least else []
    own = [Page(r.html) for r in chosen]
    made = [Page(t) for t in templates()]
    share = max(1, len(own) // max(len(made), 1))
    return Model().fit(own + made * min(share, 3))


def extract(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, text and n_chars of every page."""
    source = pages.select(key, url, html)

    def run(batches):
        for batch in batches:
            texts = [model.text(v.as_py()) for v in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, url, "text", "n_chars"],
            )

    kind = lambda c: source.schema[c].dataType.simpleString()
    return source.mapInArrow(run, f"{quoted(key)} {kind(key)}, {quoted(url)} {kind(url)}, text string, n_chars long")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Fit on the pages' own marks and extract the main text of all."""
    return extract(pages, fit(pages, key, html), key, url, html)
