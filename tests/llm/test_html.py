import html as entities
import itertools
import re

import numpy as np
import pytest

from flowlab.llm import html
from flowlab.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return html.fit(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def article(page):
    """The article of the given pages, by patterns that fit only them."""
    inner = re.search(r"<article>(.*?)(</article>|<footer|</body|$)", page, re.S).group(1)
    texts = (re.sub(r"<[^>]*>", " ", part.replace("<b>", "").replace("</b>", "")) for part in re.split(r"</?p>|</?h1>", inner))
    return "\n".join(t for part in texts if (t := " ".join(entities.unescape(part).split())))


def test_query_gives_the_articles(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = QUERIES["op9_html"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == article(pages[r.page_id].html)


def test_messages_equal_the_sum_over_all_states():
    draw = np.random.default_rng(3)
    page = html.Page("<body><div class=post><p>One.</p><p>Two.</p></div><nav><a href=x>Three</a></nav></body>")
    model = html.Model()
    model.w, model.pair = draw.normal(size=len(html.FEATURES)), draw.normal(size=model.pair.shape)
    n = len(page.nodes)
    total, single, pairs = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for states in itertools.product((0, 1), repeat=n):
        weight = np.exp(
            sum((page.x[i] @ model.w) * states[i] for i in range(n))
            + sum(model.pair[page.edge[i], states[page.parent[i]], states[i]] for i in range(n) if page.parent[i] >= 0)
        )
        total += weight
        single += weight * np.array(states)
        for i in range(n):
            if page.parent[i] >= 0:
                pairs[i, states[page.parent[i]], states[i]] += weight
    marginal, joint = model.marginals(page, joints=True)
    assert np.allclose(marginal, single / total) and np.allclose(joint, pairs / total)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html></html>", ""),
        (
            "<body><header><h1>Site</h1></header><article><h1>T</h1><p>First paragraph,\n long  enough.</p><aside><p>See also this.</p>"
            "</aside><div class='advert'>Buy now!</div><p>Second &amp; last &lt;p&gt; &#233;&nbsp;x.</p>"
            "<section class='comments'><p>Nice article, thank you.</p></section></article><footer>c</footer>",
            "T\nFirst paragraph, long enough.\nSecond & last <p> é x.",
        ),
        (
            "<div id=nav><a href=x>Home</a></div><div id=content><h2>Title here</h2><p>Some text, long enough.</p></div>"
            "<div class=cookie-banner>We use cookies. OK?</div><form><p>Sign up</p></form><div id=comments><p>I liked it.</p></div>",
            "Title here\nSome text, long enough.",
        ),
        (
            "<main><p>a<b>b</b>c<br>d<script>var x='<p>no</p>'</script><style>p{}</style><p>open<ul><li>one<li>two</ul></main>",
            "abc d\nopen\none\ntwo",
        ),
        ("<article>" + "<div>" * 3_000 + "deep text" + "</div>" * 3_000 + "</article>", "deep text"),
        ("<article><p>" + "word " * 100_000 + "</p></article>", ("word " * 100_000).strip()),
        ("<article><p>one</article></article></p><p>&am &quo &notanentity; <!-- no --></p></article>", None),
    ],
)
def test_odd_pages(model, page, text):
    got = model.text(page)
    if text is not None:
        assert got == text


def test_templates_are_learned(model):
    for page in html.templates():
        read = html.Page(page)
        labels = read.labels()
        p, _ = model.marginals(read)
        at = [i for i in read.text_at if labels[i] >= 0]
        assert ((p[at] >= 0.5) == (labels[at] == 1)).mean() > 0.95


def test_rows_and_empty_table(spark):
    rows = [(1, None, None, 0), (None, "u", "<article><p>x</p></article>", 0), (1, "u", "<article><p>x</p></article>", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    assert html.main_text(pages).columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text) for r in html.main_text(pages).collect()) == [(0, "x"), (1, ""), (1, "x")]
    assert html.main_text(pages.limit(0)).count() == 0


def test_key_name_with_a_blank(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>x</p></article>")], "`page id` long, `the url` string, html string")
    assert [tuple(r) for r in html.main_text(pages, "page id", "the url").collect()] == [(1, "u", "x", 1)]


class Walking(html.Tree):
    """The same rules by walking from the innermost open element outwards."""

    def _close_up_to(self, tags, stop):
        for place in range(len(self.path) - 1, 0, -1):
            if self.path[place].tag in stop:
                return
            if self.path[place].tag in tags:
                return self._close_from(place)

    def handle_endtag(self, tag):
        for place in range(len(self.path) - 1, 0, -1):
            if self.path[place].tag == tag:
                return self._close_from(place)
            if self.path[place].tag in html.BARRIER and tag not in html.BARRIER:
                return


def shape(node):
    return node if isinstance(node, str) else (node.tag, [shape(c) for c in node.children])


def test_tag_soup_is_closed_by_the_same_rules():
    rng = np.random.default_rng(5)
    tags = ["p", "div", "b", "td", "tr", "table", "li", "ul", "section", "span", "br"]
    for _ in range(300):
        page = "".join(f"<{'/' if rng.random() < 0.45 else ''}{rng.choice(tags)}>t" for _ in range(60))
        walking = Walking()
        walking.feed(page)
        walking.close()
        assert shape(html.parse(page)) == shape(walking.root)


def test_end_tags_without_start_take_linear_time():
    # walking outwards at each end tag would be 60,000 times 60,000 steps
    page = "<i>" + "<div><b>" * 30_000 + "</i>" * 60_000 + "</u>" * 60_000 + "text"
    assert html.parse(page).tag == "root"
