"""HTML extraction (op 5) against a plain reader of the test pages' layout."""

from html.parser import HTMLParser

import pytest

from hirelens.llm import html_extraction as he, queries
from hirelens.llm._shared import Scratch

from .conftest import SF


class Article(HTMLParser):
    """Blocks of the article element, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.on, self.blocks, self.now = False, [], []

    def cut(self):
        t = " ".join("".join(self.now).split())
        if t:
            self.blocks.append(t)
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.on = True
        elif tag in ("p", "h1", "h2", "li", "div"):
            self.cut()
        elif tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "div", "article"):
            self.cut()
        if tag == "article":
            self.on = False

    def handle_data(self, data):
        if self.on:
            self.now.append(data)


def plain(page):
    a = Article()
    a.feed(page or "")
    a.close()
    a.cut()
    return "\n".join(a.blocks)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_op5(spark, sf):
    pages = queries.table(spark, sf, "pages").collect()
    got = queries.op5_html_extraction(spark, sf).collect()
    assert sorted(str((r.page_id, r.url, plain(r.html))) for r in pages) == sorted(str((r.page_id, r.url, r.text)) for r in got)
    assert all(r.n_chars == len(r.text) for r in got)


CASES = [
    ("<p>a<p>b", ["a", "b"]),
    ("<body><div>x <b>y</b>&amp;z<br>w</div>tail</body>", ["x y&z w", "tail"]),
    ("plain &lt;b&gt; text", ["plain <b> text"]),
    ("<article><h1>T</h1><div class='share'>s</div><p>t</p><form><input>q</form><section id=comments><p>c</p></section></article>", ["T", "t"]),
    ("<nav>n</nav><header>h</header><main><p>m</p><aside>a</aside></main><footer>f</footer>", ["m"]),
    ("<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p><script>x", ["yes"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
    ("<p>un<i>closed <p>next</p></p>x", ["unclosed", "next", "x"]),
    ("<p title='a > b'>q</p><p class=ad>no</p><p data-x=\"1\">r</p>", ["q", "r"]),
    ("<p>nb&nbsp;sp &copy &#8212; &#x41;</p>", ["nb sp © — A"]),
    ("<h1>a<h2>b</h2><p>5 < 6 and 7 > 3</p>", ["a", "b", "5 < 6 and 7 > 3"]),
    ("<div role=navigation>n</div><div class='post-body'>p</div><div id=cookie-notice>c</div>", ["p"]),
    ("", []), (None, []), ("   ", []), ("<", ["<"]), ("<p", ["<p"]), ("<p>x</P></div></p>y", ["x", "y"]),
]


@pytest.mark.parametrize("page,want", CASES)
def test_blocks(page, want):
    assert [t for _, out, t in he.blocks(page) if not out] == want


def site(n, template, body="<div id=wrap><div class=top>{t}</div><div class=body><p>{a}</p><p>{b}</p><p>Rate this text</p></div></div>"):
    return [f"<html><body>{body}</body></html>".format(t=template, a=f"Story {i} begins with words of its own, {i * 7919} of them.",
                                                         b=f"It goes on for a while and ends at number {i * 104729}.") for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", "extra") for r in rows], "page_id long, url string, html string, host string, rule string").repartition(4)


def texts(df):
    return {r.page_id: r.text for r in he.extract_pages(df).collect()}


def test_template_goes_and_slots_stay(spark):
    rows = [(i, f"http://one.com/{i}", p) for i, p in enumerate(site(30, "Welcome to the site"))]
    got = texts(frame(spark, rows))
    assert got[3] == "Story 3 begins with words of its own, 23757 of them.\nIt goes on for a while and ends at number 314187."


def test_copies_of_one_article_keep_it(spark):
    page = "<html><body><article><h1>Same</h1><p>Copied text</p></article></body></html>"
    near = [f"<html><body><article><h1>Same</h1><p>Long copied text that never changes at all</p><p>{i}</p></article></body></html>" for i in range(30)]
    rows = [(i, "http://c.com/x", page) for i in range(40)] + [(100 + i, "http://n.com/x", p) for i, p in enumerate(near)]
    got = texts(frame(spark, rows))
    assert {got[i] for i in range(40)} == {"Same\nCopied text"}
    assert got[107] == "Same\nLong copied text that never changes at all\n7"


def test_wrappers_do_not_depend_on_the_order_of_few_pages(spark):
    pages = site(12, "Top")
    df = spark.createDataFrame([(f"http://a.com/{i}", p) for i, p in enumerate(pages)], "url string, html string")
    rules = {r.rule for k in (1, 5) for r in he.wrappers(df.repartition(k), Scratch(spark, "test-html")).collect()}
    assert len(rules) == 1


def test_edges(spark):
    rows = [(1, None, "<p>a</p>"), (2, "http://x.com", None), (3, "not a url", ""), (None, "http://x.com", "<p>b</p>"), (4, "http://x.com", "<p>b</p>"),
            (4, "http://x.com", "<p>b</p>"), (5, "http://x.com", "<p>" + "long " * 50000 + "</p>"), (6, "http://x.com", "<div>" * 3000 + "deep")]
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in he.extract_pages(frame(spark, rows)).collect())
    want = {1: "a", 2: "", 3: "", None: "b", 4: "b", 5: ("long " * 50000).strip(), 6: "deep"}
    assert got == sorted((str(r[0]), want[r[0]], len(want[r[0]])) for r in rows)


def test_empty(spark):
    assert he.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_simple_tree_matching():
    def tree(label, *kids):
        return {"l": label, "m": 0, "t": {}, "k": list(kids)}
    a = tree("html", tree("a", tree("x"), tree("y")), tree("b"), tree("c"))
    b = tree("html", tree("b"), tree("a", tree("y")), tree("c"))
    assert he._size(a, b) == 4  # html, a, y, c
    m = he.merge(a, b)
    assert [k["l"] for k in m["k"]] == ["b", "a", "b", "c"]


def test_blocks_beside_the_heaviest_one_stay(spark):
    bodies = {"h": "<h1>Headline {i}</h1><div id=content><p>{long}</p></div>",
              "i": "<div class=intro><p>Intro {i}</p></div><div class=text><p>{long}</p><p>End {i}</p></div><p>Last {i}</p>"}
    long = {i: f"Story {i} " + "goes on and on " * 20 + f"to {i}" for i in range(20)}
    pages = [(100 * k + i, f"http://{h}.com/{i}", "<html><body><p>Site</p>" + b.format(i=i, long=long[i]) + "</body></html>")
             for k, (h, b) in enumerate(bodies.items()) for i in range(20)]
    got = texts(frame(spark, pages))
    assert all(got[i] == f"Headline {i}\n{long[i]}" for i in range(20))
    assert all(got[100 + i] == f"Intro {i}\n{long[i]}\nEnd {i}\nLast {i}" for i in range(20))


NAMES = [(f"<div {n}><article><h1>T</h1><p>t</p></article></div>", ["T", "t"]) for n in (
    "class='layout no-sidebar'", "class=with-sidebar", "class=has-header", "class='widget-area content'", "id=skip-target",
    "class=sidebar", "id=header")] + [
    (f"<div {n}><p>no</p></div><p>yes</p>", ["yes"]) for n in (
        "class=main-sidebar", "id=site-footer", "class='x share-buttons'", "class=cookie-notice", "class=ad-box", "id=comments")] + [
    ("<article><p>a</p></article><div class=sidebar><article><p>b</p></article></div>", ["a"]),
    ("<div><p>a</p></div><div class=comments><article><p>b</p></article></div>", ["a"]),
    ("<div class=page-header><div class=body><p>a</p></div></div>", ["a"]),
    ("<div class=no-sidebar><p>a</p></div><div class=with-comments><p>b</p></div>", ["a", "b"]),
]


@pytest.mark.parametrize("page,want", NAMES)
def test_names_of_layout_wrappers(page, want):
    assert [t for _, out, t in he.blocks(page) if not out] == want


def test_template_among_many_paragraphs_and_on_few_pages(spark):
    own = lambda h, i, k: f"Paragraph {k} of page {i} of {h} says {i * 7919 + k}."
    rows, want = [], {}
    for h, n in enumerate((2, 3, 7, 60, 300)):
        for i in range(n):
            body = [own(h, i, k) for k in range(12)]
            want[1000 * h + i] = "\n".join(body)
            for k in range(8):
                body.insert((5 * i + 3 * k) % 13, f"Boilerplate {k}")
            html = "<html><body>" + "".join(f"<p>{t}</p>" for t in body) + "</body></html>"
            rows += [(1000 * h + i, f"http://h{h}.com/{i}", html)] * (1 + i % 2)
    assert texts(frame(spark, rows)) == want


def test_template_goes_at_its_node_only(spark):
    rows = [(i, f"http://one.com/{i}", f"<body><div class=top>News</div><h1>{'News' if i == 3 else i}</h1><p>Story {i} goes on and on.</p></body>")
            for i in range(10)]
    got = texts(frame(spark, rows))
    assert got[3] == "News\nStory 3 goes on and on." and got[4] == "4\nStory 4 goes on and on."


def test_deeply_nested_pages_align_quickly():
    import time
    page = "<html><body>" + "<div>" * 120 + "<p>deep {}</p><p>same</p>" + "</div>" * 120 + "</body></html>"
    began = time.time()
    tree = he.merge(he.page_tree(page.format(1)), he.page_tree(page.format(2)))
    for k in range(3, 20):
        tree = he.merge(tree, he.page_tree(page.format(k)))
    assert time.time() - began < 5
    assert he.extract(page.format(1), None) == "deep 1\nsame"


def test_ids_of_pages_do_not_grow_the_wrapper():
    page = '<html><body><div id="post-{0}" class="post post-{0} type-post"><p>text {0}</p></div><div class="box{0}"><p>other {0}</p></div></body></html>'
    tree = he.page_tree(page.format(0))
    for k in range(1, 60):
        tree = he.merge(tree, he.page_tree(page.format(k)))

    def count(n):
        return 1 + sum(count(k) for k in n["k"])
    assert count(tree) == count(he.page_tree(page.format(7)))


def test_matching_takes_the_most_nodes():
    """The memoised matching equals the plain recursion."""
    import random
    rng = random.Random(2)

    def tree(depth):
        return {"l": rng.choice("ab"), "m": 1, "k": [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else []}

    def plain(x, y):
        if x["l"] != y["l"]:
            return 0
        a, b = x["k"], y["k"]
        best = {(i, j): 0 for i in range(len(a) + 1) for j in range(len(b) + 1)}
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + plain(a[i], b[j]))
        return 1 + best[len(a), len(b)]
    for _ in range(200):
        x, y = tree(3), tree(3)
        assert he._pair(x, y, {})[0] == plain(x, y)
