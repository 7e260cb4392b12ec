import random
import time

import pytest

from graphmill.llm.extract import Wrapper, align, extract, main_text, parse, shape_of

SCHEMA = "page_id long, url string, html string"


def plain(html):
    return main_text(parse(html), None, set())


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""), ("just text", "just text"), ("<p>a<p>b", "a\nb"), ("<p>a <b>b</b>c<br>d&amp;e&nbsp;f</p>", "a bc d&e f"),
        ("<body><nav>menu</nav><div>x <i>y</i></div><footer>f</footer>", "x y"),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes</p>", "yes"),
        ("<!-- <p>no</p> --><p>1 &lt; 2 &#233;&#x41;</p>", "1 < 2 éA"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<article><header><h1>T</h1></header><p>x</p><aside>no</aside><div class='comments'><p>no</p></div><form>no<input></form></article><p>out</p>", "T\nx"),
        ("<div id=cookie-notice>no</div><main><h2>H</h2>t<table><tr><td>1<td>2<tr><td>3</table></main>", "H\nt\n1\n2\n3"),
        ("<div class='sidebar left'>no</div><div class=post>yes</div><p class='ad'>no", "yes"),
        ("<head><title>no</title><p>yes</p>", "yes"), ("<p>a<b>b<p>c</b>d", "ab\ncd"), ("<p>unclosed <a href='x", "unclosed <a href='x"),
        ("<div><span class=ad>no</span>yes</div>", "yes"), ("<p>a\n\t b　c</p>", "a b c"), ("</p></div><p>x</article>", "x"),
    ],
)
def test_pages(html, text):
    assert plain(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>one</p><a href=\"x>two</a><p>three</p>", "one\ntwo\nthree"), ("<p>it's <b title='x>y'>b</b> 5\"</p>", "it's b 5\""), ("a < b <c", "a < b <c"), ("<label>Name</label> x", "Name x"),
        ("<article><h1 class='post-header'>H</h1><p class='related'>p</p><div class='share-price'>12</div><div class='share-bar'>no</div></article>", "H\np\n12"),
        ("<table><tr><td>a</div>b<td>c</table>d", "ab\nc\nd"), ("<p><b>a<p>b</b>c</p>", "a\nbc"), ("<![CDATA[a &amp; b]]>", "a &amp; b"), ("x<!-- no", "x"), ("<p>x</p><noscript>y<p>z", "x\ny\nz"),
        ("<ul><li>a<div><ul><li>b</ul></div><li>c</ul>", "a\nb\nc"), ("<table><tbody><tr><td>1<tbody><tr><td>2</table>", "1\n2"),
    ],
)
def test_odd_markup(html, text):
    assert plain(html) == text


def brute_match(a, b):
    """The most nodes that a mapping of equal labels can hold which keeps parents and order, runs of siblings as one child."""
    if a.label != b.label:
        return 0
    runs, kids = [], b.kids
    for k in a.kids():
        if not runs or runs[-1].label != k.label:
            runs.append(k)
    best = [[0] * (len(kids) + 1) for _ in range(len(runs) + 1)]
    for i, r in enumerate(runs):
        for j, k in enumerate(kids):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_match(r, k))
    return best[-1][-1] + 1


def test_alignment_maps_as_many_nodes_as_plain_tree_matching():
    rng = random.Random(2)

    def tree(depth):
        return "".join(f"<div class={rng.choice('abc')}>{tree(depth - 1)}</div>" for _ in range(rng.randint(0, 4))) if depth else ""

    for _ in range(60):
        a, b = parse(tree(3)), parse(tree(3))
        nodes = Wrapper.of(shape_of(b))
        align(a, nodes[0])
        heads, todo = 0, [a]
        while todo:  # of each run of equal siblings one counts
            n = todo.pop()
            heads += n.index >= 0
            last = None
            for k in n.kids():
                if k.label != last:
                    todo.append(k)
                last = k.label
        assert heads == brute_match(a, nodes[0])


def test_deep_and_broken_pages_through_the_query(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    broken = {"<a ": 350_000, "<div>": 200_000, "<b></i>": 150_000, "<a b='": 150_000, "<noscript>": 100_000, "<li><p>": 150_000, "<!x": 300_000, "<tr><td>": 120_000}
    rows = [(i, "http://deep.example/", deep.replace("x", f"x{i}")) for i in range(3)] + [(10 + i, f"http://b{i}.example/", k * n) for i, (k, n) in enumerate(broken.items())]
    began = time.monotonic()
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert time.monotonic() - began < 120 and len(got) == len(rows)
    assert got[1] == "x1" and got[10] == ("<a " * 350_000).strip() and got[11] == ""


def test_the_number_of_pages_changes_no_text(spark):
    page = lambda i: f"<body><div class=x2><div>About us line</div></div><div class=x3><h1>Title {i}</h1><p>Body of page {i} with more text.</p></div><div class=x4>All rights reserved 2024</div></body>"
    rows = [(100 * n + i, f"http://h{n}.example/{i}", page(i)) for n in (2, 3, 9, 10, 40) for i in range(n)]
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(t == f"Title {k % 100}\nBody of page {k % 100} with more text." for k, t in got.items())


def test_copies_of_an_article_keep_their_text(spark):
    """Most of a host's pages carry one article beside other adverts and menus."""
    story = "".join(f"<p>Paragraph {k} of the story that many pages of this host carry.</p>" for k in range(5))
    page = lambda i, body: f"<body><div class=x1>Host name</div><div class=x3>{body}</div><div class=x5>Buy item {i} now</div></body>"
    rows = [(i, f"http://c.example/{i}", page(i, story)) for i in range(7)]
    rows += [(10 + i, f"http://c.example/o{i}", page(10 + i, "".join(f"<p>Text {i} has its own paragraph {k}, told at some length.</p>" for k in range(5)))) for i in range(5)]
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    want = "\n".join(f"Paragraph {k} of the story that many pages of this host carry." for k in range(5))
    assert all(got[i] == want for i in range(7)) and all(got[10 + i].startswith(f"Text {i} has") for i in range(5))


def test_long_and_deep_pages():
    assert plain("<div>" * 3000 + "x" + "</div>" * 3000) == "x"
    many = "<article>" + "".join(f"<p>t{i}</p>" for i in range(20000)) + "</article>"
    assert plain(many) == "\n".join(f"t{i}" for i in range(20000))


def test_alignment_keeps_parents_order_and_labels():
    a = parse("<body><div class=top>A</div><div class=main><h1>T</h1><p>1<p>2</div><div class=end>E</div>")
    b = parse("<body><div class=main><p>x<p>y<p>z</div><div class=new>N</div><div class=end>F</div>")
    nodes = Wrapper.of(shape_of(a))
    wrapper = nodes[0]
    assert align(b, wrapper) > 0
    found = {}

    def walk(n):
        found.setdefault(n.label, set()).add(n.index)
        for k in n.kids():
            walk(k)

    walk(b)
    labels = {w.index: w.label for w in nodes}
    assert all(labels[i] == label for label, at in found.items() for i in at if i >= 0)
    assert found["div.new"] == {-1} and len(found["p"]) == 1 and min(found["p"]) > 0 and min(found["div.end"]) > 0


def test_template_texts_and_the_content_node(spark):
    """No element names its role: what stays the same on a host's pages is the template."""
    page = lambda i: f"<body><div class=x1>Acme Corp</div><div class=x2><div>Shop</div><div>Contact us</div></div><div class=x3><h1>Title {i}</h1><p>Body of page {i} with more text.</p><p>Read on at Acme</p></div><div class=x4>All rights reserved</div></body>"
    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(30)] + [(100 + i, "http://small.example/a", page(i)) for i in range(3)]
    rows += [(200 + i, "http://copies.example/a", page(1)) for i in range(20)]
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[7] == "Title 7\nBody of page 7 with more text."
    assert got[101] == "Title 1\nBody of page 1 with more text."
    assert "Title 1\nBody of page 1 with more text." in got[205]


def test_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(spark, rows).collect()}
    for r in rows.collect():
        article = parse(r.html[r.html.index("<article>") : r.html.index("</article>")])
        assert got[r.page_id].text == main_text(article, None, set()) and got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_odd_rows(spark):
    rows = [(1, "http://a.example/", None), (1, "http://a.example/", None), (2, None, "<p>x</p>"), (None, "http://a.example/", "<p>y</p>"), (3, "no url", ""), (4, "//A.example:80/", "<p>z</p>"), (None, None, None)]
    got = extract(spark, spark.createDataFrame([(*r, "h", "s") for r in rows], SCHEMA + ", host string, shape string")).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0)] * 4 + [("x", 1), ("y", 1), ("z", 1)]
    assert extract(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_wrapper_chooses_also_where_pages_have_articles(spark):
    """Teasers, cards and comments in <article> aren't the page's text; an <article> with most of the text is, as a whole."""
    story = lambda i: f"<h1>Title {i}</h1><p>Body of page {i} with much more text than any teaser has, told at length in number {i}.</p><p>Its end {i}.</p>"
    cards = lambda i: f"<div class=x5><article class=card>Card {i}</article><article class=card>Card {i + 1}</article></div>"
    rows = [(i, f"http://cards.example/{i}", f"<body><div class=x3>{story(i)}</div>{cards(i)}</body>") for i in range(12)]
    rows += [(100 + i, f"http://whole.example/{i}", f"<body><article><h1>Title {i}</h1><div class=x3>{story(i)}</div></article><div class=x5><p>Card {i}</p></div></body>") for i in range(12)]
    rows += [(200 + i, f"http://few.example/{i}", f"<body><div class=x3>{story(i)}</div>{cards(i)}</body>") for i in range(2)]
    rows.append((300, "http://cards.example/other", "<body><section><main>Another layout</main></section><p>out</p></body>"))
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    text = lambda i: f"Title {i}\nBody of page {i} with much more text than any teaser has, told at length in number {i}.\nIts end {i}."
    assert all(got[i] == text(i) and got[100 + i] == f"Title {i}\n{text(i)}" for i in range(12))
    assert [got[200], got[201]] == [text(0), text(1)] and got[300] == "Another layout"


def test_articles_that_the_wrapper_lacks(spark):
    page = lambda i: f"<html><body><div class=x1>Own line {i}</div><article><h1>Title {i}</h1><p>Body {i}</p></article></body></html>"
    for first in (None, "<html><body><div class=x1>Log in here</div></body></html>", "<html><body><p>Error</p></body></html>"):
        rows = [(0, "http://h.example/0", first)] + [(i, f"http://h.example/{i}", page(i)) for i in range(1, 4)]
        got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
        assert all(got[i] == f"Title {i}\nBody {i}" for i in range(1, 4))
