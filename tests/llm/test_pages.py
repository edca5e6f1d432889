from __future__ import annotations

import time
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from assetweave.llm import templates
from assetweave.llm.markup import read
from assetweave.llm.templates import Reading


class ArticleText(HTMLParser):
    """What lies between the tags of the article, taken down tag by tag."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.within, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.within += tag == "article"
        self.out.append("" if tag in ("b", "i") else " ")

    def handle_endtag(self, tag):
        self.within -= tag == "article"
        self.out.append("" if tag in ("b", "i") else " ")

    def handle_data(self, data):
        self.out.append(data if self.within else "")

    def handle_entityref(self, name):
        at = self.rawdata.find(f"&{name}", 0)
        self.out.append((f"&{name};" if f"&{name};" in self.rawdata else self.rawdata[at:at + len(name) + 1]) if self.within else "")

    handle_charref = lambda self, name: self.out.append(f"&#{name};" if self.within else "")


def article_text(html):
    start, end = html.find("<article>"), html.find("</article>")
    parser = ArticleText()
    # References are decoded after the tags are gone, block by block.
    parser.feed(html[start:end + 10].replace("&", "\x00"))
    parser.close()
    return " ".join(unescape("".join(parser.out).replace("\x00", "&")).split())


def test_op12_on_the_tables(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = entry.queries()["op12_main_text"](spark, sf_dir)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = {(r.page_id, r.url, r.text, r.n_chars) for r in found.collect()}
    wanted = {(p.page_id, p.url, article_text(p.html), len(article_text(p.html))) for p in pages}
    assert got == wanted and len(pages) == found.count()


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain &lt;b&gt; &amp words &nbsp; here", "plain <b> & words here"),
    ("<body><p>a<p>b<br>c<b>d</b>e</body>", "a b cde"),
    ("<article><h1>T</h1><header><p>by</p></header><p>x<script>y</script>z</p><footer>f</footer></article><p>out</p>", "T by xz"),
    ("<div class='with-sidebar'><article>main</article><div class='sidebar'>side</div></div>", "main"),
    ("<main><div class='cookie-notice'>c</div><h1>t</h1><p>p</p><section id='comments'><p>who</p></section></main>", "t p"),
    ("<article>a<article>a reader says</article></article>", "a"),
    ("<article>a</article><section class='comments'><article>b</article></section>", "a"),
    ("<section class='related'><article>a</article></section>", "a"),
    ("<div class='post'><p>one</p><form>f</form><nav>n</nav></div><div>two</div>", "one"),
    ("<article><div class='entry-header'><h1>T</h1></div><div class='share-buttons'>s</div>x</article>", "T x"),
    ("<head><title>t</title><div>body<div role='navigation'>n</div><p hidden>h", "body"),
    ("<p>a <!-- b --> c <!-- d", "a c"), ("<p title='>'>a</p><p x=\"'>\">b", "a b"), ("<article>a < b <3 c</3d></article>", "a < b <3 c"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"), ("<p>a\n\t  b</p>\n<pre> c\r\nd </pre>", "a b c d"),
    ("<article>x<style>p{}</style><textarea>t</textarea></article>", "x"), ("<b><p>a</b>b</p>", "ab"), ("<p>a</div>b</p>c", "ab c"),
    ("<table><tr><td>a<td>b<tr><td>c</table>d", "a b c d"), ("<article></article><p>x</p>", "x"), ("<!DOCTYPE html><?x y><p>z", "z"),
])
def test_text_of_small_pages(html, text):
    assert Reading(html or "").text() == text


@pytest.mark.parametrize("part", [
    "<div>", '<a "', '<a x="', "<!--", "<p><b>", "<p><object><div>", "</b>", "<script>", "<", "<a ", "<b><p>", "<li>", "<article>", "<article>x",
    "&amp", "<a x='\">", "<div class='ad'>x", "<p>x</div>", "<table><p>",
])
def test_broken_pages_take_linear_time(part):
    began = time.time()
    reading = Reading(part * 20000 + "</p>" * 20000)
    reading.text(), list(reading.candidates())
    assert time.time() - began < 5


def test_elements_end_where_browsers_end_them():
    page = read("<div><p>a<ul><li>b<li>c</ul>d</div>e")
    parents = [(e.tag, page.elements[e.parent].tag) for e in page.elements[1:]]
    assert parents == [("div", ""), ("p", "div"), ("ul", "div"), ("li", "ul"), ("li", "ul")]


MENU = "<div class='x1'><a href='/'>Home</a><a href='/n'>News</a></div>"
LEGAL = "<div><p>All rights are ours and none are yours.</p></div>"


def site(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(1) for c in ("_host", "_nodes", "host", "nodes", "node", "n", "page")})


def plain_page(i, host="h.example"):
    return i, f"http://{host}/{i}", f"<body>{MENU}<div><h1>Title {i}</h1><p>Text of {i}.</p><p>A passage.</p></div>{LEGAL}</body>"


def test_subtrees_that_recur_on_a_host_go(spark):
    rows = [plain_page(i) for i in range(6)] + [(9, "https://user@H.example:8080/9?x", f"<body>{MENU}<p>Nine</p>{LEGAL}</body>")]
    rows += [(20, "http://other.example/", f"<body>{MENU}<p>Alone</p></body>"), (21, None, f"{MENU}<p>x</p>"), (22, "no address", f"{MENU}<p>y</p>")]
    done = templates.extract(site(spark, rows))
    got = {r.page_id: r.text for r in done.collect()}
    assert got[0] == "Title 0 Text of 0." and got[9] == "Nine"  # an unmarked passage on most pages of a site is a template
    assert got[20] == "HomeNews Alone" and got[21] == "HomeNews x" and got[22] == "HomeNews y"
    assert done.columns == [*site(spark, rows).columns, "text"]


def test_passages_of_marked_articles_stay_and_containers_in_them_go(spark):
    page = "<body><article><h1>T{0}</h1><p>Everybody quotes this.</p><div>Read our paper!</div><p>Own {0}</p></article></body>"
    got = [r.text for r in templates.extract(site(spark, [(i, "http://a.example/", page.format(i)) for i in range(8)])).collect()]
    assert sorted(got) == [f"T{i} Everybody quotes this. Own {i}" for i in range(8)]


def test_copies_of_a_page_are_no_template(spark):
    rows = [(i, f"http://c.example/{i}", "<body><div><div>One</div><div>Two</div></div></body>") for i in range(9)] + [plain_page(50, "c.example")]
    got = [r.text for r in templates.extract(site(spark, rows)).where("page_id < 50").collect()]
    assert got == ["One Two"] * 9


def test_templates_equal_a_count_by_hand(spark):
    rows = [plain_page(i) for i in range(5)] + [(7, "http://h.example/7", "<body><p>Other</p></body>")] * 3
    seen = {}
    for text, html in {(Reading(h).text(), h) for _, _, h in rows}:
        for node in {v for _, _, v in Reading(html).candidates()}:
            seen.setdefault(node, set()).add(text)
    pages = len({Reading(h).text() for _, _, h in rows})
    wanted = sorted(n for n, p in seen.items() if len(p) >= templates.LEAST and len(p) >= templates.SHARE * pages)
    [row] = templates.site_templates(site(spark, rows)).collect()
    assert row.host == "h.example" and row.nodes == wanted and len(wanted) > 2


def test_pages_of_nothing(spark):
    assert templates.extract(site(spark, [])).count() == 0
    rows = [(1, "http://x.example", None), (1, "http://x.example", None), (None, None, ""), (2, "http://x.example", "<p>long</p>" * 50000)]
    got = sorted(len(r.text) for r in templates.extract(site(spark, rows)).collect())
    assert got == [0, 0, 0, 5 * 50000 - 1]
    df = spark.createDataFrame([(1, "http://x", "<p>a", "old")], "page_id long, url string, html string, text string")
    assert templates.extract(df).collect()[0].asDict() == {"page_id": 1, "url": "http://x", "html": "<p>a", "text": "a"}
