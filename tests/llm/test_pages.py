import re
from html import unescape

import pytest

from lexigram.llm import pages as p

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain &amp; text", "plain & text"),
        ("<p>a<p>b <b>c<br>d</p>e", "a\nb c d\ne"),
        ("<ul><li>1<li>2</ul><table><tr><td>x<td>y</table>", "1\n2\nx\ny"),
        ("<article><header><h1>T</h1><span>by</span></header><p>x</article><footer>f</footer>", "T\nx"),
        ("<script>var t='</p>';</script>z<style>q", "z"),
        ("<p>1 < 2 && 3 > 2 &lt;b&gt;&nbsp;&#233;</p>", "1 < 2 && 3 > 2 <b> é"),
        ('<div title="a>b">q</div><!-- open', "q"),
        ('<main><p>x</p><div class="user-comments"><p>c</p></div><aside>s</aside><form>f</form></main>', "x"),
        ('<body class="has-sidebar"><div id="cookie-notice">ok</div><p hidden>h</p><p>x</p></body>', "x"),
        ('<article><p>x</p></article><div class="comments"><article><p>reader</p></article></div>', "x"),
        ('<div class="with-sidebar"><article><p>x</p><div class="share">s</div></article></div>', "x"),
        ('<div class="has-menu"><p>x</p><p>y</p></div>', "x\ny"),
        ('<div class="ad"><p>a</p></div><article> </article><div class="ad"><p>b</p></div>', ""),
        ('<div class="ad"><p>a</p></div>', ""),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
    ],
)
def test_main_text(html, text):
    root = p.parse(html)
    p.hash_subtrees(root)
    assert p.main_text(root) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ('<article><header class="entry-header"><h1>T</h1><span>by</span></header><p>x</p></article>', "T\nx"),
        ('<article><div class="post-header"><div><h1 class="header">T</h1></div><p>by</p></div><p>x</p></article>', "T\nx"),
        ('<main><div id="header"><h2>T</h2></div><p>x</p></main>', "T\nx"),
        ('<article><p>x</p><div class="comments-header"><h3>c</h3></div><div class="header ad"><h3>a</h3></div></article>', "x"),
        ('<body><div class="site-header"><h1>Site</h1></div><article><h1>T</h1><p>x</p></article></body>', "T\nx"),
        ('<body><div class="site-header"><h1>Site</h1></div><p>x</p><p>y</p></body>', "x\ny"),
    ],
)
def test_headers_by_name_keep_the_title(html, text):
    root = p.parse(html)
    p.hash_subtrees(root)
    assert p.main_text(root) == text


def page(i, host="h.example", article=None, extra=""):
    body = article or f"<p>Story {i} begins.</p><p>Common line.</p><p>It ends after {i * i} words.</p>"
    box = "<div><p>Read more from us</p><p>Every day</p></div>"
    return (i, f"http://{host}/{i}", f"<body><div>Site name</div><article><h1>Title {i}</h1>{body}{box}{extra}</article></body>")


def test_templates_of_a_host_go(spark):
    rows = [page(i) for i in range(10)]
    rows += [page(100 + i, "other.example") for i in range(2)]  # too few pages for a template
    rows += [page(200, None or "h.example", "<p>Copied story.</p>")] * 4  # copies count as one page
    rows += [(300, None, rows[0][2]), (301, "http://h.example/x", None), (None, "no url", "<p>t</p>")]
    rows += [(400 + i, f"https://plain.example/{i}", f"<body><div><p>We use cakes</p></div><p>Text {i}</p></body>") for i in range(6)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as host", "2 as text", "3 as page")
    got = {r.page_id: r for r in p.report(table).collect()}
    assert got[3].text == "Title 3\nStory 3 begins.\nCommon line.\nIt ends after 9 words."
    assert got[100].text.endswith("Read more from us\nEvery day") and got[300].text.endswith("Every day")
    assert got[200].text == "Title 200\nCopied story." and got[301].text == "" and got[None].text == "t"
    assert got[402].text == "Text 2" and got[3].n_chars == len(got[3].text)
    assert p.report(table).count() == len(rows) and p.report(table.limit(0)).count() == 0


def test_templates_of_sections_and_notices_go(spark):
    rows = []
    for i in range(60):  # six sections, each with its own menu and advert on a sixth of the pages
        menu = f"<ul><li>Part {i % 6}</li><li>More of part {i % 6}</li></ul>"
        box = f"<div><span>Buy {i % 6} now</span></div>"
        body = f"<h1>Title {i}</h1><h2>Story</h2><p>We close in May.</p><p>Text {i}.</p><p>Said {i % 6}.</p>{box}"
        rows.append((i, f"http://h.example/{i % 6}/{i}", f"<body>{menu}<article>{body}</article></body>"))
        rows.append((100 + i, f"http://plain.example/{i % 6}/{i}", f"<body>{menu}<p>Text {i}.</p>{box}</body>"))
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in p.report(table).collect()}
    for i in range(60):
        assert got[i] == f"Title {i}\nStory\nText {i}.\nSaid {i % 6}."
        assert got[100 + i] == f"Text {i}."


def test_lists_and_tables_of_few_articles_stay(spark):
    table = "<table><tr><td>North</td><td>1</td></tr></table><ul><li>see also</li></ul>"
    menu = lambda i: f"<div><ul><li>Part {i % 4}</li></ul></div>"
    rows = []
    for i in range(400):
        extra = table if i % 100 == 7 else ""  # four pages of the host
        rows.append((i, f"http://h.example/{i % 4}/{i}.html", f"<body><article>{menu(i)}<p>Text {i}.</p>{extra}</article></body>"))
        rows.append((1000 + i, f"http://flat.example/{i % 4}/{i}.html", f"<body>{menu(i)}<p>Text {i}.</p>{extra}</body>"))
    got = {r.page_id: r.text for r in p.report(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for i in range(400):
        want = f"Text {i}.\nNorth\n1\nsee also" if i % 100 == 7 else f"Text {i}."
        assert got[i] == want and got[1000 + i] == want


def test_given_pages_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in p.report(rows).collect()}
    for r in rows.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " ").replace("<b>", ""))
        want = [" ".join(unescape(x).split()) for x in parts]
        assert got[r.page_id] == "\n".join(x for x in want if x)
