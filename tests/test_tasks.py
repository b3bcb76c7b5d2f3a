from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexigram.functions.html import file_name, html_to_text, output_key
from lexigram.functions.messages import decode, encode, upload_total
from lexigram.operators.tasks import client_progress, convert, report_lines
from lexigram.sources.sinks import write_reports

TASKS = "client string, op string, url string"


@pytest.fixture
def results(spark):
    pages = spark.createDataFrame(
        [
            ("http://h/a.html", "<html><style>p{}</style><script>x='<p>'</script><p>Tom &amp; Al</p>\n<b>!</b><!-- no -->"),
            ("http://h/empty", "<html><body> </body></html>"),
        ],
        "url string, html string",
    )
    tasks = spark.createDataFrame(
        [
            ("c1", "ToText", "http://h/a.html"),
            ("c1", "ToHTML", "http://h/a.html"),
            ("c1", "ToImage", "http://h/a.html"),
            ("c2", "ToText", "http://h/gone.pdf"),
            ("c2", "ToText", "http://h/empty"),
            ("c2", "ToMorse", "http://h/a.html"),
            ("c2", None, "http://h/a.html"),
            ("c2", "ToText", None),
        ],
        TASKS,
    )
    return tasks, convert(tasks, pages)


def test_every_task_ends_in_one_row(results):
    tasks, converted = results
    got = {(r.client, r.op, r.url): r for r in converted.collect()}
    assert len(got) == tasks.count()
    text = got["c1", "ToText", "http://h/a.html"]
    assert (text.status, text.content, text.result) == ("done", "Tom & Al !", "DoneLocalIdc1a.htmlToText.txt")
    page = got["c1", "ToHTML", "http://h/a.html"].content
    assert page == (
        "<!DOCTYPE html>\n<html>\n<head>\n<title>PDF Page 1</title>\n</head>\n<body>\nTom & Al !\n</body>\n</html>"
    )
    errors = {k: r.error for k, r in got.items() if r.status == "error"}
    assert errors == {
        ("c1", "ToImage", "http://h/a.html"): "no page renderer for ToImage",
        ("c2", "ToText", "http://h/gone.pdf"): "not found: http://h/gone.pdf",
        ("c2", "ToText", "http://h/empty"): "empty document",
        ("c2", "ToMorse", "http://h/a.html"): "unknown operation ToMorse",
        ("c2", None, "http://h/a.html"): "unknown operation",
        ("c2", "ToText", None): "not found:",
    }
    assert all(got[k].result is None and got[k].content is None for k in errors)


def test_progress_counts_repeats_once(spark, results):
    tasks, converted = results
    twice = converted.unionByName(converted)
    got = {r.client: tuple(r)[1:] for r in client_progress(twice, tasks).collect()}
    assert got == {"c1": (3, 3, 1, True), "c2": (5, 5, 5, True)}
    some = client_progress(converted.where("op = 'ToHTML'"), tasks).collect()
    assert {r.client: (r.done, r.complete) for r in some} == {"c1": (1, False), "c2": (0, False)}


def test_repeated_lines_are_tasks_of_their_own(spark):
    pages = spark.createDataFrame([("u", "<p>a"), ("e", "")], "url string, html string")
    tasks = spark.createDataFrame([("c", "ToText", "u"), ("c", "ToText", "u"), ("c", "ToText", "e"), ("c", "ToText", "e"), ("d", None, "u")], TASKS)
    converted = convert(tasks, pages)
    got = {r.client: tuple(r)[1:] for r in client_progress(converted, tasks).collect()}
    assert got == {"c": (4, 4, 2, True), "d": (1, 1, 1, True)}
    late = converted.where("url = 'u'").limit(1).unionByName(converted.where("url = 'e'"))
    assert tuple(client_progress(late, tasks).where("client = 'c'").first())[1:] == (4, 3, 2, False)


def test_report_is_one_page_per_client(results, tmp_path):
    write_reports(report_lines(results[1]), str(tmp_path / "out"))
    parts = sorted((tmp_path / "out" / "client=c1").glob("part-*"))
    page = "".join(Path(p).read_text() for p in parts).splitlines()
    assert page[:6] == ["<!DOCTYPE html>", "<html>", "<head>", "<title>Document</title>", "</head>", "<body>"]
    assert page[6] == "<pre>" and page[-3:] == ["</pre>", "</body>", "</html>"]
    assert sorted(page[7:-3]) == [
        "ToHTML\thttp://h/a.html\tDoneLocalIdc1a.htmlToHTML.html",
        "ToImage\thttp://h/a.html\tno page renderer for ToImage",
        "ToText\thttp://h/a.html\tDoneLocalIdc1a.htmlToText.txt",
    ]
    assert (tmp_path / "out" / "client=c2").exists()


def test_names_and_text(spark):
    one = spark.range(1)
    url = F.lit("http://h/dir/a.pdf?x=1/")
    row = one.select(
        file_name(url).alias("name"),
        output_key(F.lit(3), url, F.lit("ToImage")).alias("image"),
        output_key(F.lit(3), url, F.lit("ToMorse")).alias("none"),
        html_to_text(F.lit("<P>a&lt;b&gt;&nbsp;&quot;c&quot; &#39;d&#39; &amp;lt;")).alias("text"),
    ).first()
    assert row.name == "a.pdf?x=1" and row.image == "DoneLocalId3a.pdf?x=1ToImage.jpg" and row.none is None
    assert row.text == "a<b> \"c\" 'd' &lt;"


def test_messages(spark):
    row = spark.range(1).select(decode(encode(F.lit(5), F.lit('op\t"u"\tré'))).alias("m"), decode(F.lit("{x")).alias("bad"))
    first = row.select("m.*", "bad.content").toDF("client", "content", "bad").first()
    assert tuple(first) == ("5", 'op\t"u"\tré', None)
    totals = spark.createDataFrame([("UPLOAD DONE-12",), ("UPLOAD DONE-",), ("op\tUPLOAD DONE-3\tx",)], "c string")
    assert [r[0] for r in totals.select(upload_total(F.col("c"))).collect()] == [12, None, None]


def test_nulls_keep_their_place_in_reports(results):
    lines = {r.line for r in report_lines(results[1]).where("client = 'c2' and section = 1").collect()}
    assert "\thttp://h/a.html\tunknown operation" in lines and "ToText\t\tnot found:" in lines


def test_pages_stored_twice_give_one_row_per_task(spark):
    pages = spark.createDataFrame([("u", "<p>b"), ("u", "<p>a"), ("v", "<p>c")], "url string, html string")
    tasks = spark.createDataFrame([("c", "ToText", "u"), ("c", "ToHTML", "u"), ("d", "ToText", "u")], TASKS)
    got = [(r.client, r.op, r.status) for r in convert(tasks, pages).collect()]
    assert sorted(got) == [("c", "ToHTML", "done"), ("c", "ToText", "done"), ("d", "ToText", "done")]
    assert {r.content for r in convert(tasks, pages).where("op = 'ToText'").collect()} == {"a"}


def test_markup_and_references(spark):
    cases = {
        '<a title="1 > 0">x</a>': "x",
        "<a title='>\"'>x</a>": "x",
        '<p class="open>x</p> y': "x y",
        "<!-- <script> --> a <!-- b > c -->d": "a d",
        "<SCRIPT>if (a < b) '<!--'</script >x<style>p > q</STYLE>y": "x y",
        "3 < 4 and 5 > 2": "3 2",
        "&amp;lt; &lt;&#60;&#x3c;&#X3C;": "&lt; <<<<",
        "&#233;&#x1F600;&#160;z": "é😀 z",
        "&unknown; &; & &amp &#0; &#xD800; &#1114112; a&b;c": "&unknown; &; & &amp &#0; &#xD800; &#1114112; a&b;c",
        "&apos;&quot;&nbsp;&gt;": "'\" >",
        "plain": "plain",
        "": "",
        "<p" + " a='b'" * 20_000 + ">x": "x",
    }
    table = spark.createDataFrame(list(cases.items()), "html string, text string")
    for r in table.select("html", "text", html_to_text(F.col("html")).alias("got")).collect():
        assert r.got == r.text, r.html[:80]
    assert spark.sql("select cast(null as string) as h").select(html_to_text(F.col("h"))).first()[0] is None
