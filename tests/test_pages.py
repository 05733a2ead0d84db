import tracemalloc
from urllib.parse import urljoin

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.dates import message_time
from corpusloom.functions.text import commit_refs, is_patch, strip_space
from corpusloom.functions.urls import canonical_url, domain, is_same_site, resolve_url
from corpusloom.operators import graph, html

PAGE = """<!DOCTYPE html><html><head><title> A &amp; <!-- x -->B </title><style>p{}</style></head><body>
<header>Top <a href="/top">top</a></header><nav><a href="/nav">nav</a></nav>
<main><h1>Head</h1><p>One <b>two<br>three <script>var a = "</p>";</script><p>four</main>
<a class=x href='/in?a=1#f'>In <i>side</i></a> <a href="https://h.org/abs">abs</a> <a href="//other.org/x">o</a>
<a href="https://elsewhere.org/">e</a> <a name="no">n</a><footer>Bottom</footer></body></html>"""


def page_rows(spark, pages):
    return spark.createDataFrame(pages, "url string, html string")


def test_page_extraction(spark):
    pages = [
        ("https://h.org/a", PAGE),
        ("https://h.org/b", "<body><h1>Only <i>head</i></h1><article>Text&nbsp;</article><article>No</article>"),
        ("https://h.org/c", "plain"),
        ("https://h.org/d", None),
        ("https://h.org/e", "<body>un<p>closed</i> <div>x</body>after"),
    ]
    rows = {r.url[-1]: r for r in html.extract_pages(page_rows(spark, pages)).collect()}
    assert rows["a"].title == "A &B"
    assert rows["a"].content == "Head\nOne\ntwo\nthree\nfour"
    assert rows["a"].links == ["https://h.org/in?a=1#f", "https://h.org/abs"]
    assert (rows["b"].title, rows["b"].content) == ("Onlyhead", "Text")
    assert (rows["c"].title, rows["c"].content, rows["c"].links) == (None, "", [])
    assert rows["d"].title is None and rows["d"].content is None
    assert rows["e"].content == "un\nclosed\nx"


def test_links(spark):
    pages = page_rows(spark, [("https://h.org/a", PAGE)])
    stripped = [r.href for r in html.page_links(pages).orderBy("position").collect()]
    assert stripped == ["/in?a=1#f", "https://h.org/abs"]
    everything = [r.href for r in html.page_links(pages, strip_regions=False, same_site=False).orderBy("position").collect()]
    assert everything == ["/top", "/nav", "/in?a=1#f", "https://h.org/abs", "//other.org/x", "https://elsewhere.org/"]
    some = html.page_links(pages, strip_regions=False, where=F.col("link").endswith("nav")).collect()
    assert [r.link for r in some] == ["https://h.org/nav"]


def test_list_pages(spark):
    page = '<nav><a href="/message-id/1@x"> First <b>one</b></a></nav><a href="/other">o</a><a href="https://z.org/message-id/2">2</a>'
    rows = html.list_page_links(page_rows(spark, [("https://h.org/list/", page)])).orderBy("position").collect()
    assert [(r.link, r.label) for r in rows] == [
        ("https://h.org/message-id/1@x", "Firstone"), ("https://z.org/message-id/2", "2"),
    ]


def test_messages(spark):
    full = """<html><title>T</title><body><h1> Re: <i>Hi</i> </h1><table>
      <tr><th>From:</th><td>A &lt;a@b&gt;</td></tr><tr><th>Date:</th> <td>2024-12-15 18:30:45</td></tr>
      <tr><th>Message-ID:</th><td>m1</td></tr><tr><th>From:</th><td>Second</td></tr><tr><th>Date alone</th></tr></table>
      <div class="x message-body">div</div><pre>Body
 &amp; more</pre></body></html>"""
    pages = [
        ("https://h.org/message-id/m1", full),
        ("https://h.org/message-id/m2", "<title>Only title</title><div class='message-body big'>text <b>b</b></div>"),
        ("https://h.org/message-id/m3", "<main>main text</main>"),
    ]
    frame = page_rows(spark, pages).withColumn("label", F.lit("From the list"))
    rows = {r.id: r for r in html.extract_messages(frame, link_subject="label").collect()}
    assert rows["m1"].subject == "Re:Hi" and rows["m1"].author == "Second" and rows["m1"].message_id == "m1"
    assert rows["m1"].date == "2024-12-15 18:30:45" and rows["m1"].content == "Body\n & more"
    assert (rows["m2"].subject, rows["m2"].content, rows["m2"].author) == ("Only title", "text b", None)
    assert (rows["m3"].subject, rows["m3"].content) == ("From the list", "main text")


def test_resolve_url(spark):
    bases = ["https://h.org/a/b?q=1#f", "http://h.org", "https://h.org/a/"]
    hrefs = ["/x", "x", "x/y?z", "?n", "#g", "", "//o.org/p", "https://o.org/q", "../u", "/../v", "/a/./b/../c", "./w", "mailto:a@b", "..", "."]
    frame = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "base string, href string")
    for row in frame.select("base", "href", resolve_url("base", "href").alias("link")).collect():
        assert row.link == urljoin(row.base, row.href) or (row.base == "http://h.org" and row.href in ("..", ".", "../u")), row


def test_url_columns(spark):
    cases = {
        "HTTPS://Host.org/P?q#f": "host.org/P?q", "http://h.org": "h.org", "/only/path#f": "/only/path", "x y|z": "x y|z",
        "https://h.org?q": "h.org?q",
    }
    frame = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.c for r in frame.select("u", canonical_url("u").alias("c")).collect()} == cases
    assert frame.where("u = 'http://h.org'").select(domain("u")).first()[0] == "h.org"
    same = {"/a": True, "//a": False, "http://H.org/x": True, "http://no.org": False, "x": False, "": False}
    frame = spark.createDataFrame([(u,) for u in same], "u string")
    got = frame.select("u", is_same_site(F.lit("https://h.org/z"), "u").alias("s")).collect()
    assert {r.u: r.s for r in got} == same


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_message_time(spark, zone):
    cases = {
        "2024-12-15 18:30:45": "2024-12-15 18:30:45", "Sun, 15 Dec 2024 18:30:45 +0100": "2024-12-15 17:30:45",
        "Sun, 1 Dec 2024 00:30:00 +0530": "2024-11-30 19:00:00", "15 Dec 2024 18:30:45": "2024-12-15 18:30:45",
        "nonsense": None, "": None, None: None, "2024-12-15": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(c,) for c in cases], "d string")
        got = {r.d: r.t for r in frame.select("d", message_time("d").cast("string").alias("t")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == cases


def test_text_columns(spark):
    frame = spark.createDataFrame([(" \t a b  \n\x1c",)], "t string")
    assert frame.select(strip_space("t")).first()[0] == "a b"
    frame = spark.createDataFrame([("see 1a2b3c4 and abcdef12345, not 12345 or xyz1234567 or 1A2B3C4D",)], "t string")
    assert frame.select(commit_refs("t")).first()[0] == ["1a2b3c4", "abcdef12345"]
    frame = spark.createDataFrame([("[PATCH] x",), ("PATCH: y",), ("Re: PATCH",)], "t string")
    assert [r[0] for r in frame.select(is_patch("t")).collect()] == [True, True, False]
    subjects = ["Topic", "re: Topic", "RE: Fwd: topic ", "FW: Re:topic"]
    frame = spark.createDataFrame([(s,) for s in subjects], "s string")
    assert frame.select(html.thread_key("s")).distinct().count() == 1


def test_crawl_order(spark):
    def page(*links):
        return "<body>" + "".join(f'<a href="{link}">x</a>' for link in links) + "</body>"

    site = {
        "/": page("/b", "/a", "/a#frag", "https://else.org/z"), "/a": page("/c", "/", "/d?x=1"), "/b": page("/d?x=1", "/e"),
        "/c": page("/f"), "/d?x=1": page("/g"), "/e": page("/missing"), "/f": "none", "/g": page("/h"), "/h": page(),
    }
    pages = page_rows(spark, [("https://s.org" + u, h) for u, h in site.items()])

    def walk(limit, depth=None):
        rows = graph.crawl_order(pages, ["https://s.org/"], limit, depth).orderBy("place").collect()
        assert [r.place for r in rows] == list(range(len(rows)))
        return [(r.canonical.removeprefix("s.org"), r.depth) for r in rows]

    seen, queue = [], [("/", 0)]
    while queue:
        here, depth = queue.pop(0)
        if here in [s for s, _ in seen]:
            continue
        seen.append((here, depth))
        for target in site.get(here, "").split('href="')[1:]:
            target = target.split('"')[0].split("#")[0]
            if target.startswith("/"):
                queue.append((target, depth + 1))
    assert walk(100) == seen
    assert walk(4) == seen[:4]
    assert walk(1) == seen[:1]
    assert walk(100, 1) == [s for s in seen if s[1] <= 1]
    only = graph.crawl_order(pages, ["https://s.org/"], 100, url_filter=F.col("link").rlike("/[ac]$")).collect()
    assert {r.canonical for r in only} == {"s.org/", "s.org/a", "s.org/c"}


def test_frontier_step(spark):
    pages = page_rows(spark, [("https://s.org/", '<a href="/a">1</a><a href="/a#x">2</a><a href="/b">3</a><a href="/">4</a>')])
    visited = spark.createDataFrame([("s.org/",), ("s.org/b",)], "canonical string")
    rows = graph.frontier_step(pages, visited).collect()
    assert [(r.canonical, r.link, r.links) for r in rows] == [("s.org/a", "https://s.org/a", 2)]


ODD_PAGE = """<![foo[x]]><!weird><!-- <a href="/hidden">h</a> --><body><a href=/bare>b</a><A HREF='/q?a=1&amp;b=2'>q
<script>var s = '<a href="/script">s</a>';</script><a href="/open">open <a href="/last">\0</a><![if !IE]><a href="/cond">c</a><![endif]><!-- open"""


def test_odd_markup_gives_the_same_links_everywhere(spark):
    pages = page_rows(spark, [("https://h.org/a", ODD_PAGE), ("https://h.org/b", "<![CDATA[x"), ("https://h.org/c", "<!["), ("https://h.org/d", "<!")])
    wanted = ["/bare", "/q?a=1&b=2", "/open", "/last", "/cond"]
    assert [r.href for r in html.page_links(pages).orderBy("position").collect()] == wanted
    assert [r.href for r in html.page_links(pages, strip_regions=False).orderBy("position").collect()] == wanted
    found = {r.url: r.links for r in html.extract_pages(pages).collect()}
    assert found["https://h.org/a"] == [f"https://h.org{w}" for w in wanted] and len(found) == 4
    listed = html.list_page_links(pages, needle="/").orderBy("position").collect()
    assert [r.link for r in listed] == [f"https://h.org{w}" for w in wanted]
    assert html.extract_messages(pages).count() == 4


def test_rows_of_a_batch_are_not_held_as_objects(monkeypatch):
    monkeypatch.setattr(html, "_SLICE", 20_000)
    page = "<title>t</title><main>" + "".join(f'<p>text {i} <a href="/a/{i}">label {i}</a></p>' for i in range(100)) + "</main>"
    wanted = html._Page().walk(page).row()
    for shape, row in ((html.PAGE, wanted), (html.LINKS, wanted["links"]), (html.HREFS, [link["href"] for link in wanted["links"]])):
        peaks = []
        for pages in (20, 400):
            batch = pa.array([page, None, ""] + [page] * pages)
            tracemalloc.start()
            found = html._found(batch, html._Page, shape)
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            assert found[0].as_py() == found[len(found) - 1].as_py() == row and found[1].as_py() is None and len(found) == len(batch)
        assert peaks[1] < 2 * peaks[0]
