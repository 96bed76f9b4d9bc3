"""Markdown, addresses and snapshots of pages, on fixtures written by hand and on the given pages."""

import html as escapes
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from quarrylight.functions import urls
from quarrylight.functions.markdown import of_html
from quarrylight.operators import snapshots, web

BASE = "https://site.org/a/b.html"

FIXTURES = [
    ("<h1>A  <b>b</b></h1><p>x <a href='c?d#e' title='T'>y</a> z<br>w<p>q", '# A **b**\n\nx [y](https://site.org/a/c?d "T") z  \nw\n\nq\n'),
    ("<ul><li>a<ul><li>b</li><li>c<ol><li>d</ol></ul></li><li><p>e</p><p>f</p></li></ul>", "- a\n  - b\n  - c\n    1. d\n- e\n\n  f\n"),
    ("<ol start=9><li>x<li>y</ol>", "9. x\n10. y\n"),
    ("<pre><code>x *y*\n  z&lt;</code></pre>", "```\nx *y*\n  z<\n```\n"),
    ("<pre>a ``` b</pre>", "````\na ``` b\n````\n"),
    ("<blockquote><p>a</p><ul><li>b</ul></blockquote>", "> a\n>\n> - b\n"),
    ("<table><thead><tr><th>a<th>b|c</thead><tbody><tr><td>1<td><b>2</b><br>3</table>", "| a | b\\|c |\n| --- | --- |\n| 1 | **2** 3 |\n"),
    ("a*b_c [x] <em> e </em>. <code>a`b*</code> <s>no</s>", "a\\*b\\_c \\[x\\] *e* . ``a`b*`` ~~no~~\n"),
    ("<img src='../i.png' alt='An  I'><img alt=only><img src=data:x alt=y>", "![An I](https://site.org/i.png)onlyy\n"),
    ("<a href='https://x.org/y'>https://x.org/y</a> <a href='mailto:a@b'>m</a> <a>n</a> <a href='/e'> </a>", "<https://x.org/y> m n\n"),
    ("<p>a<script>b</script><style>c</style>d<noscript>e</noscript><template>f</template></p><!-- g -->", "ad\n"),
    ("<html><head><title>T</title><body>B &amp; C", "B & C\n"),
    ("<a href=/q>in <p>block</p></a> after", "[in](https://site.org/q)\n\nblock\n\nafter\n"),
    ("<div>t<div>u</div>v</div><hr>w", "t\n\nu\n\nv\n\n---\n\nw\n"),
    ("<li>lone</li></ul></b>", "lone\n"),
    ("<h2></h2><p> </p><ul></ul><table></table>", ""),
    ("", ""),
    (None, ""),
]


@pytest.mark.parametrize("page,want", FIXTURES)
def test_markdown_of_fixtures(page, want):
    assert of_html(page, BASE) == want


def test_deep_pages_take_linear_time():
    for part in ("<div>x", "<ul><li>y", "<b>z", "<table><tr><td>q", "<blockquote>q", "<x1><p>", "</q>"):
        began = time.process_time()
        assert len(of_html(part * 20_000, BASE)) < 5_000_000
        assert time.process_time() - began < 10, part


def test_text_survives_any_nesting():
    rng = random.Random(4)
    tags = "div p ul li ol blockquote b i a table tr td section h2 pre span".split()
    for _ in range(300):
        words, page, opened = [], "", []
        for n in range(rng.randint(1, 25)):
            if rng.random() < 0.5:
                t = rng.choice(tags)
                page += f"<{t}>"
                opened.append(t)
            elif opened and rng.random() < 0.5:
                page += f"</{opened.pop(rng.randrange(len(opened)))}>"
            words.append(f"w{n}x")
            page += f" w{n}x "
        assert sorted(re.findall(r"w\d+x", of_html(page, BASE))) == sorted(words), page


def test_addresses():
    assert [urls.absolute(r, BASE) for r in ("c", "/c#d", "../c", "//o.org/x", "?q=1", "mailto:x@y", "javascript:1", "http://[bad", " https://o.org ")] == [
        "https://site.org/a/c", "https://site.org/c", "https://site.org/c", "https://o.org/x", "https://site.org/a/b.html?q=1", None, None, None, "https://o.org",
    ]


def test_addresses_that_are_none_go_apart(spark):
    rows = spark.createDataFrame([(1, " https://a.org/x "), (2, "ftp://a"), (3, None), (4, "http://"), (5, "HTTP://B.org"), (6, "/x"), (7, "")], "id int, url string")
    good, bad = urls.http_only(rows, "url")
    assert sorted((r.id, r.url) for r in good.collect()) == [(1, "https://a.org/x"), (5, "HTTP://B.org")] and sorted(r.id for r in bad.collect()) == [2, 3, 4, 6, 7]


def test_snapshots_of_html(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    made = {r.page_id: r for r in snapshots.of_html(pages).collect()}
    links = {}
    for r in web.links(pages).collect():
        links.setdefault(r.page_id, set()).add((r.target, r.internal))
    inside = re.compile(r"(?<!!)\[(?:[^\]\\]|\\.)*\]\(([^)\s]+)(?: \"[^\"]*\")?\)|<(https?://[^>]+)>")
    for r in pages.collect():
        got = made[r.page_id]
        assert {(u, True) for u in got.links_internal} | {(u, False) for u in got.links_external} == links.get(r.page_id, set())
        assert {m[1] or m[2] for m in inside.finditer(got.markdown)} == {u for u, _ in links.get(r.page_id, set())}
        plain = re.sub(r"(?is)<(script|style|title)[^>]*>.*?</\1>|<!--.*?-->", " ", r.html)
        words = re.findall(r"\w+", escapes.unescape(re.sub(r"<[^>]*>", " ", plain)))
        assert re.findall(r"\w+", re.sub(r"\]\([^)]*\)|[*_`#\\]|<https?://[^>]*>", " ", got.markdown)) == words or any("_" in w for w in words)


def test_snapshots_of_odd_pages(spark):
    rows = [(1, "https://h.org/p", '<meta name="description" content="D"><h1>First</h1><img src="i.png"><img src="i.png"><a href=\'x#y\'>t</a>'), (2, None, "<p>a</p><a href='/x'>y</a>"), (3, "https://h.org", None), (3, "https://h.org", "")]
    got = snapshots.of_html(spark.createDataFrame(rows, "page_id long, url string, html string")).orderBy("page_id").collect()
    assert (got[0].title, got[0].description, got[0].images, got[0].links_internal) == ("First", "D", ["https://h.org/i.png"], ["https://h.org/x"])
    assert got[1].markdown == "a\n\ny\n" and got[1].links_internal == [] and [len(r.markdown.strip()) for r in got[2:]] == [0, 0]


def test_payloads_of_both_services(spark):
    flat = {"markdown": "# Head\r\ntext", "links": ["/docs", "https://o.org/x#f", "mailto:a@b", 3, {"url": "/docs"}], "images": ["/hero.png"], "metadata": {"url": "https://e.org/final", "status_code": 200, "description": "d", "extra": [1]}}
    deep = {"markdown": {"raw_markdown": "# Raw", "fit_markdown": "# Fit"}, "metadata": {"title": "Page"}, "links": {"internal": [{"href": "https://e.org/a"}, {"href": "https://e.org/a"}, {"text": "x"}], "external": []}, "media": {"images": [{"src": "https://e.org/i.png"}]}, "redirected_url": "https://e.org/r", "url": "https://e.org/s", "status_code": 200}
    rows = [
        (1, "firecrawl", "https://e.org/start", json.dumps(flat)),
        (2, "crawl4ai", "https://e.org/start", json.dumps(deep)),
        (3, "crawl4ai", "https://e.org/start", json.dumps({"markdown": "plain text", "metadata": None, "links": None})),
        (4, "firecrawl", "https://e.org/start", json.dumps({"markdown": "x", "metadata": {"status_code": 404}})),
        (5, "firecrawl", "s", "{broken"),
        (6, "other", "s", "{}"),
        (7, None, "s", "{}"),
        (8, "firecrawl", "s", None),
        (9, "firecrawl", "s", json.dumps({"markdown": {"raw_markdown": "x"}})),
        (10, "firecrawl", "s", "[1]"),
    ]
    good, apart = snapshots.of_payloads(spark.createDataFrame(rows, "page_id long, provider string, source_url string, payload string"))
    got = {r.page_id: r for r in good.collect()}
    assert (got[1].url, got[1].title, got[1].description, got[1].status, got[1].markdown) == ("https://e.org/final", "Head", "d", 200, "# Head\ntext\n")
    assert (got[1].links_internal, got[1].links_external, got[1].images) == (["https://e.org/docs"], ["https://o.org/x"], ["https://e.org/hero.png"])
    assert (got[2].url, got[2].title, got[2].markdown, got[2].links_internal, got[2].links_external) == ("https://e.org/r", "Page", "# Fit\n", ["https://e.org/a"], [])
    assert (got[3].url, got[3].markdown, got[3].title, got[3].images) == ("https://e.org/start", "plain text\n", None, [])
    assert {r.page_id: r.reason for r in apart.collect()} == {4: "status 404", 5: "unreadable", 6: "unknown provider", 7: "unknown provider", 8: "unreadable", 9: "no markdown", 10: "no markdown"}
    assert apart.where("page_id = 5").first().payload == "{broken"


def test_empty_tables(spark):
    good, apart = snapshots.of_payloads(spark.createDataFrame([], "page_id long, provider string, source_url string, payload string"))
    assert good.count() == apart.count() == 0
    assert snapshots.of_html(spark.range(0).select(F.col("id").alias("page_id"), F.lit("").alias("url"), F.lit("").alias("html"))).count() == 0
