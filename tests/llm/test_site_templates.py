"""Main text of pages: the reader on odd markup, templates against a plain count, and the query against a plain reading of the test pages."""

import html as H
import re

import pyarrow.parquet as pq
import pytest

from merchlens.llm.site_templates import Page, main_text, op12_site_templates, site_templates
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("html, blocks", [
    ("", []),
    ("plain  text\n of a page", ["plain text of a page"]),
    ("<article><h1>A &amp;amp; B</h1><p><b>x\n y<br>z<p>next&nbsp;one</article>", ["A &amp; B", "x y z", "next one"]),
    ("<body><nav>n</nav><header>h</header><article>text</article><aside>s</aside><footer>f</footer>", ["text"]),
    ("<p>a<script>if (a<b) '</p>'</script> b<style>p{}</style><!-- c > --> d", ["a b d"]),
    ("<div class='main-ad'>x</div><div class='adapter'>y</div><div id=cookie-notice>z</div><p role=banner>r", ["y"]),
    ("<main><header><h1>Title</h1>by me</header>body<form>f<input></form></main>outside", ["Title", "body"]),
    ("<article><p>a<div class=comments><p>no</div>b<article>reply</article>c</article>", ["a", "b", "c"]),
    ("<article><p>one <span class=ad>buy</span> two <button>go</button> three", ["one two three"]),
    ("a < b <3 c<p title='1 > 0'>x<p title=\"open>y</p>", ["a < b <3 c", "x", "y"]),
    ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><td>3</table>", ["a", "b", "c", "d", "1", "2", "3"]),
    ("<p>unclosed <script>x", ["unclosed"]),
    ("<article></article>rest", []),
    ("<svg/>x<svg><path/><text>no</text></svg>y</p></b></x>z", ["xy", "z"]),
])
def test_blocks(html, blocks):
    assert Page(html).blocks == blocks


def page(i, host, body):
    return (i, f"https://{host}/p/{i}?q=1", f"<html><body>{body}</body></html>")


def test_repeated_subtrees_go_and_copied_pages_stay(spark):
    rows = [page(i, "A.example.com:80", f"<div><p>Read more of our site</p></div><p>page {i}</p><section><ul><li>x</ul></section>") for i in range(12)]
    rows += [page(100 + i, "b.example.com", "<p>the same page</p><p>many times</p>") for i in range(12)]  # copies: one page
    rows += [page(200 + i, "c.example.com", f"<article><p>quoted by all</p><p>{i}</p><ul><li>Share this</ul></article>") for i in range(12)]
    rows += [(300 + i, None, "<div>no host</div><p>%d" % i) for i in range(12)]
    rows += [(400, "/relative", None), (401, "https://d.example.com", ""), (None, None, None), (402, "https://e.example.com", "<p>" + "long " * 200000)]
    rows += rows[:1]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as nodes", "3 as key", "4 as text", "5 as n_cut")
    got = {}
    for x in main_text(df).collect():
        got.setdefault(x.page_id, []).append((x.url, x.text, x.n_chars, x.n_cut))
    assert got[0] == [(rows[0][1], "page 0", 6, 2)] * 2 and got[11][0][1] == "page 11"
    assert {got[100 + i][0][1] for i in range(12)} == {"the same page\n\nmany times"}
    assert [got[200 + i][0][1] for i in range(12)] == [f"quoted by all\n\n{i}" for i in range(12)]
    assert [got[300 + i][0][1] for i in range(12)] == [f"no host\n\n{i}" for i in range(12)]
    assert got[400] == [("/relative", "", 0, 0)] and got[401][0][1:3] == ("", 0) and got[None] == [(None, "", 0, 0)]
    assert got[402][0][2] == 200000 * 5 - 1
    counts = {(x.host, x.n_pages) for x in site_templates(df).collect()}
    assert {("a.example.com", 12), ("c.example.com", 12)} <= counts and not {h for h, _ in counts} & {"b.example.com", ""}
    assert main_text(df.filter("false")).count() == 0


def test_a_host_with_all_pages_is_dealt_over_keys(spark, monkeypatch):
    from merchlens.llm import site_templates as T

    monkeypatch.setattr(T, "HOT", 1 / 8)
    df = spark.createDataFrame([page(i, "hot.example.com", f"<div>menu of ours</div><p>{i}") for i in range(200)], "page_id long, url string, html string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {x.page_id: x.text for x in main_text(df).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: str(i) for i in range(200)}


def test_query_reads_the_articles(spark):
    want = {}
    for r in pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist():
        a = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        blocks = [" ".join(H.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", a)]
        text = "\n\n".join(b for b in blocks if b)
        want[r["page_id"]] = (r["url"], text, len(text))
    assert {x.page_id: (x.url, x.text, x.n_chars) for x in op12_site_templates(spark, SF_SMALL).collect()} == want
