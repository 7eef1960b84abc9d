from __future__ import annotations

import html as entities
import re
import time

import pytest
from pyspark.sql import functions as F

from eventmart.llm.html_density import _parse, composite_density, extract, main_text
from eventmart.llm.queries import QUERIES
from tests.conftest import SF_ORACLE

PROSE = "Plain words follow each other here, and a comma too, so that the paragraph is long enough to count as prose. "
MENU = '<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>'


def page(inner):
    return (f"<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style><script>var t='<p>no</p>';</script></head><body>{MENU}"
            f"<header><h1>Site name</h1></header><div class='cookie-notice'>{PROSE}</div>{inner}"
            f"<aside><p>{PROSE}</p></aside><footer>&copy; someone</footer></body></html>")


@pytest.mark.parametrize("inner,want", [
    ("<article><h1>Head</h1><p>Short.</p></article>", ["Head", "Short."]),
    (f"<article><h2>Head</h2><p>{PROSE}</p><div><p>x</p></div><section><p>{PROSE}</p></section></article>",
     ["Head", PROSE.strip(), "x", PROSE.strip()]),
    (f"<div id='content'><h2>Head</h2><p>{PROSE}</p><ul><li>one<li>two</ul></div><div class='comments'><p>{PROSE * 9}</p></div>",
     ["Head", PROSE.strip(), "one", "two"]),
    (f"<div><h2>Head</h2><p>{PROSE}</p><p>tiny</p></div><div class='sidebar-right'><p>{PROSE}</p></div>", ["Head", PROSE.strip(), "tiny"]),
    (f"<div class='wrap no-sidebar'><article class='post'><header><h2>Head</h2></header><p>{PROSE}</p>"
     f"<form><p>Sign up</p></form></article><section id='comments'><article class='comment'><p>{PROSE * 9}</p></article></section></div>",
     ["Head", PROSE.strip()]),
    (f"<form action='x'><article><p>{PROSE}</p></article><input value='v'><select><option>o</select></form>", [PROSE.strip()]),
    (f"<article><p><b>Bold {PROSE}<br><p>next&nbsp;&amp;\n\t line<br>end</article>", [f"Bold {PROSE.strip()}", "next & line end"]),
    ("<article>a<p>b</p>c<hr>d<!-- <p>no</p> -->e</article>", ["a", "b", "c", "de"]),
    (f"<article><table><tr><td>1<td>2<tr><td>{PROSE}</table></article>", ["1", "2", PROSE.strip()]),
    (f"<article><p>{PROSE}</p><p style='display: none'>unseen</p><p hidden>unseen</p><div class='ad'>buy</div></article>", [PROSE.strip()]),
])
def test_main_text_of_small_pages(inner, want):
    assert main_text(page(inner)) == "\n\n".join(want)


def test_cut_pages_stray_tags_and_plain_text():
    whole = page(f"<article><p>{PROSE}</p><p>{PROSE}</p></article>")
    assert main_text(whole[:whole.index("</article>")]) == "\n\n".join([PROSE.strip()] * 2)
    assert main_text(whole[:whole.index("</p></article>") - 10] + "<a hre").startswith(PROSE.strip())
    assert main_text("plain &lt;words\nonly") == "plain <words only"
    assert main_text("<p>a<p>b</i></div>") == "a\n\nb"
    assert main_text("<![foo[x]]><?php y ?><p>z &am &ampq; <3") == "z &am &q; <3"
    assert main_text("<b><p>x</b>y</p>") == "xy"
    assert [main_text(x) for x in (None, "", " \n", "<html></html>", "<script>x")] == [""] * 5
    assert main_text("<div class='ad'>all there is</div>") == "" and main_text("<div class='ad'><h1>x</h1></div>") == "x"


@pytest.mark.parametrize("part,times", [
    ("<!--", 200_000), ("<a ", 200_000), ("<div>", 100_000), ("<p><table>", 50_000), ("<!x", 200_000), ("<p><b>", 80_000), ("</ ", 200_000),
    ("<ul><li>", 50_000), ('<a "', 100_000), ("<i><div><b>", 30_000), ("</i>x", 100_000), ("word ", 600_000), ("&", 500_000), ("<", 500_000)])
def test_long_and_hostile_pages_take_linear_time(part, times):
    start = time.monotonic()
    main_text("<i><div>" + part * times + "</i>" * 1000 + ">")
    assert time.monotonic() - start < 10


def test_densities():
    assert composite_density(0, 3, 0, 0, 10, 0) == 0
    assert composite_density(100, 0, 100, 1, 1000, 100) < composite_density(100, 1, 20, 1, 1000, 100) < composite_density(100, 1, 0, 0, 1000, 100)
    assert composite_density(200, 2, 0, 0, 1000, 0) < composite_density(200, 1, 0, 0, 1000, 0)
    tree = _parse("<body><div><p>a</p></div>")
    assert tree.tag[1:] == ["body", "div", "p"] and tree.parent[1:] == [0, 1, 2]


def test_query_takes_the_article_of_every_page(spark):
    rows = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, SF_ORACLE).collect()}
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        article = re.search("<article>(.*?)(</article>|$)", p.html, re.S).group(1)
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", article)]
        got = rows[p.page_id]
        assert got.text == "\n\n".join(b for b in blocks if b) and got.n_chars == len(got.text) and got.url == p.url


def test_frames_with_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None), (1, "<p>a"), (1, "<p>a"), (None, ""), (2, "<p>𝒳é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit(1)).withColumn("main_text", F.lit("kept"))
    out = extract(pages)
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.main_text) for r in out.collect()) == [
        (0, "", 0, "kept"), (1, "", 0, "kept"), (1, "a", 1, "kept"), (1, "a", 1, "kept"), (2, "𝒳é", 2, "kept")]
    assert extract(pages.limit(0)).count() == 0
