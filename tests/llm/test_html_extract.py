import html
import re

import pytest

from panelforge.llm.html_extract import extract, main_text
from conftest import SF01


def article(page):
    """What stands between the article tags, read by the templates' own rules."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(b.replace("<br>", " ").replace("<b>", "")).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return " ".join(b for b in blocks if b)


def test_query_equals_the_templates_articles(spark):
    from __spark_entry__ import queries

    pages = {r.page_id: r for r in spark.read.parquet(f"{SF01}/pages.parquet").collect()}
    got = queries()["op6_html_extraction"](spark, SF01).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.url == pages[r.page_id].url and r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text)


BODY = "One, two, three long paragraph of the main article text, here it goes on."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), (" \n", ""), ("<html></html>", ""), ("<script>x</script>", ""), ("plain &amp;lt; \n text", "plain &lt; text"),
    (f"<body><div class='sidebar'><p>no, no, no</p></div><div id=content><h2>T</h2><p>{BODY}</p><p>Short.</p></div><div class='comments'><p>I disagree, strongly, very much, with all of it.</p></div>", f"T {BODY} Short."),
    (f"<header>h</header><article><header><h1>T &lt;x&gt;</h1></header><p>a<p>b<ul><li>c<li>d</ul><form>f</form><div class='ad-box'>{'<p>' + BODY}</div><section class='reader-comments'>c</section></article><footer>f", "T <x> a b c d"),
    (f"<article><p>{BODY}</p><div class='box-ad'>buy</div><aside>s</aside><div class=cookie-notice>ok</div><ol class='comment-list'><li>c</ol></article>", BODY),
    (f"<p>{BODY}</p><!-- <p>x</p> --><style>p{{}}</style><p>{BODY}", f"{BODY} {BODY}"),
    (f"<div><p>a<b>b</b>c &nbsp; d<br>e</p><p>{BODY}</p></div>", f"abc d e {BODY}"),
    (f"<nav><a href='/x'>{BODY}</a></nav><table><tr><td>{BODY}<td>x, y</table>", f"{BODY} x, y"),
    ("<article><p title='a > b'>t</p><script>if (a < b) '</p>'</script><p>u", "t u"),
    (f"<article><p>{BODY}</p><p class='tag-line'>A tagline, it is.</p><p class='alert-level x'>Level two.</p><h2 id=search-for-meaning>S</h2><p class='ad-box'>buy</p><p class=cookie-notice>ok</p><p class='user-comment'>c</p></article>",
     f"{BODY} A tagline, it is. Level two. S"),
    ("<main><p>in<textarea>no</textarea></p></main><p>out", "in"),
])
def test_pages(page, text):
    assert main_text(page) == text


def test_deep_long_and_broken_pages():
    assert main_text("<div>" * 20000 + "deep text") == "deep text"
    assert main_text("<" * 3000).startswith("<<")
    long = "<article>" + "".join(f"<p>p{i}, text &eacute;</p>" for i in range(20000))
    assert main_text(long) == " ".join(f"p{i}, text é" for i in range(20000))
    for broken in ("<p", "<p a='", "</p></div>x", "<!--", "<![CDATA[x", "<a b=c", "&#xD800;&#0;&bogus;", "<article", "<li><p><li></ul>y"):
        main_text(broken)


def test_table_cases(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "u", "<p>a", "y"), (None, "u", "", None)], "page_id long, url string, html string, text string")
    rows = sorted((tuple(r) for r in extract(df).collect()), key=str)
    assert rows == sorted([(1, None, "", 0), (1, "u", "a", 1), (None, "u", "", 0)], key=str)
    assert extract(df.limit(0)).collect() == []
