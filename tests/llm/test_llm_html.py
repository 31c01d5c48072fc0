"""Main texts of web pages: hand-made pages, random ones whose article is known, and the given table."""

from __future__ import annotations

import html
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sharemill.llm.html_extraction import main_text, main_texts, smoothed
from sharemill.llm.queries import QUERIES

BODY = "<p>A first paragraph of the article, long enough to look like one, with a few commas.</p><p>Short.</p><p>Another long paragraph that says what the article is about, <b>bold</b> and <a href='/x'>linked</a>.</p>"
TEXT = "A first paragraph of the article, long enough to look like one, with a few commas.\nShort.\nAnother long paragraph that says what the article is about, bold and linked."
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>Sports</a></li><li><a href='/d'>About us</a></li></ul>"


@pytest.mark.parametrize(
    "page, expected",
    [
        (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("plain  text\nonly", "plain text only"), ("a < b &amp; c", "a < b & c"),
        (f"<body><nav>{MENU}</nav><article><h1>Title</h1>{BODY}</article><footer>Imprint</footer></body>", f"Title\n{TEXT}"),
        (f"<body><div class='site-header'>Logo</div>{MENU}<div id='content'>{BODY}</div><div class='sidebar'><p>{'Other things to read here. ' * 9}</p></div></body>", TEXT),
        (f"<body><header><h1>Site</h1></header><main><header><h1>Title</h1></header>{BODY}<section id='comments'><h2>3 comments</h2><article class='comment'><p>{'I agree. ' * 40}</p></article></section></main></body>", f"Title\n{TEXT}"),
        (f"<article>{BODY}<h3>Leave a reply</h3><p>Nice one</p></article>", TEXT),
        (f"<article>{BODY}<div><h3>Comments</h3><p>Nice one</p></div></article>", TEXT),
        (f"<article><h2>Comments</h2>{BODY}</article>", f"Comments\n{TEXT}"),
        (f"<form id='page'><div class='cookie-notice'>We use cookies</div><article>{BODY}</article><form><label>Mail</label><input></form></form>", TEXT),
        (f"<body class='no-sidebar'><aside>x</aside><article class='with-comments'>{BODY}<footer>By the author</footer></article></body>", TEXT),
        (f"<div class='ad'>Buy<article>{BODY}</article>", TEXT),
        (f"<nav><ul><li>Menu<article>{BODY}</article><p>after", TEXT),
        (f"<article>{BODY}<script>var t = '<p>no</p>';</script><style>p{{}}</style><!-- no --></article>", TEXT),
        ("<article><p>one<script>x</script> two <button>Share</button>three<br>four</p><table><tr><td>a<td>b</table></article>", "one two three four\na\nb"),
        ("<article><p>&lt;b&gt; &amp;amp; &#8364;&nbsp;5 &eacute;</p></article>", "<b> &amp; € 5 é"),
        ("<p>one<p>two</div></p><li>three", "one\ntwo\nthree"), ("<article><p>open <b>text", "open text"), ("<article><p>text</p><a href='x", "text"),
        ("<article><p>a</p><![CDATA[ x ]]><![if IE]><p>b</p><!-- never closed <p>c</p></article>", "a\nb\nc"),
        ("<article><div hidden>no</div><p style='display: none'>no</p><p>yes</p></article>", "yes"),
        (f"<table><tr><td>{MENU}</td><td><div>{BODY}</div></td></tr></table>", TEXT),
        (f"<article>{BODY}<section id='cookies'><p>About cookies</p></section></article>", f"{TEXT}\nAbout cookies"),
        ("<div class='comments'><h1>Only this</h1><p>is left</p></div>", "Only this\nis left"),
    ],
)
def test_pages(page, expected):
    assert main_text(page) == expected


def test_smoothing():
    assert smoothed(smoothed(pytest.importorskip("numpy").ones(7))) == pytest.approx([1] * 7)
    assert smoothed(pytest.importorskip("numpy").array([0.0, 0, 9, 0, 0])).argmax() == 2


WORDS = st.lists(st.sampled_from(["word", "other", "Größe", "a", "<", "&", "&amp;", " ", "\n", "x" * 30]), min_size=1, max_size=40).map(" ".join)
NOISE = st.sampled_from(["", f"<nav>{MENU}</nav>", "<div class='ad'>Buy this now</div>", "<aside><p>Read more of this</p></aside>", "<!-- ad -->", "<script>if (a<b) '</p>'</script>", "<div id='cookie-banner'>We use cookies</div>", "<form><label>Name</label></form>"])
INSIDE = st.sampled_from(["", "<!-- x -->", "<script>'<p>'</script>", "<div class='share-buttons'><a href=x>Share</a></div>", "<figure><img src=x></figure>", "<div class='advert'>Buy</div>"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(WORDS, st.sampled_from(["<p>{}</p>", "<p><b>{}<br>", "<h2>{}</h2>", "<p>{}<p>", "<div>{}</div>", "<ul><li>{}</li></ul>"]), INSIDE), min_size=1, max_size=12), st.lists(NOISE, max_size=4), st.lists(NOISE, max_size=4), st.sampled_from(["article", "main"]))
def test_random_articles(blocks, before, after, tag):
    article = "".join(form.format(html.escape(text)) + more for text, form, more in blocks)
    expected = [" ".join(text.split()) for text, _, _ in blocks]
    page = f"<!DOCTYPE html><html><head><title>t</title></head><body>{''.join(before)}<{tag}>{article}</{tag}>{''.join(after)}</body>"
    assert main_text(page) == "\n".join(x for x in expected if x)


def test_malformed_pages_take_no_quadratic_time():
    start = time.perf_counter()
    for piece in ("<!--", "<a ", "<a href='", "<![CDATA[", "<div class=ad>x", "<!-- x>", "</", "&#", "<p><b><li>", "<svg>"):
        main_text(piece * 20_000), main_text(piece * 20_000 + ">")
    assert time.perf_counter() - start < 60


def test_rows_stay(spark):
    rows = [(1, "u", f"<article>{BODY}</article>", 1), (1, "u", f"<article>{BODY}</article>", 1), (None, None, None, 2), (2, "v", "", 3), (3, "w", f"<article><p>{'word ' * 400_000}</p></article>", 4)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    result = main_texts(pages)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema] == ["page_id bigint", "url string", "text string", "n_chars bigint"]
    found = sorted(((r["page_id"] or 0), r["url"], len(r["text"]), r["n_chars"]) for r in result.collect())
    assert found == [(0, None, 0, 0), (1, "u", len(TEXT), len(TEXT)), (1, "u", len(TEXT), len(TEXT)), (2, "v", 0, 0), (3, "w", 1_999_999, 1_999_999)]
    assert main_texts(pages.limit(0)).collect() == []


def test_table(spark, sf_dir):
    """Against a search by patterns, which the given pages are regular enough for."""
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op13_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        page = pages[row["page_id"]]
        article = re.search("<article>(.*?)</article>", page["html"], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"]) and row["url"] == page["url"]
