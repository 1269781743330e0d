"""Main text of pages: planted articles in pages of different make."""

import html
import re

import pytest
from pyspark.sql import functions as F

from lokum.llm import main_text
from lokum.llm.main_text import main_text as text_of

SF = "/root/testdata/sf0.01"
P = ["The first paragraph of the piece is long enough to be told from the menus around it.", "Short one.",
     "A third paragraph follows, with a few more words than the second, and it ends here.", "End."]
ARTICLE = "<h1>Title here</h1>" + "".join(f"<p>{p}</p>" for p in P)
WANT = "\n".join(["Title here", *P])
MENU = "<ul>" + "".join(f'<li><a href="/{k}">Menu entry {k}</a></li>' for k in range(8)) + "</ul>"


@pytest.mark.parametrize("page", [
    f"<html><head><title>No</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{ARTICLE}</article>"
    f"<footer>&copy; me and all the others who wrote this page in the long years of its making</footer></body></html>",
    f"<body><header><h2>Site name</h2>{MENU}</header><main>{ARTICLE}</main><aside>{P[0]}</aside>",
    f"<div class='main-nav'>{MENU}</div><div id=content>{ARTICLE}</div><div class=footer>{P[0]}</div>",
    f"<table><tr><td>{MENU}</td></tr></table><div>{ARTICLE}</div><script>var a='<p>{P[0]}</p>';</script>",
    f"<article>{ARTICLE}<div class='ad-slot'>{P[0]}</div><section id='comments'><article>{P[2]}</article></section>"
    f"</article>",
    f"<article><header><h1>Title here</h1></header><p>{P[0]}<p>{P[1]}<form><p>{P[2]}<input></form><p>{P[2]}"
    f"<div class=cookieNotice>{P[0]}</div><p>{P[3]}",
    f"<body class='no-sidebar has-comments'><article class='post'>{ARTICLE}</article><!-- <p>{P[0]}</p> -->",
    f"<BODY><ARTICLE>{ARTICLE.upper().replace('TITLE HERE', 'Title here')}".replace(P[0].upper(), P[0])
    .replace(P[1].upper(), P[1]).replace(P[2].upper(), P[2]).replace(P[3].upper(), P[3]),
])
def test_planted_article(page):
    assert text_of(page) == WANT


def test_references_white_space_and_broken_markup():
    assert text_of("<article><p>a &lt;b&gt; &amp;amp; &#65;\n\t &eacute; x &amp") == "a <b> &amp; A é x &"
    assert text_of("<article><p>one<br>two<b>three</b> <i>four</i><p>five</article>") == "one twothree four\nfive"
    assert text_of('<article><p title="a>b">x</p></p></b><p>y < z</article><p') == "x\ny < z"
    assert text_of("<article><p>x<script>never closed <p>gone") == "x"
    assert text_of("<p>Only this.</p>") == "Only this."


def test_empty_and_deep():
    for page in (None, "", " \n ", "<html></html>", "<nav><a>menu</a></nav>", "<!-- x"):
        assert text_of(page) == ""
    assert text_of("<div>" * 50_000 + "<p>deep</p>" + "</div>" * 50_000) == "deep"
    assert text_of("<article>" + "<p>a</p>" * 20_000 + "</article>") == "\n".join("a" * 20_000)


def planted(page):
    """The article of the test tables, by their own layout."""
    inner = re.search("<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split("</?(?:p|h1)>", inner)
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = {r.page_id: r for r in pages.collect()}
    for c in ("text", "n_chars", "a b"):
        pages = pages.withColumn(c, F.lit("extra"))
    pages = pages.unionByName(pages.limit(1).withColumn("page_id", F.lit(None).cast("long"))
                              .withColumn("html", F.lit(None).cast("string")))
    got = main_text.extract(pages).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert r.n_chars == len(r.text)
        assert r.text == (planted(rows[r.page_id].html) if r.page_id is not None else "")
    assert main_text.extract(pages.limit(0)).count() == 0
