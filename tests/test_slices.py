"""Cards by slices of pages against the walker, and what is worked out only where a
row lacks it."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lokum.operators import extract_html as X
from lokum.operators import extract_json as XJ
from lokum.operators import html_batch as B
from lokum.operators import html_dom as H
from lokum.operators import page_rules as R
from lokum.plans import cards as CD

AS_OF = dt.datetime(1999, 1, 1)
TAGS = ['<div data-cy="l-card">', '<a href="/d/oferta/x-ID%d.html?s=%d">', '<a class="property-card" href="/oferta/m-%d">',
        '<a class="offert-box-ctn-link" href="/oferta/%d/">', '<a href="#">', "<a href>", "<a>", "<p>",
        '<p data-testid="ad-price">', "<h6>", "<h2>", "<span>", "<strong>", '<div class="items-center">',
        "<div data-offer-card>", '<div class="result-item">', '<div class="tertiary">', '<div class="tertiary__box">',
        '<p class="x province">', '<span class="area">', '<div class="card__outer">', '<div class="offert">', "<address>",
        '<div class="price">', '<div class="details">', '<div class="bottom">', "<small>", "<br>", "<br/>", "<li>"]
TEXTS = ["", "", " ", "a", "12 zł", " b ", "x &amp; y", "&nbsp;", "\x1c", "a > b", "ą"]
ODD = ["</p>", "</div>", "<!-- c -->", "<", "</br>", '<a href="/oferta/&amp;1">']


def _page(rnd: random.Random) -> str:
    out, stack, mess = [], [], rnd.random()
    for _ in range(rnd.randrange(60)):
        text = rnd.choice(TEXTS)
        out.append("t" if text == "a > b" and mess > .3 else text)
        if stack and rnd.random() < .5:
            out.append(f"</{stack.pop()}>")
            if mess < .1 and rnd.random() < .1:
                out.append(rnd.choice(ODD))
            continue
        tag = rnd.choice(TAGS).replace("%d", str(rnd.randrange(6)))
        name = tag[1:].split()[0].strip("/>").split(">")[0]
        if name in H.CLOSES_P and "p" in stack and mess > .2:
            continue
        out.append(tag)
        if name not in H.VOID:
            stack.append(name)
    if mess > .05:
        out += [f"</{name}>" for name in reversed(stack)]
    return "".join(out)


@pytest.mark.parametrize("portal", list(R.CARDS))
def test_slices_give_the_walkers_cards(portal):
    rnd = random.Random(portal)
    plain = cards = 0
    for size in [1, 3, 40] * 25:
        pages = [_page(rnd) for _ in range(size)]
        at, columns, others = B.cards(pa.array(pages), portal)
        got = [(k, {n: v[i] for n, v in columns.items()}) for i, k in enumerate(at)]
        own = set(range(size)) - set(others)
        want = [(k, row) for k in sorted(own) for row in X._card_rows(H.parse(pages[k]), R.CARDS[portal])]
        assert got == want
        plain, cards = plain + len(own), cards + len(got)
    assert plain > 800 and cards > 50


def test_plain_pages_are_not_walked(spark, monkeypatch):
    """The walker sees the page with a comment only; both pages give their cards."""
    card = '<div data-cy="l-card"><a href="/d/oferta/x-ID%d.html"><h6>t %d</h6></a></div>'
    html = pa.array([card % (1, 1) + card % (2, 2), None, "<!-- odd -->" + card % (3, 3), ""])
    monkeypatch.setattr(X.H, "parse", lambda page, parse=H.parse: walked.append(page) or parse(page))
    walked, made = [], []

    class Pages:
        def __getitem__(self, name):
            return F.lit(name)

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array([7, 8, 9, 10]), html], ["page_id", "html"])
            made.extend(r for b in run(iter([batch])) for r in b.to_pylist())

    X.card_fields(Pages(), "olx")
    assert sorted((r["page_id"], r["card_no"], r["title"]) for r in made) == [(7, 0, "t 1"), (7, 1, "t 2"), (9, 0, "t 3")]
    assert walked == ["<!-- odd -->" + card % (3, 3)]


def _plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "extended").split("== Optimized Logical Plan ==")[1]


def test_a_cards_text_is_searched_only_for_what_its_elements_lack(spark):
    card = ('<div class="offert"><a class="offert-box-ctn-link" href="/oferta/m-%d/">1.250.000 zł, 61,5 m2, 3 pok.</a>'
            "<address>Wola, Warszawa</address>%s</div>")
    own = '<div class="price"><strong>900 000 zł</strong></div><div class="details"><strong>40 m2</strong></div>'
    pages = spark.createDataFrame([(1, card % (1, own) + card % (2, ""))], "page_id long, html string")
    df = CD.freedom_cards(pages, as_of=AS_OF)
    got = [(r.external_id, r.price_pln, r.sqm, r.rooms) for r in df.orderBy("external_id").collect()]
    assert got == [("freedom-1", 900000.0, 40.0, 3), ("freedom-2", 1250000.0, 61.5, 3)]
    assert "struct(sqm" not in _plan(df)  # all of the text's fields, for every row


def test_json_blob_is_cut_out_without_a_pattern_over_the_page(spark):
    ad = '{"props":{"pageProps":{"data":{"ads":[{"id":"1","title":"50 m2 za 300 000 zł","url":"/o/1"}]}}}}'
    tag = '<script id="__NEXT_DATA__" type="application/json">'
    pages = spark.createDataFrame(
        [(1, f"<script>x</script>{tag}{ad}</script><script>y</script>"), (2, tag + ad), (3, tag + "</script>"),
         (4, None), (5, "<p>none</p></script>")], "page_id long, html string")
    blobs = {r.page_id: r.b for r in pages.select("page_id", XJ.next_data().alias("b")).collect()}
    assert blobs == {1: ad, 2: None, 3: None, 4: None, 5: None}
    df = XJ.ads_layout_a(pages, AS_OF)
    assert [(r.external_id, r.price_pln, r.sqm) for r in df.collect()] == [("olx-1", 300000.0, 50.0)]
    assert "(.*?)</script>" not in _plan(df) and "struct(sqm" not in _plan(df)


def test_price_per_sqm_is_worked_out_behind_the_join(spark):
    """Listings without the column get it from their own values; a page's fill in what lacks."""
    from lokum.plans.normalize import detail_enrich
    listings = spark.createDataFrame(
        [("a", "https://x/1?y", 500000.0, 50.0, 2), ("b", "https://x/2", None, 40.0, 2), ("c", "https://x/3", None, 40.0, 2)],
        "external_id string, url string, price_pln double, sqm double, rooms int").selectExpr(
        "*", "'Wola' AS district", "string(null) AS description", "string(null) AS date_posted")
    details = spark.createDataFrame([("https://x/1", "za 900 000 zł"), ("https://x/2", "za 200 000 zł")],
                                    "curl string, detail_text string")
    got = detail_enrich(listings, details, AS_OF, ["Dodano"]).orderBy("external_id").collect()
    assert [(r.price_pln, r.price_per_sqm) for r in got] == [(500000.0, 10000.0), (200000.0, 5000.0), (None, None)]
