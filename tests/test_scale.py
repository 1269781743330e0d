"""Steps whose cost must not grow faster than their input: markup, shared values, layouts."""

import pyarrow as pa
import pytest

from lokum import registry as R
from lokum.functions import dates, text
from lokum.operators import extract_html, html_dom
from lokum.plans import cards
from pyspark.sql import functions as F

PAGES = ['<div class="a b"><p>x &amp; y<p>z<br/>w</div>tail', '<p>1<div><p>2</div></p>3</i>', "a > b<h2 checked>c</h2>",
         "", "<p/>q", '<a href="?x" href="?y">k</a>']
OTHER = ["<!-- c --><p>x</p>", "<div a='1'>x</div>", "<P>x", "<b>1 < 2</b>", "<div>x<script>y</script><style>z</style></div>",
         '<a href="/x?a&amp;b">k</a>', "<title>a</title>", "x<i"]


def _tree(root):
    return [(n.tag, n.attrs, n.parent.tag, n.text(" "), n.text("", False)) for n in root.iter()] + [root.text("|")]


@pytest.mark.parametrize("html", PAGES)
def test_plain_markup_gives_the_parsers_tree(html):
    parser = html_dom._Builder()
    parser.feed(html)
    parser.close()
    plain = html_dom._plain(html)
    assert plain is not None and _tree(plain) == _tree(parser.page.done())


def test_other_markup_goes_through_the_parser():
    assert all(html_dom._plain(h) is None for h in OTHER)
    page = html_dom.parse(OTHER[4])
    assert page.text() == "x" and page.find(html_dom.tag("script")).text() == "y"


def test_pages_are_handed_on_in_slices(monkeypatch):
    monkeypatch.setattr(extract_html, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3, 4, 5], "html": ["a" * 6, "b" * 6, None, "c" * 30, "d"]})
    parts = [p.column(0).to_pylist() for p in extract_html._slices(iter([batch]), 1)]
    assert parts == [[1], [2, 3], [4], [5]]


def test_tagged_values_are_worked_out_once(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>")], "page_id long, html string")
    plan = cards.adresowo_cards(pages, as_of=R.AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("m²|m2") == 1
    row = spark.range(1).select(text.unit_tagged(F.array(F.lit("9 zł"), F.lit("2 000 zł"), F.lit("pok"))).alias("v"),
                                text.unit_tagged(F.lit(None).cast("array<string>")).alias("n")).first()
    assert tuple(row["v"]) == (2000.0, None, None) and tuple(row["n"]) == (None, None, None)


def test_texts_without_a_date_are_not_parsed_as_dates(spark):
    df = spark.createDataFrame([("Dodano 5 maja 1999",), ("Dodano 7 maj",), ("Dodano wczoraj",), ("no date",), (None,),
                                ("Dodano 1.2.1998",), ("Dodano 3 foo",)], "d string")
    date = dates.text_date(F.col("d"), ["Dodano"], R.AS_OF)
    got = [None if r[0] is None else str(r[0]) for r in df.select(date).collect()]
    assert got == ["1999-05-05", "1999-05-07", "1998-12-31", None, None, "1998-02-01", None]
    plan = df.select(date)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan  # it makes an empty text of null


def test_pages_of_orders_need_no_shuffle_of_their_own(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = R.json_pages_a(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(order_key" not in plan


def test_landing_files_grow_in_number(spark, monkeypatch):
    asked = []
    run = R.ST.stream_listings
    monkeypatch.setattr(R.ST, "stream_listings", lambda *a, **k: asked.append(k["max_files"]) or run(*a, **k))
    few = R.q_stream_listings(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(R, "LANDING_ROWS", 1000)
    many = R.q_stream_listings(spark, "/root/testdata/sf0.001")
    assert asked[0] == 1 and asked[1] > 1
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
