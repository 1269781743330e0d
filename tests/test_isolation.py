"""Fault isolation: quarantine with reasons, portals that fail, observed counts."""

from collections import Counter

from lokum.plans.isolation import load_pages

GOOD = '<html><head><title>t</title></head><body><div data-cy="ad_description">text</div></body></html>'


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, portal string, html string")


def test_a_failing_portal_leaves_the_others_untouched(spark, tmp_path):
    rows = ([(i, "olx", GOOD) for i in range(20)] + [(20, "olx", None), (21, "olx", "<p>nothing here</p>")]
            + [(30 + i, "morizon", GOOD if i < 3 else "  ") for i in range(10)]
            + [(50, None, GOOD), (51, "elsewhere", GOOD)])
    got = load_pages(spark, str(tmp_path / "r"), frame(spark, rows).repartition(5), portals=("olx", "morizon"))
    assert got.down == ("morizon",)
    assert sorted(r.page_id for r in got.batch.collect()) == [*range(20), 50, 51]
    assert {r.description for r in got.batch.collect()} == {"text"}
    reasons = {r.page_id: r.reason for r in got.quarantine.collect()}
    assert reasons == {20: "no html", 21: "no content", **dict.fromkeys((30, 31, 32), "portal failing"),
                       **dict.fromkeys(range(33, 40), "no html")}
    assert got.pages == {"olx": 22, "morizon": 10, "other": 2} and got.failed == {"olx": 2, "morizon": 7, "other": 0}


def test_observed_counts_match_the_written_rows(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr(
        "page_id", "IF(page_id % 2 = 0, 'olx', 'otodom') AS portal", "IF(page_id % 5 = 0, NULL, html) AS html")
    got = load_pages(spark, str(tmp_path / "r"), pages)
    written = Counter((r.portal, r.reason) for r in spark.read.parquet(str(tmp_path / "r")).collect())
    for p in ("olx", "otodom"):
        assert got.failed[p] == written[p, "no html"] > 0
        assert got.pages[p] == sum(n for (q, _), n in written.items() if q == p)
    assert got.batch.count() + got.quarantine.count() == pages.count() and not got.down


def test_empty(spark, tmp_path):
    got = load_pages(spark, str(tmp_path / "r"), frame(spark, []))
    assert got.batch.count() == got.quarantine.count() == 0 and not got.down and set(got.pages.values()) == {0}
