"""Jobs end to end: store, streams, report target, hooks, hard inputs."""

import math
import os
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from lokum.functions import dates as FD
from lokum.operators import embed, html_dom, page_rules, report
from lokum.operators.extract_html import card_fields, page_parts
from lokum.operators.vector import batch_topk, lsh_topk, similarity
from lokum.plans import cards, pages, posts, store
from lokum.plans.normalize import detail_enrich
from lokum.streaming import jobs

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def listing(spark, *rows):
    return spark.createDataFrame(
        list(rows), "external_id string, title string, price_pln double, sqm double, rooms int, district string, "
                    "description string, url string")


def row(i, title="t", site="olx.pl"):
    return (i, title, 1.0, 2.0, 1, "d", None, f"https://www.{site}/oferta/{i}")


def test_store_keeps_old_rows_adds_new_and_survives_orphans(spark, tmp_path):
    base = str(tmp_path / "store")
    assert store.current(spark, base) == (0, None)
    assert store.ingest(spark, base, listing(spark, row("olx-1"), row("", "blank key"), row("olx-1", "z"))) == 1
    listing(spark, row("olx-9")).withColumn("portal", F.lit("olx")).write.parquet(f"{base}/snapshots/00000002")
    assert store.current(spark, base)[0] == 1  # no pointer names the orphan
    assert store.ingest(spark, base, listing(spark, row("olx-1", "later"), row("fb-2", site="facebook.com"))) == 2
    version, rows = store.current(spark, base)
    assert version == 2
    assert {(r.external_id, r.title, r.portal, r.since) for r in rows.collect()} == {
        ("olx-1", "t", "olx", 1), ("fb-2", "t", "facebook", 2)}
    plan = rows.filter(F.col("portal") == "olx")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(portal" in plan


def test_streams_resume(spark, tmp_path):
    base = str(tmp_path / "delta")
    first = {tuple(r) for r in jobs.stream_delta(spark, SF, base=base).collect()}
    batches = sorted(os.listdir(f"{base}/target"))
    assert {tuple(r) for r in jobs.stream_delta(spark, SF, base=base).collect()} == first
    assert sorted(os.listdir(f"{base}/target")) == batches  # nothing was read again


def test_sessions_stay_open_until_closed(spark, tmp_path):
    base = str(tmp_path / "sessions")
    jobs.run_counts(spark, SF, "session", "1 day", base)
    out = spark.read.schema(jobs.COUNT_SCHEMA).parquet(f"{base}/out")
    early = out.agg(F.sum("n")).first()[0] or 0
    jobs.close_windows(spark, base)
    jobs.run_counts(spark, SF, "session", "1 day", base)
    every = spark.read.parquet(f"{SF}/events.parquet").count()
    assert early < spark.read.schema(jobs.COUNT_SCHEMA).parquet(f"{base}/out").agg(F.sum("n")).first()[0] == every


def test_report_target(spark, tmp_path):
    rows = spark.createDataFrame([tuple("abcdefghij")], ", ".join(f"c{i} string" for i in range(10)))
    path = str(tmp_path / "report")
    assert [report.write_report(spark, rows, path) for _ in range(2)] == ["overwrite", "append"]
    assert spark.read.option("header", "true").csv(path).count() == 2
    other = str(tmp_path / "other")
    spark.range(1).select(F.lit("x").alias("#")).write.option("header", "true").csv(other)
    assert report.write_report(spark, rows, other) == "overwrite"
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.csv").write_bytes(b"#,x\n1,2\n")
    os.chmod(broken / "part-0.csv", 0)
    if not os.access(broken / "part-0.csv", os.R_OK):  # root reads everything
        with pytest.raises(Exception):
            report.write_report(spark, rows, str(broken))


def test_markdown_keeps_its_columns(spark):
    page = spark.createDataFrame([(1, "olx-1", None, None, None, None, None, None, None, None)],
                                 "rank long, external_id string, url string, district string, date_posted string, "
                                 "price_pln double, sqm double, rooms int, price_per_sqm double, description string")
    assert report.markdown_lines(page).first().line.count("|") == 11


@pytest.mark.parametrize("text,want", [("1704877200", "2024-01-10"), ("2024-02-03T10:00:00", "2024-02-03"),
                                       ("1704877200.5", "2024-01-10"), ("", "1999-01-01"), (None, "1999-01-01")])
def test_post_date(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(FD.post_date(text="t", as_of="1999-01-01").alias("d")).first().d == want


def test_numeric_post_times_are_epochs(spark):
    raw = spark.createDataFrame([('{"text": "a", "timestamp": 1704877200}',)], "json string")
    p = posts.normalize_posts(raw)
    assert p.select(FD.post_date(text="time", as_of="1999-01-01").alias("d")).first().d == "2024-01-10"


def test_posts_with_one_opening_stay_apart(spark):
    raw = spark.createDataFrame([(None, "x" * 60 + c, None) for c in "ab"], "post_id string, text string, url string")
    ids = {r.external_id for r in posts.with_external_id(raw).collect()}
    assert len(ids) == 2 and all(len(i) == 3 + 64 for i in ids)


def test_post_hook_sees_the_cap_and_nothing_else_is_cut(spark):
    text = "Mieszkanie " + "x" * 3000 + " 50 m2"

    def fn(batches):
        for b in batches:
            out = b[["external_id"]].copy()
            out["json"] = [f'{{"is_apartment_for_sale": true, "title": "{len(t)}"}}' for t in b["text"]]
            yield out

    p = spark.createDataFrame([("1", text, "u", "2024-01-01", "g")],
                              "post_id string, text string, url string, time string, group string")
    hooked = posts.post_listings(p, "1999-01-01", extractor=fn).first()
    assert hooked.title.endswith("2500") and hooked.description == text
    assert posts.post_listings(p, "1999-01-01").first().sqm == 50.0


def test_embedder_hook_and_stored_model(spark, tmp_path):
    docs = spark.createDataFrame([(1, "ala ma kota"), (2, "kot ma ale"), (3, " "), (4, "ala ma kota")],
                                 "doc_id long, text string")
    model = embed.fit_embedder(docs, str(tmp_path / "model"))
    whole = {r.doc_id: r.embedding for r in embed.embed_hashing(docs, model).collect()}
    part = {r.doc_id: r.embedding for r in embed.embed_hashing(docs.where("doc_id > 2"),
                                                               embed.load_embedder(str(tmp_path / "model"))).collect()}
    assert part[4] == whole[1] == whole[4] and not any(whole[3])
    assert embed.embed_text(spark, "ala ma kota", model) == whole[1]

    def fn(batches):
        for b in batches:
            yield b[["doc_id"]].assign(embedding=[[float(len(t))] for t in b["text"]])

    got = {r.doc_id: r.embedding for r in embed.embed_with(docs, fn).collect()}
    assert got[1] == [11.0] and not any(got[3])


def test_batch_topk_in_blocks(spark):
    x = np.random.default_rng(0).standard_normal((300, 8))
    x[7] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item_id long, embedding array<double>")
    q = df.withColumnRenamed("item_id", "query_id").where("query_id < 40")
    got = {}
    for r in batch_topk(df, q, 5, 0.1, shard_rows=70, block_rows=9).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.item_id)
    n = np.linalg.norm(x, axis=1)
    for i in range(40):
        if i == 7:
            assert i not in got
            continue
        sims = [(-(x[i] @ x[j]) / n[i] / n[j], j) for j in range(300) if j != 7]
        assert got[i] == [j for s, j in sorted(sims) if -s > 0.1][:5]


def test_lsh_topk_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 16))[rng.integers(0, 40, 1200)] + 0.25 * rng.standard_normal((1200, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "item_id long, embedding array<double>")
    q = df.withColumnRenamed("item_id", "query_id").where("query_id % 12 = 0")
    exact = {(r.query_id, r.item_id): r.similarity for r in batch_topk(df, q, 10).collect()}
    rows = lsh_topk(df, q, 10, shard_rows=50).collect()
    got = {(r.query_id, r.item_id): r.similarity for r in rows}
    assert len(rows) == len(got) and len(set(exact) & set(got)) >= 0.9 * len(exact)
    assert all(got[p] == pytest.approx(exact[p]) for p in set(exact) & set(got))


def test_lsh_topk_recall_on_the_embeddings(spark):
    vec = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    items, q = vec.withColumnRenamed("vec_id", "item_id"), vec.withColumnRenamed("vec_id", "query_id")
    exact = {(r.query_id, r.item_id) for r in batch_topk(items, q, 10, 0.10).collect()}
    rows = lsh_topk(items, q, 10, 0.10).collect()
    got = {(r.query_id, r.item_id) for r in rows}
    others = {p for p in exact if p[0] != p[1]}  # without a vector's match with itself
    assert len(rows) == len(got) and len(got & others) >= 0.9 * len(others)
    pieces = {(r.query_id, r.item_id) for r in lsh_topk(items, q, 10, 0.10, shard_rows=30).collect()}
    assert pieces == got


def test_similarity_of_a_zero_query_is_null(spark):
    df = spark.createDataFrame([([1.0, 0.0],)], "v array<double>")
    assert df.select(similarity("v", [0.0, 0.0]).alias("s")).first().s is None


def test_deep_markup(spark):
    deep = "<div>" * 20_000 + "<article><p>text that is long enough to count</p></article>" + "</div>" * 20_000
    assert html_dom.parse(deep).text(" ").startswith("text")
    df = spark.createDataFrame([(1, deep), (2, None)], "page_id long, html string")
    got = {r.page_id: r for r in page_parts(df).collect()}
    assert got[1].description.startswith("text") and not got[2].parsed


def test_page_depth_keeps_short_pages_and_null_hosts(spark):
    rows = [(10 * k + n, url, html) for k, url in ((0, "http://a.pl/x"), (1, None))
            for n, html in ((0, "<article>x</article>"), (1, "<article>x</article>"), (2, "<article></article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id for r in pages.page_depth(df, 3).collect()} == {0, 1, 10, 11}


def test_cards_keep_one_row_per_link(spark):
    card = '<div data-offer-card><h2><a href="/o/a-1{}">x</a></h2><div class="items-center"><p><span class="font-bold">' \
           '750 000</span> zł</p><p><span class="font-bold">50</span> m²</p></div></div>'
    df = spark.createDataFrame([(1, card.format("") + card.format("?ref=2"))], "page_id long, html string")
    got = card_fields(df, "adresowo").collect()
    assert len(got) == 1 and got[0].tags == ["750 000 zł", "50 m²"]


def test_selectors():
    page = html_dom.parse('<div class="a big-Box"><p>1</p><i><p>2</p></i></div><div class="box"><p id="x">3</p></div>'
                          '<a href="/q/oferta/1" data-k=""><span>4</span></a>')
    texts = lambda *selectors: [n.text("") for n in page_rules.every(page, selectors)]
    assert texts("div p") == ["1", "2", "3"] and texts("div.box p") == ["3"]
    assert texts("div[class*=box] p") == ["3"] and texts("div[class*=box i] p") == ["1", "2", "3"]
    assert texts("h1", "p#x,span") == ["3", "4"] and texts("a[href*=/oferta/][data-k=] span") == ["4"]
    assert texts("h1", "[missing]") == [] and page_rules.first(page, ["h1", "div p"]).text("") == "1"
    assert page_rules.first(page, ["div.a span"]) is None
    with pytest.raises(ValueError):
        page_rules.steps("div > p")


def test_pages_of_several_portals_in_one_job(spark):
    """Each page by its own portal's rules; pages of no or other portals, null and
    empty ones give no row, and columns beside may have any name."""
    olx = '<div data-cy="l-card"><a href="/d/oferta/x-IDabcd.html"><h6>Flat</h6></a><p class="Price">700 000 zł</p></div>'
    freedom = '<div class="offert"><a href="/oferta/dom-77/">x</a><address>Wola, Warszawa</address>' \
              '<div class="price"><strong>500 000 zł</strong><p><strong>10 000</strong></p></div></div>'
    rows = [(1, "olx", olx, "t"), (2, "freedom", freedom, "t"), (3, "olx", freedom, "t"), (4, None, olx, "t"),
            (5, "fb", olx, "t"), (6, "no", None, "t"), (7, "adresowo", "", "t")]
    df = spark.createDataFrame(rows, "page_id long, portal string, html string, title string")
    got = {r.external_id: r for r in cards.portal_cards(df, "1999-01-01").collect()}
    assert set(got) == {"olx-abcd", "freedom-77"}
    assert (got["olx-abcd"].title, got["olx-abcd"].price_pln) == ("Flat", 700000.0)
    assert (got["freedom-77"].price_pln, got["freedom-77"].price_per_sqm) == (500000.0, 10000.0)
    assert got["freedom-77"].district == "Wola"


def test_descriptions_come_from_the_portals_own_containers(spark):
    page = '<article>menu</article><div class="description">other</div><div data-cy="ad_description">olx text</div>' \
           '<div class="left-page"><p>a paragraph that is long enough</p></div>'
    df = spark.createDataFrame([(i, p, page) for i, p in enumerate(["olx", "freedom", "no", "otodom", "fb", None])],
                               "page_id long, portal string, html string")
    parts = pages.paragraph_description(page_parts(df, portal=F.col("portal")))
    assert [r.description for r in parts.orderBy("page_id").collect()] == [
        "olx text", "a paragraph that is long enough", "other", None,
        "a paragraph that is long enough", "a paragraph that is long enough"]


def test_detail_keeps_the_listing_date_and_fills_the_description(spark):
    lst = spark.createDataFrame([("a", "http://x/1?r=2", 1.0, 2.0, 1, "D", None, "2024-01-05", None),
                                 ("b", "http://x/2", 1.0, 2.0, 1, "D", None, None, None)],
                                "external_id string, url string, price_pln double, sqm double, rooms int, "
                                "district string, description string, date_posted string, price_per_sqm double")
    details = spark.createDataFrame([("http://x/1", "Nice flat")], "curl string, detail_text string")
    got = {r.external_id: r for r in detail_enrich(lst, details, "1999-01-01", ["Dodano"]).collect()}
    assert got["a"].date_posted == "2024-01-05" and got["a"].description == "Nice flat"
    assert got["a"].district == "D - 2024-01-05"
    assert got["b"].date_posted is None and got["b"].description is None


def test_hooks_run_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e;"
            "from pyspark.sql import SparkSession as S;"
            "s = S.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate();"
            f"print('ROWS', e.queries()['page_title'](s, {SF!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 50" in out.stdout, out.stderr[-800:]


def murmur3(data: bytes, seed: int = 42) -> int:
    """32-bit MurmurHash3, signed, as the term hashing uses it."""
    def mix(k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        return k * 0x1B873593 & 0xFFFFFFFF

    h, n = seed, len(data) // 4 * 4
    for i in range(0, n, 4):
        h ^= mix(int.from_bytes(data[i:i + 4], "little"))
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    if data[n:]:
        h ^= mix(int.from_bytes(data[n:], "little"))
    h ^= len(data)
    for shift, by in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * by & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def plain_embeddings(texts, dim=1536):
    """TF-IDF over hashed lower-case words, each vector of length one."""
    counts = []
    for t in texts:
        c = {}
        for w in re.split(r"[^A-Za-z0-9_]+", (t or "").strip().lower()):
            if w:
                k = murmur3(w.encode()) % dim
                c[k] = c.get(k, 0) + 1
        counts.append(c)
    out = np.zeros((len(texts), dim))
    for i, c in enumerate(counts):
        for k, n in c.items():
            out[i, k] = n * math.log((len(texts) + 1) / (sum(k in d for d in counts) + 1))
        norm = np.linalg.norm(out[i])
        out[i] /= norm or 1.0
    return out


def test_embeddings_equal_a_plain_tf_idf(spark, tmp_path):
    texts = ["Ala ma kota, a kot ma Ale", "kot ma mysz", "pies i kot i pies", "", "dom z ogrodem 42 m2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = embed.fit_embedder(docs, str(tmp_path / "model"))
    got = {r.doc_id: r.embedding for r in embed.embed_hashing(docs, model).collect()}
    want = plain_embeddings(texts)
    assert all(np.allclose(got[k], want[k], atol=1e-6) for k in range(len(texts)))


def test_search_text_ranks_by_cosine(spark):
    from lokum import registry
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    model = registry.fitted_embedder(spark, spark.createDataFrame(docs))
    vectors = {r.doc_id: np.array(r.embedding, float) for r in
               embed.embed_hashing(spark.createDataFrame(docs), model).collect()}
    first = vectors[docs[0].doc_id]
    sims = {k: float(v @ first / ((np.linalg.norm(v) * np.linalg.norm(first)) or 1)) for k, v in vectors.items()}
    got = registry.QUERIES["search_text"](spark, SF).orderBy("rank").collect()
    over = sorted((s for s in sims.values() if s > 0.10), reverse=True)
    assert len(got) == min(20, len(over)) and [r["rank"] for r in got] == list(range(1, len(got) + 1))
    assert all(abs(r.similarity - round(sims[r.doc_id], 4)) <= 1e-4 for r in got)
    assert all(abs(sims[r.doc_id] - s) < 1e-6 for r, s in zip(got, over))
    texts = {r.doc_id: r.text for r in docs}
    assert any(texts[r.doc_id] != docs[0].text for r in got)  # similar, not equal


def test_report_without_rows_says_so(spark):
    from lokum import registry
    page = registry._report_page(spark, SF)
    got = [r.line for r in report.markdown_report(page.limit(0), label="Wola").collect()]
    assert got == ["No apartments were found for 'Wola' strictly meeting all requirements."]
    lines = {r.row_no: r.line for r in report.markdown_report(page).collect()}
    assert lines[-1].startswith("| # | Date Posted") and lines[0].count("---") == 10 and 1 in lines or len(lines) > 2
