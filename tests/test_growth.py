"""Steps that must not grow faster than their input: what keep-first shuffles, what a
task of the vector search holds, how often a post is read, tags that a worker knows."""

import numpy as np
import pyarrow as pa
from lokum import registry as R
from lokum.functions import text
from lokum.operators import embed, html_dom, vector
from lokum.operators.dedupe import keep_first
from lokum.plans import posts
from pyspark.sql import functions as F


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keep_first_leaves_out_what_breaks_no_tie(spark):
    df = spark.createDataFrame([(1, "b", "u", 9, "long"), (1, "a", "v", 2, "other"), (1, "a", "v", 1, "text"),
                                (None, None, "w", 3, "x")], "k long, o string, u string, n long, wide string")
    rows = [tuple(r) for r in keep_first(df, ["k"], ["o"]).orderBy("k").collect()]
    assert rows == [(None, None, "w", 3, "x"), (1, "a", "v", 1, "text")]
    some = keep_first(df, ["k"], ["o"], ["k", "n", "u"])
    assert [tuple(r) for r in some.orderBy("k").collect()] == [(None, 3, "w"), (1, 1, "v")]
    assert "wide" not in _plan(some).split("LogicalRDD")[0]
    assert _plan(keep_first(df, ["k"], ["o"])).count("struct(o, o#") == 1


def test_store_and_report_rows_are_narrow(spark):
    sf = "/root/testdata/sf0.001"
    assert "Dodano" not in _plan(R.batch_table(spark, sf, ["external_id", "portal", "url"]))
    assert "Dodano" not in _plan(R.q_report_append(spark, sf)) and "Dodano" in _plan(R.batch_table(spark, sf))


def test_similarities_held_at_once_are_bounded(monkeypatch):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((300, 8)).astype(np.float32)
    t = pa.table({"id": pa.array(range(300), pa.int64()), "dim": pa.array([8] * 300, pa.int32()),
                  "v": pa.array(m.tolist(), pa.list_(pa.float32()))})
    whole = vector._best_of(5, 0.1, "q", "i")(t, t)
    sizes = []
    monkeypatch.setattr(vector, "_matrix", lambda c, dim, f=vector._matrix: sizes.append(len(c)) or f(c, dim))
    monkeypatch.setattr(vector, "MATRIX_CELLS", 3000)
    small = vector._best_of(5, 0.1, "q", "i")(t, t)
    assert max(sizes[1:]) == 10 and small.column("i").equals(whole.column("i")) and small.num_rows == whole.num_rows


def test_a_post_is_read_once(spark):
    raw = spark.createDataFrame([("1", "x sentence long enough. Two", "u", "1", "g")],
                                "post_id string, text string, url string, time string, `group` string")
    out = posts.post_listings(raw, R.AS_OF)
    assert _plan(out).count("(?:zł|pln)") == 1 and out.first()["title"] == "[FB] x sentence long enough"


def test_first_sentence(spark):
    texts = [" .  .\n a b .c", "", "...", None, "x", "\ta ", ". .\n", "a\nb . c", "no dot at all "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(text.first_sentence("t").alias("a"), F.get(text.sentences("t"), 0).alias("b")).collect():
        assert r["a"] == r["b"]


def test_vectors_are_made_as_floats_at_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, " \t"), (3, None)], "doc_id long, text string")
    model = embed.fit_embedder(docs, str(tmp_path / "m"), dim=8)
    out = embed.embed_hashing(docs, model)
    assert "cast(lambda" not in _plan(out) and dict(out.dtypes)["embedding"] == "array<float>"
    assert [sum(r["embedding"]) > 0 for r in out.orderBy("doc_id").collect()] == [True, False, False]


def test_links_do_not_fill_the_table_of_tags(monkeypatch):
    monkeypatch.setattr(html_dom, "_tags", {})
    monkeypatch.setattr(html_dom, "_MOST_TAGS", 4)
    for k in range(9):
        html_dom.parse(f'<a href="/{k}">x</a>')
    root = html_dom.parse('<b class="c">x</b>')
    assert root.find(html_dom.has_class("b", "c")).text() == "x"
    assert 'b class="c"' in html_dom._tags and len(html_dom._tags) <= 4
