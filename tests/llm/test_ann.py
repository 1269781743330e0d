"""Nearest neighbours."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lokum.llm import ann


def brute(rows, k):
    out = {}
    for i, (name, v) in enumerate(rows):
        if name is not None and name % 20 == 0 and good(v):
            s = [(-float((np.array(w) * np.array(v)).sum()), m is None, m or 0, m) for j, (m, w) in enumerate(rows)
                 if j != i and good(w) and len(w) == len(v)]
            out.setdefault(name, []).append([(m, -x) for x, _, _, m in sorted(s)[:k]])
    return out


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def search(spark, rows, k, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c in ("uid", "v", "dim", "shard", "rank"):
        df = df.withColumn(c, F.lit("extra"))
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0, k, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def vectors(n, dim, seed):
    x = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


EDGE = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
        (6, [float("inf"), 0.0]), (20, [0.5, 0.5]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [-1.0, 0.0]), (None, [1.0, 0.0]),
        (40, [1.0, 2.0, 3.0]), (9, [3.0, 2.0, 1.0]), (60, None), (80, [0.0, 0.0])]


def test_edges(spark):
    got, want = search(spark, EDGE, 4), brute(EDGE, 4)
    assert got == {k: v[0] for k, v in want.items()}
    assert [m for m, _ in got[0]] == [7, 7, None, 20] and [m for m, _ in got[40]] == [9]


def test_empty(spark):
    assert search(spark, [], 5) == {}
    assert search(spark, [(1, [1.0])], 5) == {}


@pytest.mark.parametrize("shard_rows,block_rows", [(32_768, 1024), (700, 30)])
def test_recall_and_order(spark, shard_rows, block_rows):
    x = vectors(3000, 32, 1) * np.random.default_rng(2).uniform(0.3, 3.0, (3000, 1)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got, want = search(spark, rows, 20, shard_rows=shard_rows, block_rows=block_rows), brute(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({m for m, _ in got[q]} & {m for m, _ in want[q][0]}) for q in got)
    assert hits >= 0.9 * 20 * len(got)
    exact = {(q, m): s for q in want for m, s in brute_scores(x, q)}
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(s == pytest.approx(exact[q, m], rel=1e-12, abs=1e-12) for m, s in found)


def brute_scores(x, q):
    return [(i, float(s)) for i, s in enumerate(x.astype(float) @ x[q].astype(float)) if i != q]


def test_recall_on_the_table(spark):
    vecs = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vecs.select("vec_id", "embedding").collect()]
    got, want = {}, brute(rows, 20)
    for r in ann.nearest(vecs, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {m for m, _ in w[0]}) for q, w in want.items()) >= 0.95 * 20 * len(want)


def test_common_vector(spark):
    x = vectors(2000, 16, 3)
    x[500:1500] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = search(spark, rows, 20)
    assert [m for m, _ in got[0]] == list(range(500, 520))
    assert [m for m, _ in got[1000]] == [0, *range(500, 519)]
