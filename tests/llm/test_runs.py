"""Periodic runs against a period-by-period scan."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lokum.llm import runs

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(x):
    """(start, end, period): stretches whose smallest period is tried first."""
    n, out = len(x), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            if i + q - s >= max(24, 3 * q):
                out.setdefault((s, i + q), q)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def mixed(rng, most):
    x, letters = [], rng.choice([1, 2, 3, 50])
    size = rng.randint(0, most)
    while len(x) < size:
        if rng.random() < 0.6:
            p = [rng.randrange(letters) for _ in range(rng.randint(1, 40))]
            x += (p * rng.randint(1, 9))[:rng.randint(1, 300)]
        else:
            x += [rng.randrange(letters + 5) for _ in range(rng.randint(1, 30))]
    return x


@pytest.mark.parametrize("largest", [8, 16, 1024])
def test_find_runs(monkeypatch, largest):
    monkeypatch.setattr(runs, "LARGEST", largest)
    rng = random.Random(largest)
    for _ in range(300):
        x = mixed(rng, 500)
        assert [tuple(r) for r in runs.find_runs(np.array(x, np.int64)).tolist()] == brute(x)


@pytest.mark.parametrize("n,q", [(24, 1), (23, 1), (24, 8), (27, 9), (26, 9), (3 * 700, 700), (3 * 700 - 1, 700),
                                 (9000, 3000), (8999, 3000), (40_000, 13_000)])
def test_long_periods(n, q):
    rng = random.Random(n)
    head = [10_000_000 + k for k in range(rng.randint(0, 50))]
    word = [rng.randrange(1_000_000) for _ in range(q)]
    x = head + (word * (n // q + 1))[:n] + [-5, -6]
    want = [(len(head), len(head) + n, q)] if n >= max(24, 3 * q) else []
    assert [tuple(r) for r in runs.find_runs(np.array(x, np.int64) + 10).tolist()] == want


def test_transform_is_a_convolution():
    rng = np.random.default_rng(1)
    x = rng.integers(0, runs.PRIME, (32, 5))
    there = runs.transform(x)
    back = runs.restore(there) * runs.tables(32)[4] % runs.PRIME
    assert (back == x).all()
    values = rng.integers(0, 3, 400)
    blocks = runs.Blocks(values, 8)
    at, d = blocks.matches(1, 1)
    padded = np.concatenate((values, np.zeros(40, np.int64)))
    want = {(b, k) for b in range(blocks.count - 1) for k in range(8, 16)
            if (padded[8 * b:8 * b + 8] == padded[8 * b + k:8 * b + k + 8]).all()}
    assert set(zip(at.tolist(), d.tolist())) == want


def expected(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    keep = [not any(s + q <= i < e for s, e, q in found) for i in range(n)]
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    first = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *first, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for x, k in zip(w, keep) if k).encode()).hexdigest())


def test_periodic_runs(spark):
    rng = random.Random(4)
    rows = [(k, " \t\n"[k % 3].join(f"w{v}" for v in mixed(rng, 300))) for k in range(120)]
    rows += [(None, "a b " * 30), (None, None), (200, ""), (201, None), (202, " \n "), (203, "x " * 5000),
             (203, "x " * 5000), (204, "a b " * 40 + "é"), (205, "q" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in ("n_runs", "start", "uid", "a b"):
        df = df.withColumn(c, F.lit("extra"))
    got = runs.periodic_runs(df, loop=True)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert runs.periodic_runs(df.limit(0)).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = [r for r in rows if len(r[1] or "") < 20_000]  # the scan is quadratic
    got = {r.doc_id: tuple(r) for r in runs.periodic_runs(docs, loop=True).collect()}
    for r in rows:
        assert got[r[0]] == expected(*r)
