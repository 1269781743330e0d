"""Exact dedup and SimHash near-dedup."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from lokum.llm import exact_dedup, simhash

SF = "/root/testdata/sf0.01"
EDGE = [(1, "a b  c"), (2, "abc"), (3, None), (4, ""), (5, " \n\t"), (None, "abc"), (2, "abc"), (7, "x" * 500_000),
        (8, "a b"), (9, "ab c\n")]


def edge(spark, rows=EDGE):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # clashing and odd extra columns
    for c in ("uid", "digest", "fp", "root", "kept", "_uid", "_digest", "size.x"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def expect_exact(rows):
    groups = defaultdict(list)
    for i, (k, t) in enumerate(rows):
        groups[brute.exact_key(t)].append((-len(t or ""), k is None, k or 0, i))
    out = []
    for i, (k, t) in enumerate(rows):
        g = groups[brute.exact_key(t)]
        best = min(g)[3]
        out.append((k, rows[best][0], len(g), best == i, brute.exact_key(t)))
    return out


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_exact_edges(spark, support):
    got = [tuple(r) for r in exact_dedup.exact_dedup(edge(spark).coalesce(1), support=support).drop("uid").collect()]
    assert sorted(got, key=str) == sorted(expect_exact(EDGE), key=str)


def test_exact_heavy_group(spark):
    rows = [(i, "copy" + " " * (i % 3)) for i in range(3000)] + [(10_000 + i, f"own {i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7, "doc_id")
    heavy = exact_dedup.heavy_winners(exact_dedup._rows(df, "doc_id", "text")).collect()
    assert max(r.group_size for r in heavy) == 3000 and len(heavy) <= 1000
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(df).collect()}
    assert len(got) == 6000 and all(r.kept == (r.keep_id == r.doc_id) for r in got.values())
    assert got[5].keep_id == 2 and got[5].group_size == 3000 and got[10_001].group_size == 1


def test_exact_drop_keeps_columns(spark):
    df = edge(spark).coalesce(1)
    out = exact_dedup.drop_exact_duplicates(df)
    assert out.columns == df.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(kept, key=str) == sorted([EDGE[i] for i, e in enumerate(expect_exact(EDGE)) if e[3]], key=str)


def test_empty_tables(spark):
    none = edge(spark, [])
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash.simhash_components(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0


@pytest.mark.parametrize("minimum", range(1, 9))
def test_covering(minimum):
    sets = simhash.covering(minimum)
    assert all(any(set(s) <= set(f) for s in sets) for f in combinations(range(8), minimum))


@pytest.mark.parametrize("text", ["", None, " \n", "one", "A b c d", "a b c d e", "Été À b c É É x " * 300, "\x85 \x1c x"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute.fingerprint(text)


def test_fingerprint_matches_jvm_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d")).alias("h")).first().h
    assert got % 2 ** 64 == simhash.fingerprint("A b\nC  d")


def test_simhash_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    items = [(k, brute.fingerprint(t)) for k, t in rows]
    want = {k: (f"{f:016x}", c) for (k, f), c in zip(items, brute.components(items))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == want


@pytest.mark.parametrize("block", [50_000, 20])
@pytest.mark.parametrize("max_bits", [0, 3, 4, 5])
def test_links_and_components(spark, block, max_bits):
    rng = random.Random(max_bits)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0}
    for f in list(fps)[:80]:  # chains and dense clusters
        for _ in range(6):
            for _ in range(rng.randint(1, 5)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    dense = rng.getrandbits(64)
    fps |= {dense ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(12)}
    signed = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df, max_bits, block)).collect()}
    want = brute.components([(f, f % 2 ** 64) for f in signed], max_bits)
    assert [roots.get(f, f) for f in signed] == want


def test_star_count_is_linear():
    base = np.uint64(12345)
    fps = np.unique(np.array([base ^ np.uint64(1 << i) ^ np.uint64(1 << j) for i in range(40) for j in range(40)]))
    members, roots = simhash.stars(fps, 4, 4)
    assert len(members) == len(fps) - 1 and len(set(roots.tolist())) == 1


def test_simhash_edges(spark):
    df = edge(spark).coalesce(1)
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(df).collect()]
    items = [(k, brute.fingerprint(t)) for k, t in EDGE]
    want = [(k, f"{f:016x}", c) for (k, f), c in zip(items, brute.components(items))]
    assert sorted(got, key=str) == sorted(want, key=str)
    out = simhash.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted({c for *_, c in want}, key=str)
