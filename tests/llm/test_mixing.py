"""Mixing sources to target weights."""

import pytest
from pyspark.sql import functions as F

import brute
from lokum.llm import mixing

ROWS = [(1, "a", "x y z"), (2, "a", None), (3, None, "p q"), (4, "B", "one two three four"), (5, "é", "w " * 400),
        (5, "é", "w " * 400), (None, "a", "n n"), (6, "", "  \n "), (7, "z", "u " * 37), (8, "z", "v " * 50),
        (9, "a", "k " * 9000)]


def frame(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1)
    for c in ("uid", "size", "target", "s", "range", "_uid", "_size", "taken"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.mark.parametrize("range_rows", [4096, 2])
def test_mix_edges(spark, range_rows):
    got = sorted((tuple(r) for r in mixing.mix(frame(spark), range_rows=range_rows)
                  .select("doc_id", "size", "target", "taken").collect()), key=str)
    want = sorted(((ROWS[i][0], *v) for i, v in brute.mix(ROWS).items()), key=str)
    assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want])


def test_budgets_are_exact(spark):
    rows = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), range_rows=16)
    by = rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w")).collect()
    assert all(abs(r.t - r.w) <= 0.5 for r in by)
    assert rows.where("taken > 3 * size or taken < 0").count() == 0
    assert abs(sum(r.w for r in by) - rows.agg(F.sum("size")).first()[0]) < 1e-3


def test_mixed_documents(spark):
    df = frame(spark).withColumn("n_chars", F.length("text").cast("long"))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        key = (r.doc_id, r.source)
        got[key] = got.get(key, 0) + len(brute.WORD.findall(r.text))
    want = {}
    for i, (_, _, taken) in brute.mix(ROWS).items():
        if taken:
            want[ROWS[i][:2]] = want.get(ROWS[i][:2], 0) + taken
    assert got == want


def test_empty(spark):
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mixed_documents(frame(spark, [])).count() == 0
