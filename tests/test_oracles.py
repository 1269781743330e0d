"""Every registered query against its DuckDB oracle on sf0.001 (row count,
column names and order-insensitive values). Queries that SQL cannot express are
held against brute-force versions in their own tests."""

import math

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "∅" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLES)))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    drows = [tuple(r[dcols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert _rows(df.columns, srows) == _rows(df.columns, drows)


def test_every_core_query_has_an_oracle():
    from lokum.registry import QUERIES as core
    # test_jobs: recall, and a plain TF-IDF with cosines
    assert set(core) - {"vector_lsh_topk", "search_text"} <= set(ORACLES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[0] == "rank"
    assert df.count() >= 0
