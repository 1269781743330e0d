"""The Merkle manifest against a plain tree in Python."""

import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

from lokum.llm import merkle

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[field(v) for v in (*row[:4], text)])


def up(nodes, fanout):
    """Levels from the leaves to the single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
    return levels


def steps(levels, pos, fanout):
    out = []
    for nodes in levels[:-1]:
        lo = pos // fanout * fanout
        out.append(("".join(nodes[lo:pos]), "".join(nodes[pos + 1:lo + fanout])))
        pos //= fanout
    return out


def brute(rows, fanout=16):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        trees[g] = own, up([leaf(r, r[4]) for r in own], fanout)
    top = up([trees[g][1][-1][0] for g in order], fanout)
    out = []
    for k, g in enumerate(order):
        own, levels = trees[g]
        for pos, r in enumerate(own):
            way = steps(levels, pos, fanout) + steps(top, k, fanout)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            now = leaf(r, r[4].translate(LOWER) if bad else r[4])
            for left, right in way:
                now = h(left, now, right)
            out.append((r[0], levels[0][pos], levels[-1][0], top[-1][0], h(*[a + b for a, b in way]), now,
                        now == top[-1][0]))
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for c in ("uid", "pos", "n", "g", "item", "hash", "way", "c0", "a b", "root"):
        df = df.withColumn(c, F.lit("extra"))
    return df


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
EDGE = [(1, "a", "en", 3, "ABC"), (2, "a", None, None, None), (3, None, "en", 0, ""), (None, None, "x", 1, "é"),
        (None, None, "x", 1, "é"), (7, "", "en", 5, "Ünïc"), (7, "", "en", 5, "ünïc"), (9, "Z", "en", 1, "A" * 200_000),
        (9, "Z", "en", 1, "A" * 200_000), (10, "-", "-", 1, "-")]
MANY = ([(k, "big", "en", k, f"Text {k}") for k in range(300)] + [(k, f"s{k % 37}", "en", k, f"T {k}") for k in range(500)]
        + [(5, "big", "en", 5, "Text 5")] * 40)


@pytest.mark.parametrize("rows,fanout", [(EDGE, 16), (EDGE, 2), (MANY, 16), (MANY, 3), (EDGE[:1], 16), ([], 16)])
def test_manifest(spark, rows, fanout):
    got = merkle.manifest(frame(spark, rows), fanout=fanout)
    assert got.columns == NAMES
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, fanout), key=key)


def test_tampered_rows_fail(spark):
    got = {r.doc_id: r for r in merkle.manifest(frame(spark, MANY[:300])).collect()}
    for k, r in got.items():
        assert r.verified == (zlib.crc32(str(k).encode()) % 5 != 0)
