"""Best-fit packing."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from lokum.llm import packing

SF = "/root/testdata/sf0.01"
EDGE = [(1, "hello world"), (2, None), (3, ""), (4, "a b " * 9000), (None, "x"), (1, "hello world"),
        (6, "<|endoftext|> a  b \n c\t d <|endoftext|>"), (7, " lead  and trail "), (8, "it's 12 o'clock \x1c x")]


def check_layout(rows, capacity):
    """Gapless sequences within capacity; pieces cover their documents."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_best_fit(seed):
    rng = random.Random(seed)
    cap = rng.randint(3, 60)
    h = {rng.randint(1, cap): rng.randint(1, 9) for _ in range(rng.randint(0, 12))}
    used, count = defaultdict(list), Counter()
    for n, lo, hi, first, each, at in packing.plan(h, cap):
        for r in range(lo, hi):
            used[first + (r - lo) // each].append((at + (r - lo) % each * n, n))
            count[n] += 1
    assert count == Counter(h)
    for spans in used.values():
        end = 0
        for o, n in sorted(spans):
            assert o == end
            end += n
        assert end <= cap
    assert len(used) == brute.best_fit([n for n, k in h.items() for _ in range(k)], cap)


def test_plan_size_follows_lengths_not_counts():
    h = {n: 10 ** 9 + n for n in range(1, 2049)}
    assert len(packing.plan(h, 2048)) < 50_000


def test_parts_encode_like_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice(["a", "The", " ", "  ", "\n", "\t", " ", "é", "'s", "12", "!", "\x85", " ", "日本"])
                     for _ in range(rng.randint(0, 60))) for _ in range(400)]
    enc = packing.ChunkEncoder(packing.public_tokenizers.path(packing.TOKENIZER))
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)]
    assert got == [ids[:-1] for ids in brute.token_ids(texts)]


@pytest.mark.parametrize("table", ["edge", "documents"])
def test_pack(spark, table, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    if table == "edge":
        df = spark.createDataFrame(EDGE, "doc_id long, text string")
        for c in ("uid", "piece", "length", "body", "rank", "salt"):
            df = df.withColumn(c, F.lit("extra"))
    else:
        df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = Counter()
    lengths = []
    for (k, _), ids in zip(docs, brute.token_ids([t for _, t in docs])):
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        for p, s in enumerate([0, *range(first, len(ids), 2048)]):
            own = ids[s:first if p == 0 else s + 2048]
            lengths.append(len(own))
            want[k, p, s, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    rows = packing.pack(df, digest=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_layout(rows, 2048) == brute.best_fit(lengths, 2048)


def test_pack_gives_ids(spark):
    df = spark.createDataFrame(EDGE[:4], "doc_id long, text string")
    got = defaultdict(list)
    for r in packing.pack(df, capacity=100).orderBy("doc_id", "piece").collect():
        got[r.doc_id] += r.ids
    assert [got[k] for k, _ in EDGE[:4]] == brute.token_ids([t for _, t in EDGE[:4]])


def test_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_added_tokens_have_their_own_id(spark):
    df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "<|endoftext|>"), (3, "plain words here")],
                               "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in packing.pack(df).collect()}
    assert 50256 in got[1] and got[2] == [50256, 0] and 50256 not in got[3]
    assert [got[k] for k in (1, 2, 3)] == brute.token_ids(["a <|endoftext|> b", "<|endoftext|>", "plain words here"])


def test_the_cache_forgets_without_changing_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    enc = packing.ChunkEncoder(packing.public_tokenizers.path(packing.TOKENIZER))
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(60)}é," for _ in range(40)) for _ in range(60)]
    for k in range(0, 60, 5):
        got = enc.encode(texts[k:k + 5])
        assert [np.frombuffer(x, "<u4").tolist() + [0] for x in got] == brute.token_ids(texts[k:k + 5])
