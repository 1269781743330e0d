"""Language ID and the quality classifier."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lokum.llm import langid, quality

SF = "/root/testdata/sf0.01"
EDGE = [(1, "der die das und", "de"), (2, None, "de"), (3, "", "fr"), (4, "12 %% --", "fr"), (None, "le la les", "fr"),
        (1, "der die das und", "de"), (6, "a" * 300_000, None), (7, "les eaux de la", "fr"), (8, "und der", "de"),
        (9, "½² ³", "fr"), (10, "Ωμέγα слово", "de")]


def crc(k):
    return zlib.crc32(str(k).encode())


def frame(spark, rows=EDGE):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    for c in ("uid", "held_out", "lang_pred", "score", "_score", "k", "unit", "a b"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def brute_forward(word, known, p, unknown):
    """Sum over all segmentations, character by character."""
    a = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            if word[i:j] in known:
                a[j] += a[i] * p[known[word[i:j]]]
        if word[j - 1] not in known:
            a[j] += a[j - 1] * unknown
    return a[-1]


def pieces():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=langid.public_tokenizers.path(langid.VOCABULARY))
    return {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


@pytest.mark.parametrize("words", [["a"], ["the", "und", "été"], ["ʘ日x", "qqq"], ["straßenbahn", "xxxxxxxxxxx"]])
def test_forward_sums_all_segmentations(words):
    known, trie = pieces(), langid.trie(langid.public_tokenizers.path(langid.VOCABULARY))
    p = np.random.default_rng(0).random((trie.pieces + 2, 1)) / 1000
    p[trie.pieces], p[trie.pieces + 1] = 0.0, langid.UNKNOWN
    for w in words:
        got = langid.forward(trie.lattice([langid.MARK + w]), p)[1][0, 0]
        assert got == pytest.approx(math.log(brute_forward(langid.MARK + w, known, p[:, 0], langid.UNKNOWN)))


def test_expected_counts_cover_the_words():
    trie = langid.trie(langid.public_tokenizers.path(langid.VOCABULARY))
    p = np.random.default_rng(1).random(trie.pieces + 2)
    p /= p.sum()
    p[trie.pieces], p[trie.pieces + 1] = 0.0, 1e-9
    length = {i: len(s) for s, i in pieces().items()} | {trie.pieces + 1: 1}
    out = np.zeros(trie.pieces + 2)
    langid.expected(trie.lattice(["▁theme", "▁ʘaunt"]), p, np.array([2.0, 3.0]), out)
    assert sum(length[i] * out[i] for i in np.flatnonzero(out)) == pytest.approx(6 * 2 + 6 * 3)


def test_long_word_does_not_underflow():
    trie = langid.trie(langid.public_tokenizers.path(langid.VOCABULARY))
    p = np.full((trie.pieces + 2, 2), 1 / trie.pieces)
    p[trie.pieces], p[trie.pieces + 1] = 0.0, langid.UNKNOWN
    assert np.isfinite(langid.forward(trie.lattice(["ʘ" * 3000]), p)[1]).all()


def test_long_runs_count_like_short_ones():
    trie = langid.trie(langid.public_tokenizers.path(langid.VOCABULARY))
    p = np.random.default_rng(2).random(trie.pieces + 2)
    p /= p.sum()
    p[trie.pieces], p[trie.pieces + 1] = 0.0, 1e-9
    length = {i: len(s) for s, i in pieces().items()} | {trie.pieces + 1: 1}
    out = np.zeros(trie.pieces + 2)
    langid.expected(trie.lattice([langid.MARK + "theʘaunt" * 500]), p, np.array([2.0]), out)
    assert sum(length[i] * out[i] for i in np.flatnonzero(out)) == pytest.approx(4001 * 2)


def test_labels_whose_runs_are_all_long(spark):
    rng = random.Random(4)
    words = {"l1": ["haus", "baum", "licht", "wasser"], "l2": ["casa", "arbol", "luz", "agua"],
             "l3": ["talo", "puu", "valo", "vesi"]}
    rows = [(i, "".join(rng.choice(words[k]) for _ in range(40)), k) for i, k in enumerate(sorted(words) * 40)]
    assert min(len(t) for _, t, _ in rows) > 30
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] for r in got) and any(r.held_out for r in got)


def test_identify_edges(spark):
    got = langid.identify(frame(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(k) for k, *_ in EDGE)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.held_out, r.lang_pred, r.score))
    for k, v in by.items():
        assert all(x[0] == (k is not None and crc(k) % 4 == 2) and 0 <= x[2] <= 1 for x in v)
    assert all(by[k][0][1:] == ("und", 0.0) for k in (2, 3, 4, 9))
    assert all(by[k][0][1] in ("de", "fr") for k in (1, 6, 7, 8, 10, None))
    assert len(by[1]) == 2 and by[1][0] == by[1][1]


def test_identify_without_labels_or_rows(spark):
    none = frame(spark, [(1, "text", None)])
    assert [tuple(r) for r in langid.identify(none).select("lang_pred", "score").collect()] == [("und", 0.0)]
    assert langid.identify(frame(spark, [])).count() == 0
    assert langid.drop_undetermined(frame(spark, [])).count() == 0


def test_identify_held_out_accuracy_and_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [k for k, r in got.items() if r.held_out]
    assert {k for k in lang if crc(k) % 4 == 2} == set(held)
    assert sum(got[k].lang_pred == lang[k] for k in held) >= 0.97 * len(held)
    # held-out labels are not read
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                                           F.lit("xx")).otherwise(F.col("lang")))
    again = {r.doc_id: r for r in langid.identify(other).collect()}
    assert all(again[k].lang_pred == r.lang_pred and again[k].score == pytest.approx(r.score) for k, r in got.items())


def test_drop_undetermined(spark):
    df = frame(spark)
    out = langid.drop_undetermined(df)
    assert out.columns == df.columns
    assert not {2, 3, 4, 9} & {r.doc_id for r in out.collect()}


def test_drop_undetermined_keeps_unsure_documents(spark):
    texts = ["one two three", "four five six", "seven eight nine"]
    rows = [(i, texts[i % 3], f"l{i % 7}") for i in range(210)]  # seven labels, all alike
    df = spark.createDataFrame([*rows, (300, "12 !!", "l0")], "doc_id long, text string, lang string")
    scores = [r.score for r in langid.identify(df).where("lang_pred <> 'und'").collect()]
    assert len(scores) == 210 and max(scores) < 0.5
    assert sorted(r.doc_id for r in langid.drop_undetermined(df).collect()) == list(range(210))


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    want = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (crc(k) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
               for k, r in got.items())
    held = [k for k in want if got[k].held_out]
    assert sum(got[k].predicted == want[k] for k in held) >= 0.95 * len(held)
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r for r in quality.classify(docs, flipped).collect()}
    assert all(again[k].score == pytest.approx(r.score, abs=1e-9) for k, r in got.items())


def test_quality_edges(spark):
    docs = frame(spark).drop("lang")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 0), (99, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    empty = {r.doc_id: r.score for r in got if r.doc_id in (2, 3)}
    assert empty[2] == empty[3]
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_ftrl_learns_a_separable_problem():
    rng = random.Random(0)
    features, rows = quality.Features(), []
    for _ in range(400):
        good = rng.random() < 0.5
        rows.append((*features.of(" ".join(rng.choice("abcdef" if good else "efghij") for _ in range(30))), float(good)))
    w = quality.ftrl(rows)
    assert np.mean([(w[s] @ v > 0) == (y == 1) for s, v, y in rows]) > 0.97


def brute_ftrl(rows, epochs):
    """FTRL-proximal with dictionaries, coordinate by coordinate."""
    z, n = {}, {}

    def weight(k):
        zk, nk = z.get(k, 0.0), n.get(k, 0.0)
        if abs(zk) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, zk) - zk) / ((quality.BETA + math.sqrt(nk)) / quality.ALPHA + quality.L2)

    for _ in range(epochs):
        for slots, values, label in rows:
            w = {k: weight(k) for k in slots}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in zip(slots, values))))
            for k, v in zip(slots, values):
                g = (p - label) * v
                s = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / quality.ALPHA
                z[k] = z.get(k, 0.0) + g - s * w[k]
                n[k] = n.get(k, 0.0) + g * g
    return {k: weight(k) for k in z}


def labelled(spark, n=240):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdef" if k % 2 else "efghij") for _ in range(30)), k % 2) for k in range(n)]
    return (rows, spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"),
            spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, quality int"))


def test_ftrl_and_scores_equal_the_plain_version(spark):
    rows, docs, labels = labelled(spark)
    features = quality.Features()
    learn = [r for r in rows if crc(r[0]) % 3 != 1]
    turn = {r.doc_id: r.turn for r in docs.select(
        "doc_id", F.xxhash64(F.lit("turn"), F.col("doc_id").cast("string")).alias("turn")).collect()}
    learn.sort(key=lambda r: turn[r[0]])
    plain = brute_ftrl([(s.tolist(), v.tolist(), y) for s, v, y in
                        ((*features.of(t), y) for _, t, y in learn)], quality.EPOCHS)
    w = quality.train(docs, labels, learn_from=~langid.held_out(F.col("doc_id"), 3, 1), shards=1)
    assert {k for k, x in plain.items() if x} == set(np.flatnonzero(w).tolist())
    assert all(w[k] == pytest.approx(x, abs=1e-9) for k, x in plain.items())
    got = {r.doc_id: r.score for r in quality.classify(docs, labels, shards=1).collect()}
    for k, t, _ in rows:
        slots, values = features.of(t)
        x = sum(plain.get(s, 0.0) * v for s, v in zip(slots.tolist(), values.tolist()))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-9)


def test_quality_ignores_labels_of_absent_ids(spark):
    _, docs, labels = labelled(spark)
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels, sample_rows=10 ** 6).collect()}
    more = labels.unionByName(spark.range(10_000, 30_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality"))
    again = {r.doc_id: r.score for r in quality.classify(docs, more, sample_rows=10 ** 6).collect()}
    assert all(again[k] == pytest.approx(s, abs=1e-9) for k, s in scores.items())


def test_quality_learns_an_id_of_many_rows_once(spark):
    _, docs, labels = labelled(spark)
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    copies = docs.unionByName(docs.where("doc_id = 4").crossJoin(spark.range(3000)).select("doc_id", "text"))
    again = {r.doc_id: r.score for r in quality.classify(copies, labels).collect()}
    assert all(again[k] == pytest.approx(s, abs=1e-9) for k, s in scores.items())


def test_a_language_called_und_is_a_language(spark):
    words = {"und": "haus baum licht", "l2": "casa arbol luz"}
    rows = [(k, words[x], x) for k, x in enumerate(["und", "l2"] * 40)]
    df = spark.createDataFrame([*rows, (100, "12 !!", "und")], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in langid.drop_undetermined(df).collect()) == list(range(80))


def test_expected_counts_equal_enumerated_segmentations():
    known, trie = pieces(), langid.trie(langid.public_tokenizers.path(langid.VOCABULARY))
    p = np.random.default_rng(6).random(trie.pieces + 2) / 1000
    p[trie.pieces], p[trie.pieces + 1] = 0.0, langid.UNKNOWN
    for word in (langid.MARK + "the", langid.MARK + "unʘd", langid.MARK + "ation"):
        ways = [[]]
        for k in range(1, len(word) + 1):
            ways = [[*w, k] for w in ways] + ways if k < len(word) else [[*w, k] for w in ways]
        total, want = 0.0, {}
        for cuts in ways:
            parts = [word[a:b] for a, b in zip([0, *cuts], cuts)]
            ids = [known.get(x, trie.pieces + 1 if len(x) == 1 else None) for x in parts]
            if None in ids:
                continue
            mass = float(np.prod([p[i] for i in ids]))
            total += mass
            for i in ids:
                want[i] = want.get(i, 0.0) + mass
        out = np.zeros(trie.pieces + 2)
        langid.expected(trie.lattice([word]), p, np.array([3.0]), out)
        assert set(np.flatnonzero(out).tolist()) == set(want)
        assert all(out[i] == pytest.approx(3 * m / total) for i, m in want.items())
