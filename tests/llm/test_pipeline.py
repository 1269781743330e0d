"""The corpus pipeline against a chain of the brute-force versions."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from lokum.llm import langid
from lokum.llm.common import stable, work_table
from test_packing import check_layout

SF = "/root/testdata/sf0.001"


def exact(rows):
    best = {}
    for i, (k, s, t) in enumerate(rows):
        key = brute.exact_key(t)
        best[key] = min(best.get(key, (1,)), (-len(t or ""), k, i)) if key in best else (-len(t or ""), k, i)
    kept = {i for *_, i in best.values()}
    return [r for i, r in enumerate(rows) if i in kept]


def near(rows):
    items = [(k, brute.fingerprint(t)) for k, _, t in rows]
    return [r for r, c in zip(rows, brute.components(items)) if r[0] == c]


def mixed(rows):
    out = []
    for i, (size, _, taken) in brute.mix(rows).items():
        k, s, text = rows[i]
        whole, part = divmod(taken, size) if size else (0, 0)
        out += [(k, s, text)] * whole
        if part:
            ends = [m.end() for m in brute.WORD.finditer(text)]
            out.append((k, s, text[:ends[part - 1]]))
    return out


def test_stages_and_whole_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = docs.limit(3).select((F.col("doc_id") + 100_000).alias("doc_id"), F.lit("12 !! 34").alias("text"), "lang",
                                "source", "n_chars")
    docs = work_table(docs.unionByName(junk).unionByName(docs.where("doc_id < 5")), "docs")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want = [r for r in rows if any(c.isalpha() for c in r[2] or "")]
    for (name, stage), brute_stage in zip(corpus_pipeline.STAGES[:4], (None, exact, near, mixed)):
        out = work_table(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns
        want = want if brute_stage is None else brute_stage(want)
        assert Counter((r.doc_id, r.source, r.text) for r in out.collect()) == Counter(want), name
        docs = out
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF).collect()
    lengths, all_ids = [], Counter()
    for ids in brute.token_ids([t for _, _, t in want]):
        all_ids[tuple(ids)] += 1
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        lengths += [first] + [2048] * ((len(ids) - first) // 2048)
    assert Counter(r.length for r in packed) == Counter(lengths)
    assert check_layout(packed, 2048) == brute.best_fit(lengths, 2048)
    # the token ids come out whole: as many ids of each value as the kept texts have
    flat = Counter()
    for ids, n in all_ids.items():
        for i in ids:
            flat[i] += n
    assert Counter(i for r in packed for i in np.frombuffer(r.ids, "<u4").tolist()) == flat
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in packed)


def test_odd_rows_go_through_all_stages(spark):
    rows = [(None, "der die das und", "de", "s"), (1, "der die das und", "de", "s"), (1, "der die das und", "de", "s"),
            (2, None, "de", "s"), (3, "", None, None), (4, "la casa de la luz", "es", None), (5, "x " * 60_000, "es", "t"),
            (6, "12 34 !!", "es", "t"), (7, "le chat noir dort bien", None, "t"), (None, "la mesa blanca", "es", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in ("uid", "_uid", "score", "lang_pred", "fingerprint", "root", "size", "taken", "piece", "ids", "a b"):
        df = df.withColumn(c, F.lit("extra"))
    docs = work_table(df.coalesce(2), "odd")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = work_table(stage(spark, docs, SF), "odd-stage")
        assert docs.columns == df.columns, name
        assert {r[0] for r in docs.select("a b").collect()} == {"extra"}
        if name == "language_id":
            assert {(r.doc_id, r.text) for r in docs.collect()} == {r[:2] for r in rows if any(
                c.isalpha() for c in r[1] or "")}
    packed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} <= {None, 1, 4, 5, 7} and packed.count() > 0


def test_run_and_empty(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_unstable_inputs_are_written_first(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert stable(docs.where("doc_id > 3")).inputFiles() == docs.inputFiles()
    assert stable(docs.repartition(3)).inputFiles() != docs.inputFiles()


def test_language_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert langid.drop_undetermined(docs).count() == docs.count()
