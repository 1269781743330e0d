"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lokum.llm import (ann, chat, exact_dedup, langid, line_dedup, main_text, merkle, mixing, packing, quality, runs,
                       simhash, warc)
from lokum.llm.common import work_table
from lokum.session import apply_conf
from lokum.sources.tables import read_table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return langid.identify(docs).drop("uid")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.simhash_components(docs).select("doc_id", "fingerprint", "component_id")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).drop("uid", "source")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup.exact_dedup(docs).drop("uid")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.classify(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))


# a conversation whose texts are control strings themselves
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    out = work_table(chat.format_chats(turns.unionByName(probe)), "chats")
    read = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"),
                      chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").alias("chars"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return line_dedup.drop_recurring_lines(docs).drop("uid")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, F.col("vec_id") % 20 == 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, ids=None, digest=True)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(read_table(spark, sf_dir, "documents", "doc_id", "text"), loop=True)


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def _with_conf(f: Callable) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return f(spark, sf_dir)
    return run


QUERIES = {f.__name__: _with_conf(f) for f in (
    op1_language_id, op2_simhash, op3_mixing, op4_exact_dedup, op5_quality,
    op6_chat, op7_warc, op8_line_dedup, op9_ann, op10_packing,
    op11_merkle, op12_runs, op13_main_text)}
