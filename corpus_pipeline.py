"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what its predecessor kept and calls one operator of
``lokum.llm``: language ID (documents without a recognised language go), exact
dedup, SimHash near-dedup (one document of each group stays), mixing the sources
to their target weights (takes are repeated rows, a source's last take is cut at
its budget) and best-fit packing. All but the last return the columns of the
documents table; a stage reads its input as a stable table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lokum.llm import exact_dedup, langid, mixing, packing, simhash
from lokum.llm.common import drop_work, work_mark, work_table
from lokum.session import apply_conf


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose text is null or has no letter, nor any if no row has a label."""
    apply_conf(spark)
    return langid.drop_undetermined(docs)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for white space; null is empty) the longest, then the smallest id."""
    apply_conf(spark)
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked fingerprints one row with the smallest id; null ids go where another has one."""
    apply_conf(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows as often as the mix takes them; null sources are one source, empty texts are not taken."""
    apply_conf(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces: token ids (32-bit little-endian, end to end) and their CRC-32,
    sequence and place. A null text is a document of one separator."""
    apply_conf(spark)
    return packing.pack(docs, ids="binary", digest=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact),
    ("simhash", drop_near),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language ID, fingerprints and tokenising have no SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = work_mark()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            inner = work_mark()
            docs = work_table(docs, f"stage-{name}")
            # the stage is written: its own work tables and its input are done with
            drop_work(spark, made, inner)
            made = inner
    return docs
