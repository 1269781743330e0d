"""Exact dedup with a heavy-hitter split (native: DataFrame functions only).

1. Every text becomes a SHA-256 digest of its form without white space.
2. Misra-Gries counters (``freqItems``; at most 1 / ``support`` of them, merged
   map-side) find candidate frequent digests. They are verified: an exact count
   and the winner per candidate. That table has at most 1 / ``support`` rows, so
   it is broadcast, and the rows of frequent digests are settled map-side.
3. All other digests use an ordinary aggregate and join on the digest; none of
   them holds more than about ``support`` of the rows.

A frequent digest that the counters miss takes path 3, so the split changes the
plan, never the result.

Defined cases: null text counts as empty (all empty and white-space-only texts
are equal); the row with the most code points of original text stays, then the
smallest id (null ids last), then the first row of the input, so of repeated
rows exactly one stays; an empty table gives an empty result; other columns are
ignored by ``exact_dedup`` and carried unchanged by ``drop_exact_duplicates``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lokum.llm.common import WHITE, col, free_name, stable, with_uid, work_table

SUPPORT = 0.001


def digest(text: Column) -> Column:
    return F.sha2(F.translate(F.coalesce(text, F.lit("")), WHITE, ""), 256)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return with_uid(docs.select(
        col(id_col).alias("doc_id"),
        F.length(F.coalesce(col(text_col), F.lit(""))).cast("long").alias("chars"),
        F.unhex(digest(col(text_col))).alias("digest")), "uid")


def _winner() -> list[Column]:
    order = F.struct((-F.col("chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                     F.col("doc_id"), F.col("uid"))
    return [F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size")]


def heavy_winners(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Winner and exact size of the frequent digests: at most 1 / support rows."""
    cand = (rows.select(F.hex("digest").alias("d")).stat.freqItems(["d"], support)
            .select(F.explode(F.col("d_freqItems")).alias("d"))
            .select(F.unhex("d").alias("digest")).where("digest is not null"))
    return rows.join(F.broadcast(cand), "digest").groupBy("digest").agg(*_winner()).where("group_size > 1")


def settle(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """rows(doc_id, chars, digest, uid) with ``best`` and ``group_size``."""
    heavy = work_table(heavy_winners(rows, support), "heavy")
    tagged = rows.join(F.broadcast(heavy), "digest", "left")
    hot = tagged.where("best is not null")
    cold = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    winners = cold.groupBy("digest").agg(*_winner())
    return hot.unionByName(cold.join(winners, "digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                support: float = SUPPORT) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, uid."""
    rows = work_table(_rows(docs, id_col, text_col), "digests")
    return settle(rows, support).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "uid")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          support: float = SUPPORT) -> DataFrame:
    """The rows that stay, with all their columns. Losers of frequent digests
    leave map-side, before the texts are shuffled."""
    docs = stable(docs)
    rows = work_table(_rows(docs, id_col, text_col), "digests")
    heavy = work_table(heavy_winners(rows, support), "heavy")
    dg, uid, best = (free_name(n, docs) for n in ("_digest", "_uid", "_best"))
    winners = F.broadcast(heavy.select(F.col("digest").alias(dg), F.col("best.uid").alias(best)))
    thinned = (with_uid(docs, uid).withColumn(dg, F.unhex(digest(col(text_col))))
               .join(winners, dg, "left").where(F.col(best).isNull() | (F.col(best) == F.col(uid))))
    cold = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    keep = (heavy.select("best.uid").unionByName(
        cold.groupBy("digest").agg(*_winner()).select("best.uid")).withColumnRenamed("uid", uid))
    return thinned.join(keep.hint("merge"), uid, "left_semi").select(*[col(c) for c in docs.columns])
