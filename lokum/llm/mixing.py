"""Mixing sources to target weights (native: DataFrame functions only).

1. Every row gets its token count (words) and a hash-random key of its id.
2. Sources, in code-point order with null last, weigh ``weights`` in turn. Their
   targets share ``total`` of all tokens by weight and stop at ``max_epochs``
   times the source's own size, the excess going to the others by weight. Sorted
   by size / weight that is one running sum over the table of sources.
3. Within a source rows are range-sorted by key: a source is cut into key ranges
   of about ``RANGE_ROWS`` rows, the sums of whole ranges are summed up first and
   running sums inside the ranges follow, so no task holds a source.
4. A source's exact budget is cut there: every row of the full epochs, then the
   rows before the cut once more; the row at the cut gives its first words.

Defined cases: null text has size 0; null sources form one source, the last;
null ids and repeated rows are ordinary rows (ties in key and id go by input
order); size-0 rows and sources take nothing; an empty table gives an empty
result; other columns are ignored by ``mix`` and carried by ``mixed_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lokum.llm.common import WORD, col, free_name, stable, with_uid, work_table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
RANGE_ROWS = 4096
SEED = "mix"


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources(source, source_size, ...) with weight and target: one row each."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    s = sources.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                                                  (turn + 1).cast("int")))
    s = s.withColumn("most", F.col("source_size") * max_epochs)
    by_room = (Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
               .rowsBetween(Window.unboundedPreceding, -1))
    everything = Window.partitionBy()
    # the share of a unit of weight if all sources with less room than this one are full;
    # it rises while sources fill up and falls after, so the largest is the final one
    unit = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(by_room), F.lit(0))).cast("double")
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0))).cast("double"))
    s = s.withColumn("unit", unit).withColumn("unit", F.max("unit").over(everything))
    return s.withColumn("target", F.least(F.col("most").cast("double"), F.col("unit") * F.col("weight"))).drop(
        "most", "unit")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, source, uid."""
    rows = work_table(with_uid(docs.select(
        col(id_col).alias("doc_id"), col(source_col).alias("source"), words(col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit("")))).alias("key")), "uid"), "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = work_table(targets(sources, weights, max_epochs).withColumn(
        "ranges", F.ceil(F.col("n") / F.lit(range_rows))), "sources")
    uniform = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    named = sources.select(F.col("source").alias("s"), "source_size", "target", "ranges")
    dealt = (rows.join(named, rows.source.eqNullSafe(named.s)).drop("s")
             .withColumn("range", F.floor(uniform * F.col("ranges") / F.lit(2 ** 32)).cast("long")))
    earlier = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    base = (dealt.groupBy(F.col("source").alias("s"), F.col("range").alias("r")).agg(F.sum("size").alias("sum"))
            .withColumn("base", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum"))
    inside = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "uid")
              .rowsBetween(Window.unboundedPreceding, -1))
    summed = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = summed.join(base, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    budget = F.floor(F.col("target") + 0.5)
    own = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(budget / own)
    rest = budget - epochs * own - F.col("base") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "uid")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row per whole take, and a
    shortened row (its first words) for the row at a source's cut."""
    docs = stable(docs)
    uid, size, taken, take = (free_name(n, docs) for n in ("_uid", "_size", "_taken", "_take"))
    plan = (mix(docs, id_col, text_col, source_col, **options).where("taken > 0")
            .select(F.col("uid").alias(uid), F.col("size").alias(size), F.col("taken").alias(taken)))
    copies = F.sequence(F.lit(1).cast("long"), F.ceil(F.col(taken) / F.col(size)))
    rest = F.col(taken) - (F.col(take) - 1) * F.col(size)
    spaced = F.regexp_extract_all(col(text_col), F.lit("[\\x20\\x09-\\x0D]*" + WORD), F.lit(0))
    text = F.when(rest >= F.col(size), col(text_col)).otherwise(
        F.array_join(F.slice(spaced, F.lit(1), rest.cast("int")), ""))
    out = with_uid(docs, uid).join(plan.hint("merge"), uid).withColumn(take, F.explode(copies)).withColumn(text_col, text)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.length(col(text_col)).cast(kind))
    return out.select(*[col(c) for c in docs.columns])
