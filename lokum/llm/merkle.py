"""Merkle dataset manifest by slot pivots (DataFrame functions only).

1. A leaf is the digest of a row's length-prefixed fields. Rows are numbered per
   group in leaf order without a window over a group: range partitions are sorted,
   a row's place is its index in the partition plus the rows of its group in the
   partitions before.
2. Level by level, conditional aggregates spread the children of a parent into
   ``FANOUT`` slot columns; the concatenated columns are hashed to the parent. A
   group with one node left is done: that node is its subroot. The subroots, in
   group order, are the leaves of one more tree of the same kind.
3. Top down, a pivoted parent is taken apart again: the slots before and after a
   child's own are its siblings, and the parent's own list of siblings follows.
   A leaf so gets its proof without a join at the leaf level.
4. ``folded_root`` hashes a leaf upwards through its siblings.

Defined cases: null fields are ``-`` in a leaf, empty ones ``0:``; null groups
come first and are one group; null ids come first in their group and are never
tampered with; rows with equal ids go by their leaf, whole copies of a row are
leaves side by side; an empty table gives an empty result; columns other than
``fields`` are not read, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lokum.llm.common import col, with_uid, work_table

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5
WAY = "array<struct<l:string,r:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(parts: list[Column]) -> Column:
    """SHA-256 of the concatenated parts; null parts are absent."""
    return F.sha2(F.concat_ws("", *parts), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0, within the group by ``order``) and ``n`` (rows
    of the group). ``order`` must be total up to rows that are alike."""
    spark = rows.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [*group, *order]
    placed = work_table(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                        .withColumn("_at", F.monotonically_increasing_id())
                        .withColumn("_part", F.shiftright("_at", 33)), name)
    # a row per partition and group; a group's rows lie in neighbouring partitions
    whole = Window.partitionBy(*group)
    sums = (placed.groupBy("_part", *group).agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
            .withColumn("_before", F.sum("_c").over(whole.orderBy("_part")) - F.col("_c"))
            .withColumn("n", F.sum("_c").over(whole)))
    right = sums.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_{g}") for g in group],
                        (F.col("_before") - F.col("_first")).alias("_shift"), "n")
    same = F.col("_part") == F.col("_p")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (placed.join(right, same).withColumn("pos", F.col("_at") + F.col("_shift"))
            .drop("_at", "_part", "_p", "_shift", *[f"_{g}" for g in group]))


def pivoted(nodes: DataFrame, group: list[str], fanout: int) -> DataFrame:
    """nodes(group, n, pos, item struct with ``hash``) to parents: group, n (of the
    children's level), pos, c0.. (the children's items) and hash."""
    spread = [F.expr(f"max(CASE WHEN pos % {fanout} = {k} THEN item END) AS c{k}") for k in range(fanout)]
    up = (nodes.withColumn("_up", F.floor(F.col("pos") / fanout)).groupBy(*group, "n", F.col("_up").alias("pos"))
          .agg(*spread))
    beside = ", ".join(f"c{k}.hash" for k in range(fanout))
    return up.withColumn("hash", F.expr(f"sha2(concat_ws('', {beside}), 256)"))


def children(parents: DataFrame, group: list[str], fanout: int, *more: str) -> DataFrame:
    """The children of pivoted parents: group, up (the parent's place), slot, item,
    the hashes in the slots before and after (own) and the columns ``more``."""
    beside = ", ".join(f"c{k}.hash" for k in range(fanout))
    slots = ", ".join(f"c{k}" for k in range(fanout))
    kids = parents.selectExpr(*group, "pos AS up", f"array({beside}) AS beside", *more,
                              f"posexplode(array({slots})) AS (slot, item)").where("item IS NOT NULL")
    own = (f"CAST(array(struct(array_join(slice(beside, 1, slot), '') AS l, "
           f"array_join(slice(beside, slot + 2, {fanout}), '') AS r)) AS {WAY}) AS own")
    return kids.selectExpr(*group, "up", "slot", "item", own, *more)


def climb(nodes: DataFrame, group: list[str], fanout: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Subroots (group, hash) and the pivoted levels from the leaves up.
    nodes(group, n, pos, item)."""
    levels: list[DataFrame] = []
    done = nodes.where("n = 1").select(*group, F.col("item")["hash"].alias("hash"))
    most = nodes.agg(F.max("n")).first()[0] or 0
    left = nodes
    while most > 1:
        up = work_table(pivoted(left.where("n > 1"), group, fanout), f"{name}-{len(levels)}")
        levels.append(up)
        left = up.select(*group, F.ceil(F.col("n") / fanout).cast("long").alias("n"), "pos",
                         F.struct("hash").alias("item"))
        done = done.unionByName(left.where("n = 1").select(*group, F.col("item")["hash"].alias("hash")))
        most = -(-most // fanout)
    return work_table(done, f"{name}-roots"), levels


def same_group(a: DataFrame, b: DataFrame, group: list[str]) -> Column:
    out = F.lit(True)
    for g in group:
        out &= a[g].eqNullSafe(b[f"_{g}"])
    return out


def with_way(rows: DataFrame, above: DataFrame | None, ends: DataFrame, group: list[str], alone: Column) -> DataFrame:
    """rows(group, pos, ...) with the way up and the subroot: of a subroot (``alone``)
    that of its group in ``ends``, of other nodes that of the same node in ``above``."""
    def renamed(df: DataFrame, *keys: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"_{k}") for k in keys], "way", "subroot")

    end = renamed(ends, *group)
    out = rows.where(alone).join(end, same_group(rows, end, group)).drop(*[f"_{g}" for g in group])
    if above is not None:
        up = renamed(above, *group, "pos")
        more = rows.where(~alone).join(up, (rows.pos == up["_pos"]) & same_group(rows, up, group))
        out = out.unionByName(more.drop("_pos", *[f"_{g}" for g in group]))
    return out


def leaf_ways(nodes: DataFrame, levels: list[DataFrame], ends: DataFrame, group: list[str], fanout: int,
              name: str) -> DataFrame:
    """item, way, subroot of every leaf. ``ends`` has group, subroot and the way on
    from there: one row a group, joined where a group has one node, never per leaf."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        kids = children(with_way(levels[k], above, ends, group, F.col("n") <= fanout), group, fanout, "way", "subroot")
        way = F.concat("own", "way").alias("way")
        if k:
            above = work_table(kids.select(*group, (F.col("up") * fanout + F.col("slot")).alias("pos"), way, "subroot"),
                               f"{name}-way-{k}")
        else:
            above = kids.select("item", way, "subroot")
    single = with_way(nodes.where("n = 1"), None, ends, group, F.lit(True)).select("item", "way", "subroot")
    return single if above is None else single.unionByName(above)


def fold(leaf: Column, way: Column) -> Column:
    return F.aggregate(way, leaf, lambda acc, s: F.sha2(F.concat(s["l"], acc, s["r"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text",
             fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT, tamper_every: int = TAMPER_EVERY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. Rows whose
    id's CRC-32 is a multiple of ``tamper_every`` are folded from a leaf whose text
    is lower-cased (A-Z)."""
    def leaf(text: Column) -> Column:
        return digest([field(text if f == text_col else col(f)) for f in fields])

    spark: SparkSession = docs.sparkSession
    lowered = F.translate(col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(col(id_col).cast("string").cast("binary")) % tamper_every == 0
    own = leaf(col(text_col))
    rows = work_table(with_uid(docs.select(
        col(group_col).alias("g"), col(id_col).alias("doc_id"), own.alias("hash"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf(lowered)).otherwise(own).alias("now")), "uid"), "leaves")
    nodes = numbered(rows, ["g"], ["doc_id", "hash", "uid"], "leaf-order").select(
        "g", "n", "pos", F.struct("hash", "doc_id", "now").alias("item"))
    subroots, levels = climb(nodes, ["g"], fanout, "group")
    # the tree over the groups, all of them one group
    tops = numbered(subroots.withColumn("all", F.lit(0)), ["all"], ["g"], "group-order").select(
        "all", "n", "pos", F.struct("hash", "g").alias("item"))
    roots, over = climb(tops, ["all"], fanout, "top")
    end = roots.select("all", F.col("hash").alias("subroot"), F.array().cast(WAY).alias("way"))
    ends = leaf_ways(tops, over, end, ["all"], fanout, "top").select(
        F.col("item.g").alias("g"), F.col("item.hash").alias("subroot"), "way")
    root = roots.first()  # one row, or none
    out = leaf_ways(nodes, levels, work_table(ends, "group-ends"), ["g"], fanout, "group")
    siblings = F.transform("way", lambda s: F.concat(s["l"], s["r"]))
    out = out.select(
        F.col("item.doc_id").alias("doc_id"), F.col("item.hash").alias("leaf"), "subroot",
        F.lit(root.hash if root else None).cast("string").alias("root"),
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        fold(F.col("item.now"), F.col("way")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
