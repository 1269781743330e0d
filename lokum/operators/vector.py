"""Vector similarity and top-k.

* Single query (W7): the query vector is a literal array; similarity is a JVM
  higher-order expression (``aggregate(zip_with(...))``), the threshold a
  filter, and ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject
  (per-partition top-k, then one small merge).
* Query batch (W8): shards of items meet blocks of queries, both of bounded
  size, in co-grouped numpy tasks that return their local top-k per query; a
  ranked window cuts those again, before and after its shuffle.

Thresholds and ranks use the full similarity (float32 inputs, float64
arithmetic), ties go to the smaller item id; only what is shown is rounded.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col_, round_to

SIM_DECIMALS = 4
MAX_QUERY_MATRIX_BYTES = 256 * 1024 * 1024


def dot(a, b) -> Column:
    z = F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(z, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(col_(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b, b_norm: Column | None = None) -> Column:
    """Cosine similarity; null when either vector has zero norm (V2: a zero
    vector never matches)."""
    na = norm(a)
    nb = b_norm if b_norm is not None else norm(b)
    den = na * nb
    return F.when(den > 0, dot(a, b) / den)


def vec_literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def similarity(vec_col: str, query: Sequence[float] | Column) -> Column:
    """Cosine similarity to one query vector; a literal one is scaled to length
    one here, so a row costs one dot product and its own norm."""
    if isinstance(query, Column):
        return cosine(vec_col, query)
    length = math.sqrt(sum(float(x) * float(x) for x in query))
    if not length:
        return F.lit(None).cast("double")
    na = norm(vec_col)
    return F.when(na > 0, dot(vec_col, vec_literal([float(x) / length for x in query])) / na)


def rounded(sim) -> Column:
    return round_to(sim, SIM_DECIMALS)


def topk(df: DataFrame, sim_col: str, k: int | None, threshold: float | None,
         id_col: str) -> DataFrame:
    """Rows with sim > threshold, best ``k`` by (sim desc, id)."""
    out = df
    if threshold is not None:
        out = out.filter(F.col(sim_col) > F.lit(float(threshold)))
    out = out.orderBy(F.col(sim_col).desc(), F.col(id_col).asc())
    return out.limit(k) if k is not None else out


# --- W8: batch top-k ---------------------------------------------------------

SHARD_ROWS, BLOCK_ROWS = 16_384, 2_048
MATRIX_CELLS = 2_097_152  # similarities held at once: 16 MB


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    m = pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy(zero_copy_only=False)
    m = m.astype(np.float64).reshape(-1, dim)
    n = np.sqrt((m * m).sum(axis=1))
    n[n == 0] = np.nan
    return m / n[:, None]


def _best_of(k: int, threshold: float | None, query_id: str, item_id: str):
    """Co-group function: the k best items of a group for each of its queries."""
    least = -np.inf if threshold is None else float(threshold)

    def best(own: pa.Table, asks: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if own.num_rows and asks.num_rows:
            dim = own["dim"][0].as_py()
            ids, m = own["id"].to_numpy(), _matrix(own["v"], dim)
            step = max(1, min(BLOCK_ROWS, MATRIX_CELLS // own.num_rows))
            for lo in range(0, asks.num_rows, step):
                block = asks.slice(lo, step)
                for name, sims in zip(block["id"].to_pylist(), _matrix(block["v"], dim) @ m.T):
                    at = np.flatnonzero(sims > least)
                    if len(at) > k:
                        low = np.partition(sims[at], len(at) - k)[len(at) - k]
                        at = at[sims[at] >= low]
                    at = at[np.lexsort((ids[at], -sims[at]))[:k]]
                    found.append((np.full(len(at), name), ids[at], sims[at]))
        cols = [np.concatenate(c) for c in zip(*found)] or [[], [], []]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                         pa.array(cols[2], pa.float64())], [query_id, item_id, "similarity"])

    return best


def _ranked(local: DataFrame, k: int, query_id: str, item_id: str) -> DataFrame:
    w = Window.partitionBy(query_id).orderBy(F.desc("similarity"), F.asc(item_id))
    return local.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def batch_topk(items: DataFrame, queries: DataFrame, k: int, threshold: float | None = None,
               item_id: str = "item_id", item_vec: str = "embedding",
               query_id: str = "query_id", query_vec: str = "embedding",
               shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top-k items per query by cosine similarity (exact).

    Items are dealt into shards and queries into blocks of bounded size; each
    (shard, block) is a task of its own that returns its k best per query, and
    a window with a pre-shuffle group limit keeps the best of those. Nothing is
    collected or broadcast, whatever the number of queries."""
    shards = max(1, -(-items.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))

    def deal(name: str, n: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n)).cast("int")

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    i = items.select(F.col(item_id).cast("long").alias("id"), F.size(item_vec).alias("dim"),
                     deal(item_id, shards).alias("shard"), F.col(item_vec).alias("v"))
    q = queries.select(F.col(query_id).cast("long").alias("id"), F.size(query_vec).alias("dim"),
                       deal(query_id, blocks).alias("block"), F.col(query_vec).alias("v"))
    key = ["dim", "shard", "block"]
    i = i.where("dim > 0").select("*", spread(blocks).alias("block")).groupBy(*key)
    q = q.where("dim > 0").select("*", spread(shards).alias("shard")).groupBy(*key)
    local = i.cogroup(q).applyInArrow(_best_of(k, threshold, query_id, item_id),
                                      f"{query_id} long, {item_id} long, similarity double")
    return _ranked(local, k, query_id, item_id)


# --- W8, approximate: hashed by random hyperplanes, re-ranked exactly -----------

LSH_TABLES, LSH_BITS, LSH_SEED = 12, 5, 7
LSH_PROBES = 3  # buckets that a query looks into, a table


def _bucketed(df: DataFrame, id_col: str, vec_col: str, tables: int, bits: int, seed: int, probes: int = 1) -> DataFrame:
    """id, dim, v and a row per table and probed bucket. A bucket says on which
    side of each of the table's hyperplanes the vector lies; the further probes
    are the buckets across the hyperplanes that it is nearest to."""
    own = df.select(F.col(id_col).cast("long").alias("id"), F.size(vec_col).alias("dim"),
                    F.col(vec_col).alias("v")).where("dim > 0")
    if own.schema["v"].dataType.elementType.typeName() != "float":
        own = own.withColumn("v", F.transform("v", lambda x: x.cast("double")))
    across = min(probes - 1, bits)

    def sides(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            codes = []
            for v in b.column(2).to_pylist():
                n = len(v)
                if n not in planes:
                    planes[n] = np.random.default_rng([seed, n]).standard_normal((n, tables * bits))
                far = (np.array(v, dtype=np.float64) @ planes[n]).reshape(tables, bits)
                code = ((far > 0) << np.arange(bits)).sum(1)[:, None]
                near = np.argsort(np.abs(far), axis=1, kind="stable")[:, :across]
                codes.append(np.concatenate((code, code ^ (1 << near)), axis=1).tolist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(codes, pa.list_(pa.list_(pa.int32())))],
                                             ["id", "dim", "v", "codes"])

    kind = own.schema["v"].dataType.simpleString()
    return (own.mapInArrow(sides, f"id long, dim int, v {kind}, codes array<array<int>>")
            .select("id", "dim", "v", F.posexplode("codes").alias("hash_table", "buckets"))
            .select("id", "dim", "v", "hash_table", F.explode("buckets").alias("bucket")))


def lsh_topk(items: DataFrame, queries: DataFrame, k: int, threshold: float | None = None,
             item_id: str = "item_id", item_vec: str = "embedding", query_id: str = "query_id",
             query_vec: str = "embedding", tables: int = LSH_TABLES, bits: int = LSH_BITS, seed: int = LSH_SEED,
             shard_rows: int = SHARD_ROWS, probes: int = LSH_PROBES) -> DataFrame:
    """Approximate top-k: in each table a query meets the items of its own
    bucket and of the ``probes - 1`` buckets across its nearest hyperplanes, by
    their exact similarity. Large buckets are dealt into shards of items and
    blocks of queries, both of bounded size; their size tables have at most
    tables * 2^bits rows per dimension."""
    i = _bucketed(items, item_id, item_vec, tables, bits, seed)
    q = _bucketed(queries, query_id, query_vec, tables, bits, seed, probes)
    where = ["dim", "hash_table", "bucket"]

    def pieces(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias(name))

    def deal(df: DataFrame, own: str, other: str) -> DataFrame:
        return (df.join(sizes, where).withColumn("own", F.pmod(F.xxhash64("id"), F.col(own)).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
                .select("id", "v", *where, F.col("own").alias(own[:-1]), F.col("other").alias(other[:-1])))

    sizes = pieces(i, "shards").join(pieces(q, "blocks"), where)
    key = [*where, "shard", "block"]
    local = deal(i, "shards", "blocks").groupBy(*key).cogroup(deal(q, "blocks", "shards").groupBy(*key)).applyInArrow(
        _best_of(k, threshold, query_id, item_id), f"{query_id} long, {item_id} long, similarity double")
    # a pair that meets in several tables counts once
    return _ranked(local.groupBy(query_id, item_id).agg(F.max("similarity").alias("similarity")), k, query_id, item_id)
