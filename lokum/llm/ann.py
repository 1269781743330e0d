"""Approximate nearest neighbours by collision counting (query-aware hashing).

Nearness is the largest inner product. Vectors get one more component that makes
all lengths equal and queries are scaled to that length, so the largest inner
products are the smallest distances. The index of a shard is ``PROJECTIONS``
sorted arrays, one per random projection. A query opens a window around its own
projection in each array; a vector inside a window collides. Windows are widened
by virtual rehashing, without rehashing anything: the vectors with the most
collisions in first, narrow windows are verified; the distance of the k-th of
them is the next radius, which no true neighbour exceeds. Vectors whose
collisions reach the threshold, which a vector at that radius reaches with
probability ``CERTAINTY``, are verified by their exact inner product. Nothing is
fitted, every vector is indexed, and no number of candidates is capped.

Shards of about ``SHARD_ROWS`` vectors meet blocks of about ``BLOCK_ROWS``
queries, each two in a task of their own; a task returns its k best per query
and the best of these are picked by a window that cuts before the shuffle.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; a query meets vectors of its own dimension only; ties
go to the smaller id (null ids last); repeated rows are candidates each, a row is
never its own candidate; a repeated query row is searched each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import chain
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lokum.llm.common import col, with_uid, work_table

PROJECTIONS = 40
WIDTH = 1.43           # half a window, in radii
CERTAINTY = 0.85
FIRST_WINDOW = 0.05    # share of a shard in the first windows
FIRST_SHARE = 0.02     # share of a shard that is verified for the next radius
SHARD_ROWS = 32_768
BLOCK_ROWS = 1024
AT_ONCE = 64           # queries
SEED = 20


def threshold(projections: int = PROJECTIONS, width: float = WIDTH, certainty: float = CERTAINTY) -> int:
    """Collisions that a vector at the radius reaches with this probability."""
    p = 2 * NormalDist().cdf(width) - 1
    return int(projections * p - NormalDist().inv_cdf(certainty) * (projections * p * (1 - p)) ** 0.5)


class Index:
    """Sorted projections of one shard."""

    def __init__(self, vectors: np.ndarray, projections: int, seed: int):
        self.vectors = vectors
        norms = np.einsum("ij,ij->i", vectors, vectors)
        self.top = float(np.sqrt(norms.max()))
        self.a = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, projections))
        rest = np.sqrt(np.maximum(self.top ** 2 - norms, 0.0))
        p = vectors @ self.a[:-1] + rest[:, None] * self.a[-1]
        self.order = np.argsort(p, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(p.T, self.order, axis=1)

    def windows(self, at: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end position of each query's window in each sorted array."""
        lo = np.stack([np.searchsorted(p, x - half, "left") for p, x in zip(self.sorted, at.T)], 1)
        hi = np.stack([np.searchsorted(p, x + half, "right") for p, x in zip(self.sorted, at.T)], 1)
        return lo, hi

    def collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many of one query's windows hold each vector."""
        m, n = self.order.shape
        spans = zip(self.order, lo.tolist(), hi.tolist())
        if 2 * (hi - lo).sum() <= m * n:
            return np.bincount(np.concatenate([o[a:b] for o, a, b in spans]), minlength=n)
        return m - np.bincount(np.concatenate([x for o, a, b in spans for x in (o[:a], o[b:])]), minlength=n)

    def search(self, queries: np.ndarray, own: list[int | None], k: int, need: int):
        """Per query (rows, inner products) of at least the k nearest found, ties included."""
        n, everything = len(self.vectors), np.arange(len(self.vectors))
        if n <= 8 * k:
            for query, me in zip(queries, own):
                yield self.verified(query, everything, me, k)
            return
        scale = self.top / np.sqrt(np.einsum("ij,ij->i", queries, queries))
        at = (queries * scale[:, None]) @ self.a[:-1]
        first = max(8 * k, int(FIRST_SHARE * n))
        near = np.searchsorted(self.sorted[0], at[:, 0])
        step = int(np.ceil(FIRST_WINDOW * n / 2))
        edges = self.sorted[0][np.clip(np.stack((near - step, near + step)), 0, n - 1)]
        seeds, radius = [], np.empty(len(queries))
        for i, (lo, hi) in enumerate(zip(*self.windows(at, np.abs(edges - at[:, 0]).max(0) + 1e-12))):
            counts = self.collisions(lo, hi)
            if own[i] is not None:
                counts[own[i]] = -1
            seeds.append(np.argpartition(-counts, first - 1)[:first])
            score = self.vectors[seeds[i]] @ queries[i]
            best = np.partition(score, first - k)[first - k]
            # distance to the scaled query of a vector with this inner product
            radius[i] = np.sqrt(max(0.0, 2 * self.top ** 2 - 2 * scale[i] * best)) + 1e-9 * self.top
        for i, (lo, hi) in enumerate(zip(*self.windows(at, WIDTH * radius))):
            passed = self.collisions(lo, hi) >= need
            passed[seeds[i]] = True
            yield self.verified(queries[i], np.flatnonzero(passed), own[i], k)

    def verified(self, query: np.ndarray, rows: np.ndarray, own: int | None, k: int):
        if own is not None:
            rows = rows[rows != own]
        if len(rows) > k:
            score = self.vectors[rows] @ query
            least = np.partition(score, len(rows) - k)[len(rows) - k]
            rows = rows[score >= least - 1e-9 * max(1.0, abs(least))]
        # a sum of its own per vector: equal vectors get equal scores
        return rows, (self.vectors[rows] * query).sum(axis=1)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return pa.concat_arrays([c.flatten() for c in column.chunks]).to_numpy().reshape(-1, dim)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            projections: int = PROJECTIONS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
            seed: int = SEED) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of every row
    that ``is_query`` (a condition on the frame's columns) marks."""
    rows = with_uid(vectors.select(
        col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.transform(col(vector_col), lambda x: x.cast("double")).alias("v")), "uid")
    rows = work_table(rows.where(usable(F.col("v"))).withColumn("dim", F.size("v")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, -(-sizes[0] // shard_rows)), max(1, -(-sizes[1] // block_rows))

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = rows.select("dim", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard"),
                       spread(blocks).alias("block"), "uid", "vec_id", "v")
    right = rows.where("asks").select("dim", spread(shards).alias("shard"),
                                      F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"),
                                      "uid", "vec_id", "v")
    need = threshold(projections)

    def meet(own: pa.Table, asks: pa.Table) -> pa.Table:
        q_uid, q_id, c_id, score = [], [], [], []
        if own.num_rows and asks.num_rows:
            dim = own["dim"][0].as_py()
            own = own.sort_by("uid")
            index = Index(_matrix(own["v"], dim), projections, seed)
            uids, ids = own["uid"].to_numpy(), own["vec_id"].to_pylist()
            where = {u: i for i, u in enumerate(uids.tolist())}
            queries = _matrix(asks["v"], dim)
            asking = asks["uid"].to_pylist()
            got = chain.from_iterable(
                index.search(queries[i:i + AT_ONCE], [where.get(u) for u in asking[i:i + AT_ONCE]], k, need)
                for i in range(0, len(asking), AT_ONCE))
            for u, name, (found, s) in zip(asking, asks["vec_id"].to_pylist(), got):
                named = sorted(((-x, ids[i] is None, ids[i] or 0, i) for x, i in zip(s.tolist(), found.tolist())))[:k]
                q_uid += [u] * len(named)
                q_id += [name] * len(named)
                c_id += [ids[i] for *_, i in named]
                score += [-x for x, *_ in named]
        return pa.table([pa.array(q_uid, pa.int64()), pa.array(q_id, pa.int64()), pa.array(c_id, pa.int64()),
                         pa.array(score, pa.float64())], ["q_uid", "query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    local = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        meet, "q_uid long, query_id long, vec_id long, score double")
    best = Window.partitionBy("q_uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return (local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
