"""Pagination and global ranks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_offset(page: int | None, limit: int, offset: int = 0) -> int:
    """page p (> 1) starts at (p - 1) * limit; otherwise ``offset``."""
    if page is not None and page > 1:
        return (page - 1) * limit
    return offset


def paginate(df: DataFrame, order: Sequence[Column], offset: int, limit: int | None) -> DataFrame:
    """Rows [offset, offset + limit) of the total order (all when limit is
    None). Negative offsets are rejected (the source slices from the end). A page
    is a bounded top-k; an offset alone goes by distributed ranks, not through
    one task."""
    if offset < 0:
        raise ValueError("offset must be >= 0")
    if limit is None:
        name = "__rank"
        return rank_unbounded(df, order, name=name).filter(F.col(name) > offset).drop(name)
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


def rank_bounded(df: DataFrame, order: Sequence[Column], start: int = 1, name: str = "rank") -> DataFrame:
    """W6 on an already bounded set (a top-k or one page): a single ordered
    window over at most k rows."""
    w = Window.orderBy(*order)
    return df.withColumn(name, F.row_number().over(w) + F.lit(start - 1))


def rank_unbounded(df: DataFrame, order: Sequence[Column], start: int = 1, name: str = "rank",
                   partitions: int | None = None) -> DataFrame:
    """W6 for unbounded output without one global window: range-partition and
    sort, number rows inside each partition, and add the row count of all
    earlier partitions (a table with one row per partition, broadcast)."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    mid = F.monotonically_increasing_id()
    # ids depend on the physical partitioning, so the numbered rows are
    # materialised once (reliable checkpoint in spark.checkpoint.dir): the
    # count branch and the row branch then read the same partitions.
    tagged = ranged.withColumn("__mid", mid) \
        .withColumn("__pid", F.shiftright(F.col("__mid"), 33)) \
        .withColumn("__loc", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1))).checkpoint(eager=True)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).select("__pid", "__off")
    # one row per partition: bounded by the partition count
    return (tagged.join(F.broadcast(offsets), "__pid")
            .withColumn(name, F.col("__off") + F.col("__loc") + F.lit(start))
            .drop("__mid", "__pid", "__loc", "__off"))
