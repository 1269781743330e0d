"""Helpers shared by the operators: work tables, row ids, free column names."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lokum.session import ensure_checkpoint_dir

# Java regex classes of the contracts: white space is space and \t..\r.
WORD = "[^\\x20\\x09-\\x0D]+"
WHITE = " \t\n\x0b\x0c\r"


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder; the driver's
    JVM removes it when it ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    _WORK.append(path)
    return path


_WORK: list[str] = []  # the driver's folders, oldest first


def work_mark() -> int:
    return len(_WORK)


def drop_work(spark: SparkSession, first: int, last: int) -> None:
    """Remove the work tables made from one mark to another: what read them has
    been written itself."""
    for path in _WORK[first:last]:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage so
    that lost executors cost a reread, never a recomputation, and gives the
    planner real sizes."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Plans of these read the same rows in the same order in every job.
STABLE = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation", "Range"}


def stable(df: DataFrame) -> DataFrame:
    """``df`` itself if it only reads, filters and projects a table; anything else
    (a join, a shuffle, a limit) is written to the shared folder first, as its
    rows have no fixed order and could not be numbered alike in two jobs."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in STABLE:
            return work_table(df, "input")
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return df


def free_name(base: str, *dfs: DataFrame) -> str:
    """A column name that no given frame has (names are case-insensitive)."""
    taken = {c.lower() for df in dfs for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_uid(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of a ``stable`` input: the same files give a row the same
    number in every job and task attempt. How files are split must not follow the
    executors that happen to be alive, so the session's split is pinned."""
    spark = df.sparkSession
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return df.withColumn(name, F.monotonically_increasing_id())


def keep_rows(df: DataFrame, uid: str, keep: DataFrame) -> DataFrame:
    """The rows of ``with_uid(df, uid)`` whose number is in ``keep`` (one column);
    a merge join at every size, since ``keep`` grows with the rows."""
    k = keep.select(F.col(keep.columns[0]).alias(uid)).hint("merge")
    return with_uid(df, uid).join(k, uid, "left_semi").drop(uid)


def by_bytes(batch: pa.RecordBatch, at: int, most: int = 1 << 20, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch with at most ``rows`` rows and about ``most`` bytes
    of text in column ``at`` (a longer text comes alone)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
    lo, held = 0, 0
    for k, size in enumerate(sizes):
        if k > lo and (held + size > most or k - lo >= rows):
            yield batch.slice(lo, k - lo)
            lo, held = k, 0
        held += size
    if lo < len(sizes):
        yield batch.slice(lo)


def give_back() -> None:
    """Return a finished task's memory to the system: Python workers are reused by
    the tasks of other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass
