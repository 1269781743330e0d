"""Structured Streaming jobs.

* T1 incremental ingest: file stream of captures, ``trigger(availableNow)``,
  ``foreachBatch`` running keep-first -> delta anti-join -> append into the
  target table. Each micro-batch writes its own ``batch_id=<n>`` folder with
  ``mode("overwrite")`` so a replayed batch rewrites the same files
  (idempotent); the anti-join against the target keeps keys unique.
* T2 stateful keep-first: ``withWatermark`` + ``dropDuplicatesWithinWatermark``
  (state bounded by the watermark, late rows dropped).
* T3 per-type counts by tumbling / sliding / session windows with a watermark,
  in append mode: a window is written once, when the watermark has passed it,
  and its state is dropped then. ``close_windows`` ends a stream whose input is
  complete: a marker far in the future moves the watermark past all windows.

A job lives in the folder ``base`` (its checkpoint, its sink): given the same
folder again it goes on where it stopped. Without one, a fresh folder under the
shared checkpoint folder is used.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_first
from ..plans import store
from ..session import scratch_dir
from ..sources.tables import table_path

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


TABLE = "events.parquet"  # in a folder of tables; a landing folder has any names


def event_stream(spark: SparkSession, folder: str, max_files: int = 1, files: str | None = TABLE) -> DataFrame:
    """Captured events as a file stream, event time cast to a zoned timestamp (UTC)
    for watermarks: all Parquet files of a landing folder (``files`` None), or those
    that match a pattern."""
    src = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", max_files)
    if files is not None:
        src = src.option("pathGlobFilter", files)
    return src.parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def _run_dir(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, f"stream-{name}-{uuid.uuid4().hex[:12]}")


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _job_dir(spark: SparkSession, base: str | None, name: str) -> str:
    return base or _run_dir(spark, name)


def stream_dedupe(spark: SparkSession, sf_dir: str, key: str = "user_id",
                  watermark: str = "30 days", base: str | None = None) -> DataFrame:
    """First event per key within the watermark; emits the key."""
    base = _job_dir(spark, base, "dedupe")
    out = os.path.join(base, "out")
    s = (event_stream(spark, sf_dir).withWatermark("ts", watermark)
         .dropDuplicatesWithinWatermark([key]).select(key))
    q = (s.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    _await(q)
    return spark.read.schema(f"{key} long").parquet(out)


WINDOWS = {"tumbling": lambda: F.window("ts", "1 day"),
           "sliding": lambda: F.window("ts", "1 day", "12 hours"),
           "session": lambda: F.session_window("ts", "1 hour")}
COUNT_SCHEMA = "window_start string, window_end string, event_type string, n long"


def _marks(spark: SparkSession, base: str) -> str:
    """Folder of the markers that close windows, with an empty file at first."""
    marks = os.path.join(base, "marks")
    spark.createDataFrame([], EVENT_SCHEMA).coalesce(1).write.mode("ignore").parquet(marks)
    return marks


def closed(spark: SparkSession, base: str) -> bool:
    """Whether ``close_windows`` has ended the job."""
    return not spark.read.schema(EVENT_SCHEMA).parquet(_marks(spark, base)).isEmpty()


def run_counts(spark: SparkSession, sf_dir: str, kind: str, watermark: str, base: str,
               files: str | None = TABLE) -> None:
    """One pass over what has arrived since the last: adds the closed windows to the sink."""
    marks = spark.readStream.schema(EVENT_SCHEMA).parquet(_marks(spark, base))
    ev = (event_stream(spark, sf_dir, files=files).unionByName(marks.withColumn("ts", F.col("ts").cast("timestamp")))
          .withWatermark("ts", watermark))
    agg = ev.groupBy(WINDOWS[kind]().alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("w.start").cast("string").alias("window_start"),
                      F.col("w.end").cast("string").alias("window_end"), "event_type", "n")
         .write.mode("overwrite").parquet(os.path.join(base, "out", f"batch_id={batch_id}")))

    _await(agg.writeStream.outputMode("append").foreachBatch(write)
           .option("checkpointLocation", os.path.join(base, "ckpt")).trigger(availableNow=True).start())


def close_windows(spark: SparkSession, base: str) -> None:
    """Marks the input as complete; the next pass writes the open windows."""
    mark = spark.range(1).selectExpr("cast(null as long) event_id", "timestamp_ntz'9000-01-01' ts",
                                     "cast(null as long) user_id", "cast(null as string) event_type",
                                     "cast(null as double) value", "cast(null as string) props")
    mark.write.mode("append").parquet(os.path.join(base, "marks"))


def stream_counts(spark: SparkSession, sf_dir: str, kind: str = "tumbling", watermark: str = "1 day",
                  base: str | None = None, files: str | None = TABLE, complete: bool = True) -> DataFrame:
    """Event counts per type and window (tumbling 1 day, sliding 1 day
    every 12 hours, or sessions with a 1 hour gap). With ``complete`` the input has
    all arrived: open windows are written and the job ends for good (called again it
    gives what it has written). Without, a pass writes the windows that the watermark
    has closed and the job goes on with the next call; a job that has ended refuses."""
    base = _job_dir(spark, base, f"counts-{kind}")
    if closed(spark, base):
        if not complete:
            raise ValueError("the job's windows were closed; give a new folder for further input")
    else:
        run_counts(spark, sf_dir, kind, watermark, base, files)
        if complete:
            close_windows(spark, base)
    if complete:  # also after a run that died in between
        run_counts(spark, sf_dir, kind, watermark, base, files)
    return spark.read.schema(COUNT_SCHEMA).parquet(os.path.join(base, "out")).drop("batch_id")


def stream_listings(spark: SparkSession, landing: str, store_base: str, schema: str, job: str = "listings",
                    base: str | None = None, max_files: int = 1) -> int:
    """Extracted listings that arrive as Parquet files in ``landing`` go through
    the load (keep-first, delta, record) into the store; returns its version. The
    manifest holds the job's last batch, so a replayed batch is not loaded twice even
    if the stream's own log was lost after the commit."""
    base = _job_dir(spark, base, job)

    def load(batch: DataFrame, batch_id: int) -> None:
        store.ingest(batch.sparkSession, store_base, batch, job, batch_id)

    _await(spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)
           .writeStream.foreachBatch(load).option("checkpointLocation", os.path.join(base, "ckpt"))
           .trigger(availableNow=True).start())
    return store.read_manifest(spark, store_base).version


def stream_delta(spark: SparkSession, sf_dir: str, stored_types=("view",), base: str | None = None,
                 landing: str | None = None) -> DataFrame:
    """Captures -> keep-first per key -> anti-join the target -> append
    the new keys as this batch's folder. A new target starts with the keys of
    ``stored_types`` (the already-loaded part). Captures are the events table, or
    all files of a ``landing`` folder."""
    base = _job_dir(spark, base, "delta")
    target = os.path.join(base, "target")
    seed = (spark.read.parquet(table_path(sf_dir, "events"))
            .filter(F.col("event_type").isin(*stored_types))
            .select(F.concat(F.lit("ev-"), F.col("user_id").cast("string"), F.lit("-"),
                             F.col("event_type")).alias("external_id"),
                    F.col("ts").cast("timestamp").alias("first_seen")))
    keep_first(seed, ["external_id"], order=["first_seen"]).write.mode("ignore") \
        .parquet(os.path.join(target, "batch_id=-1"))

    def merge(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.select(F.concat(F.lit("ev-"), F.col("user_id").cast("string"), F.lit("-"),
                                      F.col("event_type")).alias("external_id"),
                             F.col("ts").alias("first_seen"))
        fresh = keep_first(keyed, ["external_id"], order=["first_seen"])
        stored = spark.read.parquet(target).filter(F.col("batch_id") != batch_id).select("external_id")
        new = fresh.join(stored, "external_id", "left_anti")
        new.write.mode("overwrite").parquet(os.path.join(target, f"batch_id={batch_id}"))

    arriving = event_stream(spark, landing, files=None) if landing else event_stream(spark, sf_dir)
    q = (arriving.writeStream.foreachBatch(merge)
         .option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    _await(q)
    return spark.read.parquet(target).select(
        "external_id", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))
