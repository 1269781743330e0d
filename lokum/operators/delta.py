"""Delta load, existing-id lookup and upsert merge.

All are key joins on ``external_id``. No side is broadcast by hint: the store
grows without bound, so the planner picks sort-merge and AQE demotes to a
broadcast only when a side is measured small at runtime. Spark's runtime bloom
filter (``spark.sql.optimizer.runtime.bloomFilter.enabled``) prunes the store
scan when the batch side is selective.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "external_id"


def new_rows(batch: DataFrame, store: DataFrame, key: str = KEY) -> DataFrame:
    """Batch rows whose key is not stored yet."""
    return batch.join(store.select(key), key, "left_anti")


def existing_ids(requested: DataFrame, store: DataFrame, key: str = KEY) -> DataFrame:
    """Distinct requested keys that are stored (empty in -> empty out)."""
    return requested.select(key).distinct().join(store.select(key), key, "left_semi")


def upsert(store: DataFrame, incoming: DataFrame, key: str = KEY) -> DataFrame:
    """Whole-record replace by key: stored rows without a newer
    version, plus every incoming row. ``incoming`` must be unique by key."""
    kept = store.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)



def with_timestamps(rows: DataFrame, timestamps: DataFrame, key: str = KEY) -> DataFrame:
    """created_at and updated_at as the lookup table has them; rows that it
    does not know keep their own."""
    rows = rows if "updated_at" in rows.columns else rows.withColumn("updated_at", F.lit(None).cast("timestamp"))
    t = timestamps.select(key, F.col("created_at").alias("__c"), F.col("updated_at").alias("__u"), F.lit(True).alias("__k"))
    j = rows.join(t, key, "left")
    for name, found in (("created_at", "__c"), ("updated_at", "__u")):
        j = j.withColumn(name, F.when(F.col("__k"), F.col(found)).otherwise(F.col(name)))
    return j.drop("__c", "__u", "__k")


def flag_existing(batch: DataFrame, store: DataFrame, key: str = KEY) -> DataFrame:
    """Batch rows with an ``exists`` flag (left join against distinct store keys)."""
    stored = store.select(key).distinct().withColumn("__exists", F.lit(True))
    return (batch.join(stored, key, "left")
            .withColumn("exists", F.coalesce(F.col("__exists"), F.lit(False)))
            .drop("__exists"))
