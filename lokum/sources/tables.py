"""Scans of the captured tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Parquet scan; selecting columns here keeps ReadSchema narrow."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if columns:
        df = df.select(*columns)
    return df
