"""Run summaries (A1-A5). Every count is a partial (map-side) aggregate; the
only shuffles are on the grouping keys, and the outputs are tiny."""

from __future__ import annotations

import datetime as _dt
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import filters as P
from .delta import flag_existing


def delta_summary(batch: DataFrame, store: DataFrame, key: str = "external_id") -> DataFrame:
    """A1: total scraped (after keep-first), already stored, new."""
    flagged = flag_existing(batch.select(key), store, key)
    return flagged.agg(
        F.count(F.lit(1)).alias("total_scraped"),
        F.count_if(F.col("exists")).alias("skipped"),
        F.count_if(~F.col("exists")).alias("new_count"))


def exclusion_reason(district_terms: Sequence[str]) -> Column:
    return (F.when(P.district_excluded(district_terms), F.lit("district"))
            .when(P.agency_excluded(), F.lit("agency"))
            .otherwise(F.lit("remaining")))


def exclusion_counts(df: DataFrame, district_terms: Sequence[str]) -> DataFrame:
    """A2: rows per exclusion reason (district first, then agency)."""
    return df.groupBy(exclusion_reason(district_terms).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def portal_counts(df: DataFrame) -> DataFrame:
    """A3: listings per portal."""
    return df.groupBy("portal").agg(F.count(F.lit(1)).alias("n"))


def distinct_ids(df: DataFrame, key: str = "external_id") -> DataFrame:
    """A4: rows and distinct ids per portal (exact)."""
    return df.groupBy("portal").agg(F.count(F.lit(1)).alias("rows"),
                                    F.countDistinct(key).alias("distinct_ids"))



def new_count(df: DataFrame, date_iso: Column, as_of: _dt.datetime, days: int) -> DataFrame:
    """A5: rows posted within ``days`` of ``as_of`` (undated rows count)."""
    return df.agg(F.count_if(P.recent(date_iso, as_of, days)).alias("new_count"))
