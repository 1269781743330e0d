"""Fault isolation of a load (S13, A5): pages that cannot be read go to quarantine
with a reason, a portal whose pages mostly break becomes an empty batch, and the
counts are observed on the write itself.

Every page is parsed once and written once with its reason (null: fine), one
partition a portal. ``Observation`` counts pages and failures of each portal while
they are written, so no second job reads them. Only these counts, two numbers a
portal, reach the driver; batch and quarantine are reads of the written partitions.

Defined cases: a null or unknown portal is ``other``; no pages give empty batches and
zero counts; a null page id is kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import PORTAL_KEYS
from ..functions.text import blank
from ..operators.extract_html import page_parts

OTHER = "other"
MAX_FAILED = 0.5  # share of a portal's pages; with more of them failing its batch is empty
NO_HTML, UNREADABLE, NO_CONTENT, PORTAL_FAILING = "no html", "unreadable", "no content", "portal failing"


@dataclass(frozen=True)
class Loaded:
    batch: DataFrame        # page_id, portal, description, title: pages of portals that work
    quarantine: DataFrame   # page_id, portal, reason
    pages: dict[str, int]   # by portal
    failed: dict[str, int]
    down: tuple[str, ...]   # portals over the failure share


def reason() -> Column:
    return (F.when(F.col("no_html"), F.lit(NO_HTML)).when(~F.col("parsed"), F.lit(UNREADABLE))
            .when(F.col("description").isNull(), F.lit(NO_CONTENT)))


def load_pages(spark: SparkSession, path: str, pages: DataFrame, portals: Sequence[str] = tuple(PORTAL_KEYS),
               max_failed: float = MAX_FAILED) -> Loaded:
    """``pages`` (page_id, portal, html) into the new folder ``path``."""
    known = F.when(F.col("portal").isin(*portals), F.col("portal")).otherwise(F.lit(OTHER))
    parts = page_parts(pages.select("page_id", "html", known.alias("portal"), blank("html").alias("no_html")),
                       keep=["portal", "no_html"])
    judged = parts.select("page_id", "portal", "title", "description", reason().alias("reason"))
    seen, names = Observation(), [*portals, OTHER]
    counts = [c for i, p in enumerate(names) for c in (
        F.count_if(F.col("portal") == p).alias(f"pages_{i}"),
        F.count_if((F.col("portal") == p) & F.col("reason").isNotNull()).alias(f"failed_{i}"))]
    judged.observe(seen, *counts).write.partitionBy("portal").parquet(path)
    got = seen.get
    n = {p: got[f"pages_{i}"] for i, p in enumerate(names)}
    bad = {p: got[f"failed_{i}"] for i, p in enumerate(names)}
    down = tuple(p for p in names if bad[p] > max_failed * n[p])
    stored = spark.read.schema(judged.schema).parquet(path)
    is_down = F.col("portal").isin(*down) if down else F.lit(False)
    return Loaded(
        stored.filter(~is_down & F.col("reason").isNull()).select("page_id", "portal", "title", "description"),
        stored.filter(is_down | F.col("reason").isNotNull())
        .select("page_id", "portal", F.coalesce("reason", F.lit(PORTAL_FAILING)).alias("reason")),
        n, bad, down)
