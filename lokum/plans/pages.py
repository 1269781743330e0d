"""Jobs over captured pages: paragraph descriptions, per-page url dedupe,
page-depth bound with stop-at-first-empty, quarantine split and query-string
scope predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import PARAGRAPH_MIN_CHARS
from ..functions import urls as FU
from ..operators.dedupe import keep_first
from ..operators.filters import query_param


def paragraph_description(parts: DataFrame) -> DataFrame:
    """X11: paragraphs longer than 20 characters joined by a blank line, else
    the description container text."""
    kept = F.filter("paragraphs", lambda p: F.length(p) > PARAGRAPH_MIN_CHARS)
    joined = F.when(F.size(kept) > 0, F.array_join(kept, "\n\n"))
    return parts.withColumn("description", F.coalesce(joined, F.col("description")))


def with_page_no(pages: DataFrame) -> DataFrame:
    return (pages.withColumn("host", F.lower(FU.origin("url")))
            .withColumn("page_no", (F.col("page_id") % 10 + 1).cast("int")))


def dedupe_page_url(pages: DataFrame) -> DataFrame:
    """First row per canonical url within a result page (host, page_no),
    by page position (page_id)."""
    p = with_page_no(pages).withColumn("canon", FU.canonical_url("url"))
    return keep_first(p.select("host", "page_no", "canon", "page_id", "url"),
                      ["host", "page_no", "canon"], order=["page_id"])


def page_depth(pages: DataFrame, max_pages: int) -> DataFrame:
    """Pages 1..max(1, n) per source (null host: a source of its own),
    stopping before the first page that gave the extractor no row. The stop
    page is an aggregate with one narrow row per source, not a window."""
    from ..operators.extract_html import page_parts
    p = with_page_no(pages).filter(F.col("page_no") <= F.lit(max(1, max_pages)))
    p = page_parts(p, keep=["url", "host", "page_no"])
    empty = F.coalesce(F.trim("description") == "", F.lit(True))
    p = p.select("page_id", "url", "host", "page_no", empty.alias("empty"))
    stops = (p.filter("empty").groupBy(F.col("host").alias("source"))
             .agg(F.min("page_no").alias("stop")))
    return (p.join(stops, p.host.eqNullSafe(stops.source), "left")
            .filter(F.col("stop").isNull() | (F.col("page_no") < F.col("stop"))).drop("source"))


def quarantine_split(pages: DataFrame) -> DataFrame:
    """A page without html or without any description container goes to
    quarantine; no row fails the job."""
    from ..operators.extract_html import page_parts
    parts = page_parts(pages).select("page_id", "description", "parsed")
    return parts.withColumn(
        "status", F.when(F.col("parsed") & F.col("description").isNotNull(), F.lit("ok"))
        .otherwise(F.lit("quarantine")))


# --- FIXED VALUES: what a portal's search url asks for: secondary market only,
# --- private sellers only.
SEARCH_SCOPE = {"otodom": ("market", "SECONDARY"), "olx": ("search[private_business]", "private")}


def search_scope(pages: DataFrame, portal: str = "portal", url: str = "search_url") -> DataFrame:
    """Captures whose search url is in its portal's scope; portals
    without a scope keep all."""
    keep = F.lit(True)
    for name, (param, value) in SEARCH_SCOPE.items():
        keep = F.when(F.col(portal) == name, query_param(url, param) == value).otherwise(keep)
    return pages.filter(F.coalesce(keep, F.lit(False)))


def source_scope(pages: DataFrame, name: str, value: str) -> DataFrame:
    """Keep captures whose search url carries ``name=value``."""
    p = pages.withColumn(name, query_param("url", name)).withColumn("page", query_param("url", "page"))
    return p.filter(F.col(name) == F.lit(value))
