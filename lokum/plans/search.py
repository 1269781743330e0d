"""Similarity search over stored listings.

Plan: listings -> caps (pushed to the scan of a stored table) -> join the vector table scored
against the query and cut by the threshold -> top ``match_count`` by
(similarity desc, external_id) -> timestamp enrichment (J3) -> price/m²
(F11) -> district / portal / agency exclusions -> recency -> offset/limit.

``mode="post"`` keeps the reference order (exclusions after the candidate cap,
pages may come back short); ``mode="pre"`` applies the exclusions before the
cap, so a page is only short when the data runs out.

Scale notes: the similarity is computed on the vector table (one score per
vector, before the join), the threshold filter shrinks it before the join,
and everything after the top-k touches at most ``match_count`` rows; the
enrichment join broadcasts that bounded side.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import (DEFAULT_EXCLUDED_DISTRICTS, DEFAULT_MATCH_COUNT, DEFAULT_MATCH_THRESHOLD,
                         DEFAULT_MAX_PRICE, DEFAULT_MIN_ROOMS, DEFAULT_MIN_SQM,
                         DEFAULT_NEW_WITHIN_DAYS, DEFAULT_PAGE_SIZE)
from ..functions.dates import listing_date, unpack_district
from ..functions.text import price_per_sqm
from ..operators import filters as P
from ..operators.paging import rank_bounded
from ..operators.delta import with_timestamps
from ..operators.vector import rounded, similarity

AS_OF = _dt.datetime(1999, 1, 1, 0, 0, 0)


@dataclass(frozen=True)
class SearchParams:
    max_price: float | None = DEFAULT_MAX_PRICE
    min_sqm: float | None = DEFAULT_MIN_SQM
    min_rooms: int | None = DEFAULT_MIN_ROOMS
    match_count: int = DEFAULT_MATCH_COUNT
    match_threshold: float = DEFAULT_MATCH_THRESHOLD
    top_n: int | None = DEFAULT_PAGE_SIZE
    offset: int = 0
    filter_agencies: bool = True
    exclude_portals: Sequence[str] | None = None
    include_portals: Sequence[str] | None = None
    exclude_districts: Sequence[str] | None = None  # None -> defaults, [] -> off
    only_new: bool = False
    new_within_days: int = DEFAULT_NEW_WITHIN_DAYS
    as_of: _dt.datetime = AS_OF
    mode: str = "post"
    portal_term_in_url: bool = False

    @property
    def districts(self) -> list[str]:
        return list(DEFAULT_EXCLUDED_DISTRICTS if self.exclude_districts is None
                    else self.exclude_districts)


def scored_vectors(vectors: DataFrame, query: Sequence[float] | F.Column, params: SearchParams,
                   vec_id: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One similarity per vector, cut by the threshold before any join."""
    return (vectors.select(vec_id, similarity(vec_col, query).alias("similarity"))
            .filter(F.col("similarity") > F.lit(float(params.match_threshold))))


def _exclusions(df: DataFrame, p: SearchParams) -> DataFrame:
    if p.districts:
        df = df.filter(~P.district_excluded(p.districts))
    df = df.filter(~P.portal_excluded(p.exclude_portals, term_in_url=p.portal_term_in_url))
    df = df.filter(P.portal_included(p.include_portals, term_in_url=p.portal_term_in_url))
    if p.filter_agencies:
        df = df.filter(~P.agency_excluded())
    return df


def search(listings: DataFrame, vectors: DataFrame, query, params: SearchParams = SearchParams(),
           timestamps: DataFrame | None = None, timestamps_key: str = "external_id") -> DataFrame:
    """W9. ``listings`` has external_id, portal, url, title, price_pln, sqm,
    rooms, district, description, created_at, vec_id. ``timestamps`` (optional)
    has ``timestamps_key``, created_at and updated_at. Returns the requested page with ``rank``."""
    p = params
    cand = listings.filter(P.numeric_caps(p.max_price, p.min_sqm, p.min_rooms))
    if p.mode == "pre":
        cand = _exclusions(cand, p)
    cand = cand.join(scored_vectors(vectors, query, p), "vec_id")
    order = [F.col("similarity").desc(), F.col("external_id").asc()]
    top = cand.orderBy(*order).limit(p.match_count)
    if timestamps is not None:
        # the bounded candidate set feeds two branches (keys for the lookup
        # and the rows); materialise it once in the shared checkpoint folder
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(listings.sparkSession)
        top = top.checkpoint(eager=True)

    if timestamps is not None:
        # Left lookup. A left outer join can only build its right side, so
        # the unbounded lookup table is first reduced to the top-k keys by a
        # semi join that broadcasts those keys (bounded by match_count); the
        # reduced table then joins back (AQE broadcasts it by measured size).
        keys = F.broadcast(top.select(timestamps_key))
        ts_small = timestamps.join(keys, timestamps_key, "left_semi")
        top = with_timestamps(top, ts_small, timestamps_key)
    else:
        top = top.withColumn("updated_at", F.lit(None).cast("timestamp"))

    top = top.withColumn("price_per_sqm", price_per_sqm("price_pln", "sqm"))
    if p.mode != "pre":
        top = _exclusions(top, p)
    top = top.withColumn("date_posted", listing_date(None, "district", "created_at",
                                                     "updated_at", p.as_of))
    if p.only_new:
        top = top.filter(P.recent(F.col("date_posted"), p.as_of, p.new_within_days))
    ranked = rank_bounded(top, order, start=1)
    lo = p.offset
    page = ranked.filter(F.col("rank") > lo)
    if p.top_n is not None:
        page = page.filter(F.col("rank") <= lo + p.top_n)
    return page.select("rank", "external_id", "portal", "title", "price_pln", "price_per_sqm",
                       "sqm", "rooms", unpack_district("district").alias("district"),
                       "date_posted", "url", "description", rounded("similarity").alias("similarity"))
