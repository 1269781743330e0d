"""Search and ingest predicates (P1-P13) as Column expressions.

Predicates on raw columns (price, area, rooms, portal) stay simple
comparisons: over a stored table Catalyst pushes them into the parquet scan or the
partition filter; above a keep-first aggregate they stay where they are.
"""

from __future__ import annotations

import datetime as _dt
import re
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import AGENCY_PHRASES, RENTAL_TERMS, SALE_TERMS
from ..functions.text import PY_WS, col_, pystrip
from ..functions.urls import portal_matches


def numeric_caps(max_price=None, min_sqm=None, min_rooms=None,
                 price="price_pln", sqm="sqm", rooms="rooms") -> Column:
    """Price <= cap, sqm >= floor, rooms >= floor; None disables a cap.
    SQL null rules: a null value fails an active cap."""
    cond = F.lit(True)
    if max_price is not None:
        cond = cond & (F.col(price) <= F.lit(float(max_price)))
    if min_sqm is not None:
        cond = cond & (F.col(sqm) >= F.lit(float(min_sqm)))
    if min_rooms is not None:
        cond = cond & (F.col(rooms) >= F.lit(int(min_rooms)))
    return cond


def _any_substring(text: Column, terms: Sequence[str]) -> Column:
    terms = [t.lower() for t in terms if t]
    if not terms:
        return F.lit(False)
    return text.rlike("|".join(re.escape(t) for t in terms))


def location_text(district="district", title="title", url="url") -> Column:
    """lower("district title url") with missing parts as ''."""
    return F.lower(F.concat_ws(" ", F.coalesce(col_(district), F.lit("")),
                               F.coalesce(col_(title), F.lit("")),
                               F.coalesce(col_(url), F.lit(""))))


def district_excluded(terms: Sequence[str], district="district", title="title", url="url") -> Column:
    """Any term is a substring of lower("district title url")."""
    return _any_substring(location_text(district, title, url), terms)


def portal_excluded(terms: Sequence[str] | None, portal="portal", url="url",
                    term_in_url: bool = False) -> Column:
    """Portal term matches (exclude when true)."""
    if not terms:
        return F.lit(False)
    return portal_matches(portal, terms, url, term_in_url)


def portal_included(terms: Sequence[str] | None, portal="portal", url="url",
                    term_in_url: bool = False) -> Column:
    """Keep only matching portals (all when no terms)."""
    if not terms:
        return F.lit(True)
    return portal_matches(portal, terms, url, term_in_url)


def agency_text(title="title", description="description") -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(col_(title), F.lit("")),
                               F.coalesce(col_(description), F.lit(""))))


def agency_excluded(phrases: Sequence[str] = AGENCY_PHRASES, title="title",
                    description="description") -> Column:
    """P5: an agency / developer phrase in lower("title description")."""
    return _any_substring(agency_text(title, description), phrases)


def recent(date_iso: Column, as_of: _dt.datetime, days: int) -> Column:
    """Date >= as_of - days; unparseable or missing dates are kept.
    The date is midnight UTC; the cutoff keeps the time of ``as_of``."""
    cutoff = F.lit(as_of) - F.make_interval(days=F.lit(days))
    ts = F.try_to_timestamp(date_iso, F.lit("yyyy-MM-dd"))
    return F.coalesce(ts >= cutoff, F.lit(True))


def min_text_length(c, n: int, strictly_longer: bool = False) -> Column:
    """Stripped length >= n (or > n)."""
    ln = F.length(pystrip(col_(c)))
    return F.coalesce(ln > n if strictly_longer else ln >= n, F.lit(False))


def rental_only(c, rental: Sequence[str] = RENTAL_TERMS, sale: Sequence[str] = SALE_TERMS) -> Column:
    """A rental term and no sale term (such posts are dropped before the
    costly extractor)."""
    low = F.lower(col_(c))
    return _any_substring(low, rental) & ~_any_substring(low, sale)



def query_param(url, name: str) -> Column:
    """Value of a query-string parameter of ``url`` (P13), null if there is
    none; the url need not be a valid URI (captured ones hold brackets)."""
    u = F.col(url) if isinstance(url, str) else url
    query = F.split_part(F.split_part(u, F.lit("#"), F.lit(1)), F.lit("?"), F.lit(2))
    return F.nullif(F.regexp_extract(query, f"(?:^|&){re.escape(name)}=([^&]*)", 1), F.lit(""))
