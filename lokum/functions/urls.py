"""URL expressions: absolute and canonical urls, offer ids, external ids and
portal classification (F12-F15, F20)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (DEFAULT_PORTAL_KEY, DEFAULT_PORTAL_LABEL, PORTAL_HOSTS, PORTAL_KEYS,
                         PORTAL_LABELS, PORTAL_PREFIXES)
from .text import col_, first_match

# --- FIXED VALUES: offer-id patterns per portal, tried in order on the
# --- canonical url (group 1 is the id).
OFFER_ID_PATTERNS = {
    "olx": [r"-ID([a-zA-Z0-9]{4,20})(?:\.html)?", r"ID([a-zA-Z0-9]{4,20})"],
    "adresowo": [r"-([a-zA-Z0-9]+)$", r"(\d+)"],
    "no": [r"/(\d{6,10})\.html", r"(\d{6,10})"],
    "morizon": [r"-(mzn\d+|mzn-[a-zA-Z0-9]+|\d+)$", r"-(mzn[a-zA-Z0-9]+)$", r"(\d{6,12})"],
    "freedom": [r"-(\d+-\d+-[a-z]+)/?$", r"-(\d+)/?$", r"(\d{5,10})"],
}


def origin(url) -> Column:
    """scheme://host of an absolute url."""
    return first_match(col_(url), r"^(https?://[^/?#]+)")


def absolute_url(href, base) -> Column:
    """keep http(s) urls, "//x" -> "https://x", else base + href."""
    h = col_(href)
    b = col_(base) if not isinstance(base, str) else F.lit(base)
    return (F.when(h.isNull(), F.lit(None))
            .when(h.startswith("http"), h)
            .when(h.startswith("//"), F.concat(F.lit("https:"), h))
            .otherwise(F.concat(b, h)))


def canonical_url(url) -> Column:
    """url cut at the first '?'."""
    return F.substring_index(col_(url), "?", 1)


def url_hash_id(url) -> Column:
    """Stable fallback id: the full sha-256 (the same in every process)."""
    return F.sha2(col_(url), 256)


def offer_id(url, portal: str) -> Column:
    """first matching per-portal pattern on the canonical url, else hash."""
    return canonical_offer_id(canonical_url(url), portal)


def canonical_offer_id(cu: Column, portal: str) -> Column:
    """F14 of a canonical url."""
    tries = [first_match(cu, p) for p in OFFER_ID_PATTERNS[portal]]
    return F.coalesce(*tries, url_hash_id(cu))


def external_id(prefix, ident) -> Column:
    """"<prefix>-<id>"."""
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat_ws("-", p, col_(ident).cast("string"))


def _portal_chain(url, ext_id, values, default) -> Column:
    u = F.lower(F.coalesce(col_(url), F.lit("")))
    e = F.lower(F.coalesce(col_(ext_id), F.lit("")))
    out = F.lit(default)
    # order: first match wins, otodom is the default (so it is not tested)
    for host, prefix, val in reversed(list(zip(PORTAL_HOSTS, PORTAL_PREFIXES, values))[1:]):
        out = F.when(u.contains(host) | e.startswith(prefix + "-"), F.lit(val)).otherwise(out)
    return out


def portal_key(url, ext_id) -> Column:
    """portal key from url host or id prefix."""
    return _portal_chain(url, ext_id, PORTAL_KEYS, DEFAULT_PORTAL_KEY)


def portal_label(url, ext_id) -> Column:
    """display label from url host or id prefix."""
    return _portal_chain(url, ext_id, PORTAL_LABELS, DEFAULT_PORTAL_LABEL)



def portal_matches(key_col, terms, url=None, term_in_url: bool = False) -> Column:
    """Portal term match: substring of the portal key (and, in compat mode,
    of the url)."""
    conds = []
    for raw in terms:
        t = raw.lower().replace("_", "-")
        c = F.lower(col_(key_col)).contains(t)
        if t == "no":
            c = c | (col_(key_col) == "nieruchomosci-online")
        if term_in_url and url is not None:
            c = c | F.lower(col_(url)).contains(t)
        conds.append(c)
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out
