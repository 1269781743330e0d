"""District extraction from location text (F9a-e, F10) as array expressions.

A location like "Mokotów, Warszawa, mazowieckie" is split on commas and the
parts are filtered with higher-order functions; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DISTRICT_STOP, SLUG_CHARS, SLUG_NOT_DISTRICT
from .text import WS, capitalize, col_, first_match, let, pystrip, title_case


def _parts(c, drop_empty: bool) -> Column:
    parts = F.transform(F.split(col_(c), ","), lambda p: pystrip(p))
    return F.filter(parts, lambda p: p != "") if drop_empty else parts


def _not_stop(p: Column) -> Column:
    return ~F.lower(p).isin(*DISTRICT_STOP)


def _empty(c) -> Column:
    return col_(c).isNull() | (col_(c) == "")


def district_first(c) -> Column:
    """First part that is not "warszawa" (title case); a single part is
    returned title-cased as is."""
    def pick(parts):
        other = F.when(F.size(parts) > 1, F.get(F.filter(parts, lambda p: F.lower(p) != "warszawa"), 0))
        return F.coalesce(other, F.get(parts, 0))

    return F.when(_empty(c), F.lit(None)).otherwise(title_case(let(_parts(c, False), pick)))


def district_stopset(c) -> Column:
    """First part not in {warszawa, mazowieckie}, else the first part."""
    return F.when(_empty(c), F.lit(None)).otherwise(title_case(let(
        _parts(c, False), lambda parts: F.coalesce(F.get(F.filter(parts, _not_stop), 0), F.get(parts, 0)))))


def district_last(c) -> Column:
    """Last non-empty part not in the stop set (title case), else the
    first part unchanged."""
    def pick(parts):
        kept = F.filter(parts, _not_stop)
        return F.coalesce(title_case(F.try_element_at(kept, F.lit(-1))), F.get(parts, 0))

    return F.when(_empty(c), F.lit(None)).otherwise(let(_parts(c, True), pick))


def district_no_street(c) -> Column:
    """F9d: first non-empty part outside the stop set that is not a street
    ("ul. ..."), capitalised; else the first part unchanged."""
    def pick(parts):
        kept = F.filter(parts, lambda p: _not_stop(p) & ~F.lower(p).startswith("ul."))
        return F.coalesce(let(F.get(kept, 0), capitalize), F.get(parts, 0))

    return F.when(_empty(c), F.lit(None)).otherwise(let(_parts(c, True), pick))


def district_strip_city(c, city: str = "Warszawa") -> Column:
    """F9e: each part with the city name removed; first non-empty part outside
    the stop set, capitalised; else the first raw part."""
    parts = _parts(c, False)
    cleaned = F.transform(parts, lambda p: pystrip(F.replace(p, F.lit(city), F.lit(""))))
    kept = F.filter(cleaned, lambda p: (p != "") & _not_stop(p))
    return F.when(_empty(c), F.lit(None)).otherwise(
        F.coalesce(capitalize(F.get(kept, 0)), F.get(parts, 0)))


def district_from_slug(url, text) -> Column:
    """"warszawa-<d>-ul" in the url, else "Warszawa <d>" in the text;
    hyphens to spaces, title case, not a generic word."""
    from_url = first_match(F.lower(col_(url)), r"warszawa-(" + SLUG_CHARS + r")-ul")
    from_text = first_match(F.lower(col_(text)), r"warszawa" + WS + r"+(" + SLUG_CHARS + r")")
    raw = pystrip(F.replace(F.coalesce(from_url, from_text), F.lit("-"), F.lit(" ")))
    return F.when(raw.isNotNull() & ~F.lower(raw).isin(*SLUG_NOT_DISTRICT), title_case(raw))
