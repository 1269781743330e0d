"""Search-result cards -> listing records.

The HTML hook (``extract_html.card_fields``) returns raw field text per card.
A portal's rules are a table: one Column expression per step over that text and
the steps before.
"""

from __future__ import annotations

import functools
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DATE_LABELS_DOTTED, DATE_LABELS_TEXTUAL, PORTALS
from ..functions import dates as FD
from ..functions import district as FDi
from ..functions import text as FT
from ..functions import urls as FU
from ..operators.extract_html import card_fields
from .normalize import default_title, low_fallback

BASE = {p[0]: p[4] for p in PORTALS}
STEPS = ["link", "url", "low", "low_card", "tagged", "offer_id", "district", "own_price", "own_sqm", "own_rooms", "own_date",
         "price_pln", "own_per_sqm", "sqm", "rooms", "date_posted", "name", "shown"]

ZLOTY = r"(\d[\d\s\x{a0}.]*)[\s\x{a0}]*zł"
DECIMAL = r"(\d+(?:[.,]\d+)?)"


def _below(base: str, kept: Column) -> Column:
    """``href`` itself where ``kept``, else below the portal's address."""
    return F.when(kept, F.col("href")).otherwise(F.concat(F.lit(base), F.col("href")))


def _amount(column: str, pattern: str = ZLOTY) -> Column:
    """A number whose thousands are set apart by blanks or dots."""
    return F.translate(FT.number_text(column, pattern), " \xa0.", "").try_cast("double")


def _decimal(text: Column, pattern: str = DECIMAL) -> Column:
    return F.replace(FT.number_text(text, pattern), F.lit(","), F.lit(".")).try_cast("double")


def _some(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def _card_and_url() -> Column:
    return F.concat_ws(" ", F.col("card_text"), F.col("url"))


# A field that an element may give is two steps: ``own_...`` is the element's value, and
# the field is that or, where it is falsy, the value in the card's text (F8). The text is
# searched only for what a row lacks.

def _olx(as_of) -> dict[str, Column]:
    """Title, price and location elements; area, rooms and date from the text."""
    fb = low_fallback("low", DATE_LABELS_TEXTUAL["olx"], as_of)
    return dict(
        link=FU.absolute_url("href", BASE["olx"]),
        district=FDi.district_first(F.coalesce("location", F.lit(""))),
        own_price=FT.parse_number("price"),
        price_pln=FT.falsy_or("own_price", fb["price_pln"]), sqm=fb["sqm"], rooms=fb["rooms"],
        date_posted=fb["date_posted"], name=default_title(_some("title"), "district"))


def _adresowo(as_of) -> dict[str, Column]:
    """Unit-tagged values (F29), place and street in the heading; the rest from
    the text and the url (F8, F10)."""
    place = F.get("heads", F.lit(0))
    named = FT.title_case(FT.pystrip(F.replace(place, F.lit("Warszawa"), F.lit(""))))
    fb = low_fallback("low", price="low_card")
    value = lambda name: FT.falsy_or(f"tagged.{name}", fb[name])
    return dict(
        tagged=FT.unit_tagged("tags"),
        link=_below(BASE["adresowo"], F.col("href").startswith("http")),
        low=F.lower(F.concat_ws(" ", F.col("card_text"), F.col("link"))), low_card=F.lower(F.col("card_text")),
        district=F.coalesce(F.when(place.contains("Warszawa"), F.nullif(named, F.lit(""))),
                            FDi.district_from_slug(F.col("link"), F.col("card_text"))),
        price_pln=value("price_pln"), sqm=value("sqm"), rooms=value("rooms"), date_posted=F.lit(None).cast("date"),
        name=FT.pystrip(F.concat_ws(" ", F.lit("Mieszkanie Warszawa"), F.coalesce("district", F.lit("")),
                                    F.coalesce(F.get("heads", F.lit(1)), F.lit("")))),
        shown=F.col("link"))


def _nieruchomosci(as_of) -> dict[str, Column]:
    """The link's text as title, the province link as district, price and area
    elements; rooms and date from the text."""
    href = F.col("href")
    province = F.nullif(F.regexp_replace("location", ",+$", ""), F.lit(""))
    fb = low_fallback("low", DATE_LABELS_TEXTUAL["no"], as_of)
    return dict(
        link=F.when(href.startswith("//"), F.concat(F.lit("https:"), href))
        .otherwise(_below(BASE["no"], href.startswith("http"))),
        district=F.coalesce(province, FDi.district_stopset(_card_and_url()), F.lit("Warszawa")),
        own_price=_amount("price"), own_sqm=_decimal(F.col("area")),
        price_pln=FT.falsy_or("own_price", fb["price_pln"]), sqm=FT.falsy_or("own_sqm", fb["sqm"]),
        rooms=fb["rooms"], date_posted=fb["date_posted"],
        name=F.coalesce(_some("title"), default_title(F.lit(None).cast("string"), "district")))


def _morizon(as_of) -> dict[str, Column]:
    """Data-cy fields; rooms by word or number, district = last location part."""
    fb = low_fallback("low", DATE_LABELS_DOTTED["morizon"], as_of, textual_dates=False)
    return dict(
        link=_below(BASE["morizon"], ~F.col("href").startswith("/")),
        district=FDi.district_last(F.col("location")),
        own_price=_amount("price"), own_sqm=_decimal(F.col("area")), own_rooms=FT.parse_rooms("rooms"),
        price_pln=FT.falsy_or("own_price", fb["price_pln"]),
        own_per_sqm=_amount("price_m2"),
        sqm=FT.falsy_or("own_sqm", fb["sqm"]), rooms=FT.falsy_or("own_rooms", fb["rooms"]),
        date_posted=fb["date_posted"],
        name=F.coalesce("title", F.lit("Mieszkanie na sprzedaż (Warszawa)")),
        shown=F.col("link"))


def _freedom(as_of) -> dict[str, Column]:
    """Address, price, price per m², details, date at the bottom."""
    details = F.concat_ws(" ", "details")
    per_sqm = F.translate(FT.number_text("price_m2", r"(\d[\d\s\x{a0}.]*)"), " \xa0", "")
    place = F.coalesce(_some("district"), F.lit("Warszawa"))
    fb = low_fallback("low", DATE_LABELS_DOTTED["freedom"], as_of, textual_dates=False)
    return dict(
        link=_below(BASE["freedom"], ~F.col("href").startswith("/")),
        district=FDi.district_no_street(F.col("location")),
        own_price=_amount("price"), own_sqm=_decimal(details, DECIMAL + r"[\s\x{a0}]*m"),
        own_rooms=FT.number_text(F.lower(details), r"(\d+)[\s\x{a0}]*pok").try_cast("int"),
        own_date=FD.parse_date_ingest(F.col("date"), as_of, True),
        price_pln=FT.falsy_or("own_price", fb["price_pln"]),
        own_per_sqm=per_sqm.try_cast("double"),
        sqm=FT.falsy_or("own_sqm", fb["sqm"]), rooms=FT.falsy_or("own_rooms", fb["rooms"]),
        date_posted=F.coalesce("own_date", fb["date_posted"]),
        name=F.concat(F.lit("Mieszkanie Warszawa ("), place, F.lit(")")),
        shown=F.col("link"))


RULES = {"olx": _olx, "adresowo": _adresowo, "no": _nieruchomosci, "morizon": _morizon, "freedom": _freedom}


def _rules(portal: str, as_of) -> dict[str, Column]:
    """A portal's steps; those that it doesn't name are the common ones."""
    none = dict.fromkeys(["low_card", "tagged", "own_price", "own_sqm", "own_rooms", "own_date"], F.lit(None))
    common = dict(none, url=FU.canonical_url(F.col("link")), low=F.lower(_card_and_url()),
                  offer_id=FU.canonical_offer_id(F.col("url"), portal), own_per_sqm=F.lit(None).cast("double"),
                  shown=F.col("url"))
    return {**common, **RULES[portal](as_of)}


def _one_portal(pages: DataFrame, portal: str, as_of) -> DataFrame:
    """One row per link on a portal's result pages."""
    rules = _rules(portal, as_of)
    out = card_fields(pages, portal)
    for step in STEPS:
        out = out.withColumn(step, rules[step])
    per_sqm = FT.price_per_sqm("price_pln", "sqm", F.col("own_per_sqm"))
    day = F.col("date_posted").cast("string")
    return out.select(
        F.concat("portal", F.lit("-"), "offer_id").alias("external_id"), F.col("name").alias("title"), "price_pln",
        per_sqm.alias("price_per_sqm"), "sqm", "rooms", FD.pack_district(F.col("district"), day).alias("district"),
        day.alias("date_posted"), F.col("shown").alias("url"))


def portal_cards(pages: DataFrame, as_of, portals: Sequence[str] = tuple(RULES), portal: str = "portal") -> DataFrame:
    """Result pages of any portals (column ``portal``: the id prefix) to one
    row per link, in one job. Pages of other or no portals give no row. Each page is
    parsed once: a branch reads its portal's pages only (pruned folders, where the
    captures are partitioned by portal). One choice by portal inside a single branch
    is no alternative: its code is beyond the JVM's limit for a method."""
    return functools.reduce(DataFrame.unionByName, [
        _one_portal(pages.filter(F.col(portal) == p), p, as_of) for p in portals])


olx_cards, adresowo_cards, nieruchomosci_cards, morizon_cards, freedom_cards = (
    functools.partial(_one_portal, portal=p) for p in RULES)
