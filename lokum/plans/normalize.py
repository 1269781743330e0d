"""Listing normalisation: fallback parameters from text (F8), default titles
(F16), and the store-stage record (F11, F21, F22) — one ``select`` each, no UDF.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as FD
from ..functions import text as FT


def fallback_params(text: Column, url: Column | None, date_labels: Sequence[str], as_of,
                    textual_dates: bool = True) -> Column:
    """F8: sqm and rooms from "text url", price from text only, labelled date."""
    combined = F.concat_ws(" ", text, url) if url is not None else text
    return F.struct(
        FT.text_sqm(combined).alias("sqm"),
        FT.text_rooms(combined).alias("rooms"),
        FT.text_price(text).alias("price_pln"),
        FD.text_date(text, date_labels, as_of, textual=textual_dates).alias("date_posted"),
    )


def low_fallback(low: str, date_labels: Sequence[str] = (), as_of=None, textual_dates: bool = True,
                 price: str | None = None) -> dict[str, Column]:
    """F8 over lower-case text in a column (``price``: that of the price, if another):
    the fields one by one, so that a row works out only those that it lacks."""
    return dict(sqm=FT.low_sqm(low), rooms=FT.low_rooms(low), price_pln=FT.low_price(price or low),
                date_posted=FD.low_date(low, date_labels, as_of, textual_dates) if date_labels
                else F.lit(None).cast("date"))


def default_title(title="title", district="district") -> Column:
    """F16: "Mieszkanie na sprzedaż (<district or Warszawa>)" for a blank title."""
    d = FT.col_(district)
    name = F.when(d.isNotNull() & (d != ""), d).otherwise(F.lit("Warszawa"))
    return F.when(FT.blank(title), F.concat(F.lit("Mieszkanie na sprzedaż ("), name, F.lit(")"))) \
        .otherwise(FT.col_(title))


def store_record(df: DataFrame) -> DataFrame:
    """Store stage of a new listing: default title, fill missing (``is None``)
    sqm / rooms / price from "title description", price per m², then the
    imputed defaults with flags, and the text to embed."""
    t = default_title("title", "district")
    desc = F.coalesce(F.col("description"), F.lit(""))
    combined = FT.pystrip(F.concat(t, F.lit(" "), desc))
    sqm1 = F.coalesce(F.col("sqm"), FT.text_sqm(combined))
    rooms1 = F.coalesce(F.col("rooms"), FT.text_rooms(combined))
    price1 = F.coalesce(F.col("price_pln"), FT.text_price(combined))
    existing = F.col("price_per_sqm") if "price_per_sqm" in df.columns else None
    out = (df.withColumn("title", t)
           .withColumn("sqm", sqm1).withColumn("rooms", rooms1).withColumn("price_pln", price1))
    out = out.withColumn("price_per_sqm", FT.price_per_sqm("price_pln", "sqm", existing))
    return (out.withColumn("sqm_imputed", F.col("sqm").isNull())
               .withColumn("rooms_imputed", F.col("rooms").isNull())
               .withColumn("sqm", FT.impute_sqm("sqm"))
               .withColumn("rooms", FT.impute_rooms("rooms"))
               .withColumn("embed_text", FT.embed_text("title", "district", "description")))


def detail_enrich(listings: DataFrame, details: DataFrame, as_of, date_labels: Sequence[str]) -> DataFrame:
    """Listing ⋈ detail page by canonical url (left: a missing or empty
    page leaves the row as it is, with its null description). A non-empty
    detail text fills the description and falsy sqm / rooms / price, supplies
    the posting date unless the listing has one (packed into the district only
    when the district has no '-'), and recomputes a missing price/m².
    ``listings`` has description and date_posted, ``details`` curl, detail_text. A price/m²
    that ``listings`` doesn't bring is worked out behind the join, from the listing's own
    price and area: it isn't shuffled."""
    from ..functions.urls import canonical_url
    j = listings.withColumn("curl", canonical_url("url")).join(details, "curl", "left")
    if "price_per_sqm" not in j.columns:
        j = j.withColumn("price_per_sqm", FT.price_per_sqm("price_pln", "sqm"))
    has = FT.truthy_str("detail_text")
    fb = fallback_params(F.col("detail_text"), None, date_labels, as_of)
    j = j.withColumn("fb", fb)
    own = F.nullif(F.col("date_posted").cast("string"), F.lit(""))
    date = F.coalesce(own, F.when(has, F.col("fb.date_posted").cast("string")))
    j = j.withColumn("description", F.when(has, FT.falsy_or("description", "detail_text", "str"))
                     .otherwise(F.col("description")))
    j = (j.withColumn("sqm", F.when(has, FT.falsy_or("sqm", "fb.sqm")).otherwise(F.col("sqm")))
          .withColumn("rooms", F.when(has, FT.falsy_or("rooms", "fb.rooms")).otherwise(F.col("rooms")))
          .withColumn("price_pln", F.when(has, FT.falsy_or("price_pln", "fb.price_pln"))
                      .otherwise(F.col("price_pln")))
          .withColumn("date_posted", date))
    dist = F.coalesce(F.nullif(F.col("district"), F.lit("")), F.lit("Warszawa"))
    j = j.withColumn("district", F.when(has & F.col("date_posted").isNotNull() & ~dist.contains("-"),
                                        F.concat(dist, F.lit(" - "), F.col("date_posted")))
                     .otherwise(F.col("district")))
    recompute = has & ~FT.truthy_num("price_per_sqm") & FT.truthy_num("price_pln") & FT.truthy_num("sqm")
    return j.withColumn("price_per_sqm", F.when(recompute, FT.round_to(F.col("price_pln") / F.col("sqm"), 2))
                        .otherwise(F.col("price_per_sqm"))).drop("fb", "curl", "detail_text")
