"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the driver tables (or data Spark derives from them) in full.
Parameters that stand in for user input (exclusion terms, the query vector
row, page size) are fixed here and mirrored in the oracle SQL.
"""

from __future__ import annotations

import datetime as _dt
import functools
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.dedupe import keep_first
from .plans.search import SearchParams, search
from .session import sorted_groups
from .sources.listings import listing_view
from .sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = _dt.datetime(1999, 1, 1, 0, 0, 0)
AS_OF_DATE = "1999-01-01"
QUERY_VEC_ID = 42


def register(name: str):
    """Register a query; the wrapper applies the session defaults (UTC, AQE)
    and the checkpoint folder first, since the caller owns the session."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from .session import apply_conf, ensure_checkpoint_dir
            apply_conf(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def L(spark: SparkSession, sf: str) -> DataFrame:
    return listing_view(spark, sf)


def listing_order() -> list:
    """Which of the rows with one id stays: portals in ingest order, then
    the earliest capture (then the other columns, so the order is total)."""
    rank = F.array_position(F.array(*[F.lit(k) for k in PORTAL_KEYS]), F.col("portal"))
    return [rank, "created_at"]


def stored_listings(spark: SparkSession, sf: str) -> DataFrame:
    """W1 applied to L: one row per external_id."""
    return keep_first(L(spark, sf), ["external_id"], listing_order())


def query_vector(spark: SparkSession, sf: str, vec_id: int = QUERY_VEC_ID) -> list[float]:
    """V4: the query vector (one row of the vector table)."""
    row = (read_table(spark, sf, "embeddings", "vec_id", "embedding")
           .filter(F.col("vec_id") == vec_id).select("embedding").first())
    return list(row[0]) if row else []


def order_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    made = F.col("o_orderdate").cast("timestamp")
    return read_table(spark, sf, "orders", "o_orderkey", "o_orderdate").select(
        F.col("o_orderkey").alias("order_key"), made.alias("created_at"),
        (made + F.expr("make_dt_interval(o_orderkey % 30)")).alias("updated_at"))


SEARCH_PARAMS = SearchParams(
    exclude_districts=["nation_3", "red"], exclude_portals=["freedom"], only_new=True,
    new_within_days=90, as_of=AS_OF, top_n=50, offset=10)


def run_search(spark: SparkSession, sf: str, params: SearchParams = SEARCH_PARAMS) -> DataFrame:
    vectors = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    ts = order_timestamps(spark, sf)
    # part keys go round the vector ids: every vector has listings only if the ids
    # are 0..n-1 and there are at least n parts with listings; vectors beyond that
    # have none, and a listing whose id is missing is dropped by the join
    listings = stored_listings(spark, sf).withColumn("vec_id", F.col("part_key") % max(1, vectors.count()))
    out = search(listings, vectors, query_vector(spark, sf), params,
                 timestamps=ts, timestamps_key="order_key")
    return out.withColumn("rank", F.col("rank").cast("long"))


@register("search")
def q_search(spark, sf):
    return run_search(spark, sf)


@register("search_prefilter")
def q_search_prefilter(spark, sf):
    from dataclasses import replace
    return run_search(spark, sf, replace(SEARCH_PARAMS, mode="pre"))


# =============================================================================
# Scalar functions (F1-F30) over the listing view
# =============================================================================

from .constants import MONTH_GENITIVE, PORTAL_KEYS, PORTAL_PREFIXES  # noqa: E402
from .functions import dates as FD  # noqa: E402
from .functions import district as FDi  # noqa: E402
from .functions import text as FT  # noqa: E402
from .functions import urls as FU  # noqa: E402

ROOM_WORD_FORMS = ["ONE", "TWO", "THREE", "FOUR", "FIVE"]


def _n():
    return F.col("line_no")


def rooms_raw_col():
    n, r = _n(), F.col("rooms").cast("string")
    return (F.when(n == 1, F.element_at(F.array(*[F.lit(w) for w in ROOM_WORD_FORMS]), F.col("rooms")))
            .when(n == 2, F.concat(r, F.lit(" pokoje")))
            .when(n == 3, F.lit("kawalerka"))
            .when(n == 4, F.concat(r, F.lit(" POKÓJ")))
            .when(n == 5, r)
            .when(n == 6, F.lit(None).cast("string"))
            .otherwise(F.concat(r, F.lit(" pokoi"))))


def month_word_of(ts):
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_GENITIVE]), F.month(ts))


def raw_date_col():
    n, c = _n(), F.col("created_at")
    return (F.when(n == 1, F.lit("Dzisiaj o 14:30"))
            .when(n == 2, F.col("district"))
            .when(n == 3, F.lit("wczoraj"))
            .when(n == 4, F.concat_ws(" ", F.dayofmonth(c).cast("string"), month_word_of(c)))
            .when(n == 5, F.concat_ws(" ", F.dayofmonth(c).cast("string"), month_word_of(c),
                                      F.year(c).cast("string")))
            .otherwise(F.col("description")))


def clean_district_col():
    return F.split_part(F.col("district"), F.lit(" - "), F.lit(1))


def location_col():
    """Location text in three shapes: "Warszawa, <d>", "<d>, Warszawa,
    mazowieckie", "<d>" (lower-cased district name)."""
    d = F.lower(clean_district_col())
    k = F.col("line_no") % 3
    return (F.when(k == 0, F.concat(F.lit("Warszawa, "), d))
            .when(k == 1, F.concat(d, F.lit(", Warszawa, mazowieckie")))
            .otherwise(d))


@register("parse_rooms")
def q_parse_rooms(spark, sf):
    df = L(spark, sf).select("external_id", rooms_raw_col().alias("rooms_raw"))
    return df.select("external_id", "rooms_raw", FT.parse_rooms("rooms_raw").alias("rooms"),
                     FT.parse_rooms("rooms_raw", strict=True).alias("rooms_strict"))


@register("parse_number")
def q_parse_number(spark, sf):
    return L(spark, sf).select("external_id", "description",
                               FT.parse_number("description").alias("number"))


@register("parse_date_ingest")
def q_parse_date_ingest(spark, sf):
    df = L(spark, sf).select("external_id", raw_date_col().alias("raw"))
    return df.select("external_id", "raw",
                     FD.parse_date_ingest_iso("raw", AS_OF).alias("date_iso"),
                     FD.parse_date_ingest("raw", AS_OF).cast("string").alias("date_posted"))


@register("parse_date_year_required")
def q_parse_date_year_required(spark, sf):
    df = L(spark, sf).select("external_id", raw_date_col().alias("raw"))
    return df.select("external_id", "raw",
                     FD.parse_date_ingest("raw", AS_OF, year_required=True).cast("string")
                     .alias("date_posted"))


@register("parse_date_read")
def q_parse_date_read(spark, sf):
    df = L(spark, sf).select("external_id", raw_date_col().alias("raw"))
    return df.select("external_id", "raw", FD.parse_date_read("raw", AS_OF).alias("date_posted"))


def _text_col():
    return F.concat_ws(" ", F.col("title"), F.col("description"))


@register("text_sqm")
def q_text_sqm(spark, sf):
    return L(spark, sf).select("external_id", FT.text_sqm(_text_col()).alias("sqm"),
                               FT.text_sqm(_text_col(), sanity=(10, 1000)).alias("sqm_sane"))


@register("text_rooms")
def q_text_rooms(spark, sf):
    return L(spark, sf).select("external_id", FT.text_rooms(_text_col()).alias("rooms"))


@register("text_price")
def q_text_price(spark, sf):
    return L(spark, sf).select("external_id", FT.text_price(_text_col()).alias("price_pln"))


@register("text_date")
def q_text_date(spark, sf):
    from .constants import DATE_LABELS_DOTTED, DATE_LABELS_TEXTUAL
    d = F.col("description")
    return L(spark, sf).select(
        "external_id",
        FD.text_date(d, DATE_LABELS_TEXTUAL["olx"], AS_OF).cast("string").alias("date_olx"),
        FD.text_date(d, DATE_LABELS_TEXTUAL["no"], AS_OF).cast("string").alias("date_no"),
        FD.text_date(d, DATE_LABELS_DOTTED["morizon"], AS_OF, textual=False).cast("string").alias("date_morizon"),
        FD.text_date(d, DATE_LABELS_DOTTED["freedom"], AS_OF, textual=False).cast("string").alias("date_freedom"))


@register("fallback_params")
def q_fallback_params(spark, sf):
    from .plans.normalize import fallback_params
    from .constants import DATE_LABELS_TEXTUAL
    fb = fallback_params(_text_col(), F.col("url"), DATE_LABELS_TEXTUAL["olx"], AS_OF)
    return L(spark, sf).select("external_id", fb.alias("fb")).select(
        "external_id", F.col("fb.sqm").alias("sqm"), F.col("fb.rooms").alias("rooms"),
        F.col("fb.price_pln").alias("price_pln"),
        F.col("fb.date_posted").cast("string").alias("date_posted"))


@register("district_first")
def q_district_first(spark, sf):
    return L(spark, sf).select("external_id", location_col().alias("location")) \
        .select("external_id", "location", FDi.district_first("location").alias("district"))


@register("district_stopset")
def q_district_stopset(spark, sf):
    return L(spark, sf).select("external_id", location_col().alias("location")) \
        .select("external_id", "location", FDi.district_stopset("location").alias("district"))


@register("district_last")
def q_district_last(spark, sf):
    return L(spark, sf).select("external_id", location_col().alias("location")) \
        .select("external_id", "location", FDi.district_last("location").alias("district"))


@register("district_no_street")
def q_district_no_street(spark, sf):
    loc = F.when(F.col("line_no") == 7, F.concat(F.lit("ul. Polna 3, "), location_col())) \
        .otherwise(location_col())
    return L(spark, sf).select("external_id", loc.alias("location")) \
        .select("external_id", "location", FDi.district_no_street("location").alias("district"))


@register("district_strip_city")
def q_district_strip_city(spark, sf):
    loc = F.when(F.col("line_no") == 5, F.concat(F.lit("Warszawa "), clean_district_col())) \
        .otherwise(location_col())
    return L(spark, sf).select("external_id", loc.alias("location")) \
        .select("external_id", "location", FDi.district_strip_city("location").alias("district"))


def slug_url_col():
    slug = F.lower(F.replace(clean_district_col(), F.lit(" "), F.lit("-")))
    return F.when(F.col("line_no") % 2 == 1,
                  F.concat(F.lit("https://adresowo.pl/o/mieszkanie-warszawa-"), slug, F.lit("-ul-"),
                           F.col("part_key").cast("string"))).otherwise(F.col("url"))


@register("district_from_slug")
def q_district_from_slug(spark, sf):
    text = F.concat(F.lit("Mieszkanie Warszawa "), clean_district_col(), F.lit(" ul. Polna"))
    return L(spark, sf).select("external_id", slug_url_col().alias("slug_url"), text.alias("text")) \
        .select("external_id", FDi.district_from_slug("slug_url", "text").alias("district"))


@register("price_per_sqm")
def q_price_per_sqm(spark, sf):
    return L(spark, sf).select("external_id", FT.price_per_sqm("price_pln", "sqm").alias("price_per_sqm"))


@register("external_id")
def q_external_id(spark, sf):
    prefix = F.element_at(F.array(*[F.lit(p) for p in PORTAL_PREFIXES]),
                          F.array_position(F.array(*[F.lit(k) for k in PORTAL_KEYS]), F.col("portal")).cast("int"))
    ident = F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_no").cast("string"))
    return L(spark, sf).select(FU.external_id(prefix, ident).alias("external_id"), "portal")


@register("title_default")
def q_title_default(spark, sf):
    from .plans.normalize import default_title
    from .constants import FB_DEFAULT_TITLE, FB_TITLE_PREFIX
    return L(spark, sf).select(
        "external_id",
        default_title("title", "district").alias("title"),
        F.concat(F.lit("Mieszkanie Warszawa ("),
                 F.coalesce(F.nullif(clean_district_col(), F.lit("")), F.lit("Warszawa")),
                 F.lit(")")).alias("title_freedom"),
        F.concat(F.lit(FB_TITLE_PREFIX), F.coalesce(F.nullif(F.col("title"), F.lit("")),
                                                  F.lit(FB_DEFAULT_TITLE))).alias("title_fb"))


@register("district_pack")
def q_district_pack(spark, sf):
    date = FD.text_date(F.col("description"), ["Dodano"], AS_OF).cast("string")
    return L(spark, sf).select("external_id", FD.pack_district(clean_district_col(), date).alias("district"))


@register("district_unpack")
def q_district_unpack(spark, sf):
    return L(spark, sf).select(
        "external_id", FD.unpack_district("district").alias("district"),
        FD.listing_date(None, "district", "created_at", None, AS_OF).alias("date_posted"))


@register("falsy_coalesce")
def q_falsy_coalesce(spark, sf):
    fb = FT.text_price(F.col("description"))
    return L(spark, sf).select(
        "external_id",
        FT.falsy_or("price_pln", fb).alias("price_or"),
        FT.is_none_or("price_pln", fb).alias("price_is_none"),
        FT.falsy_or("title", F.lit("Mieszkanie"), kind="str").alias("title_or"))


@register("portal_classify")
def q_portal_classify(spark, sf):
    return L(spark, sf).select("external_id", "url",
                               FU.portal_key("url", "external_id").alias("portal_key"),
                               FU.portal_label("url", "external_id").alias("portal_label"))


@register("impute_defaults")
def q_impute_defaults(spark, sf):
    from .plans.normalize import store_record
    return store_record(L(spark, sf)).select("external_id", "title", "sqm", "sqm_imputed", "rooms",
                                             "rooms_imputed", "price_pln", "price_per_sqm")


@register("embed_text")
def q_embed_text(spark, sf):
    from .plans.normalize import default_title
    return L(spark, sf).select("external_id", FT.embed_text(default_title("title", "district"), "district",
                                                            "description").alias("embed_text"))


@register("highlight_snippet")
def q_highlight_snippet(spark, sf):
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", FT.highlight_snippet("text").alias("snippet"))


@register("title_case")
def q_title_case(spark, sf):
    name = F.lower(F.replace(clean_district_col(), F.lit(" "), F.lit("-")))
    return L(spark, sf).select("external_id", name.alias("name"),
                               FT.title_case(name).alias("title_case"),
                               FT.capitalize(name).alias("capitalized"))


@register("format_money")
def q_format_money(spark, sf):
    pps = FT.price_per_sqm("price_pln", "sqm")
    return L(spark, sf).select("external_id", FT.format_money("price_pln").alias("price"),
                               FT.format_money(pps).alias("price_per_sqm"))


@register("post_date")
def q_post_date(spark, sf):
    ev = read_table(spark, sf, "events", "event_id", "ts", "props")
    epoch = F.unix_timestamp(F.col("ts").cast("timestamp"))
    k = F.col("event_id") % 3
    return ev.select(
        "event_id",
        F.when(k == 0, FD.post_date(epoch_seconds=epoch, as_of=AS_OF))
        .when(k == 1, FD.post_date(text=F.col("ts").cast("string"), as_of=AS_OF))
        .otherwise(FD.post_date(as_of=AS_OF)).alias("date_posted"))


@register("text_cap")
def q_text_cap(spark, sf):
    from .constants import EXTRACT_TEXT_CAP
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", FT.text_cap("text", EXTRACT_TEXT_CAP).alias("text"))


@register("unit_tagged_values")
def q_unit_tagged_values(spark, sf):
    price = F.concat(F.format_number("price_pln", 0), F.lit(" zł"))
    price = F.replace(price, F.lit(","), F.lit(" "))
    area = F.concat(F.replace(F.col("sqm").cast("string"), F.lit("."), F.lit(",")), F.lit(" m²"))
    rooms = F.concat(F.col("rooms").cast("string"), F.lit(" pok."))
    tags = F.array(price, area, rooms, F.lit("9 zł"), F.lit("5 m2"))
    v = FT.unit_tagged(tags)
    return L(spark, sf).select("external_id", v.alias("v")).select(
        "external_id", F.col("v.price_pln").alias("price_pln"), F.col("v.sqm").alias("sqm"),
        F.col("v.rooms").alias("rooms"))


# =============================================================================
# Dedupe, delta, merge, joins, aggregates, predicates, paging, top-k
# =============================================================================

from .operators import aggregates as AG  # noqa: E402
from .operators import delta as DL  # noqa: E402
from .operators import filters as P  # noqa: E402
from .operators.paging import page_offset, paginate, rank_unbounded  # noqa: E402
from .sources.listings import stored_half  # noqa: E402

EXCL_TERMS = ["nation_3", "nation_1", "red"]


def store_table(spark, sf, columns=None):
    """The stored table: keep-first over the stored half of L."""
    return keep_first(L(spark, sf).filter(stored_half()), ["external_id"], listing_order(), columns)


def batch_table(spark, sf, columns=None):
    """A new scrape batch: every L row, keep-first per id (W1 + P10)."""
    from .operators.dedupe import keep_first_nonblank_key
    return keep_first_nonblank_key(L(spark, sf), "external_id", listing_order(), columns)


def _public(df):
    return df.select("external_id", "portal", "url", "title", "price_pln", "sqm", "rooms", "district",
                     "description", F.col("created_at").cast("string").alias("created_at"))


@register("dedupe_external_id")
def q_dedupe_external_id(spark, sf):
    return _public(batch_table(spark, sf))


@register("delta_anti")
def q_delta_anti(spark, sf):
    return DL.new_rows(batch_table(spark, sf), store_table(spark, sf)).select("external_id", "portal", "url")


@register("existing_ids")
def q_existing_ids(spark, sf):
    return DL.existing_ids(L(spark, sf), store_table(spark, sf))


@register("enrich_timestamps")
def q_enrich_timestamps(spark, sf):
    rows = DL.with_timestamps(stored_listings(spark, sf), order_timestamps(spark, sf), "order_key")
    return rows.select("external_id", F.col("created_at").cast("string").alias("created_at"),
                       F.col("updated_at").cast("string").alias("updated_at"))


@register("upsert_merge")
def q_upsert_merge(spark, sf):
    from .plans.normalize import store_record
    cols = ["external_id", "title", "price_pln", "sqm", "rooms", "url"]
    store = store_table(spark, sf).select(*cols).withColumn("version", F.lit("old"))
    incoming = store_record(keep_first(L(spark, sf).filter(~stored_half()), ["external_id"], listing_order())) \
        .select(*cols).withColumn("version", F.lit("new"))
    return DL.upsert(store, incoming)


@register("delta_summary")
def q_delta_summary(spark, sf):
    return AG.delta_summary(batch_table(spark, sf), store_table(spark, sf))


@register("exclusion_counts")
def q_exclusion_counts(spark, sf):
    return AG.exclusion_counts(stored_listings(spark, sf), EXCL_TERMS)


@register("portal_counts")
def q_portal_counts(spark, sf):
    return AG.portal_counts(L(spark, sf))


@register("distinct_ids")
def q_distinct_ids(spark, sf):
    return AG.distinct_ids(L(spark, sf))


@register("new_count")
def q_new_count(spark, sf):
    d = stored_listings(spark, sf).withColumn(
        "date_posted", FD.listing_date(None, "district", "created_at", None, AS_OF))
    return AG.new_count(d, F.col("date_posted"), AS_OF, 90)


@register("numeric_caps")
def q_numeric_caps(spark, sf):
    return stored_listings(spark, sf).filter(P.numeric_caps(750000, 30, None)) \
        .select("external_id", "price_pln", "sqm", "rooms")


@register("exclude_districts")
def q_exclude_districts(spark, sf):
    return stored_listings(spark, sf).filter(~P.district_excluded(EXCL_TERMS)).select("external_id", "district")


@register("exclude_portals")
def q_exclude_portals(spark, sf):
    return stored_listings(spark, sf).filter(~P.portal_excluded(["freedom", "no"])).select("external_id", "portal")


@register("include_portals")
def q_include_portals(spark, sf):
    return stored_listings(spark, sf).filter(P.portal_included(["olx", "otodom"])).select("external_id", "portal")


@register("exclude_agencies")
def q_exclude_agencies(spark, sf):
    return stored_listings(spark, sf).filter(~P.agency_excluded()).select("external_id")


@register("recency_filter")
def q_recency_filter(spark, sf):
    d = stored_listings(spark, sf).withColumn(
        "date_posted", FD.listing_date(None, "district", "created_at", None, AS_OF))
    return d.filter(P.recent(F.col("date_posted"), AS_OF, 90)).select("external_id", "date_posted")


@register("ingest_portal_filter")
def q_ingest_portal_filter(spark, sf):
    from .plans.ingest import select_portals
    keys = select_portals(include=["olx", "no", "morizon"], exclude=["morizon"])
    return L(spark, sf).filter(F.col("portal").isin(*keys)).select("external_id", "portal")


@register("scan_projection")
def q_scan_projection(spark, sf):
    return read_table(spark, sf, "orders", "o_orderkey", "o_orderdate").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("string").alias("created_at"))


@register("capped_scan")
def q_capped_scan(spark, sf):
    return stored_listings(spark, sf).filter(P.numeric_caps(750000, 30, 2)) \
        .orderBy("external_id").limit(500).select("external_id", "price_pln", "sqm", "rooms")


@register("paginate")
def q_paginate(spark, sf):
    off = page_offset(3, 25)
    return paginate(stored_listings(spark, sf), [F.col("price_pln").desc_nulls_last(), F.col("external_id")],
                    off, 25).select("external_id", "price_pln")


@register("rank_page")
def q_rank_page(spark, sf):
    return rank_unbounded(stored_listings(spark, sf).select("external_id", "created_at"),
                          [F.col("created_at"), F.col("external_id")]) \
        .select(F.col("rank").cast("long").alias("rank"), "external_id")


@register("vector_topk")
def q_vector_topk(spark, sf):
    from .operators.vector import rounded, similarity, topk
    vec = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    scored = vec.select("vec_id", similarity("embedding", query_vector(spark, sf)).alias("similarity"))
    return topk(scored, "similarity", 20, 0.10, "vec_id").withColumn("similarity", rounded("similarity"))


# =============================================================================
# Captured pages: extraction, urls, page depth, quarantine (X10-X12, F12-F14,
# W2, S2, S13, P13)
# =============================================================================

from .operators.extract_html import page_parts  # noqa: E402
from .plans import pages as PG  # noqa: E402


def pages_table(spark, sf):
    return read_table(spark, sf, "pages", "page_id", "url", "html")


@register("page_description")
def q_page_description(spark, sf):
    return page_parts(pages_table(spark, sf)).select("page_id", "description")


@register("page_paragraphs")
def q_page_paragraphs(spark, sf):
    return PG.paragraph_description(page_parts(pages_table(spark, sf))).select("page_id", "description")


@register("page_title")
def q_page_title(spark, sf):
    return page_parts(pages_table(spark, sf)).select("page_id", "title", "page_text")


@register("url_absolute")
def q_url_absolute(spark, sf):
    pages = pages_table(spark, sf)
    return page_parts(pages, keep=["url"]).select(
        "page_id", FU.absolute_url("first_href", FU.origin("url")).alias("link"))


@register("url_canonical")
def q_url_canonical(spark, sf):
    return pages_table(spark, sf).select("page_id", FU.canonical_url("url").alias("url"))


@register("offer_id")
def q_offer_id(spark, sf):
    return pages_table(spark, sf).select(
        "page_id", *[FU.offer_id("url", p).alias(f"id_{p}") for p in FU.OFFER_ID_PATTERNS])


@register("dedupe_page_url")
def q_dedupe_page_url(spark, sf):
    return PG.dedupe_page_url(pages_table(spark, sf)).select("page_id", "url")


@register("page_depth")
def q_page_depth(spark, sf):
    return PG.page_depth(pages_table(spark, sf), max_pages=3).select("page_id", "host", "page_no")


@register("quarantine_split")
def q_quarantine_split(spark, sf):
    return PG.quarantine_split(pages_table(spark, sf)).select("page_id", "status")


@register("distinct_profile")
def q_distinct_profile(spark, sf):
    """A4: the listings arrive in seven runs (by line number), each adds its sketches;
    the merged estimate per portal, held against the exact count."""
    import uuid
    from .operators import profile
    from .session import scratch_dir
    path = scratch_dir(spark, f"profile-{uuid.uuid4().hex[:12]}")
    for run in range(1, 8):
        profile.append_profile(L(spark, sf).filter(F.col("line_no") == run), path, str(run))
    exact = L(spark, sf).groupBy("portal").agg(F.count_distinct("external_id").alias("exact_ids"))
    off = F.abs(F.col("distinct_ids") - F.col("exact_ids"))
    return (profile.merged_profile(spark, path).join(exact, "portal")
            .select("portal", "n_runs", "n_rows", "exact_ids",
                    (off <= F.col("exact_ids") * profile.ERROR).alias("within_error")))


@register("portal_isolation")
def q_portal_isolation(spark, sf):
    """Captures of seven portals, some without html or content, those of one
    portal mostly; every page in the batch (null reason) or in quarantine."""
    import uuid
    from .plans.isolation import load_pages
    from .session import scratch_dir
    page = F.col("page_id")
    portal = F.element_at(F.array(*[F.lit(k) for k in PORTAL_KEYS]), (page % len(PORTAL_KEYS) + 1).cast("int"))
    html = (F.when((portal == PORTAL_KEYS[2]) & (page % 3 != 0), F.lit(None))
            .when(page % 11 == 0, F.lit(" ")).when(page % 13 == 0, F.lit("<p>gone</p>")).otherwise(F.col("html")))
    captured = pages_table(spark, sf).select("page_id", portal.alias("portal"), html.alias("html"))
    run = load_pages(spark, scratch_dir(spark, f"load-{uuid.uuid4().hex[:12]}"), captured)
    return (run.batch.select("page_id", "portal", F.lit(None).cast("string").alias("reason"))
            .unionByName(run.quarantine))


@register("source_scope")
def q_source_scope(spark, sf):
    p = pages_table(spark, sf)
    return PG.source_scope(p, "ref", "x").select("page_id", "ref", "page")


@register("search_scope")
def q_search_scope(spark, sf):
    """Search captures, one per order, dealt over three portals."""
    n, key = F.col("o_orderkey") % 3, F.col("o_orderkey").cast("string")
    url = (F.when(n == 0, F.concat(F.lit("https://www.otodom.pl/pl/wyniki?page="), key, F.lit("&market="),
                                   F.when(F.col("o_orderstatus") == "F", "SECONDARY").otherwise("PRIMARY")))
           .when(n == 1, F.concat(F.lit("https://www.olx.pl/warszawa/?page="), key,
                                  F.when(F.col("o_orderstatus") == "F", "&search[private_business]=private")
                                  .otherwise("")))
           .otherwise(F.concat(F.lit("https://www.morizon.pl/?page="), key)))
    portal = F.when(n == 0, "otodom").when(n == 1, "olx").otherwise("morizon")
    pages = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus").select(
        F.col("o_orderkey").alias("page_id"), portal.alias("portal"), url.alias("search_url"))
    return PG.search_scope(pages).select("page_id", "portal")


@register("paginate_rest")
def q_paginate_rest(spark, sf):
    return paginate(stored_listings(spark, sf), [F.col("price_pln").desc_nulls_last(), F.col("external_id")],
                    50, None).select("external_id", "price_pln")


# =============================================================================
# Social posts over documents
# =============================================================================

from .plans import posts as PS  # noqa: E402

RENTAL_TEST_TERMS = ["rent", "lease"]
SALE_TEST_TERMS = ["ble"]


def raw_posts(spark, sf):
    """Post records as captured: JSON with per-record field names."""
    d = read_table(spark, sf, "documents", "doc_id", "text", "source")
    k = F.col("doc_id") % 3
    text_key = F.when(k == 0, F.lit("text")).when(k == 1, F.lit("message")).otherwise(F.lit("postText"))
    url_key = F.when(F.col("doc_id") % 2 == 0, F.lit("url")).otherwise(F.lit("postUrl"))
    id_key = F.when(F.col("doc_id") % 2 == 0, F.lit("id")).otherwise(F.lit("postId"))
    time_key = F.when(k == 0, F.lit("time")).when(k == 1, F.lit("timestamp")).otherwise(F.lit("date"))
    post_id = F.when(F.col("doc_id") % 5 != 0, F.col("doc_id").cast("string"))
    url = F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("https://www.facebook.com/groups/"), F.col("source"),
                                                     F.lit("/posts/"), F.col("doc_id").cast("string")))
    day = F.col("doc_id") % 28
    time = F.when(F.col("doc_id") % 6 == 0, (F.lit(1704103200) + day * 86400).cast("string")).otherwise(
        F.concat(F.lit("2024-01-"), F.lpad((day + 1).cast("string"), 2, "0"), F.lit("T10:00:00")))
    m = F.create_map(text_key, F.col("text"), url_key, url, id_key, post_id, time_key, time,
                     F.lit("group"), F.col("source"))
    return d.select(F.to_json(m).alias("json"))


def posts_table(spark, sf):
    return PS.normalize_posts(raw_posts(spark, sf))


@register("post_normalize")
def q_post_normalize(spark, sf):
    return posts_table(spark, sf)


@register("post_groups")
def q_post_groups(spark, sf):
    groups = PS.group_list(None, " src1,src2 ,, src3", ["src0"])
    return PS.in_groups(posts_table(spark, sf), groups).select("post_id", "group")


@register("post_cap_per_group")
def q_post_cap_per_group(spark, sf):
    order = [FD.post_moment("time").desc_nulls_last(), F.col("url").desc_nulls_last(), F.col("post_id").desc_nulls_last()]
    return PS.top_n_per_group(posts_table(spark, sf), "group", order, PS.posts_cap(1)) \
        .select("post_id", "group", "time")


@register("min_text_length")
def q_min_text_length(spark, sf):
    from .constants import POST_MIN_CHARS
    return read_table(spark, sf, "documents", "doc_id", "text") \
        .filter(P.min_text_length("text", POST_MIN_CHARS)).select("doc_id")


@register("keyword_prefilter")
def q_keyword_prefilter(spark, sf):
    return read_table(spark, sf, "documents", "doc_id", "text") \
        .filter(~P.rental_only("text", RENTAL_TEST_TERMS, SALE_TEST_TERMS)).select("doc_id")


@register("dedupe_posts")
def q_dedupe_posts(spark, sf):
    p = PS.with_external_id(posts_table(spark, sf))
    return keep_first(p, ["external_id"], order=["post_id", "url", "time", "text"]) \
        .select("external_id", "post_id")


def post_verdicts(spark, sf):
    return read_table(spark, sf, "labels", "doc_id", "quality").select(
        F.col("doc_id").cast("string").alias("post_id"), (F.col("quality") == 1).alias("verdict"))


@register("post_extract")
def q_post_extract(spark, sf):
    posts = posts_table(spark, sf).join(post_verdicts(spark, sf), "post_id", "left")
    return PS.post_listings(posts, AS_OF, verdict=F.col("verdict"), rental=RENTAL_TEST_TERMS,
                            sale=SALE_TEST_TERMS)


# =============================================================================
# Embedded JSON extraction (X1-X3) over pages rendered from L
# =============================================================================

from .operators import extract_json as XJ  # noqa: E402


def _ad_id():
    return F.concat(F.col("order_key").cast("string"), F.lit("x"), F.col("line_no").cast("string"))


def _wrap_json(payload):
    return F.concat(F.lit('<html><head><script id="__NEXT_DATA__" type="application/json">'),
                    F.to_json(payload), F.lit("</script></head><body></body></html>"))


def json_pages_a(spark, sf):
    """Search pages in layout A, rendered from all of L: one page per order, one ad per line item."""
    n = F.col("line_no")
    iso = F.substring(F.col("created_at").cast("string"), 1, 10)
    word = F.lower(F.element_at(F.array(*[F.lit(w) for w in ROOM_WORD_FORMS]), F.col("rooms")))
    ad = F.struct(
        _ad_id().alias("id"), F.col("title").alias("title"),
        F.concat(F.lit("/d/oferta/mieszkanie-"), F.col("part_key").cast("string"), F.lit("-ID"), _ad_id(),
                 F.lit(".html")).alias("url"),
        F.when(n % 2 == 1, F.concat(iso, F.lit("T00:00:00"))).alias("created_time"),
        F.when(n % 2 == 0, F.lit("Dzisiaj")).alias("last_refresh_time"),
        F.struct(F.concat(F.lit("Warszawa, "), F.lower(clean_district_col())).alias("city_name")).alias("location"),
        F.struct(F.struct(F.concat(F.col("price_pln").cast("string"), F.lit(" zł")).alias("value")).alias("price"),
                 F.struct(F.concat(F.col("sqm").cast("string"), F.lit(" m²")).alias("value")).alias("m"),
                 F.struct(word.alias("value")).alias("rooms")).alias("params"))
    # each ad is serialised before grouping (collect_list of deeply nested
    # structs with null strings trips the aggregate); the page joins the texts
    sorted_groups(spark)
    pages = L(spark, sf).groupBy("order_key").agg(F.collect_list(F.to_json(ad)).alias("ads"))
    blob = F.concat(F.lit('{"props":{"pageProps":{"data":{"ads":['), F.array_join("ads", ","),
                    F.lit("]}}}}"))
    html = F.concat(F.lit('<html><head><script id="__NEXT_DATA__" type="application/json">'), blob,
                    F.lit("</script></head><body></body></html>"))
    return pages.select(F.col("order_key").alias("page_id"), html.alias("html"))


def json_pages_b(spark, sf):
    n = F.col("line_no")
    word = F.element_at(F.array(*[F.lit(w) for w in ROOM_WORD_FORMS]), F.col("rooms"))
    rooms_txt = (F.when(n == 1, word).when(n == 2, F.col("rooms").cast("string"))
                 .otherwise(F.concat(F.col("rooms").cast("string"), F.lit(" pokoje"))))
    city = F.struct(F.lit("city").alias("locationLevel"), F.lit("Warszawa").alias("name"))
    dist = F.struct(F.lit("district").alias("locationLevel"), clean_district_col().alias("name"))
    locs = F.when(n % 2 == 0, F.array(city, dist)).otherwise(F.array(city))
    item = F.struct(
        _ad_id().alias("id"),
        F.when(n != 7, F.concat(F.lit("mieszkanie-"), F.col("part_key").cast("string"), F.lit("-"), _ad_id()))
        .alias("slug"),
        F.col("title").alias("title"),
        F.struct(F.col("price_pln").alias("value")).alias("totalPrice"),
        F.struct(FT.price_per_sqm("price_pln", "sqm").alias("value")).alias("pricePerSquareMeter"),
        F.col("sqm").alias("areaInSquareMeters"), rooms_txt.alias("roomsNumber"),
        F.struct(F.struct(locs.alias("locations")).alias("reverseGeocoding"),
                 F.struct(F.struct(F.when(n % 2 == 1, clean_district_col()).alias("name")).alias("district"))
                 .alias("address")).alias("location"))
    sorted_groups(spark)
    pages = L(spark, sf).groupBy("order_key").agg(F.collect_list(item).alias("items"))
    payload = F.struct(F.struct(F.struct(F.struct(F.struct(F.col("items").alias("items")).alias("searchAds"))
                                         .alias("data")).alias("pageProps")).alias("props"))
    return pages.select(F.col("order_key").alias("page_id"), _wrap_json(payload).alias("html"))


@register("json_ads_a")
def q_json_ads_a(spark, sf):
    return XJ.ads_layout_a(json_pages_a(spark, sf), AS_OF).drop("page_id")


@register("json_ads_b")
def q_json_ads_b(spark, sf):
    return XJ.ads_layout_b(json_pages_b(spark, sf)).drop("page_id")


@register("json_district")
def q_json_district(spark, sf):
    return XJ.ads_layout_b(json_pages_b(spark, sf)).select("external_id", "district")


# =============================================================================
# Streaming
# =============================================================================

from .streaming import jobs as ST  # noqa: E402


@register("stream_dedupe")
def q_stream_dedupe(spark, sf):
    return ST.stream_dedupe(spark, sf)


@register("stream_counts")
def q_stream_counts(spark, sf):
    return ST.stream_counts(spark, sf, "tumbling")


@register("stream_counts_sliding")
def q_stream_counts_sliding(spark, sf):
    return ST.stream_counts(spark, sf, "sliding")


@register("stream_sessions")
def q_stream_sessions(spark, sf):
    return ST.stream_counts(spark, sf, "session")


@register("stream_delta")
def q_stream_delta(spark, sf):
    return ST.stream_delta(spark, sf)


# =============================================================================
# Embeddings (V1-V3), batch top-k (W8, J8), report (R1, R2, S10-S12), union
# =============================================================================

from .operators import embed as EM  # noqa: E402
from .operators import report as RP  # noqa: E402
from .operators.vector import batch_topk, rounded  # noqa: E402


def _docs(spark, sf):
    return read_table(spark, sf, "documents", "doc_id", "text")


TEXT_MATCHES = 20  # a page of the text search


def fitted_embedder(spark, corpus):
    """Term weights of a corpus, stored in the shared folder."""
    import uuid
    from .session import scratch_dir
    return EM.fit_embedder(corpus, scratch_dir(spark, f"embedder-{uuid.uuid4().hex[:12]}"))


@register("embed_corpus")
def q_embed_corpus(spark, sf):
    docs = _docs(spark, sf)
    e = EM.embed_hashing(docs, fitted_embedder(spark, docs))
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    return e.select("doc_id", F.size("embedding").alias("dim"), F.round(length, 3).alias("length"))


@register("embed_blank_zero")
def q_embed_blank_zero(spark, sf):
    docs = _docs(spark, sf).withColumn("text", F.when(F.col("doc_id") % 10 != 0, F.col("text")).otherwise(F.lit("  ")))
    e = EM.embed_hashing(docs, fitted_embedder(spark, docs))
    return e.select("doc_id", F.size("embedding").alias("dim"),
                    F.forall("embedding", lambda x: x == 0).alias("is_zero"))


@register("embed_delta")
def q_embed_delta(spark, sf):
    """Even documents are stored; ``same`` compares each vector of the batch
    with the one that the whole table gets from the same model."""
    docs = _docs(spark, sf)
    even = docs.filter(F.col("doc_id") % 2 == 0)
    model = fitted_embedder(spark, even)
    everything = EM.embed_hashing(docs, model)
    stored = (everything.filter(F.col("doc_id") % 2 == 0)
              .join(docs.select("doc_id", EM.content_hash().alias("content_hash")), "doc_id"))
    out = EM.embed_delta(docs, stored, model=model)
    return (out.join(everything.withColumnRenamed("embedding", "whole"), "doc_id")
            .select("doc_id", "reused", F.size("embedding").alias("dim"),
                    (F.col("embedding") == F.col("whole")).alias("same")))


@register("embed_cached")
def q_embed_cached(spark, sf):
    """V1, V3 by content: a run over the even documents, then one over all. The second
    embeds what the first has not; ``same`` compares every looked-up vector with the
    one that its text gets directly (blank texts: the zero vector)."""
    import uuid
    from .plans import results
    from .session import scratch_dir
    docs = _docs(spark, sf)
    model = fitted_embedder(spark, docs)
    base = results.model_base(scratch_dir(spark, f"vectors-{uuid.uuid4().hex[:12]}"), "1")
    hook = EM.embedding_hook(model)
    results.with_results(spark, base, docs.filter(F.col("doc_id") % 2 == 0), "text", hook, "embedding")
    out = results.with_results(spark, base, docs, "text", hook, "embedding")
    direct = EM.embed_hashing(docs, model).withColumnRenamed("embedding", "direct")
    vector = F.coalesce("embedding", EM.zero_vector(model.idf.size))
    return (out.join(direct, "doc_id")
            .select("doc_id", (F.col("embedding_version") == 1).alias("first_run"), F.size(vector).alias("dim"),
                    (vector == F.col("direct")).alias("same")))


@register("search_text")
def q_search_text(spark, sf):
    """V4: a text query against all embedded documents: the nearest ones over the
    default threshold with their rank. The query is the first document's text."""
    from pyspark.sql import Window
    from .constants import DEFAULT_MATCH_THRESHOLD
    from .operators.vector import similarity, topk
    docs = _docs(spark, sf)
    model = fitted_embedder(spark, docs)
    query = EM.embed_text(spark, docs.orderBy("doc_id").first()["text"], model)
    scored = EM.embed_hashing(docs, model).select("doc_id", similarity("embedding", query).alias("similarity"))
    best = topk(scored, "similarity", TEXT_MATCHES, DEFAULT_MATCH_THRESHOLD, "doc_id")  # at most a page of rows
    rank = F.row_number().over(Window.orderBy(F.col("similarity").desc(), "doc_id")).cast("long")
    return best.select(rank.alias("rank"), "doc_id", rounded("similarity").alias("similarity"))


@register("vector_batch_topk")
def q_vector_batch_topk(spark, sf):
    vec = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    queries = vec.select(F.col("vec_id").alias("query_id"), "embedding")
    items = vec.select(F.col("vec_id").alias("item_id"), "embedding")
    return batch_topk(items, queries, k=10, threshold=0.10).select(
        "query_id", "item_id", rounded("similarity").alias("similarity"), F.col("rank").cast("long").alias("rank"))


@register("vector_lsh_topk")
def q_vector_lsh_topk(spark, sf):
    """Approximate top 10 of every vector, exactly re-ranked."""
    from .operators.vector import lsh_topk
    vec = read_table(spark, sf, "embeddings", "vec_id", "embedding")
    return lsh_topk(vec.withColumnRenamed("vec_id", "item_id"), vec.withColumnRenamed("vec_id", "query_id"),
                    k=10, threshold=0.10).select("query_id", "item_id", rounded("similarity").alias("similarity"),
                                                 F.col("rank").cast("long").alias("rank"))


def _report_page(spark, sf):
    from dataclasses import replace
    return run_search(spark, sf, replace(SEARCH_PARAMS, only_new=False, top_n=100, offset=0))


@register("report_rows")
def q_report_rows(spark, sf):
    return RP.report_rows(_report_page(spark, sf))


@register("report_markdown")
def q_report_markdown(spark, sf):
    return RP.markdown_lines(_report_page(spark, sf))


@register("report_document")
def q_report_document(spark, sf):
    """R2: the report with its header."""
    return RP.markdown_report(_report_page(spark, sf))


@register("report_append")
def q_report_append(spark, sf):
    # the part key stands in the url, so it breaks no tie between rows of one url
    d = keep_first(L(spark, sf).select("external_id", "portal", "url", "part_key", "created_at"), ["external_id"],
                   listing_order(), ["external_id", "url", "part_key"])
    existing = d.filter(stored_half()).select("url")
    incoming = d.select("external_id", "url")
    n_existing = existing.count()  # data rows; numbering goes on after them
    return RP.append_new(existing, incoming, ["external_id"], n_existing) \
        .select(F.col("row_no").cast("long").alias("row_no"), "external_id", "url")


@register("report_target_reset")
def q_report_target_reset(spark, sf):
    from .session import scratch_dir
    import uuid
    path = scratch_dir(spark, f"report-{uuid.uuid4().hex[:12]}")
    rows = RP.report_rows(_report_page(spark, sf))
    first = RP.write_report(spark, rows, path)
    second = RP.write_report(spark, rows, path)
    return spark.read.option("header", "true").csv(path).withColumn(
        "modes", F.lit(f"{first},{second}"))


@register("listing_json")
def q_listing_json(spark, sf):
    d = stored_listings(spark, sf).select("external_id", "title", "price_pln", "sqm", "rooms", "district", "url")
    return d.select("external_id", F.to_json(F.struct(*d.columns), {"ignoreNullFields": "false"}).alias("json"))


@register("portal_union")
def q_portal_union(spark, sf):
    listings = L(spark, sf).select("external_id", "title", "price_pln", "sqm", "rooms", "district", "url")
    posts = posts_table(spark, sf).join(post_verdicts(spark, sf), "post_id", "left")
    fb = PS.post_listings(posts, AS_OF, verdict=F.col("verdict"), rental=RENTAL_TEST_TERMS,
                          sale=SALE_TEST_TERMS).select("external_id", "title", "price_pln", "sqm", "rooms",
                                                       "district", "url", "date_posted")
    return listings.unionByName(fb, allowMissingColumns=True)


# =============================================================================
# Search-result cards (X5-X9), rendered from L, one page per order
# =============================================================================

from .plans import cards as CD  # noqa: E402


def _price_txt():
    return F.concat(F.replace(F.format_number("price_pln", 0), F.lit(","), F.lit(" ")), F.lit(" zł"))


def _sqm_txt():
    return F.replace(F.col("sqm").cast("string"), F.lit("."), F.lit(","))


def _ad_number():
    return F.concat(F.col("order_key").cast("string"), F.col("line_no").cast("string"))


def _opt(cond_col, html):
    return F.when(F.col(cond_col).isNotNull(), html).otherwise(F.lit(""))


def _card_pages(spark, sf, card):
    """One result page per order with a card per row of L; every third row's
    card is on the page twice, as promoted results are."""
    twice = F.when(F.col("line_no") % 3 == 0, F.concat(card, card)).otherwise(card)
    placed = F.struct("line_no", "part_key", "title", "price_pln", "sqm", "rooms", "district", "created_at",
                      "description", twice.alias("card"))
    cards = F.transform(F.sort_array(F.collect_list(placed)), lambda c: c["card"])
    sorted_groups(spark)
    pages = L(spark, sf).groupBy("order_key").agg(F.array_join(cards, "").alias("cards"))
    return pages.select(F.col("order_key").alias("page_id"),
                        F.concat(F.lit("<html><body>"), F.col("cards"), F.lit("</body></html>")).alias("html"))


def olx_card_html():
    loc = F.concat(F.lit("Warszawa, "), F.lower(clean_district_col()))
    area = F.concat_ws(" · ", F.when(F.col("sqm").isNotNull(), F.concat(_sqm_txt(), F.lit(" m²"))),
                       F.when(F.col("rooms").isNotNull(), F.concat(F.col("rooms").cast("string"), F.lit(" pok."))))
    return F.concat(
        F.lit('<div data-cy="l-card"><a href="/d/oferta/mieszkanie-'), F.col("part_key").cast("string"),
        F.lit("-ID"), _ad_id(), F.lit('.html?s=1">'),
        _opt("title", F.concat(F.lit("<h6>"), F.col("title"), F.lit("</h6>"))), F.lit("</a>"),
        _opt("price_pln", F.concat(F.lit('<p data-testid="ad-price">'), _price_txt(), F.lit("</p>"))),
        F.concat(F.lit("<span>"), area, F.lit("</span>")),
        F.concat(F.lit('<p data-testid="location-date">'), loc, F.lit("</p>")), F.lit("</div>"))


@register("cards_olx")
def q_cards_olx(spark, sf):
    return CD.olx_cards(_card_pages(spark, sf, olx_card_html()), as_of=AS_OF)


def morizon_card_html():
    return F.concat(
        F.lit('<div class="card__outer"><a class="property-card" href="/oferta/mieszkanie-'),
        F.col("part_key").cast("string"), F.lit("-mzn"), F.col("order_key").cast("string"),
        F.col("line_no").cast("string"), F.lit('">'),
        _opt("title", F.concat(F.lit('<h3 data-cy="propertyCardTitle">'), F.col("title"), F.lit("</h3>"))),
        F.lit('<p data-cy="propertyCardLocation">Mazowieckie, Warszawa, '), clean_district_col(), F.lit("</p>"),
        _opt("price_pln", F.concat(F.lit('<span data-cy="propertyCardPrice">'), _price_txt(), F.lit("</span>"))),
        _opt("sqm", F.concat(F.lit('<span data-cy="cardPropertyInfoArea">'), _sqm_txt(), F.lit(" m²</span>"))),
        _opt("rooms", F.concat(F.lit('<span data-cy="cardPropertyInfoRooms">'), F.col("rooms").cast("string"),
                               F.lit(" pokoje</span>"))), F.lit("</a></div>"))


@register("cards_morizon")
def q_cards_morizon(spark, sf):
    return CD.morizon_cards(_card_pages(spark, sf, morizon_card_html()), as_of=AS_OF)


def freedom_card_html():
    iso = F.substring(F.col("created_at").cast("string"), 1, 10)
    dotted = F.concat_ws(".", F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4))
    return F.concat(
        F.lit('<div class="offert"><a class="offert-box-ctn-link" href="/oferta/mieszkanie-'),
        F.col("part_key").cast("string"), F.lit("-"), _ad_number(), F.lit('/">link</a>'),
        F.lit("<address>ul. Polna 3, "), clean_district_col(), F.lit(", Warszawa</address>"),
        F.lit('<div class="price">'), _opt("price_pln", F.concat(F.lit("<strong>"), _price_txt(), F.lit("</strong>"))),
        F.lit("</div>"),
        F.lit('<div class="details">'), _opt("sqm", F.concat(F.lit("<strong>"), _sqm_txt(), F.lit(" m2</strong>"))),
        _opt("rooms", F.concat(F.lit("<strong>"), F.col("rooms").cast("string"), F.lit(" pok.</strong>"))),
        F.lit('</div><div class="bottom"><small>'), dotted, F.lit("</small></div></div>"))


@register("cards_freedom")
def q_cards_freedom(spark, sf):
    return CD.freedom_cards(_card_pages(spark, sf, freedom_card_html()), as_of=AS_OF)


def no_card_html():
    return F.concat(
        F.lit('<div class="tertiary"><a href="/mieszkanie-'), F.col("order_key").cast("string"),
        F.lpad(F.col("line_no").cast("string"), 3, "0"), F.lit('.html">'), F.coalesce("title", F.lit("")),
        F.lit('</a><p class="province"><a href="#">'), clean_district_col(), F.lit(",</a></p>"),
        _opt("price_pln", F.concat(F.lit('<p class="primary-display">'), _price_txt(), F.lit("</p>"))),
        _opt("sqm", F.concat(F.lit('<span class="area">'), _sqm_txt(), F.lit(" m²</span>"))),
        F.lit("<span>"), F.col("description"), F.lit("</span></div>"))


@register("cards_no")
def q_cards_no(spark, sf):
    return CD.nieruchomosci_cards(_card_pages(spark, sf, no_card_html()), as_of=AS_OF)


def adresowo_card_html():
    return F.concat(
        F.lit('<div data-offer-card><h2><a href="/o/mieszkanie-warszawa-'),
        F.lower(F.replace(clean_district_col(), F.lit(" "), F.lit("-"))), F.lit("-ul-polna-"),
        F.col("order_key").cast("string"), F.lit("x"), F.col("line_no").cast("string"), F.lit('"><span>Warszawa '),
        clean_district_col(), F.lit("</span><span>ul. Polna</span></a></h2>"),
        F.lit('<div class="items-center">'),
        _opt("price_pln", F.concat(F.lit('<p><span class="font-bold">'),
                                   F.replace(F.format_number("price_pln", 0), F.lit(","), F.lit(" ")),
                                   F.lit("</span> zł</p>"))),
        _opt("sqm", F.concat(F.lit('<p><span class="font-bold">'), _sqm_txt(), F.lit("</span> m²</p>"))),
        _opt("rooms", F.concat(F.lit('<p><span class="font-bold">'), F.col("rooms").cast("string"),
                               F.lit("</span> pok.</p>"))), F.lit("</div></div>"))


@register("cards_adresowo")
def q_cards_adresowo(spark, sf):
    return CD.adresowo_cards(_card_pages(spark, sf, adresowo_card_html()), as_of=AS_OF)


def _portal_pages(spark, sf):
    """Result pages of the five portals with cards, each with its portal."""
    cards = {"olx": olx_card_html(), "adresowo": adresowo_card_html(), "no": no_card_html(),
             "morizon": morizon_card_html(), "freedom": freedom_card_html()}
    pages = [_card_pages(spark, sf, card).withColumn("portal", F.lit(name)) for name, card in cards.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), pages)


@register("cards_portals")
def q_cards_portals(spark, sf):
    """X5-X9 in one pass: pages of all portals through one walker and one plan."""
    return CD.portal_cards(_portal_pages(spark, sf), AS_OF)


# =============================================================================
# Detail-page enrichment
# =============================================================================


@register("detail_enrich")
def q_detail_enrich(spark, sf):
    from .constants import DATE_LABELS_TEXTUAL
    from .operators.dedupe import keep_first_nonblank_key
    from .plans.normalize import detail_enrich
    src = keep_first(L(spark, sf).select(FU.canonical_url("url").alias("curl"), "external_id", "title",
                                         "description"), ["curl"], order=["external_id"])
    html = F.concat(F.lit("<html><head><title>"), F.coalesce("title", F.lit("")),
                    F.lit('</title></head><body><div data-cy="ad_description">'),
                    F.coalesce("description", F.lit("")), F.lit("</div></body></html>"))
    pages = src.select(F.lit(0).alias("page_id"), "curl", html.alias("html"))
    details = page_parts(pages, keep=["curl"]).select("curl", F.col("description").alias("detail_text"))
    # search results carry no description; odd lines carry a date already
    dated = F.when(F.col("line_no") % 2 == 1, F.substring(F.col("created_at").cast("string"), 1, 10))
    # the line number stands in the id: no description is needed to break ties before it
    first = keep_first_nonblank_key(
        L(spark, sf).select("external_id", "portal", "url", "title", "price_pln", "sqm", "rooms", "district", "line_no",
                            "created_at"), "external_id", listing_order())
    lst = first.select("external_id", "url", "price_pln", "sqm", "rooms", "district",
                       F.lit(None).cast("string").alias("description"), dated.alias("date_posted"))
    return detail_enrich(lst, details, AS_OF, DATE_LABELS_TEXTUAL["olx"]).select(
        "external_id", "sqm", "rooms", "price_pln", "district", "description", "date_posted", "price_per_sqm")


@register("extract_fallback")
def q_extract_fallback(spark, sf):
    """JSON layout A first; pages that gave no JSON rows go to the card
    extractor (anti-join on the page id), then both are unioned."""
    json_p = json_pages_a(spark, sf).filter(F.col("page_id") % 2 == 0)
    card_p = _card_pages(spark, sf, olx_card_html()).filter(F.col("page_id") % 2 == 1)
    pages = json_p.unionByName(card_p)
    from_json = XJ.ads_layout_a(pages, AS_OF)
    rest = pages.join(from_json.select("page_id").distinct(), "page_id", "left_anti")
    from_cards = CD.olx_cards(rest, as_of=AS_OF)
    return (from_json.select("external_id", "url", F.lit("json").alias("source"))
            .unionByName(from_cards.select("external_id", "url", F.lit("cards").alias("source"))))


# =============================================================================
# The load: captured pages and posts -> rows -> store
# =============================================================================


def _extracted(spark, sf, with_cards: bool):
    """Rows of the JSON pages and, in the second run, of both JSON layouts, the card
    pages of five portals and posts: all seven sources in one batch."""
    names = ["external_id", "title", "price_pln", "sqm", "rooms", "district", "url"]
    pages = json_pages_a(spark, sf)
    rows = XJ.ads_layout_a(pages.filter(F.col("page_id") % 2 == 0), AS_OF).select(*names)
    if with_cards:
        posts = posts_table(spark, sf).join(post_verdicts(spark, sf), "post_id", "left")
        others = [XJ.ads_layout_b(json_pages_b(spark, sf)),
                  CD.portal_cards(_portal_pages(spark, sf).filter(F.col("page_id") % 2 == 1), AS_OF),
                  PS.post_listings(posts, AS_OF, verdict=F.col("verdict"), rental=RENTAL_TEST_TERMS,
                                   sale=SALE_TEST_TERMS)]
        rows = functools.reduce(lambda a, b: a.unionByName(b.select(*names)), others, rows)
    return rows.withColumn("description", F.lit(None).cast("string"))


def _loaded_store(spark, sf) -> str:
    import uuid
    from .plans.store import ingest
    from .session import scratch_dir
    base = scratch_dir(spark, f"store-{uuid.uuid4().hex[:12]}")
    ingest(spark, base, _extracted(spark, sf, with_cards=False))
    ingest(spark, base, _extracted(spark, sf, with_cards=True))
    return base


@register("ingest")
def q_ingest(spark, sf):
    """Two runs of the load into a new store; the snapshot read back."""
    from .plans.store import current
    version, rows = current(spark, _loaded_store(spark, sf))
    return rows.select("external_id", "portal", "title", "since", F.lit(version).cast("long").alias("version"))


@register("store_portal")
def q_store_portal(spark, sf):
    """One portal of the store: a partition filter, other folders are not read."""
    from .plans.store import current
    rows = current(spark, _loaded_store(spark, sf))[1]
    return rows.filter(P.portal_included(["facebook"])).groupBy("since").agg(F.count(F.lit(1)).alias("n"))


LISTING_COLUMNS = ["external_id", "portal", "title", "price_pln", "sqm", "rooms", "district", "description", "url"]


def _listing_columns(df):
    return df.select(*LISTING_COLUMNS)


def _stored_base(spark, sf) -> str:
    """A store that holds the stored half of L, one row per id."""
    import uuid
    from .plans import store
    from .session import scratch_dir
    base = scratch_dir(spark, f"store-{uuid.uuid4().hex[:12]}")
    store.upsert(spark, base, store_table(spark, sf, LISTING_COLUMNS))
    return base


@register("store_delta")
def q_store_delta(spark, sf):
    """J1 against the store: filters, then the keys of the groups that may hold one."""
    from .plans import store
    base = _stored_base(spark, sf)
    batch = batch_table(spark, sf, ["external_id", "portal", "url"])
    stored = store.existing_keys(spark, base, store.read_manifest(spark, base), batch).keys
    return batch.join(stored, "external_id", "left_anti").select("external_id", "portal", "url")


@register("store_upsert")
def q_store_upsert(spark, sf):
    """J6 / S9 in the store: replaced rows die by the buckets' lists; read after a
    compaction of those buckets."""
    from .plans import store
    from .plans.normalize import store_record
    base = _stored_base(spark, sf)
    incoming = keep_first(L(spark, sf).filter(~stored_half()), ["external_id"], listing_order(), LISTING_COLUMNS)
    store.upsert(spark, base, _listing_columns(store_record(incoming)))
    store.compact(spark, base)
    return store.current(spark, base)[1].select("external_id", "title", "price_pln", "sqm", "rooms", "url", "since")


LANDING_ROWS = 1_000_000  # of a landing file


@register("stream_listings")
def q_stream_listings(spark, sf):
    """L arrives as several files in a landing folder and goes through the load
    into the store in three batches; all rows of an id are in one file. Files grow in
    number, not in size."""
    import uuid
    from .plans import store
    from .session import scratch_dir
    base = scratch_dir(spark, f"landing-{uuid.uuid4().hex[:12]}")
    rows = _listing_columns(L(spark, sf)).drop("portal")
    a_batch = 1 + read_table(spark, sf, "lineitem", "l_orderkey").count() // (3 * LANDING_ROWS)
    rows.repartition(3 * a_batch, "external_id").write.parquet(f"{base}/landing")
    ST.stream_listings(spark, f"{base}/landing", f"{base}/store", rows.schema.simpleString()[7:-1].replace(":", " "),
                       base=f"{base}/job", max_files=a_batch)
    return store.current(spark, f"{base}/store")[1].select("external_id", "portal")
