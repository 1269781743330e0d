"""Social posts -> listing records.

Order matters: every cheap predicate (length, keep-first per post id,
rental pre-filter) runs before the extractor, which is the only costly step;
Catalyst does not move filters through ``mapInPandas``, so the plan is built
in that order explicitly.

The extractor is a pluggable batch hook ``Iterator[pd.DataFrame] ->
Iterator[pd.DataFrame]`` (columns ``post_id, text`` in, ``post_id, json``
out), e.g. a language-model client. The default extractor is a set of JVM
rules (area, rooms, price from text) emitting the same JSON contract.
"""

from __future__ import annotations

from typing import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (EXTRACT_MIN_CHARS, EXTRACT_TEXT_CAP, FB_DEFAULT_TITLE, FB_TITLE_PREFIX,
                         POST_MIN_CHARS, POSTS_PER_PAGE)
from ..functions import dates as FD
from ..functions import text as FT
from ..functions.urls import url_hash_id
from ..operators import filters as P
from ..operators.dedupe import keep_first
from .results import with_results

# Post records arrive with alternative field names (first non-empty wins).
POST_FIELDS = {
    "text": ["text", "message", "postText"],
    "url": ["url", "postUrl"],
    "post_id": ["id", "postId"],
    "time": ["time", "timestamp", "date"],
}
RAW_POST_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for names in POST_FIELDS.values() for n in names]
    + [T.StructField("group", T.StringType())])

EXTRACTION_SCHEMA = T.StructType([
    T.StructField("is_apartment_for_sale", T.BooleanType()),
    T.StructField("title", T.StringType()),
    T.StructField("price_pln", T.DoubleType()),
    T.StructField("sqm", T.DoubleType()),
    T.StructField("rooms", T.IntegerType()),
    T.StructField("district", T.StringType()),
])


def _first_nonempty(names: Sequence[str], src: str = "p") -> Column:
    return F.coalesce(*[F.nullif(F.col(f"{src}.{n}"), F.lit("")) for n in names])


def normalize_posts(raw_json: DataFrame, json_col: str = "json") -> DataFrame:
    """Parse post JSON with an explicit schema (PERMISSIVE: bad records
    give nulls, never a failed job) and resolve the alternative field names."""
    p = raw_json.select(F.from_json(json_col, RAW_POST_SCHEMA, {"mode": "PERMISSIVE"}).alias("p"))
    return p.select(
        _first_nonempty(POST_FIELDS["post_id"]).alias("post_id"),
        _first_nonempty(POST_FIELDS["text"]).alias("text"),
        _first_nonempty(POST_FIELDS["url"]).alias("url"),
        _first_nonempty(POST_FIELDS["time"]).alias("time"),
        F.col("p.group").alias("group"))


def group_list(override: Sequence[str] | None, configured: str | None, default: Sequence[str]) -> list[str]:
    """The groups to take: given ones, else a comma-separated setting
    (trimmed, blanks left out), else the default."""
    if override:
        return list(override)
    return [g.strip() for g in (configured or "").split(",") if g.strip()] or list(default)


def in_groups(posts: DataFrame, groups: Sequence[str]) -> DataFrame:
    return posts.filter(F.col("group").isin(*groups))


def with_external_id(posts: DataFrame) -> DataFrame:
    """Post id, else the hash of the url or of the whole text."""
    ident = F.coalesce(F.col("post_id"), url_hash_id(F.coalesce("url", "text")))
    return posts.withColumn("external_id", F.concat(F.lit("fb-"), ident))


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int,
                    salts: int = 32, salt_key: str | None = None) -> DataFrame:
    """First ``n`` rows per group without putting a hot group in one
    task: rank inside (group, salt) first, keep n per salt, then rank the at
    most ``salts * n`` survivors per group."""
    key = F.col(salt_key) if salt_key else F.xxhash64(*df.columns)
    salted = df.withColumn("__salt", F.pmod(key, F.lit(salts)))
    w1 = Window.partitionBy(group, "__salt").orderBy(*order)
    s1 = salted.withColumn("__r", F.row_number().over(w1)).filter(F.col("__r") <= n).drop("__r", "__salt")
    w2 = Window.partitionBy(group).orderBy(*order)
    return s1.withColumn("__r", F.row_number().over(w2)).filter(F.col("__r") <= n).drop("__r")


def posts_cap(max_pages: int) -> int:
    return max(1, max_pages) * POSTS_PER_PAGE


def rule_extractor(posts: DataFrame, verdict: Column) -> DataFrame:
    """Default extractor: JVM rules emitting the extraction JSON contract
    (``verdict`` supplies is_apartment_for_sale)."""
    t = F.col("text")
    title = FT.first_sentence(t)
    payload = F.struct(verdict.alias("is_apartment_for_sale"),
                       title.alias("title"),
                       FT.text_price(t).alias("price_pln"), FT.text_sqm(t).alias("sqm"),
                       FT.text_rooms(t).alias("rooms"), F.lit(None).cast("string").alias("district"))
    return posts.withColumn("json", F.to_json(payload, {"ignoreNullFields": "false"}))


def hook_extractor(posts: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                   results: str | None = None) -> DataFrame:
    """Pluggable extractor (e.g. a model client) as an Arrow batch hook. Its
    prompt takes the first ``EXTRACT_TEXT_CAP`` characters (F27); nothing else is cut.
    With a ``results`` folder (of one model version) a prompt that any run has
    extracted is looked up there and never sent again."""
    capped = posts.withColumn("__prompt", FT.text_cap("text", EXTRACT_TEXT_CAP))
    if results is not None:
        def hook(contents: DataFrame) -> DataFrame:
            return (contents.select(F.col("content_hash").alias("external_id"), F.col("content").alias("text"))
                    .mapInPandas(fn, "external_id string, json string")
                    .select(F.col("external_id").alias("content_hash"), F.col("json").alias("result")))
        return with_results(posts.sparkSession, results, capped, "__prompt", hook, "json").drop("__prompt", "json_version")
    out = capped.select("external_id", F.col("__prompt").alias("text")).mapInPandas(fn, "external_id string, json string")
    return posts.join(out, "external_id", "left")


def post_listings(posts: DataFrame, as_of, verdict: Column | None = None, extractor=None, results: str | None = None,
                  rental: Sequence[str] | None = None, sale: Sequence[str] | None = None) -> DataFrame:
    """S4 output -> P7 -> W3 -> P8 -> F27 -> extractor -> from_json -> P9
    -> listing record (F11, F15, F16, F17, F26)."""
    p = posts.filter(P.min_text_length("text", POST_MIN_CHARS))
    p = with_external_id(p)
    p = keep_first(p, ["external_id"], order=["post_id", "url", "time", "text"])
    kw = {}
    if rental is not None:
        kw["rental"] = rental
    if sale is not None:
        kw["sale"] = sale
    p = p.filter(~P.rental_only("text", **kw) & P.min_text_length("text", EXTRACT_MIN_CHARS))
    if extractor is None:
        p = rule_extractor(p, verdict if verdict is not None else F.lit(True))
    else:
        p = hook_extractor(p, extractor, results)
    x = F.from_json("json", EXTRACTION_SCHEMA, {"mode": "PERMISSIVE"})
    # as a generated row the extraction is worked out once: a filter on a projected
    # struct is pushed below the projection, and every text is read for both
    p = p.select("*", F.explode(F.array(x)).alias("x")).filter(F.coalesce(F.col("x.is_apartment_for_sale"), F.lit(False)))
    date = FD.post_date(text=F.col("time"), as_of=as_of)
    district = F.coalesce(F.nullif(F.col("x.district"), F.lit("")), F.lit("Warszawa"))
    title = F.coalesce(F.nullif(F.col("x.title"), F.lit("")), F.lit(FB_DEFAULT_TITLE))
    return p.select(
        "external_id",
        F.concat(F.lit(FB_TITLE_PREFIX), title).alias("title"),
        F.col("x.price_pln").alias("price_pln"),
        FT.price_per_sqm("x.price_pln", "x.sqm").alias("price_per_sqm"),
        F.col("x.sqm").alias("sqm"), F.col("x.rooms").alias("rooms"),
        FD.pack_district(district, date).alias("district"),
        date.alias("date_posted"),
        F.col("text").alias("description"),
        F.coalesce(F.col("url"), F.concat(F.lit("https://www.facebook.com/groups/"),
                                          F.expr("substring(external_id, 4)"))).alias("url"))
