"""Derived listing view ``L`` over the driver tables.

The driver data has no captured listings, so a listing record is derived from
``lineitem ⋈ orders ⋈ part ⋈ supplier ⋈ nation``: one listing per line item.
The line number ``n`` (1..7) selects which quirk a row exercises (missing
title / price / area / rooms, zero price, packed district, Polish text).

Columns: external_id, portal, url, title, price_pln, sqm, rooms, district,
description, created_at, plus keys used by other jobs: order_key, part_key,
line_no.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MONTH_GENITIVE, PORTAL_HOSTS, PORTAL_KEYS, PORTAL_PREFIXES
from .tables import read_table

LISTING_COLUMNS = ["external_id", "portal", "url", "title", "price_pln", "sqm", "rooms",
                   "district", "description", "created_at"]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                    "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size")
    supplier = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")

    # the planner broadcasts a side whose measured size allows it: supplier and nation are
    # joined one by one, as the size of a join of both is their product to it, and line
    # items would be shuffled by supplier. Orders come last: where this is a shuffled
    # join, its rows lie by order, as the pages that are made of an order's listings need them
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supplier, li.l_suppkey == supplier.s_suppkey)
           .join(nation, supplier.s_nationkey == nation.n_nationkey)
           .join(orders, li.l_orderkey == orders.o_orderkey))

    n = F.col("l_linenumber")
    p = (F.col("l_suppkey") % 7).cast("int")
    iso = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    dd, mm, yyyy = F.substring(iso, 9, 2), F.substring(iso, 6, 2), F.substring(iso, 1, 4)
    room_n = (F.floor("l_quantity").cast("int") % 5) + 1
    month_word = F.element_at(F.array(*[F.lit(m) for m in MONTH_GENITIVE]), mm.cast("int"))

    description = (
        F.when(n == 1, F.lit("Blisko park i metro. Balkon od południa."))
        .when(n == 2, F.lit("Stan deweloperski. Rynek pierwotny."))
        .when(n == 3, F.lit(""))
        .when(n == 4, F.concat(F.lit("Cena "), F.floor("l_extendedprice").cast("string"),
                               F.lit(" zł. Zadbane.")))
        .when(n == 5, F.concat(F.lit("Mieszkanie "), F.col("p_size").cast("string"),
                               F.lit(",5 m² i "), room_n.cast("string"), F.lit(" pok.")))
        .when(n == 6, F.concat(F.lit("Kawalerka. Dodano "), dd, F.lit("."), mm, F.lit("."), yyyy))
        .otherwise(F.concat(F.lit("Dodano "), dd, F.lit(" "), month_word, F.lit(" "), yyyy))
    )

    return j.select(
        F.concat(_pick(PORTAL_PREFIXES, p), F.lit("-"), F.col("l_orderkey").cast("string"),
                 F.lit("-"), n.cast("string")).alias("external_id"),
        _pick(PORTAL_KEYS, p).alias("portal"),
        F.concat(F.lit("https://www."), _pick(PORTAL_HOSTS, p), F.lit("/oferta/"),
                 F.col("l_partkey").cast("string"),
                 F.when(n % 2 == 0, F.concat(F.lit("?ref="), F.col("l_orderkey").cast("string")))
                 .otherwise(F.lit(""))).alias("url"),
        F.when(n == 3, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("title"),
        F.when(n == 4, F.lit(None).cast("double")).when(n == 6, F.lit(0.0))
        .otherwise(F.round(F.col("l_extendedprice") * 10, 0)).alias("price_pln"),
        F.when(n == 5, F.lit(None).cast("double")).otherwise(F.col("p_size").cast("double")).alias("sqm"),
        F.when(n == 6, F.lit(None).cast("int")).otherwise(room_n).alias("rooms"),
        F.when(n % 2 == 0, F.concat(F.col("n_name"), F.lit(" - "), iso))
        .otherwise(F.col("n_name")).alias("district"),
        description.alias("description"),
        F.col("l_shipdate").cast("timestamp").alias("created_at"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_partkey").alias("part_key"),
        n.alias("line_no"),
    )


def stored_half() -> Column:
    """Rows that count as "already stored" in delta / merge jobs: even part keys."""
    return F.col("part_key") % 2 == 0
