"""Unit fixtures: the reference's own test cases and the quirk table
(FIXTURES §1 and §4), on in-memory DataFrames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lokum.functions import dates as FD
from lokum.functions import district as FDi
from lokum.functions import text as FT

AS_OF = dt.datetime(2026, 8, 1, 12, 0, 0)


def one(spark, col_expr, value, schema="x string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col_expr.alias("r")).first()["r"]


@pytest.mark.parametrize("raw,expected", [
    ("THREE", 3), ("3 pokoje", 3), ("kawalerka", 1), ("1 POKÓJ", 1), ("2", 2), (None, None),
    ("4 POKOJE", 4), ("5 pokoi", 5), ("  six ", 6), ("pokoje: 7", 7),
])
def test_parse_rooms_table(spark, raw, expected):
    assert one(spark, FT.parse_rooms(F.col("x")), raw) == expected


def test_parse_rooms_numeric_and_strict(spark):
    assert one(spark, FT.parse_rooms_numeric(F.col("x")), 3.9, "x double") == 3
    assert one(spark, FT.parse_rooms(F.col("x"), strict=True), "3 pokoje") is None
    assert one(spark, FT.parse_rooms(F.col("x"), strict=True), "FOUR") == 4


@pytest.mark.parametrize("text,expected", [
    ("46 m2 750 000 zł", 750000.0),       # fixed: the "2" of m2 is not taken
    ("1.250.000 ZŁ", 1250000.0),
    ("750 000 PLN", 750000.0),
    ("Cena 21168 zł. Zadbane.", 21168.0),
    ("bez ceny", None),
])
def test_text_price(spark, text, expected):
    assert one(spark, FT.text_price(F.col("x")), text) == expected


def test_text_sqm_and_sanity(spark):
    assert one(spark, FT.text_sqm(F.col("x")), "300 metrów do parku") == 300.0
    assert one(spark, FT.text_sqm(F.col("x"), sanity=(10, 1000)), "3000 m2") is None
    assert one(spark, FT.text_sqm(F.col("x")), "Mieszkanie 46,5 m²") == 46.5


def test_text_rooms(spark):
    assert one(spark, FT.text_rooms(F.col("x")), "Kawalerka 3 pok") == 1
    assert one(spark, FT.text_rooms(F.col("x")), "3-pokojowe") == 3
    assert one(spark, FT.text_rooms(F.col("x")), "2 - pok.") == 2


def test_dates_quirks(spark):
    # month word with "ź" parses (fixed)
    assert str(one(spark, FD.parse_date_ingest(F.col("x"), AS_OF), "15 października 2026")) == "2026-10-15"
    assert one(spark, FD.parse_date_read(F.col("x"), AS_OF), "15 października 2026") == "2026-10-15"
    # impossible date: null (the source kept "2026-99-99")
    assert one(spark, FD.parse_date_ingest(F.col("x"), AS_OF), "99.99.2026") is None
    # year optional (F3a) / required (F3b) / read policy falls back to 10 chars
    assert str(one(spark, FD.parse_date_ingest(F.col("x"), AS_OF), "02 lipca")) == "2026-07-02"
    assert one(spark, FD.parse_date_ingest(F.col("x"), AS_OF, year_required=True), "02 lipca") is None
    assert one(spark, FD.parse_date_read(F.col("x"), AS_OF), "02 lipca") == "02 lipca"
    assert str(one(spark, FD.parse_date_ingest(F.col("x"), AS_OF), "wczoraj")) == "2026-07-31"
    assert one(spark, FD.parse_date_read(F.col("x"), AS_OF), None) == "N/A"


def test_recency_keeps_unparseable(spark):
    from lokum.operators.filters import recent
    df = spark.createDataFrame([("2026-99-99",), ("2026-07-30",), ("2026-01-01",), (None,)], "d string")
    kept = [r["d"] for r in df.filter(recent(F.col("d"), AS_OF, 3)).collect()]
    assert kept == ["2026-99-99", "2026-07-30", None]


def test_district_unpack(spark):
    assert one(spark, FD.unpack_district(F.col("x")), "Wola - 2026-05-01") == "Wola"
    assert one(spark, FD.packed_date(F.col("x")), "Wola - 2026-05-01") == "2026-05-01"
    assert one(spark, FD.unpack_district(F.col("x")), "Praga-Południe") == "Praga-Południe"


def test_title_and_capitalize(spark):
    assert one(spark, FT.title_case(F.col("x")), "praga-południe") == "Praga-Południe"
    assert one(spark, FT.capitalize(F.col("x")), "praga-południe") == "Praga-południe"


def test_district_rules(spark):
    assert one(spark, FDi.district_first(F.col("x")), "Warszawa, mokotów") == "Mokotów"
    assert one(spark, FDi.district_stopset(F.col("x")), "mazowieckie, Warszawa, wola") == "Wola"
    assert one(spark, FDi.district_last(F.col("x")), "Wola, Mirów, Warszawa") == "Mirów"
    assert one(spark, FDi.district_no_street(F.col("x")), "ul. Polna 3, ochota") == "Ochota"
    assert one(spark, FDi.district_strip_city(F.col("x")), "Warszawa Bemowo") == "Bemowo"


def test_rounding_follows_binary_value(spark):
    # round(x * 100) / 100 in double arithmetic: the same in Spark and DuckDB
    assert one(spark, FT.round_to(F.col("x"), 2), 2.675, "x double") == 2.68
    assert one(spark, FT.price_per_sqm(F.lit(733179.0), F.col("x")), 40.0, "x double") == 18329.47


def test_falsy_vs_is_none(spark):
    df = spark.createDataFrame([(0.0, 5.0)], "a double, b double")
    r = df.select(FT.falsy_or("a", "b").alias("o"), FT.is_none_or("a", "b").alias("n")).first()
    assert (r["o"], r["n"]) == (5.0, 0.0)


def test_snippet(spark):
    text = "Cicha okolica. Blisko parku i lasu Bielańskiego, 10 minut spacerem. Balkon."
    assert one(spark, FT.highlight_snippet(F.col("x")), text) == \
        "Blisko parku i lasu Bielańskiego, 10 minut spacerem"
    assert one(spark, FT.highlight_snippet(F.col("x")), None) == "No details snippet"
    long = "A" * 80 + ". B"
    assert one(spark, FT.highlight_snippet(F.col("x")), long) == "A" * 65 + "..."


def test_format_money(spark):
    assert one(spark, FT.format_money(F.col("x")), 1234567.0, "x double") == "1 234 567"
    assert one(spark, FT.format_money(F.col("x")), 0.0, "x double") == "N/A"


def test_paginate_past_end(spark):
    from lokum.operators.paging import paginate
    df = spark.range(10)
    assert paginate(df, [F.col("id")], 50, 20).count() == 0
    with pytest.raises(ValueError):
        paginate(df, [F.col("id")], -1, 20)
