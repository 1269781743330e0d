"""Report rows, markdown lines and the append-without-duplicates sink
(R1, R2, S10, S11, W4, J4)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ..constants import REPORT_EMPTY, REPORT_HEADER
from ..functions import text as FT
from ..functions.dates import unpack_district
from ..functions.urls import portal_label
from .dedupe import keep_first
from .paging import rank_unbounded


def _cell(c):
    """Typed value -> sheet cell: the value as text, "N/A" when falsy."""
    return F.when(FT.truthy_num(c), F.col(c).cast("string")).otherwise(F.lit("N/A"))


def report_rows(page: DataFrame, row_no: str = "rank") -> DataFrame:
    """The 10 report columns for an already ranked page. ``page`` has
    rank, external_id, url, district, date_posted, price_pln, sqm, rooms,
    price_per_sqm, description."""
    pps = FT.price_per_sqm("price_pln", "sqm", F.col("price_per_sqm"))
    return page.select(
        F.col(row_no).cast("long").alias("row_no"),
        F.col("date_posted").alias("date_posted"),
        portal_label("url", "external_id").alias("portal"),
        unpack_district("district").alias("district"),
        _cell("price_pln").alias("price"), _cell("sqm").alias("area"),
        F.when(FT.truthy_num("rooms"), F.col("rooms").cast("string")).otherwise(F.lit("N/A")).alias("rooms"),
        F.when(FT.truthy_num(pps), pps.cast("string")).otherwise(F.lit("N/A")).alias("price_per_sqm"),
        FT.highlight_snippet("description").alias("details"),
        F.col("url").alias("link"))


def markdown_lines(page: DataFrame, row_no: str = "rank") -> DataFrame:
    """R2: one markdown table line per row; ``markdown_report`` adds the header."""
    pps = FT.price_per_sqm("price_pln", "sqm", F.col("price_per_sqm"))
    cells = [F.col(row_no).cast("string"), F.col("date_posted"), portal_label("url", "external_id"),
             unpack_district("district"), FT.format_money("price_pln"),
             F.when(FT.truthy_num("sqm"), F.col("sqm").cast("string")).otherwise(F.lit("N/A")),
             F.coalesce(F.col("rooms").cast("string"), F.lit("N/A")),
             FT.format_money(pps), FT.highlight_snippet("description"),
             F.concat(F.lit("[View Offer]("), F.col("url"), F.lit(")"))]
    # a null cell keeps its column
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c, F.lit("N/A")) for c in cells]), F.lit(" |"))
    return page.select(F.col(row_no).cast("long").alias("row_no"), line.alias("line"))



def markdown_report(page: DataFrame, row_no: str = "rank", header: Sequence[str] = REPORT_HEADER,
                    label: str = "Matching Apartments") -> DataFrame:
    """R2: the whole report as lines: header and rule (row_no -1 and 0), then the
    rows of the page; for a page without rows the "not found" text alone."""
    lines = markdown_lines(page, row_no)
    spark = page.sparkSession
    top = spark.createDataFrame([(-1, "| " + " | ".join(header) + " |"), (0, "|" + "---|" * len(header))],
                                "row_no long, line string")
    nothing = spark.createDataFrame([(0, REPORT_EMPTY.format(label=label))], "row_no long, line string")
    some = lines.limit(1).agg(F.count(F.lit(1)).alias("some"))  # one row
    framed = top.crossJoin(some).where("some > 0").unionByName(nothing.crossJoin(some).where("some = 0")).drop("some")
    return framed.unionByName(lines)


def url_key(url_col: str = "url"):
    return F.lower(F.trim(F.col(url_col)))


def append_new(existing: DataFrame, incoming: DataFrame, order, existing_rows: int) -> DataFrame:
    """Incoming rows whose url is not in the report yet
    (trim + lower case), first per url (blank urls never deduped), numbered
    on from the report's last row."""
    keyed = incoming.withColumn("__u", url_key())
    fresh = keyed.join(existing.select(url_key().alias("__u")).distinct(), "__u", "left_anti")
    is_blank = F.col("__u").isNull() | (F.col("__u") == "")
    kept = keep_first(fresh.filter(~is_blank), ["__u"], order=order).unionByName(fresh.filter(is_blank))
    return rank_unbounded(kept.drop("__u"), [F.col(o) if isinstance(o, str) else o for o in order],
                          start=existing_rows + 1, name="row_no")


def write_report(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """Reset the target when it does not exist or its header is not the
    report header, else append. CSV with a header line. Any other failure to
    read the target is raised: a report is never replaced because of it."""
    try:
        head = spark.read.option("header", "true").csv(path).columns
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        head = []
    mode = "append" if head == list(REPORT_HEADER) else "overwrite"
    renamed = rows.toDF(*REPORT_HEADER) if len(rows.columns) == len(REPORT_HEADER) else rows
    renamed.write.mode(mode).option("header", "true").csv(path)
    return mode
