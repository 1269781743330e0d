"""Posting-date parsing as Column expressions (F3a/b/c, F7, F17, F18, F26).

Three policies share pieces:
  ingest (F3a): ISO -> d.m.Y -> today -> yesterday -> "dd <month> [yyyy]"
                (year optional: taken from ``as_of``) -> null
  ingest, year required (F3b): same, but the text form needs a year
  read (F3c): "dd <month> yyyy" -> d.m.Y -> ISO -> today -> yesterday ->
              first 10 characters; empty -> "N/A" (returns text)

"Today" is an explicit ``as_of`` (UTC) instead of the wall clock, so results
are reproducible. Month words match ``\\p{L}+`` (covers "października").
"""

from __future__ import annotations

import datetime as _dt
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import MONTH_WORDS
from .text import WS, col_, first_match, has_any, pystrip

# --- FIXED VALUES: date patterns, searched anywhere in the text.
ISO_RE = r"\d{4}-\d{2}-\d{2}"
DOT_RE = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
TEXT_RE_YEAR = r"(\d{1,2})" + WS + r"+(\p{L}+)" + WS + r"+(\d{4})"
TEXT_RE_OPT = r"(\d{1,2})" + WS + r"+(\p{L}+)(?:" + WS + r"+(\d{4}))?"

# Each part below is one chain over its input: the text is searched once, and
# what follows rewrites the few characters that were found.


def _found(s: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(s, pattern, 0), F.lit(""))


def _padded(c: Column) -> Column:
    """One-digit months and days with a zero in front."""
    return F.regexp_replace(c, r"-(\d)(?!\d)", "-0$1")


def _month_numbers(c: Column) -> Column:
    """A month word between two hyphens as its number: one lookup of the few parts
    of what was found, not a search for each month. Null stays null."""
    numbers = F.create_map(*[F.lit(x) for w, n in MONTH_WORDS.items() for x in (w, str(n))])
    return F.array_join(F.transform(F.split(c, "-"), lambda x: F.coalesce(F.try_element_at(numbers, x), x)), "-")


def _as_of_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)


def iso_part(s: Column) -> Column:
    return F.when(s.contains("-"), _found(s, ISO_RE))


def dot_part(s: Column) -> Column:
    return F.when(s.contains("."), _padded(F.regexp_replace(_found(s, DOT_RE), DOT_RE, "$3-$2-$1")))


def text_part(s: Column, as_of, year_required: bool) -> Column:
    pattern = TEXT_RE_YEAR if year_required else TEXT_RE_OPT
    found = F.regexp_replace(F.lower(_found(s, pattern)), pattern, "$3-$2-$1")
    c = _padded(_found(_month_numbers(found), r"^\d*-\d{2}-\d{1,2}$"))
    if year_required:
        return c
    return F.when(c.startswith("-"), F.concat(F.year(_as_of_date(as_of)).cast("string"), c)).otherwise(c)


def _relative(s: Column, as_of) -> Column:
    low = F.lower(s)
    today = _as_of_date(as_of)
    return (F.when(low.contains("dzisiaj") | low.contains("today"), F.date_format(today, "yyyy-MM-dd"))
            .when(low.contains("wczoraj") | low.contains("yesterday"),
                  F.date_format(F.date_sub(today, 1), "yyyy-MM-dd")))


def _missing(c: Column) -> Column:
    return c.isNull() | (c == "") | (c == "N/A")


def parse_date_ingest_iso(c, as_of, year_required: bool = False) -> Column:
    """F3a / F3b as ISO text (unvalidated, like the source)."""
    raw = col_(c).cast("string")
    return F.when(~_missing(raw), F.coalesce(iso_part(raw), dot_part(raw), _relative(raw, as_of),
                                             text_part(raw, as_of, year_required)))


def parse_date_ingest(c, as_of, year_required: bool = False) -> Column:
    """F3a / F3b validated to a DATE (impossible dates -> null)."""
    return F.try_to_date(parse_date_ingest_iso(c, as_of, year_required), "yyyy-MM-dd")


def parse_date_read(c, as_of) -> Column:
    """Read-side policy, returns text ('N/A' when empty)."""
    raw = col_(c).cast("string")
    return F.when(_missing(raw), F.lit("N/A")).otherwise(
        F.coalesce(text_part(raw, as_of, True), dot_part(raw), iso_part(raw), _relative(raw, as_of),
                   F.substring(pystrip(raw), 1, 10)))


# --- F7: labelled dates inside free text -------------------------------------

def _label_alt(labels) -> str:
    return "(?:" + "|".join(l.lower() for l in labels) + ")"


def low_date(low: str, labels, as_of, textual: bool = True) -> Column:
    """F7 over lower-case text that stands in a column: only a text that holds a label is
    searched by pattern."""
    labelled = F.when(has_any(low, [label.lower() for label in labels]), F.col(low))
    return _labelled_date(labelled, labels, as_of, textual)


def text_date(c, labels, as_of, textual: bool = True) -> Column:
    """Date after a label such as "Dodano" (F7). ``textual`` portals accept
    "dd <month> [yyyy]", d.m.Y, "dzisiaj", "wczoraj"; the others d.m.Y only."""
    return _labelled_date(F.lower(col_(c)), labels, as_of, textual)


def _labelled_date(low: Column, labels, as_of, textual: bool) -> Column:
    if textual:
        val = r"(\d{1,2}" + WS + r"+\p{L}+(?:" + WS + r"+\d{4})?|\d{1,2}\.\d{1,2}\.\d{4}|dzisiaj|wczoraj)"
    else:
        val = r"(\d{1,2}\.\d{1,2}\.\d{4})"
    pat = _label_alt(labels) + WS + "*:?" + WS + "*" + val
    # the label fixes what was found: one chain of rewrites, no alternatives to try. A
    # text without a date is null from here on: an empty one would fail as a date, row by row
    x = F.regexp_replace(first_match(low, pat), DOT_RE, "$3-$2-$1")
    if textual:
        today = _as_of_date(as_of)
        x = _month_numbers(F.regexp_replace(x, TEXT_RE_OPT, "$3-$2-$1"))
        x = F.replace(x, F.lit("dzisiaj"), F.date_format(today, "yyyy-MM-dd"))
        x = F.replace(x, F.lit("wczoraj"), F.date_format(F.date_sub(today, 1), "yyyy-MM-dd"))
        x = F.regexp_replace(x, F.lit("^-"), F.concat(F.year(today).cast("string"), F.lit("-")))
    return F.try_to_date(_padded(x), "yyyy-MM-dd")


# --- F17 / F18: packed "district - date" -------------------------------------

PACKED_SUFFIX_RE = (WS + r"*-" + WS + r"*(\d{1,2}" + WS + r"+\p{L}+" + WS + r"+\d{4}|\d{1,2}\.\d{1,2}\.\d{4}"
                    r"|\d{4}-\d{2}-\d{2}|\d{1,2}" + WS + r"+\p{L}+)$")


def pack_district(district, date_iso) -> Column:
    """"<district> - <date>" when both present, else district or Warszawa."""
    d, t = col_(district), col_(date_iso)
    has_d = d.isNotNull() & (d != "")
    has_t = t.isNotNull() & (t.cast("string") != "")
    return F.when(has_d & has_t, F.concat(d, F.lit(" - "), t.cast("string"))) \
        .otherwise(F.when(has_d, d).otherwise(F.lit("Warszawa")))


def unpack_district(district) -> Column:
    """District with a trailing " - <date>" cut off."""
    raw = F.when(col_(district).isNull() | (col_(district) == ""), F.lit("N/A")).otherwise(col_(district))
    return F.when(F.regexp_extract(raw, PACKED_SUFFIX_RE, 0) != "",
                  pystrip(F.regexp_replace(raw, PACKED_SUFFIX_RE, ""))).otherwise(raw)


def packed_date(district) -> Column:
    """The date text packed after the district, or null."""
    return first_match(col_(district), PACKED_SUFFIX_RE)


def listing_date(date_posted, district, created_at, updated_at, as_of) -> Column:
    """Read-side posting date (F18 + F3c): date_posted -> packed suffix ->
    created_at -> updated_at -> "N/A"."""
    def s(c):
        if c is None:
            return F.lit(None).cast("string")
        c = col_(c).cast("string")
        return F.when((c != "") & (c != "N/A"), c)
    raw = F.coalesce(s(date_posted), pystrip(packed_date(district)), s(created_at), s(updated_at))
    return parse_date_read(raw, as_of)


def post_moment(text) -> Column:
    """Instant of a post time given as epoch seconds or ISO text."""
    t = col_(text)
    return F.coalesce(F.timestamp_seconds(t.try_cast("double")), t.try_cast("timestamp"))


# --- F26: social post date ---------------------------------------------------

def post_date(epoch_seconds=None, text=None, as_of=None) -> Column:
    """Epoch number (also as text) -> UTC date; other text -> first 10
    characters; else as_of."""
    parts = []
    if epoch_seconds is not None:
        parts.append(F.date_format(F.timestamp_seconds(col_(epoch_seconds)), "yyyy-MM-dd"))
    if text is not None:
        t = col_(text)
        parts.append(F.date_format(F.timestamp_seconds(t.try_cast("double")), "yyyy-MM-dd"))
        parts.append(F.when(t != "", F.substring(t, 1, 10)))
    parts.append(F.date_format(_as_of_date(as_of), "yyyy-MM-dd"))
    return F.coalesce(*parts)
