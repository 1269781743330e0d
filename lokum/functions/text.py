"""Text -> number Column expressions (room counts, numbers, area, price,
falsy semantics, imputation, embedding text, snippets, casing, money format).

All are built-in JVM expressions (codegen'd, no Python). Regexes are written so
that Java (Spark) and RE2 agree: ASCII ``\\d``, explicit whitespace classes,
case folding done by ``lower()`` before matching.
"""

from __future__ import annotations

import functools
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (GREEN_KEYWORDS, IMPUTED_ROOMS, IMPUTED_SQM, NO_SNIPPET,
                         ROOM_WORDS, ROOM_WORDS_STRICT, SNIPPET_CHARS)

# Whitespace as Python's str.strip()/\s sees it (the commonly occurring part).
PY_WS = r"[\t\n\x{0B}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# The same characters, for ``trim``, which looks at both ends only.
PY_WS_CHARS = ("\t\n\x0b\f\r \x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
               + "\u2028\u2029\u202f\u205f\u3000")
# Whitespace inside value patterns: ASCII whitespace plus no-break space.
WS = r"[\s\x{a0}]"
NBSP = " "


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Evaluate ``value`` once per row and pass it to ``body`` as a lambda
    variable. Expressions that repeat a costly input (a regex over the whole
    text, a sentence split) would otherwise evaluate it once per reference:
    lambda-bearing expressions are excluded from common-subexpression
    elimination."""
    return F.element_at(F.transform(F.array(col_(value)), body), 1)


def pystrip(c) -> Column:
    """Python ``str.strip()``: trim all whitespace kinds, not only spaces."""
    return F.btrim(col_(c), F.lit(PY_WS_CHARS))


def blank(c) -> Column:
    """None, empty or whitespace-only string."""
    return col_(c).isNull() | (pystrip(c) == "")


def truthy_num(c) -> Column:
    """Python truthiness of a number: not None and not 0."""
    c = col_(c)
    return c.isNotNull() & (c != 0)


def truthy_str(c) -> Column:
    c = col_(c)
    return c.isNotNull() & (c != "")


def falsy_or(a, b, kind: str = "num") -> Column:
    """``a or b`` (F19): b when a is None / 0 / ''."""
    t = truthy_num(a) if kind == "num" else truthy_str(a)
    return F.when(t, col_(a)).otherwise(col_(b))


def is_none_or(a, b) -> Column:
    """``a if a is not None else b`` (store stage)."""
    return F.coalesce(col_(a), col_(b))


def first_match(c, pattern: str, group: int = 1) -> Column:
    """regexp_extract with null (not '') when there is no match."""
    return F.nullif(F.regexp_extract(col_(c), pattern, group), F.lit(""))


def number_text(c, pattern: str) -> Column:
    """The text of a number to be cast: '' where there is no match, which casts to
    null like any other text that is no number."""
    return F.regexp_extract(col_(c), pattern, 1)


def _map_lit(d: dict) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


# --- F1 ---------------------------------------------------------------------

def parse_rooms(c, strict: bool = False) -> Column:
    """Room count from a value that may be int, float or text (F1).

    Numeric input passes (floats truncate). Text: word map on upper(strip(x)),
    else the first integer (lenient) or the whole text as an integer (strict).
    """
    c = col_(c)
    key = F.upper(pystrip(c.cast("string")))
    words = ROOM_WORDS_STRICT if strict else ROOM_WORDS
    mapped = F.try_element_at(_map_lit(words), key)
    if strict:
        rest = key.try_cast("int")
    else:
        rest = number_text(key, r"(\d+)").try_cast("int")
    return F.coalesce(mapped, rest)


def parse_rooms_numeric(c) -> Column:
    """Numeric branch of F1: ints pass, floats truncate toward zero."""
    return F.when(col_(c).isNull(), F.lit(None).cast("int")).otherwise(
        F.when(col_(c) >= 0, F.floor(c)).otherwise(F.ceil(c)).cast("int"))


# --- F2 ---------------------------------------------------------------------

def parse_number(c) -> Column:
    """First number after dropping nbsp/spaces and reading ',' as '.' (F2)."""
    cleaned = F.translate(col_(c).cast("string"), ", \xa0", ".")
    return number_text(cleaned, r"(\d+(?:\.\d+)?)").try_cast("double")


# --- F4 / F5 / F6 -------------------------------------------------------------

SQM_RE = r"(\d+(?:[.,]\d+)?)" + WS + r"*(?:m2|m²|metr)"
ROOMS_RE = r"(\d+)" + WS + r"*(?:-| )*pok"
# Price: digits grouped by space / nbsp / dot before "zł" or "pln". The digit
# run must not continue a word or number ("46 m2 750 000 zł" -> 750000, not the
# "2" of "m2"); RE2 has no look-behind, so a boundary char is consumed instead.
PRICE_RE = r"(?:^|[^\p{L}\d])(\d[\d\s\x{a0}.]*)" + WS + r"*(?:zł|pln)"


def has_any(low, words) -> Column:
    """Lower-case text that holds one of ``words``: cheaper than a search by pattern."""
    return functools.reduce(lambda a, b: a | b, [col_(low).contains(w) for w in words])


def text_sqm(c, sanity: tuple[float, float] | None = None) -> Column:
    """Area from text: number before m2 / m² / metr."""
    v = _sqm(F.lower(col_(c)))
    if sanity:
        lo, hi = sanity
        v = F.when((v > lo) & (v < hi), v)
    return v


def _sqm(low: Column) -> Column:
    return F.replace(number_text(low, SQM_RE), F.lit(","), F.lit(".")).try_cast("double")


def _rooms(low: Column) -> Column:
    return number_text(low, ROOMS_RE).try_cast("int")


def _price(low: Column) -> Column:
    return F.translate(number_text(low, PRICE_RE), " \xa0.\t\n\r\f", "").try_cast("double")


def text_rooms(c) -> Column:
    """Rooms from text: "kawalerka" -> 1, else integer before "pok" (F5)."""
    low = F.lower(col_(c))
    return F.when(low.contains("kawalerka"), F.lit(1)).otherwise(_rooms(low))


def text_price(c) -> Column:
    """Price from text: grouped digits before zł / PLN."""
    return _price(F.lower(col_(c)))


# The same over lower-case text that stands in a column: only a text that holds the unit
# is searched by pattern.

def low_sqm(low: str) -> Column:
    return F.when(has_any(low, ["m2", "m²", "metr"]), _sqm(F.col(low)))


def low_rooms(low: str) -> Column:
    return F.when(F.col(low).contains("kawalerka"), F.lit(1)).when(F.col(low).contains("pok"), _rooms(F.col(low)))


def low_price(low: str) -> Column:
    return F.when(has_any(low, ["zł", "pln"]), _price(F.col(low)))


# --- rounding ---------------------------------------------------------------

def round_to(c, digits: int) -> Column:
    """Round the binary value: round(x * 10^d) / 10^d, half away from zero.
    (``F.round`` on a double rounds its shortest decimal text instead, which
    turns 18329.475 -> 18329.48 though the stored value is 18329.47499...)"""
    m = float(10 ** digits)
    return F.round(col_(c) * F.lit(m), 0) / F.lit(m)


# --- F11 --------------------------------------------------------------------

def price_per_sqm(price, sqm, existing=None) -> Column:
    """round(price / sqm, 2) when missing and both truthy and sqm > 0."""
    calc = F.when(truthy_num(price) & truthy_num(sqm) & (col_(sqm) > 0),
                  round_to(F.try_divide(col_(price), col_(sqm)), 2))
    if existing is None:
        return calc
    return F.when(truthy_num(existing), col_(existing)).otherwise(calc)


# --- F21 / F22 --------------------------------------------------------------

def impute_sqm(c) -> Column:
    return F.coalesce(col_(c), F.lit(IMPUTED_SQM))


def impute_rooms(c) -> Column:
    return F.coalesce(col_(c), F.lit(IMPUTED_ROOMS))


def embed_text(title, district, description) -> Column:
    """Text to embed (F22): stripped description, else "title district"."""
    dist = F.when(truthy_str(district), col_(district)).otherwise(F.lit("Warszawa"))
    return F.when(blank(description), pystrip(F.concat_ws(" ", col_(title), dist))) \
        .otherwise(pystrip(description))


# --- F23 --------------------------------------------------------------------

def _kw_regex(words) -> str:
    return "|".join(words)


def sentences(c) -> Column:
    """desc.split('.') -> strip each -> drop empties."""
    parts = F.split(col_(c), r"\.")
    return F.filter(F.transform(parts, lambda s: pystrip(s)), lambda s: s != "")


def first_sentence(c) -> Column:
    """The first of ``sentences``, null if there is none; what follows it is not read."""
    return F.nullif(pystrip(F.regexp_extract(col_(c), rf"^(?:\.|{PY_WS})*+([^.]*)", 1)), F.lit(""))


def highlight_snippet(c, keywords=GREEN_KEYWORDS, width: int = SNIPPET_CHARS,
                      default: str = NO_SNIPPET) -> Column:
    """First sentence naming a keyword, else the first sentence; cut to
    ``width`` characters with "..." (F23)."""
    pat = _kw_regex(keywords)

    def pick(sents):
        hit = F.get(F.filter(sents, lambda s: F.lower(s).rlike(pat)), 0)
        return F.coalesce(hit, F.get(sents, 0))

    def cut(chosen):
        short = F.when(F.length(chosen) > width,
                       F.concat(F.substring(chosen, 1, width), F.lit("..."))).otherwise(chosen)
        return F.coalesce(short, F.lit(default))

    return F.when(truthy_str(c), let(let(sentences(c), pick), cut)).otherwise(F.lit(default))


# --- F24 --------------------------------------------------------------------

def title_case(c) -> Column:
    """Python ``str.title()`` for words split by spaces and hyphens.
    (``initcap`` alone keeps the letter after '-' lower case.)"""
    parts = F.split(F.lower(col_(c)), "-")
    return F.array_join(F.transform(parts, lambda p: F.initcap(p)), "-")


def capitalize(c) -> Column:
    """Python ``str.capitalize()``: first char upper, rest lower."""
    c = col_(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


# --- F25 --------------------------------------------------------------------

def format_money(c, na: str = "N/A") -> Column:
    """Thousands separated by spaces, no decimals; N/A when falsy."""
    return F.when(truthy_num(c), F.replace(F.format_number(col_(c), 0), F.lit(","), F.lit(" "))) \
        .otherwise(F.lit(na))


# --- F27 --------------------------------------------------------------------

def text_cap(c, n: int) -> Column:
    return F.substring(col_(c), 1, n)


# --- F29 --------------------------------------------------------------------

def unit_tagged(tags) -> Column:
    """Classify unit-tagged snippets (F29): price (zł, > 1000), area (m²/m2,
    > 10), rooms (pok); later valid snippets win, like an overwrite loop."""
    tags = col_(tags)
    is_price = lambda t: t.contains("zł")
    is_area = lambda t: ~t.contains("zł") & (t.contains("m²") | t.contains("m2"))
    is_rooms = lambda t: ~t.contains("zł") & ~t.contains("m²") & ~t.contains("m2") & t.contains("pok")

    prices = F.filter(F.transform(F.filter(tags, is_price), lambda t: F.translate(
        F.replace(pystrip(t), F.lit("zł"), F.lit("")), " \xa0.", "").try_cast("double")), lambda v: v > 1000)
    areas = F.filter(F.transform(F.filter(tags, is_area), lambda t: pystrip(F.replace(
        F.regexp_replace(pystrip(t), "m²|m2", ""), F.lit(","), F.lit("."))).try_cast("double")), lambda v: v > 10)
    rooms = F.filter(F.transform(F.filter(tags, is_rooms), lambda t: number_text(
        t, r"(\d+)").try_cast("int")), lambda v: v.isNotNull())
    last = lambda a: F.try_element_at(a, F.lit(-1))  # null for none; ``a`` is worked out once
    return F.struct(last(prices).alias("price_pln"), last(areas).alias("sqm"),
                    last(rooms).alias("rooms"))
