"""DuckDB oracle SQL: independent re-statements of each registered query.

The driver registers one view per table; every oracle is a plain SQL text
over those views. The listing view ``L`` is rebuilt here as a CTE, and SQL
fragments for the shared text rules are produced by small helpers (mostly
long CASE / alternation lists built from the fixed values).
"""

from __future__ import annotations

import re

from .constants import (AGENCY_PHRASES, GREEN_KEYWORDS, MONTH_GENITIVE, MONTH_WORDS,
                        PORTAL_HOSTS, PORTAL_KEYS, PORTAL_LABELS, PORTAL_PREFIXES, ROOM_WORDS,
                        ROOM_WORDS_STRICT)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_idx(expr: str, values: list[str], base: int = 0) -> str:
    whens = " ".join(f"WHEN {i + base} THEN {q(v)}" for i, v in enumerate(values))
    return f"(CASE {expr} {whens} END)"


def case_map(expr: str, mapping: dict, cast: str | None = None) -> str:
    def lit(v):
        return str(v) if isinstance(v, (int, float)) else q(v)
    whens = " ".join(f"WHEN {q(k)} THEN {lit(v)}" for k, v in mapping.items())
    out = f"(CASE {expr} {whens} ELSE NULL END)"
    return f"CAST({out} AS {cast})" if cast else out


PY_WS = r"[\t\n\x{0B}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS = r"[\t\n\x{0B}\f\r \x{a0}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"


def rx(x: str, pat: str, g: int = 1) -> str:
    return f"NULLIF(regexp_extract({x}, {q(pat)}, {g}), '')"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')")


def title(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), '-'), lambda p: {initcap('p')}), '-')"


def capitalize(x: str) -> str:
    return f"(upper(left({x}, 1)) || lower(substr({x}, 2)))"


def truthy(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> 0)"


def truthy_s(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


# --- listing view L ----------------------------------------------------------

def _l_select() -> str:
    p = "CAST(l.l_suppkey % 7 AS INTEGER)"
    n = "l.l_linenumber"
    iso = "substr(CAST(o.o_orderdate AS VARCHAR), 1, 10)"
    dd, mm, yy = f"substr({iso}, 9, 2)", f"substr({iso}, 6, 2)", f"substr({iso}, 1, 4)"
    room_n = "(CAST(floor(l.l_quantity) AS INTEGER) % 5 + 1)"
    month = case_idx(f"CAST({mm} AS INTEGER)", MONTH_GENITIVE, base=1)
    return f"""
SELECT
  {case_idx(p, PORTAL_PREFIXES)} || '-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST({n} AS VARCHAR) AS external_id,
  {case_idx(p, PORTAL_KEYS)} AS portal,
  'https://www.' || {case_idx(p, PORTAL_HOSTS)} || '/oferta/' || CAST(l.l_partkey AS VARCHAR)
     || CASE WHEN {n} % 2 = 0 THEN '?ref=' || CAST(l.l_orderkey AS VARCHAR) ELSE '' END AS url,
  CASE WHEN {n} = 3 THEN NULL ELSE pt.p_name END AS title,
  CASE WHEN {n} = 4 THEN NULL WHEN {n} = 6 THEN CAST(0 AS DOUBLE) ELSE round(l.l_extendedprice * 10, 0) END AS price_pln,
  CASE WHEN {n} = 5 THEN NULL ELSE CAST(pt.p_size AS DOUBLE) END AS sqm,
  CASE WHEN {n} = 6 THEN NULL ELSE {room_n} END AS rooms,
  CASE WHEN {n} % 2 = 0 THEN nn.n_name || ' - ' || {iso} ELSE nn.n_name END AS district,
  CASE {n}
    WHEN 1 THEN 'Blisko park i metro. Balkon od południa.'
    WHEN 2 THEN 'Stan deweloperski. Rynek pierwotny.'
    WHEN 3 THEN ''
    WHEN 4 THEN 'Cena ' || CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) || ' zł. Zadbane.'
    WHEN 5 THEN 'Mieszkanie ' || CAST(pt.p_size AS VARCHAR) || ',5 m² i ' || CAST({room_n} AS VARCHAR) || ' pok.'
    WHEN 6 THEN 'Kawalerka. Dodano ' || {dd} || '.' || {mm} || '.' || {yy}
    ELSE 'Dodano ' || {dd} || ' ' || {month} || ' ' || {yy}
  END AS description,
  CAST(l.l_shipdate AS TIMESTAMP) AS created_at,
  l.l_partkey % (SELECT count(*) FROM embeddings) AS vec_id,
  l.l_orderkey AS order_key,
  l.l_partkey AS part_key,
  {n} AS line_no
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part pt ON l.l_partkey = pt.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation nn ON s.s_nationkey = nn.n_nationkey
"""


L_CTE = "L AS (" + _l_select() + ")"

# keep-first order: portal rank, capture time, then every column (nulls first)
KEEP_FIRST_ORDER = (f"{case_map('portal', {k: i for i, k in enumerate(PORTAL_KEYS)})}, created_at NULLS FIRST, "
                    "portal NULLS FIRST, url NULLS FIRST, title NULLS FIRST, price_pln NULLS FIRST, "
                    "sqm NULLS FIRST, rooms NULLS FIRST, district NULLS FIRST, "
                    "description NULLS FIRST, created_at NULLS FIRST, vec_id NULLS FIRST, "
                    "order_key NULLS FIRST, part_key NULLS FIRST, line_no NULLS FIRST")

D_CTE = ("D AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_id "
         f"ORDER BY {KEEP_FIRST_ORDER}) AS rn FROM L) WHERE rn = 1)")


def with_l(body: str, *more_ctes: str, dedupe: bool = False) -> str:
    ctes = [L_CTE] + ([D_CTE] if dedupe else []) + list(more_ctes)
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- text rules --------------------------------------------------------------

ISO_RE = r"(\d{4})-(\d{2})-(\d{2})"
DOT_RE = r"(\d{1,2})\.(\d{1,2})\.(\d{4})"
TEXT_RE_YEAR = r"(\d{1,2})" + WS + r"+(\p{L}+)" + WS + r"+(\d{4})"
TEXT_RE_OPT = r"(\d{1,2})" + WS + r"+(\p{L}+)(?:" + WS + r"+(\d{4}))?"


def month_of(word_expr: str) -> str:
    return case_map(f"lower({word_expr})", MONTH_WORDS)


def _iso(s):
    return (f"CASE WHEN regexp_extract({s}, {q(ISO_RE)}, 0) <> '' THEN regexp_extract({s}, {q(ISO_RE)}, 1) || '-' || "
            f"regexp_extract({s}, {q(ISO_RE)}, 2) || '-' || regexp_extract({s}, {q(ISO_RE)}, 3) END")


def _dot(s):
    return (f"CASE WHEN regexp_extract({s}, {q(DOT_RE)}, 0) <> '' THEN regexp_extract({s}, {q(DOT_RE)}, 3) || '-' || "
            f"lpad(regexp_extract({s}, {q(DOT_RE)}, 2), 2, '0') || '-' || lpad(regexp_extract({s}, {q(DOT_RE)}, 1), 2, '0') END")


def _text(s, as_of_year: str, year_required: bool):
    pat = TEXT_RE_YEAR if year_required else TEXT_RE_OPT
    m = month_of(f"regexp_extract({s}, {q(pat)}, 2)")
    year = f"regexp_extract({s}, {q(pat)}, 3)"
    if not year_required:
        year = f"(CASE WHEN {year} = '' THEN {q(as_of_year)} ELSE {year} END)"
    return (f"CASE WHEN regexp_extract({s}, {q(pat)}, 1) <> '' AND {m} IS NOT NULL THEN "
            f"{year} || '-' || {m} || '-' || lpad(regexp_extract({s}, {q(pat)}, 1), 2, '0') END")


def _rel(s, as_of_date: str):
    import datetime as dt
    d = dt.date.fromisoformat(as_of_date)
    y = (d - dt.timedelta(days=1)).isoformat()
    return (f"CASE WHEN lower({s}) LIKE '%dzisiaj%' OR lower({s}) LIKE '%today%' THEN {q(d.isoformat())} END",
            f"CASE WHEN lower({s}) LIKE '%wczoraj%' OR lower({s}) LIKE '%yesterday%' THEN {q(y)} END")


def _missing(x):
    return f"({x} IS NULL OR {x} = '' OR {x} = 'N/A')"


def date_ingest_iso(x: str, as_of_date: str, year_required: bool = False) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    today, yday = _rel(s, as_of_date)
    body = f"coalesce({_iso(s)}, {_dot(s)}, {today}, {yday}, {_text(s, as_of_date[:4], year_required)})"
    return f"(CASE WHEN {_missing(f'CAST({x} AS VARCHAR)')} THEN NULL ELSE {body} END)"


def date_ingest(x: str, as_of_date: str, year_required: bool = False) -> str:
    return f"TRY_CAST({date_ingest_iso(x, as_of_date, year_required)} AS DATE)"


def date_read(x: str, as_of_date: str) -> str:
    raw = f"CAST({x} AS VARCHAR)"
    s = strip(raw)
    today, yday = _rel(s, as_of_date)
    body = f"coalesce({_text(s, as_of_date[:4], True)}, {_dot(s)}, {_iso(s)}, {today}, {yday}, substr({s}, 1, 10))"
    return f"(CASE WHEN {_missing(raw)} THEN 'N/A' ELSE {body} END)"


PACKED_SUFFIX_RE = (WS + r"*-" + WS + r"*(\d{1,2}" + WS + r"+\p{L}+" + WS + r"+\d{4}|\d{1,2}\.\d{1,2}\.\d{4}"
                    r"|\d{4}-\d{2}-\d{2}|\d{1,2}" + WS + r"+\p{L}+)$")


def unpack_district(x: str) -> str:
    raw = f"(CASE WHEN {x} IS NULL OR {x} = '' THEN 'N/A' ELSE {x} END)"
    cut = strip(f"regexp_replace({raw}, {q(PACKED_SUFFIX_RE)}, '')")
    return (f"(CASE WHEN regexp_extract({raw}, {q(PACKED_SUFFIX_RE)}, 0) <> '' THEN {cut} "
            f"ELSE {raw} END)")


def packed_date(x: str) -> str:
    return rx(x, PACKED_SUFFIX_RE)


def listing_date(district: str, created_at: str, updated_at: str, as_of_date: str,
                 date_posted: str | None = None) -> str:
    def s(c):
        return f"(CASE WHEN CAST({c} AS VARCHAR) <> '' AND CAST({c} AS VARCHAR) <> 'N/A' THEN CAST({c} AS VARCHAR) END)"
    parts = ([s(date_posted)] if date_posted else []) + [strip(packed_date(district)), s(created_at), s(updated_at)]
    return date_read(f"coalesce({', '.join(parts)})", as_of_date)


SQM_RE = r"(\d+(?:[.,]\d+)?)" + WS + r"*(?:m2|m²|metr)"
ROOMS_RE = r"(\d+)" + WS + r"*(?:-| )*pok"
PRICE_RE = r"(?:^|[^\p{L}\d])(\d[\d\t\n\x{0B}\f\r \x{a0}.]*)" + WS + r"*(?:zł|pln)"


def text_sqm(x):
    return f"TRY_CAST(replace({rx(f'lower({x})', SQM_RE)}, ',', '.') AS DOUBLE)"


def text_rooms(x):
    return (f"(CASE WHEN lower({x}) LIKE '%kawalerka%' THEN 1 ELSE "
            f"TRY_CAST({rx(f'lower({x})', ROOMS_RE)} AS INTEGER) END)")


def text_price(x):
    return (f"TRY_CAST(regexp_replace({rx(f'lower({x})', PRICE_RE)}, '[ \\x{{a0}}.\\t\\n\\r\\f]', '', 'g') "
            f"AS DOUBLE)")


def price_per_sqm(price, sqm):
    return (f"(CASE WHEN {truthy(price)} AND {truthy(sqm)} AND {sqm} > 0 THEN "
            f"round({price} / {sqm}, 2) END)")


def any_substring(text: str, terms) -> str:
    terms = [t.lower() for t in terms if t]
    if not terms:
        return "FALSE"
    return "(" + " OR ".join(f"contains({text}, {q(t)})" for t in terms) + ")"


def location_text(d="district", t="title", u="url"):
    return f"lower(coalesce({d}, '') || ' ' || coalesce({t}, '') || ' ' || coalesce({u}, ''))"


def agency_text(t="title", d="description"):
    return f"lower(coalesce({t}, '') || ' ' || coalesce({d}, ''))"


def portal_label(url: str, ext: str) -> str:
    return _portal_chain(url, ext, PORTAL_LABELS)


def portal_key(url: str, ext: str) -> str:
    return _portal_chain(url, ext, PORTAL_KEYS)


def _portal_chain(url, ext, values):
    u, e = f"lower(coalesce({url}, ''))", f"lower(coalesce({ext}, ''))"
    whens = " ".join(
        f"WHEN contains({u}, {q(h)}) OR starts_with({e}, {q(p + '-')}) THEN {q(v)}"
        for h, p, v in list(zip(PORTAL_HOSTS, PORTAL_PREFIXES, values))[1:])
    return f"(CASE {whens} ELSE {q(values[0])} END)"


def sentences(x):
    return (f"list_filter(list_transform(string_split({x}, '.'), lambda s: {strip('s')}), "
            f"lambda s: s <> '')")


def snippet(x, keywords=GREEN_KEYWORDS, width=65, default="No details snippet"):
    sents = sentences(x)
    pat = "|".join(keywords)
    hit = f"list_filter({sents}, lambda s: regexp_matches(lower(s), {q(pat)}))[1]"
    chosen = f"coalesce({hit}, ({sents})[1])"
    cut = (f"(CASE WHEN length({chosen}) > {width} THEN substr({chosen}, 1, {width}) || '...' "
           f"ELSE {chosen} END)")
    return f"(CASE WHEN {truthy_s(x)} AND {chosen} IS NOT NULL THEN {cut} ELSE {q(default)} END)"


def rooms_map(x, strict=False):
    return case_map(f"upper({strip(f'CAST({x} AS VARCHAR)')})", ROOM_WORDS_STRICT if strict else ROOM_WORDS,
                    cast="INTEGER")


def parse_rooms(x, strict=False):
    key = f"upper({strip(f'CAST({x} AS VARCHAR)')})"
    rest = f"TRY_CAST({key} AS INTEGER)" if strict else f"TRY_CAST({rx(key, r'(\d+)')} AS INTEGER)"
    return f"coalesce({rooms_map(x, strict)}, {rest})"


def fmt_money(x):
    return f"(CASE WHEN {truthy(x)} THEN replace(format('{{:,.0f}}', {x}), ',', ' ') ELSE 'N/A' END)"


def re_escape(s: str) -> str:
    return re.escape(s)
