"""Oracle SQL (DuckDB) for every registered query that SQL can express."""

from __future__ import annotations

from .constants import AGENCY_PHRASES, PORTAL_KEYS, PORTAL_PREFIXES, REPORT_HEADER
from .oracle import (agency_text, any_substring, listing_date, location_text, price_per_sqm,
                     unpack_district, with_l)
from .registry import AS_OF_DATE, QUERY_VEC_ID, SEARCH_PARAMS

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def _search_sql(pre: bool) -> str:
    p = SEARCH_PARAMS
    excl = (f"NOT {any_substring(location_text(), p.exclude_districts)} "
            f"AND NOT (portal LIKE '%freedom%') "
            f"AND NOT {any_substring(agency_text(), AGENCY_PHRASES)}")
    cutoff = f"(TIMESTAMP '{AS_OF_DATE} 00:00:00' - INTERVAL {p.new_within_days} DAY)"
    date_expr = listing_date("district", "created_at", "updated_at", AS_OF_DATE)
    return with_l(f"""
SELECT rank, external_id, portal, title, price_pln, price_per_sqm, sqm, rooms,
       {unpack_district('district')} AS district, date_posted, url, description, round(similarity, 4) AS similarity
FROM R WHERE rank > {p.offset} AND rank <= {p.offset + p.top_n}
""", f"""Q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = {QUERY_VEC_ID})""",
        f"""S AS (SELECT vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(Q.q AS DOUBLE[])) AS similarity
           FROM embeddings e, Q)""",
        f"""C AS (SELECT D.*, S.similarity FROM D JOIN S USING (vec_id)
           WHERE price_pln <= {p.max_price} AND sqm >= {p.min_sqm} AND rooms >= {p.min_rooms}
             AND S.similarity > {p.match_threshold} {'AND ' + excl if pre else ''}
           ORDER BY similarity DESC, external_id LIMIT {p.match_count})""",
        f"""E AS (SELECT C.* EXCLUDE (created_at), coalesce(CAST(o.o_orderdate AS TIMESTAMP), C.created_at) AS created_at,
                  CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST(o.o_orderkey % 30 AS INTEGER)) AS updated_at,
                  {price_per_sqm('C.price_pln', 'C.sqm')} AS price_per_sqm
           FROM C LEFT JOIN orders o ON o.o_orderkey = C.order_key)""",
        f"""F AS (SELECT *, {date_expr} AS date_posted FROM E {'' if pre else 'WHERE ' + excl})""",
        f"""G AS (SELECT * FROM F WHERE coalesce(TRY_CAST(TRY_CAST(date_posted AS DATE) AS TIMESTAMP) >= {cutoff}, TRUE))""",
        """R AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, external_id) AS rank FROM G)""",
        dedupe=True)


oracle("search", _search_sql(pre=False))
oracle("search_prefilter", _search_sql(pre=True))


# =============================================================================
# Scalar functions
# =============================================================================

from . import oracle as O  # noqa: E402
from .constants import (DATE_LABELS_DOTTED, DATE_LABELS_TEXTUAL, EXTRACT_TEXT_CAP,  # noqa: E402
                        FB_DEFAULT_TITLE, FB_TITLE_PREFIX, MONTH_GENITIVE, PORTAL_KEYS,
                        PORTAL_PREFIXES)
from .oracle import q  # noqa: E402

A = AS_OF_DATE


def rooms_raw():
    words = O.case_idx("rooms", ["ONE", "TWO", "THREE", "FOUR", "FIVE"], base=1)
    r = "CAST(rooms AS VARCHAR)"
    return (f"(CASE line_no WHEN 1 THEN {words} WHEN 2 THEN {r} || ' pokoje' WHEN 3 THEN 'kawalerka' "
            f"WHEN 4 THEN {r} || ' POKÓJ' WHEN 5 THEN {r} WHEN 6 THEN NULL ELSE {r} || ' pokoi' END)")


def month_word(ts):
    return O.case_idx(f"month({ts})", MONTH_GENITIVE, base=1)


def raw_date():
    c = "created_at"
    return (f"(CASE line_no WHEN 1 THEN 'Dzisiaj o 14:30' WHEN 2 THEN district WHEN 3 THEN 'wczoraj' "
            f"WHEN 4 THEN CAST(day({c}) AS VARCHAR) || ' ' || {month_word(c)} "
            f"WHEN 5 THEN CAST(day({c}) AS VARCHAR) || ' ' || {month_word(c)} || ' ' || CAST(year({c}) AS VARCHAR) "
            f"ELSE description END)")


CLEAN_D = "split_part(district, ' - ', 1)"


def location():
    d = f"lower({CLEAN_D})"
    return (f"(CASE line_no % 3 WHEN 0 THEN 'Warszawa, ' || {d} WHEN 1 THEN {d} || ', Warszawa, mazowieckie' "
            f"ELSE {d} END)")


def from_l(select: str, where: str = "") -> str:
    return with_l(f"SELECT {select} FROM L {where}")


def from_sub(inner_select: str, outer_select: str) -> str:
    return with_l(f"SELECT {outer_select} FROM (SELECT {inner_select} FROM L) t")


oracle("parse_rooms", from_sub(f"external_id, {rooms_raw()} AS rooms_raw",
                               f"external_id, rooms_raw, {O.parse_rooms('rooms_raw')} AS rooms, "
                               f"{O.parse_rooms('rooms_raw', strict=True)} AS rooms_strict"))


def parse_number(x):
    cleaned = f"replace(regexp_replace(CAST({x} AS VARCHAR), '[ \\x{{a0}}]', '', 'g'), ',', '.')"
    return f"TRY_CAST({O.rx(cleaned, r'(\d+(?:\.\d+)?)')} AS DOUBLE)"


oracle("parse_number", from_l(f"external_id, description, {parse_number('description')} AS number"))
oracle("parse_date_ingest", from_sub(
    f"external_id, {raw_date()} AS raw",
    f"external_id, raw, {O.date_ingest_iso('raw', A)} AS date_iso, "
    f"CAST({O.date_ingest('raw', A)} AS VARCHAR) AS date_posted"))
oracle("parse_date_year_required", from_sub(
    f"external_id, {raw_date()} AS raw",
    f"external_id, raw, CAST({O.date_ingest('raw', A, True)} AS VARCHAR) AS date_posted"))
oracle("parse_date_read", from_sub(f"external_id, {raw_date()} AS raw",
                                   f"external_id, raw, {O.date_read('raw', A)} AS date_posted"))

TEXT = "concat_ws(' ', title, description)"


def text_sqm_sane(x):
    v = O.text_sqm(x)
    return f"(CASE WHEN {v} > 10 AND {v} < 1000 THEN {v} END)"


oracle("text_sqm", from_l(f"external_id, {O.text_sqm(TEXT)} AS sqm, {text_sqm_sane(TEXT)} AS sqm_sane"))
oracle("text_rooms", from_l(f"external_id, {O.text_rooms(TEXT)} AS rooms"))
oracle("text_price", from_l(f"external_id, {O.text_price(TEXT)} AS price_pln"))


def text_date(x, labels, textual=True):
    alt = "(?:" + "|".join(l.lower() for l in labels) + ")"
    ws = O.WS
    if textual:
        val = r"(\d{1,2}" + ws + r"+\p{L}+(?:" + ws + r"+\d{4})?|\d{1,2}\.\d{1,2}\.\d{4}|dzisiaj|wczoraj)"
    else:
        val = r"(\d{1,2}\.\d{1,2}\.\d{4})"
    pat = alt + ws + "*:?" + ws + "*" + val
    return O.date_ingest(O.rx(f"lower({x})", pat), A, year_required=not textual)


oracle("text_date", from_l(
    "external_id, "
    f"CAST({text_date('description', DATE_LABELS_TEXTUAL['olx'])} AS VARCHAR) AS date_olx, "
    f"CAST({text_date('description', DATE_LABELS_TEXTUAL['no'])} AS VARCHAR) AS date_no, "
    f"CAST({text_date('description', DATE_LABELS_DOTTED['morizon'], False)} AS VARCHAR) AS date_morizon, "
    f"CAST({text_date('description', DATE_LABELS_DOTTED['freedom'], False)} AS VARCHAR) AS date_freedom"))

COMB = f"concat_ws(' ', {TEXT}, url)"
oracle("fallback_params", from_l(
    f"external_id, {O.text_sqm(COMB)} AS sqm, {O.text_rooms(COMB)} AS rooms, "
    f"{O.text_price(TEXT)} AS price_pln, "
    f"CAST({text_date(TEXT, DATE_LABELS_TEXTUAL['olx'])} AS VARCHAR) AS date_posted"))


def parts(x, drop_empty):
    p = f"list_transform(string_split({x}, ','), lambda p: {O.strip('p')})"
    return f"list_filter({p}, lambda p: p <> '')" if drop_empty else p


STOP = "('warszawa', 'mazowieckie')"


def empty_or(x, expr):
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE {expr} END)"


def d_first(x):
    ps = parts(x, False)
    pick = f"(CASE WHEN len({ps}) > 1 THEN list_filter({ps}, lambda p: lower(p) <> 'warszawa')[1] END)"
    return empty_or(x, O.title(f"coalesce({pick}, ({ps})[1])"))


def d_stop(x):
    ps = parts(x, False)
    return empty_or(x, O.title(f"coalesce(list_filter({ps}, lambda p: lower(p) NOT IN {STOP})[1], ({ps})[1])"))


def d_last(x):
    ps = parts(x, True)
    kept = f"list_filter({ps}, lambda p: lower(p) NOT IN {STOP})"
    return empty_or(x, f"coalesce({O.title(f'(CASE WHEN len({kept}) > 0 THEN ({kept})[-1] END)')}, ({ps})[1])")


def d_no_street(x):
    ps = parts(x, True)
    kept = f"list_filter({ps}, lambda p: lower(p) NOT IN {STOP} AND NOT starts_with(lower(p), 'ul.'))"
    return empty_or(x, f"coalesce({O.capitalize(f'({kept})[1]')}, ({ps})[1])")


def d_strip_city(x):
    ps = parts(x, False)
    cleaned = f"list_transform({ps}, lambda p: {O.strip(chr(114) + 'eplace(p, ' + q('Warszawa') + ', ' + q('') + ')')})"
    kept = f"list_filter({cleaned}, lambda p: p <> '' AND lower(p) NOT IN {STOP})"
    return empty_or(x, f"coalesce({O.capitalize(f'({kept})[1]')}, ({ps})[1])")


for _name, _fn, _loc in [
    ("district_first", d_first, location()),
    ("district_stopset", d_stop, location()),
    ("district_last", d_last, location()),
    ("district_no_street", d_no_street, f"(CASE WHEN line_no = 7 THEN 'ul. Polna 3, ' || {location()} ELSE {location()} END)"),
    ("district_strip_city", d_strip_city, f"(CASE WHEN line_no = 5 THEN 'Warszawa ' || {CLEAN_D} ELSE {location()} END)"),
]:
    oracle(_name, from_sub(f"external_id, {_loc} AS location",
                           f"external_id, location, {_fn('location')} AS district"))

SLUG_CHARS = r"[a-zA-Z\-żółćęśąźńZÓŁĆĘŚĄŹŃ]+"


def from_slug(url, text):
    u = O.rx(f"lower({url})", r"warszawa-(" + SLUG_CHARS + r")-ul")
    t = O.rx(f"lower({text})", r"warszawa" + O.WS + r"+(" + SLUG_CHARS + r")")
    raw = O.strip(f"replace(coalesce({u}, {t}), '-', ' ')")
    return f"(CASE WHEN {raw} IS NOT NULL AND lower({raw}) NOT IN ('mieszkanie', 'sprzedaz') THEN {O.title(raw)} END)"


SLUG_URL = (f"(CASE WHEN line_no % 2 = 1 THEN 'https://adresowo.pl/o/mieszkanie-warszawa-' || "
            f"lower(replace({CLEAN_D}, ' ', '-')) || '-ul-' || CAST(part_key AS VARCHAR) ELSE url END)")
oracle("district_from_slug", from_sub(
    f"external_id, {SLUG_URL} AS slug_url, 'Mieszkanie Warszawa ' || {CLEAN_D} || ' ul. Polna' AS text",
    f"external_id, {from_slug('slug_url', 'text')} AS district"))

oracle("price_per_sqm", from_l(f"external_id, {price_per_sqm('price_pln', 'sqm')} AS price_per_sqm"))
_pref = O.case_map("portal", dict(zip(PORTAL_KEYS, PORTAL_PREFIXES)))
oracle("external_id", from_l(
    f"{_pref} || '-' || CAST(order_key AS VARCHAR) || '-' || CAST(line_no AS VARCHAR) AS external_id, portal"))


def default_title(t="title", d="district"):
    name = f"(CASE WHEN {d} IS NOT NULL AND {d} <> '' THEN {d} ELSE 'Warszawa' END)"
    return f"(CASE WHEN {O.blank(t)} THEN 'Mieszkanie na sprzedaż (' || {name} || ')' ELSE {t} END)"


oracle("title_default", from_l(
    f"external_id, {default_title()} AS title, "
    f"'Mieszkanie Warszawa (' || coalesce(NULLIF({CLEAN_D}, ''), 'Warszawa') || ')' AS title_freedom, "
    f"{q(FB_TITLE_PREFIX)} || coalesce(NULLIF(title, ''), {q(FB_DEFAULT_TITLE)}) AS title_fb"))


def pack(d, t):
    return (f"(CASE WHEN {d} IS NOT NULL AND {d} <> '' AND {t} IS NOT NULL AND {t} <> '' THEN {d} || ' - ' || {t} "
            f"WHEN {d} IS NOT NULL AND {d} <> '' THEN {d} ELSE 'Warszawa' END)")


oracle("district_pack", from_l(
    f"external_id, {pack(CLEAN_D, 'CAST(' + text_date('description', ['Dodano']) + ' AS VARCHAR)')} AS district"))
oracle("district_unpack", from_l(
    f"external_id, {unpack_district('district')} AS district, "
    f"{O.date_read('coalesce(' + O.strip(O.packed_date('district')) + ', CAST(created_at AS VARCHAR))', A)} AS date_posted"))


def falsy_or(a, b):
    return f"(CASE WHEN {O.truthy(a)} THEN {a} ELSE {b} END)"


oracle("falsy_coalesce", from_l(
    f"external_id, {falsy_or('price_pln', O.text_price('description'))} AS price_or, "
    f"coalesce(price_pln, {O.text_price('description')}) AS price_is_none, "
    f"(CASE WHEN {O.truthy_s('title')} THEN title ELSE 'Mieszkanie' END) AS title_or"))
oracle("portal_classify", from_l(
    f"external_id, url, {O.portal_key('url', 'external_id')} AS portal_key, "
    f"{O.portal_label('url', 'external_id')} AS portal_label"))


def store_record_sql():
    t = default_title()
    comb = O.strip(f"{t} || ' ' || coalesce(description, '')")
    return f"""
SELECT external_id, title, coalesce(sqm1, 42.0) AS sqm, sqm1 IS NULL AS sqm_imputed,
       coalesce(rooms1, 2) AS rooms, rooms1 IS NULL AS rooms_imputed, price_pln,
       {price_per_sqm('price_pln', 'sqm1')} AS price_per_sqm
FROM (SELECT external_id, {t} AS title, coalesce(sqm, {O.text_sqm(comb)}) AS sqm1,
             coalesce(rooms, {O.text_rooms(comb)}) AS rooms1,
             coalesce(price_pln, {O.text_price(comb)}) AS price_pln FROM L) t"""


oracle("impute_defaults", with_l(store_record_sql()))


def embed_text(t, d, desc):
    dist = f"(CASE WHEN {O.truthy_s(d)} THEN {d} ELSE 'Warszawa' END)"
    return f"(CASE WHEN {O.blank(desc)} THEN {O.strip(f'concat_ws({q(chr(32))}, {t}, {dist})')} ELSE {O.strip(desc)} END)"


oracle("embed_text", from_l(f"external_id, {embed_text(default_title(), 'district', 'description')} AS embed_text"))
oracle("highlight_snippet", f"SELECT doc_id, {O.snippet('text')} AS snippet FROM documents")
_name = f"lower(replace({CLEAN_D}, ' ', '-'))"
oracle("title_case", from_l(f"external_id, {_name} AS name, {O.title(_name)} AS title_case, "
                            f"{O.capitalize(_name)} AS capitalized"))
oracle("format_money", from_l(f"external_id, {O.fmt_money('price_pln')} AS price, "
                              f"{O.fmt_money(price_per_sqm('price_pln', 'sqm'))} AS price_per_sqm"))
oracle("post_date", f"""
SELECT event_id, CASE event_id % 3
  WHEN 0 THEN CAST(CAST(ts AS DATE) AS VARCHAR)
  WHEN 1 THEN substr(CAST(ts AS VARCHAR), 1, 10)
  ELSE {q(A)} END AS date_posted
FROM events""")
oracle("text_cap", f"SELECT doc_id, substr(text, 1, {EXTRACT_TEXT_CAP}) AS text FROM documents")


def unit_tagged_sql():
    price = "replace(format('{:,.0f}', price_pln), ',', ' ') || ' zł'"
    area = "replace(CAST(sqm AS VARCHAR), '.', ',') || ' m²'"
    rooms = "CAST(rooms AS VARCHAR) || ' pok.'"
    tags = f"[{price}, {area}, {rooms}, '9 zł', '5 m2']"
    pr = (f"list_filter(list_transform(list_filter({tags}, lambda t: contains(t, 'zł')), "
          f"lambda t: TRY_CAST(regexp_replace({O.strip('t')}, '[ \\x{{a0}}.]|zł', '', 'g') AS DOUBLE)), lambda v: v > 1000)")
    ar = (f"list_filter(list_transform(list_filter({tags}, lambda t: NOT contains(t, 'zł') AND (contains(t, 'm²') OR contains(t, 'm2'))), "
          f"lambda t: TRY_CAST({O.strip(chr(114) + 'eplace(regexp_replace(' + O.strip('t') + ', ' + q('m²|m2') + ', ' + q('') + ', ' + q('g') + '), ' + q(',') + ', ' + q('.') + ')')} AS DOUBLE)), lambda v: v > 10)")
    ro = (f"list_filter(list_transform(list_filter({tags}, lambda t: NOT contains(t, 'zł') AND NOT contains(t, 'm²') AND NOT contains(t, 'm2') AND contains(t, 'pok')), "
          f"lambda t: TRY_CAST(NULLIF(regexp_extract(t, '(\\d+)', 1), '') AS INTEGER)), lambda v: v IS NOT NULL)")

    def last(a):
        return f"(CASE WHEN len({a}) > 0 THEN ({a})[-1] END)"
    return f"SELECT external_id, {last(pr)} AS price_pln, {last(ar)} AS sqm, {last(ro)} AS rooms FROM L"


oracle("unit_tagged_values", with_l(unit_tagged_sql()))


# =============================================================================
# Dedupe, delta, merge, joins, aggregates, predicates, paging, top-k
# =============================================================================

from .oracle import D_CTE, KEEP_FIRST_ORDER, L_CTE  # noqa: E402

EXCL = ["nation_3", "nation_1", "red"]
STORE_CTE = ("S AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_id "
             f"ORDER BY {KEEP_FIRST_ORDER}) AS rn FROM L WHERE part_key % 2 = 0) WHERE rn = 1)")
BATCH_CTE = ("B AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_id "
             f"ORDER BY {KEEP_FIRST_ORDER}) AS rn FROM L WHERE external_id IS NOT NULL AND external_id <> '') "
             "WHERE rn = 1)")


def with_ctes(body, *ctes):
    return "WITH " + ",\n".join((L_CTE,) + ctes) + "\n" + body


PUBLIC = ("external_id, portal, url, title, price_pln, sqm, rooms, district, description, "
          "CAST(created_at AS VARCHAR) AS created_at")
oracle("dedupe_external_id", with_ctes(f"SELECT {PUBLIC} FROM B", BATCH_CTE))
oracle("delta_anti", with_ctes("SELECT external_id, portal, url FROM B WHERE external_id NOT IN (SELECT external_id FROM S)",
                               STORE_CTE, BATCH_CTE))
oracle("existing_ids", with_ctes("SELECT DISTINCT external_id FROM L WHERE external_id IN (SELECT external_id FROM S)",
                                 STORE_CTE))
oracle("enrich_timestamps", with_ctes(
    "SELECT D.external_id, CAST(CAST(o.o_orderdate AS TIMESTAMP) AS VARCHAR) AS created_at, "
    "CAST(CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST(o.o_orderkey % 30 AS INTEGER)) AS VARCHAR) AS updated_at "
    "FROM D LEFT JOIN orders o ON o.o_orderkey = D.order_key", D_CTE))


def _store_record_cols():
    t = default_title()
    comb = O.strip(f"{t} || ' ' || coalesce(description, '')")
    return (f"external_id, {t} AS title, coalesce(price_pln, {O.text_price(comb)}) AS price_pln, "
            f"coalesce(coalesce(sqm, {O.text_sqm(comb)}), 42.0) AS sqm, "
            f"coalesce(coalesce(rooms, {O.text_rooms(comb)}), 2) AS rooms, url")


NEWB_CTE = ("N AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY external_id "
            f"ORDER BY {KEEP_FIRST_ORDER}) AS rn FROM L WHERE part_key % 2 <> 0) WHERE rn = 1)")
oracle("upsert_merge", with_ctes(
    "SELECT external_id, title, price_pln, sqm, rooms, url, 'old' AS version FROM S "
    "WHERE external_id NOT IN (SELECT external_id FROM N) "
    f"UNION ALL SELECT {_store_record_cols()}, 'new' AS version FROM N", STORE_CTE, NEWB_CTE))
oracle("delta_summary", with_ctes(
    "SELECT count(*) AS total_scraped, count(*) FILTER (WHERE e) AS skipped, count(*) FILTER (WHERE NOT e) AS new_count "
    "FROM (SELECT external_id IN (SELECT external_id FROM S) AS e FROM B) t", STORE_CTE, BATCH_CTE))


def reason_sql():
    return (f"CASE WHEN {any_substring(location_text(), EXCL)} THEN 'district' "
            f"WHEN {any_substring(agency_text(), AGENCY_PHRASES)} THEN 'agency' ELSE 'remaining' END")


oracle("exclusion_counts", with_ctes(f"SELECT {reason_sql()} AS reason, count(*) AS n FROM D GROUP BY 1", D_CTE))
oracle("portal_counts", from_l("portal, count(*) AS n", "GROUP BY portal"))
oracle("distinct_ids", from_l("portal, count(*) AS rows, count(DISTINCT external_id) AS distinct_ids",
                              "GROUP BY portal"))
_LD = listing_date("district", "created_at", "NULL", A)
_CUT = f"(TIMESTAMP '{A} 00:00:00' - INTERVAL 90 DAY)"
_RECENT = f"coalesce(TRY_CAST(TRY_CAST(date_posted AS DATE) AS TIMESTAMP) >= {_CUT}, TRUE)"
oracle("new_count", with_ctes(f"SELECT count(*) FILTER (WHERE {_RECENT}) AS new_count "
                              f"FROM (SELECT {_LD} AS date_posted FROM D) t", D_CTE))
oracle("numeric_caps", with_ctes("SELECT external_id, price_pln, sqm, rooms FROM D WHERE price_pln <= 750000 AND sqm >= 30",
                                 D_CTE))
oracle("exclude_districts", with_ctes(
    f"SELECT external_id, district FROM D WHERE NOT {any_substring(location_text(), EXCL)}", D_CTE))
oracle("exclude_portals", with_ctes(
    "SELECT external_id, portal FROM D WHERE NOT (contains(lower(portal), 'freedom') OR contains(lower(portal), 'no') "
    "OR portal = 'nieruchomosci-online')", D_CTE))
oracle("include_portals", with_ctes(
    "SELECT external_id, portal FROM D WHERE contains(lower(portal), 'olx') OR contains(lower(portal), 'otodom')", D_CTE))
oracle("exclude_agencies", with_ctes(
    f"SELECT external_id FROM D WHERE NOT {any_substring(agency_text(), AGENCY_PHRASES)}", D_CTE))
oracle("recency_filter", with_ctes(
    f"SELECT external_id, date_posted FROM (SELECT external_id, {_LD} AS date_posted FROM D) t WHERE {_RECENT}", D_CTE))
oracle("ingest_portal_filter", from_l("external_id, portal", "WHERE portal IN ('olx', 'nieruchomosci-online')"))
oracle("scan_projection", "SELECT o_orderkey AS id, CAST(o_orderdate AS VARCHAR) AS created_at FROM orders")
oracle("capped_scan", with_ctes(
    "SELECT external_id, price_pln, sqm, rooms FROM D WHERE price_pln <= 750000 AND sqm >= 30 AND rooms >= 2 "
    "ORDER BY external_id LIMIT 500", D_CTE))
oracle("paginate", with_ctes(
    "SELECT external_id, price_pln FROM D ORDER BY price_pln DESC NULLS LAST, external_id LIMIT 25 OFFSET 50", D_CTE))
oracle("rank_page", with_ctes(
    "SELECT row_number() OVER (ORDER BY created_at, external_id) AS rank, external_id FROM D", D_CTE))
oracle("vector_topk", f"""
WITH Q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = {QUERY_VEC_ID})
SELECT vec_id, round(s, 4) AS similarity FROM (
  SELECT vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(Q.q AS DOUBLE[])) AS s
  FROM embeddings e, Q) t
WHERE s > 0.1 ORDER BY s DESC, vec_id LIMIT 20""")


# =============================================================================
# Captured pages
# =============================================================================

SEP = "chr(1)"


def unescape(s):
    return (f"replace(replace(replace(replace(replace(replace(replace(replace({s}, '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')")


def strings_joined(html_expr, sep_sql):
    pieces = f"string_split(regexp_replace({html_expr}, '<[^>]*>', {SEP}, 'g'), {SEP})"
    return (f"array_to_string(list_filter(list_transform({pieces}, lambda s: {O.strip(unescape('s'))}), "
            f"lambda s: s <> ''), {sep_sql})")


ARTICLE = "regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1)"
oracle("page_description", f"SELECT page_id, {strings_joined(ARTICLE, 'chr(10)')} AS description FROM pages")

_BLOCKS = "div|article|section|h1|h2|h3|h4|h5|h6|ul|ol|table|header|footer|nav|address|form|pre|blockquote"


def _paras():
    pieces = f"(string_split({ARTICLE}, '<p>'))[2:]"
    cut = f"regexp_replace(x, '(?s)(</p>|<({_BLOCKS})[\\s>/]).*$', '')"
    texts = f"list_transform({pieces}, lambda x: {strings_joined(cut, chr(39) * 2)})"
    return f"list_filter({texts}, lambda t: length(t) > 20)"


oracle("page_paragraphs", f"""
SELECT page_id, CASE WHEN len({_paras()}) > 0 THEN array_to_string({_paras()}, chr(10) || chr(10))
                     ELSE {strings_joined(ARTICLE, 'chr(10)')} END AS description FROM pages""")
_NOSCRIPT = ("regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', ' ', 'g'), "
             "'(?s)<style[^>]*>.*?</style>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')")
oracle("page_title", f"""
SELECT page_id, {strings_joined("regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)", "''")} AS title,
       {strings_joined(_NOSCRIPT, "' '")} AS page_text FROM pages""")
_HREF = "NULLIF(regexp_extract(html, '<a[^>]*href=\"([^\"]*)\"', 1), '')"
_ORIG = "NULLIF(regexp_extract(url, '^(https?://[^/?#]+)', 1), '')"
oracle("url_absolute", f"""
SELECT page_id, CASE WHEN h IS NULL THEN NULL WHEN starts_with(h, 'http') THEN h
                     WHEN starts_with(h, '//') THEN 'https:' || h ELSE o || h END AS link
FROM (SELECT page_id, {_HREF} AS h, {_ORIG} AS o FROM pages) t""")
oracle("url_canonical", "SELECT page_id, split_part(url, '?', 1) AS url FROM pages")


def _offer_id(portal):
    from .functions.urls import OFFER_ID_PATTERNS
    cu = "split_part(url, '?', 1)"
    tries = ", ".join(O.rx(cu, p) for p in OFFER_ID_PATTERNS[portal])
    return f"coalesce({tries}, sha256({cu})) AS id_{portal}"


oracle("offer_id", "SELECT page_id, " + ", ".join(_offer_id(p) for p in
                                                  ["olx", "adresowo", "no", "morizon", "freedom"]) + " FROM pages")
_HOST = "lower(NULLIF(regexp_extract(url, '^(https?://[^/?#]+)', 1), ''))"
oracle("dedupe_page_url", f"""
SELECT page_id, url FROM (
  SELECT page_id, url, row_number() OVER (PARTITION BY {_HOST}, CAST(page_id % 10 + 1 AS INTEGER), split_part(url, '?', 1)
                                          ORDER BY page_id) AS rn FROM pages) t WHERE rn = 1""")
oracle("page_depth", f"""
WITH P AS (SELECT page_id, {_HOST} AS host, CAST(page_id % 10 + 1 AS INTEGER) AS page_no,
                  coalesce({strings_joined(ARTICLE, "''")} = '', TRUE) AS empty FROM pages),
Q AS (SELECT * FROM P WHERE page_no <= 3),
S AS (SELECT host, min(CASE WHEN empty THEN page_no END) AS stop FROM Q GROUP BY host)
SELECT page_id, Q.host, page_no FROM Q LEFT JOIN S ON Q.host IS NOT DISTINCT FROM S.host
WHERE stop IS NULL OR page_no < stop""")
oracle("quarantine_split", f"""
SELECT page_id, CASE WHEN {strings_joined(ARTICLE, "''")} <> '' THEN 'ok' ELSE 'quarantine' END AS status
FROM pages""")
oracle("distinct_profile", from_l("""
portal, count(DISTINCT line_no) AS n_runs, count(*) AS n_rows, count(DISTINCT external_id) AS exact_ids,
TRUE AS within_error""", "GROUP BY portal"))
_KEYS = ", ".join(f"'{k}'" for k in PORTAL_KEYS)
oracle("portal_isolation", f"""
WITH P AS (SELECT page_id, ([{_KEYS}])[CAST(page_id % {len(PORTAL_KEYS)} AS INTEGER) + 1] AS portal FROM pages),
R AS (
  SELECT page_id, portal,
         CASE WHEN portal = '{PORTAL_KEYS[2]}' AND page_id % 3 <> 0 OR page_id % 11 = 0 THEN 'no html'
              WHEN page_id % 13 = 0 THEN 'no content' END AS reason
  FROM P),
S AS (SELECT portal, count(reason) > 0.5 * count(*) AS down FROM R GROUP BY portal)
SELECT page_id, portal, coalesce(reason, CASE WHEN down THEN 'portal failing' END) AS reason FROM R JOIN S USING (portal)""")
oracle("search_scope", """
SELECT o_orderkey AS page_id, (['otodom', 'olx', 'morizon'])[CAST(o_orderkey % 3 AS INTEGER) + 1] AS portal FROM orders
WHERE o_orderkey % 3 = 2 OR o_orderstatus = 'F'""")
oracle("paginate_rest", with_ctes(
    "SELECT external_id, price_pln FROM D ORDER BY price_pln DESC NULLS LAST, external_id OFFSET 50", D_CTE))
oracle("source_scope", """
SELECT page_id, ref, page FROM (
  SELECT page_id, NULLIF(regexp_extract(split_part(split_part(url, '#', 1), '?', 2), '(?:^|&)ref=([^&]*)', 1), '') AS ref,
         NULLIF(regexp_extract(split_part(split_part(url, '#', 1), '?', 2), '(?:^|&)page=([^&]*)', 1), '') AS page
  FROM pages) t WHERE ref = 'x'""")


# =============================================================================
# Social posts
# =============================================================================

POSTS_CTE = """P AS (
  SELECT CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id AS VARCHAR) END AS post_id,
         NULLIF(text, '') AS text,
         CASE WHEN doc_id % 4 <> 0 THEN 'https://www.facebook.com/groups/' || source || '/posts/' || CAST(doc_id AS VARCHAR) END AS url,
         '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS day,
         CASE WHEN doc_id % 6 = 0 THEN CAST(epoch(CAST('2024-01-01 10:00:00' AS TIMESTAMP))::BIGINT + doc_id % 28 * 86400 AS VARCHAR)
              ELSE '2024-01-' || lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') || 'T10:00:00' END AS time,
         source AS "group"
  FROM documents)"""
oracle("post_normalize", f"WITH {POSTS_CTE} SELECT post_id, text, url, time, \"group\" FROM P")
oracle("post_cap_per_group", f"""WITH {POSTS_CTE}
SELECT post_id, "group", time FROM (
  SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY day DESC, url DESC NULLS LAST, post_id DESC NULLS LAST) AS r
  FROM P) t WHERE r <= 15""")
oracle("post_groups", f"""WITH {POSTS_CTE} SELECT post_id, "group" FROM P WHERE "group" IN ('src1', 'src2', 'src3')""")
oracle("min_text_length", f"SELECT doc_id FROM documents WHERE length({O.strip('text')}) >= 20")
oracle("keyword_prefilter", "SELECT doc_id FROM documents WHERE NOT ((contains(lower(text), 'rent') OR contains(lower(text), 'lease')) "
                            "AND NOT contains(lower(text), 'ble'))")
_EXT = "'fb-' || coalesce(post_id, sha256(coalesce(url, text)))"
_PK = ("row_number() OVER (PARTITION BY external_id ORDER BY post_id NULLS FIRST, url NULLS FIRST, "
       "time NULLS FIRST, text NULLS FIRST)")
oracle("dedupe_posts", f"""WITH {POSTS_CTE}
SELECT external_id, post_id FROM (SELECT *, {_PK} AS rn FROM (SELECT *, {_EXT} AS external_id FROM P) a) b WHERE rn = 1""")


def _post_extract_sql():
    t = "ct"
    first = f"({O.sentences(t)})[1]"
    title = f"coalesce(NULLIF({first}, ''), {q(FB_DEFAULT_TITLE)})"
    date = "day"
    return f"""WITH {POSTS_CTE},
V AS (SELECT CAST(doc_id AS VARCHAR) AS post_id, quality = 1 AS verdict FROM labels),
K AS (SELECT * FROM (SELECT *, {_PK} AS rn FROM (SELECT *, {_EXT} AS external_id FROM P
      WHERE coalesce(length({O.strip('text')}) >= 20, FALSE)) a) b WHERE rn = 1),
R AS (SELECT K.*, text AS ct, V.verdict FROM K LEFT JOIN V USING (post_id)
      WHERE NOT ((contains(lower(text), 'rent') OR contains(lower(text), 'lease')) AND NOT contains(lower(text), 'ble'))
        AND coalesce(length({O.strip('text')}) >= 15, FALSE)),
X AS (SELECT *, {O.text_price(t)} AS xp, {O.text_sqm(t)} AS xs, {O.text_rooms(t)} AS xr FROM R WHERE coalesce(verdict, FALSE))
SELECT external_id, {q(FB_TITLE_PREFIX)} || {title} AS title, xp AS price_pln, {price_per_sqm('xp', 'xs')} AS price_per_sqm,
       xs AS sqm, xr AS rooms, 'Warszawa - ' || {date} AS district, {date} AS date_posted, text AS description,
       coalesce(url, 'https://www.facebook.com/groups/' || substr(external_id, 4)) AS url
FROM X"""


oracle("post_extract", _post_extract_sql())


# =============================================================================
# Embedded JSON extraction
# =============================================================================

_AD = "CAST(order_key AS VARCHAR) || 'x' || CAST(line_no AS VARCHAR)"
_D0 = O.title(f"lower({CLEAN_D})")
_DATE_A = f"CASE WHEN line_no % 2 = 1 THEN substr(CAST(created_at AS VARCHAR), 1, 10) ELSE '{A}' END"
_PA = "NULLIF(price_pln, 0)"
oracle("json_ads_a", from_l(f"""
'olx-' || {_AD} AS external_id,
CASE WHEN {O.blank('title')} THEN 'Mieszkanie na sprzedaż (' || {_D0} || ')' ELSE title END AS title,
{_PA} AS price_pln, {price_per_sqm(_PA, 'sqm')} AS price_per_sqm, sqm, rooms,
{_D0} || ' - ' || ({_DATE_A}) AS district, {_DATE_A} AS date_posted,
'https://www.olx.pl/d/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-ID' || {_AD} || '.html' AS url""",
                            ""))
_ROOMS_B = "CASE WHEN line_no IN (1, 2) THEN rooms END"
_B_SELECT = f"""'otodom-' || {_AD} AS external_id, title, price_pln, {price_per_sqm('price_pln', 'sqm')} AS price_per_sqm,
sqm, {_ROOMS_B} AS rooms, {CLEAN_D} AS district,
'https://www.otodom.pl/pl/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-' || {_AD} AS url"""
oracle("json_ads_b", from_l(_B_SELECT, "WHERE line_no <> 7"))
oracle("json_district", from_l(f"'otodom-' || {_AD} AS external_id, {CLEAN_D} AS district",
                               "WHERE line_no <> 7"))


# =============================================================================
# Streaming
# =============================================================================

oracle("stream_dedupe", "SELECT DISTINCT user_id FROM events")
oracle("stream_counts", """
SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS window_start,
       CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS VARCHAR) AS window_end, event_type, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
oracle("stream_counts_sliding", """
WITH W AS (
  SELECT time_bucket(INTERVAL 12 HOUR, ts) AS s, event_type FROM events
  UNION ALL SELECT time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR AS s, event_type FROM events)
SELECT CAST(s AS VARCHAR) AS window_start, CAST(s + INTERVAL 1 DAY AS VARCHAR) AS window_end, event_type, count(*) AS n
FROM W GROUP BY 1, 2, 3""")
oracle("stream_sessions", """
WITH E AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens
           FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts)),
S AS (SELECT *, sum(opens) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM E)
SELECT CAST(min(ts) AS VARCHAR) AS window_start, CAST(max(ts) + INTERVAL 1 HOUR AS VARCHAR) AS window_end,
       event_type, count(*) AS n FROM S GROUP BY event_type, session""")
oracle("stream_delta", """
SELECT 'ev-' || CAST(user_id AS VARCHAR) || '-' || event_type AS external_id,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_seen
FROM events GROUP BY 1""")


# =============================================================================
# Embeddings, batch top-k, report, union
# =============================================================================

oracle("embed_blank_zero", f"SELECT doc_id, 1536 AS dim, doc_id % 10 = 0 AS is_zero FROM documents")
oracle("embed_corpus", f"SELECT doc_id, 1536 AS dim, CASE WHEN {O.blank('text')} THEN 0.0 ELSE 1.0 END AS length FROM documents")
oracle("embed_delta", """
SELECT doc_id, sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0) AS reused, 1536 AS dim,
       TRUE AS same
FROM documents""")
oracle("embed_cached", """
SELECT doc_id, CASE WHEN trim(text) <> '' THEN sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id % 2 = 0) END
       AS first_run, 1536 AS dim, TRUE AS same
FROM documents""")
oracle("vector_batch_topk", """
WITH Q AS (SELECT vec_id AS query_id, embedding AS q FROM embeddings),
S AS (SELECT query_id, e.vec_id AS item_id,
             list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(Q.q AS DOUBLE[])) AS similarity
      FROM Q, embeddings e),
R AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS rank
      FROM S WHERE similarity > 0.1)
SELECT query_id, item_id, round(similarity, 4) AS similarity, rank FROM R WHERE rank <= 10""")


def _report_base():
    from dataclasses import replace
    import lokum.oracles as me  # noqa: F401
    return _search_sql_params(replace(SEARCH_PARAMS, only_new=False, top_n=100, offset=0), pre=False)


def _search_sql_params(p, pre):
    excl = (f"NOT {any_substring(location_text(), p.exclude_districts)} "
            f"AND NOT (portal LIKE '%freedom%') "
            f"AND NOT {any_substring(agency_text(), AGENCY_PHRASES)}")
    date_expr = listing_date("district", "created_at", "updated_at", AS_OF_DATE)
    recency = ""
    if p.only_new:
        cutoff = f"(TIMESTAMP '{AS_OF_DATE} 00:00:00' - INTERVAL {p.new_within_days} DAY)"
        recency = f"WHERE coalesce(TRY_CAST(TRY_CAST(date_posted AS DATE) AS TIMESTAMP) >= {cutoff}, TRUE)"
    return with_l(f"""
SELECT rank, external_id, portal, title, price_pln, price_per_sqm, sqm, rooms, district AS district,
       date_posted, url, description, round(similarity, 4) AS similarity
FROM R WHERE rank > {p.offset} AND rank <= {p.offset + p.top_n}
""", f"""Q AS (SELECT embedding AS q FROM embeddings WHERE vec_id = {QUERY_VEC_ID})""",
        f"""S AS (SELECT vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(Q.q AS DOUBLE[])) AS similarity
           FROM embeddings e, Q)""",
        f"""C AS (SELECT D.*, S.similarity FROM D JOIN S USING (vec_id)
           WHERE price_pln <= {p.max_price} AND sqm >= {p.min_sqm} AND rooms >= {p.min_rooms}
             AND S.similarity > {p.match_threshold} {'AND ' + excl if pre else ''}
           ORDER BY similarity DESC, external_id LIMIT {p.match_count})""",
        f"""E AS (SELECT C.* EXCLUDE (created_at), coalesce(CAST(o.o_orderdate AS TIMESTAMP), C.created_at) AS created_at,
                  CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST(o.o_orderkey % 30 AS INTEGER)) AS updated_at,
                  {price_per_sqm('C.price_pln', 'C.sqm')} AS price_per_sqm
           FROM C LEFT JOIN orders o ON o.o_orderkey = C.order_key)""",
        f"""F AS (SELECT *, {date_expr} AS date_posted FROM E {'' if pre else 'WHERE ' + excl})""",
        f"""G AS (SELECT * FROM F {recency})""",
        """R AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, external_id) AS rank FROM G)""",
        dedupe=True)


def _cell(c):
    return f"CASE WHEN {O.truthy(c)} THEN CAST({c} AS VARCHAR) ELSE 'N/A' END"


oracle("report_rows", f"""
SELECT rank AS row_no, date_posted, {O.portal_label('url', 'external_id')} AS portal,
       {unpack_district('district')} AS district, {_cell('price_pln')} AS price, {_cell('sqm')} AS area,
       {_cell('rooms')} AS rooms, {_cell('price_per_sqm')} AS price_per_sqm,
       {O.snippet('description')} AS details, url AS link
FROM ({_report_base()}) s""")
def _report_twice():
    """A new target takes the rows, a second run appends them again."""
    names = ["row_no", "date_posted", "portal", "district", "price", "area", "rooms", "price_per_sqm", "details", "link"]
    cells = ", ".join(f'CAST({n} AS VARCHAR) AS "{h}"' for n, h in zip(names, REPORT_HEADER))
    one = f"SELECT {cells}, 'overwrite,append' AS modes FROM ({ORACLES['report_rows']}) r"
    return f"{one} UNION ALL {one}"


oracle("report_target_reset", _report_twice())
oracle("report_markdown", f"""
SELECT rank AS row_no, '| ' || concat_ws(' | ', CAST(rank AS VARCHAR), coalesce(date_posted, 'N/A'), {O.portal_label('url', 'external_id')},
       {unpack_district('district')}, {O.fmt_money('price_pln')}, {_cell('sqm')}, coalesce(CAST(rooms AS VARCHAR), 'N/A'),
       {O.fmt_money('price_per_sqm')}, {O.snippet('description')}, coalesce('[View Offer](' || url || ')', 'N/A')) || ' |' AS line
FROM ({_report_base()}) s""")
oracle("report_append", with_ctes("""
SELECT CAST(row_number() OVER (ORDER BY external_id) + (SELECT count(*) FROM D WHERE part_key % 2 = 0) AS BIGINT) AS row_no,
       external_id, url
FROM (SELECT *, row_number() OVER (PARTITION BY lower(trim(url)) ORDER BY external_id) AS rn
      FROM D WHERE lower(trim(url)) NOT IN (SELECT lower(trim(url)) FROM D WHERE part_key % 2 = 0)) t
WHERE rn = 1""", D_CTE))
oracle("listing_json", with_ctes("""
SELECT external_id, to_json(struct_pack(external_id := external_id, title := title, price_pln := price_pln,
       sqm := sqm, rooms := rooms, district := district, url := url)) AS json FROM D""", D_CTE))
oracle("portal_union", with_l(f"""
SELECT external_id, title, price_pln, sqm, rooms, district, url, CAST(NULL AS VARCHAR) AS date_posted FROM L
UNION ALL
SELECT external_id, title, price_pln, sqm, rooms, district, url, date_posted FROM ({_post_extract_sql()}) p"""))


# =============================================================================
# Cards
# =============================================================================

# one card per link of a page: the first in page order
CARD_ORDER = ("line_no, part_key, title NULLS FIRST, price_pln NULLS FIRST, sqm NULLS FIRST, rooms NULLS FIRST, "
              "district NULLS FIRST, created_at NULLS FIRST, description NULLS FIRST")
_OLX_URL = f"'https://www.olx.pl/d/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-ID' || {_AD} || '.html'"


def card_rows(url):
    return (f"(SELECT *, {url} AS link FROM L QUALIFY row_number() OVER (PARTITION BY order_key, {url} "
            f"ORDER BY {CARD_ORDER}) = 1)")


def _olx_cards_sql():
    from .functions.urls import OFFER_ID_PATTERNS
    price_txt = "CASE WHEN price_pln IS NOT NULL THEN replace(format('{:,.0f}', price_pln), ',', ' ') || ' zł' END"
    span = ("NULLIF(concat_ws(' · ', CASE WHEN sqm IS NOT NULL THEN replace(CAST(sqm AS VARCHAR), '.', ',') || ' m²' END, "
            "CASE WHEN rooms IS NOT NULL THEN CAST(rooms AS VARCHAR) || ' pok.' END), '')")
    loc = f"'Warszawa, ' || lower({CLEAN_D})"
    oid = "coalesce(" + ", ".join(O.rx("url", p) for p in OFFER_ID_PATTERNS["olx"]) + ", sha256(url))"
    pn = parse_number("price_txt")
    return with_l(f"""
SELECT 'olx-' || {oid} AS external_id,
       CASE WHEN {O.blank('title')} THEN 'Mieszkanie na sprzedaż (' || coalesce(dist, 'Warszawa') || ')' ELSE title END AS title,
       price AS price_pln, {price_per_sqm('price', 'xs')} AS price_per_sqm, xs AS sqm, xr AS rooms,
       CASE WHEN dist IS NOT NULL AND dist <> '' THEN dist ELSE 'Warszawa' END AS district,
       CAST(NULL AS VARCHAR) AS date_posted, url
FROM (SELECT *, CASE WHEN {O.truthy(pn)} THEN {pn} ELSE {O.text_price('fbt')} END AS price,
             {O.text_sqm('fbt')} AS xs, {O.text_rooms('fbt')} AS xr
      FROM (SELECT *, concat_ws(' ', title, price_txt, span, loc) || ' ' || url AS fbt, {d_first('loc')} AS dist
            FROM (SELECT title, link AS url, {price_txt} AS price_txt, {span} AS span, {loc} AS loc
                  FROM {card_rows(_OLX_URL)} r) a) b) c""")


def _cards_sql(prefix, url, offer, title, district, price="price_pln", sqm="sqm", rooms="rooms",
               date="CAST(NULL AS VARCHAR)"):
    """Cards straight from the listing's own fields."""
    return with_l(f"""
SELECT '{prefix}-' || offer AS external_id, title2 AS title, price AS price_pln,
       {price_per_sqm('price', 'area')} AS price_per_sqm, area AS sqm, n_rooms AS rooms,
       {pack('dist', 'day')} AS district, day AS date_posted, link AS url
FROM (SELECT link, {offer} AS offer, {title} AS title2, {price} AS price, {sqm} AS area, {rooms} AS n_rooms,
             {district} AS dist, {date} AS day FROM {card_rows(url)} r) c""")


_TITLE_D = O.title(f"lower({CLEAN_D})")
_NUMBER = "CAST(order_key AS VARCHAR) || CAST(line_no AS VARCHAR)"
_NO_URL = ("'https://warszawa.nieruchomosci-online.pl/mieszkanie-' || CAST(order_key AS VARCHAR) "
           "|| lpad(CAST(line_no AS VARCHAR), 3, '0') || '.html'")
oracle("cards_olx", _olx_cards_sql())
oracle("cards_morizon", _cards_sql(
    "morizon", f"'https://www.morizon.pl/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-mzn' || {_NUMBER}",
    f"'mzn' || {_NUMBER}", "coalesce(title, 'Mieszkanie na sprzedaż (Warszawa)')", _TITLE_D,
    # a zero price is read again from the card's text, where the district stands before it
    price=f"CASE WHEN price_pln = 0 THEN {O.text_price(CLEAN_D + " || ' 0 zł'")} ELSE price_pln END"))
oracle("cards_freedom", _cards_sql(
    "freedom", f"'https://freedom.pl/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-' || {_NUMBER} || '/'",
    _NUMBER, f"'Mieszkanie Warszawa (' || {O.capitalize(CLEAN_D)} || ')'", O.capitalize(CLEAN_D),
    date="substr(CAST(created_at AS VARCHAR), 1, 10)"))
oracle("cards_no", _cards_sql(
    "no", _NO_URL, f"coalesce({O.rx('link', r'([0-9]{6,10})')}, sha256(link))",
    f"coalesce(NULLIF(title, ''), 'Mieszkanie na sprzedaż (' || {CLEAN_D} || ')')", CLEAN_D,
    price=f"coalesce(price_pln, {O.text_price('description')})", sqm=f"coalesce(sqm, {O.text_sqm('description')})",
    rooms=O.text_rooms("description"),
    date=f"CAST({text_date('description', DATE_LABELS_TEXTUAL['no'])} AS VARCHAR)"))
oracle("cards_adresowo", _cards_sql(
    "adresowo", f"'https://adresowo.pl/o/mieszkanie-warszawa-' || lower(replace({CLEAN_D}, ' ', '-')) || '-ul-polna-' || {_AD}",
    _AD, f"'Mieszkanie Warszawa ' || {_TITLE_D} || ' ul. Polna'", _TITLE_D))

CARD_PORTALS = ["olx", "adresowo", "no", "morizon", "freedom"]
oracle("cards_portals", " UNION ALL ".join(f"SELECT * FROM ({ORACLES['cards_' + p]}) {p}_cards" for p in CARD_PORTALS))


# =============================================================================
# Detail enrichment
# =============================================================================

def _detail_sql():
    dt = O.strip("description")
    date = f"CAST({text_date('dt', DATE_LABELS_TEXTUAL['olx'])} AS VARCHAR)"
    return with_ctes(f"""
SELECT external_id, sqm2 AS sqm, rooms2 AS rooms, price2 AS price_pln, CASE WHEN has THEN dt END AS description,
       CASE WHEN has AND d2 IS NOT NULL AND NOT contains(coalesce(NULLIF(district, ''), 'Warszawa'), '-')
            THEN coalesce(NULLIF(district, ''), 'Warszawa') || ' - ' || d2 ELSE district END AS district,
       d2 AS date_posted,
       CASE WHEN has AND NOT {O.truthy('pps')} AND {O.truthy('price2')} AND {O.truthy('sqm2')}
            THEN round(price2 / sqm2, 2) ELSE pps END AS price_per_sqm
FROM (SELECT *,
        CASE WHEN has THEN (CASE WHEN {O.truthy('sqm')} THEN sqm ELSE {O.text_sqm('dt')} END) ELSE sqm END AS sqm2,
        CASE WHEN has THEN (CASE WHEN {O.truthy('rooms')} THEN rooms ELSE {O.text_rooms('dt')} END) ELSE rooms END AS rooms2,
        CASE WHEN has THEN (CASE WHEN {O.truthy('price_pln')} THEN price_pln ELSE {O.text_price('dt')} END) ELSE price_pln END AS price2,
        coalesce(CASE WHEN line_no % 2 = 1 THEN substr(CAST(created_at AS VARCHAR), 1, 10) END,
                 CASE WHEN has THEN {date} END) AS d2
      FROM (SELECT B.external_id, B.line_no, B.created_at, B.price_pln, B.sqm, B.rooms, B.district,
                   {price_per_sqm('B.price_pln', 'B.sqm')} AS pps, T.dt, coalesce(T.dt <> '', FALSE) AS has
            FROM B LEFT JOIN (SELECT curl, {dt} AS dt FROM (
                SELECT split_part(url, '?', 1) AS curl, description,
                       row_number() OVER (PARTITION BY split_part(url, '?', 1) ORDER BY external_id, title NULLS FIRST,
                                          description NULLS FIRST) AS rn FROM L) x
                WHERE rn = 1) T ON split_part(B.url, '?', 1) = T.curl) a) b""", BATCH_CTE)


oracle("detail_enrich", _detail_sql())


def _fallback_sql():
    from .functions.urls import OFFER_ID_PATTERNS
    url = f"'https://www.olx.pl/d/oferta/mieszkanie-' || CAST(part_key AS VARCHAR) || '-ID' || {_AD} || '.html'"
    oid = "coalesce(" + ", ".join(O.rx("u", p) for p in OFFER_ID_PATTERNS["olx"]) + ", sha256(u))"
    return with_l(f"""
SELECT 'olx-' || {_AD} AS external_id, {url} AS url, 'json' AS source FROM L WHERE order_key % 2 = 0
UNION ALL
SELECT 'olx-' || {oid} AS external_id, u AS url, 'cards' AS source
FROM (SELECT link AS u FROM {card_rows(_OLX_URL)} r WHERE order_key % 2 = 1) t""")


oracle("extract_fallback", _fallback_sql())


# =============================================================================
# The load
# =============================================================================

def _ingest_sql():
    json_a = ORACLES["json_ads_a"]
    default_title_sql = (f"CASE WHEN {O.blank('title')} THEN 'Mieszkanie na sprzedaż (' || "
                         "coalesce(NULLIF(district, ''), 'Warszawa') || ')' ELSE title END")
    # cards stand on the pages of odd orders: the order's number is in the link
    order = {"olx": ("-ID([0-9]+)x", 1), "adresowo": ("-([0-9]+)x[0-9]+$", 1), "no": ("-([0-9]+).html$", 1000),
             "morizon": ("-mzn([0-9]+)$", 10), "freedom": ("-([0-9]+)/$", 10)}
    keys = dict(zip(PORTAL_PREFIXES, PORTAL_KEYS))
    cards = " UNION ALL ".join(
        f"SELECT external_id, '{keys[p]}', title, 2 FROM ({ORACLES['cards_' + p]}) {p}_cards "
        f"WHERE CAST(regexp_extract(url, '{rx}', 1) AS BIGINT) // {by} % 2 = 1" for p, (rx, by) in order.items())
    return f"""
SELECT external_id, any_value(portal) AS portal, min(title) AS title, min(since) AS since, 2 AS version FROM (
  SELECT external_id, 'olx' AS portal, title, 1 AS since FROM ({json_a}) j
  WHERE CAST(regexp_extract(external_id, '^olx-([0-9]+)x', 1) AS BIGINT) % 2 = 0
  UNION ALL SELECT external_id, 'otodom', {default_title_sql}, 2 FROM ({ORACLES["json_ads_b"]}) b
  QUALIFY row_number() OVER (PARTITION BY external_id ORDER BY title NULLS FIRST, price_pln NULLS FIRST,
                             sqm NULLS FIRST, rooms NULLS FIRST, district NULLS FIRST, url) = 1
  UNION ALL {cards}
  UNION ALL SELECT external_id, 'facebook', title, 2 FROM ({ORACLES["post_extract"]}) p) u
GROUP BY external_id"""


oracle("ingest", _ingest_sql())
oracle("store_portal", f"SELECT since, count(*) AS n FROM ({_ingest_sql()}) s WHERE portal = 'facebook' GROUP BY since")
oracle("store_delta", ORACLES["delta_anti"])
oracle("store_upsert", f"SELECT * EXCLUDE (version), CAST(CASE version WHEN 'old' THEN 1 ELSE 2 END AS BIGINT) AS since "
                       f"FROM ({ORACLES['upsert_merge']}) u")
oracle("stream_listings", with_ctes("SELECT DISTINCT external_id, portal FROM L"))
oracle("report_document", f"""
SELECT row_no, line FROM ({ORACLES["report_markdown"]}) m
UNION ALL SELECT -1, '| {" | ".join(REPORT_HEADER)} |' UNION ALL SELECT 0, '|{"---|" * len(REPORT_HEADER)}'""")
