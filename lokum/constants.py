"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour being
reproduced (word lists, lookup tables, labels, default parameters). They are
kept here, in natural order, so the Column expressions elsewhere stay generic.
"""

# --- FIXED VALUES: Polish month words -> month number (genitive, nominative,
# --- three-letter forms), as used by every date parser.
MONTH_WORDS = {
    "stycznia": "01", "stycznie": "01", "styczeń": "01", "sty": "01",
    "lutego": "02", "luty": "02", "lut": "02",
    "marca": "03", "marzec": "03", "mar": "03",
    "kwietnia": "04", "kwiecień": "04", "kwi": "04",
    "maja": "05", "maj": "05",
    "czerwca": "06", "czerwiec": "06", "cze": "06",
    "lipca": "07", "lipiec": "07", "lip": "07",
    "sierpnia": "08", "sierpień": "08", "sie": "08",
    "września": "09", "wrzesień": "09", "wrz": "09",
    "października": "10", "październik": "10", "paź": "10",
    "listopada": "11", "listopad": "11", "lis": "11",
    "grudnia": "12", "grudzień": "12", "gru": "12",
}

# --- FIXED VALUES: genitive month names by month number (used to render dates
# --- as Polish text, e.g. "Dodano 05 października 1996").
MONTH_GENITIVE = [
    "stycznia", "lutego", "marca", "kwietnia", "maja", "czerwca",
    "lipca", "sierpnia", "września", "października", "listopada", "grudnia",
]

# --- FIXED VALUES: room words (upper-cased, trimmed) -> room count.
ROOM_WORDS = {
    "ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5,
    "SIX": 6, "SEVEN": 7, "EIGHT": 8, "NINE": 9, "TEN": 10,
    "KAWALERKA": 1, "1 POKÓJ": 1, "2 POKOJE": 2, "3 POKOJE": 3,
    "4 POKOJE": 4, "5 POKOI": 5, "1": 1, "2": 2, "3": 3, "4": 4, "5": 5,
}
# Strict variant (JSON layout B): English number words only, else integer text.
ROOM_WORDS_STRICT = {
    "ONE": 1, "TWO": 2, "THREE": 3, "FOUR": 4, "FIVE": 5,
    "SIX": 6, "SEVEN": 7, "EIGHT": 8, "NINE": 9, "TEN": 10,
}

# --- FIXED VALUES: portals. One row per source, in ingest order:
# --- (id prefix, portal key, display label, host marker, base url).
PORTALS = [
    ("otodom", "otodom", "Otodom", "otodom.pl", "https://www.otodom.pl"),
    ("olx", "olx", "OLX", "olx.pl", "https://www.olx.pl"),
    ("adresowo", "adresowo", "Adresowo", "adresowo.pl", "https://adresowo.pl"),
    ("no", "nieruchomosci-online", "Nieruchomości-online", "nieruchomosci-online.pl",
     "https://warszawa.nieruchomosci-online.pl"),
    ("morizon", "morizon", "Morizon", "morizon.pl", "https://www.morizon.pl"),
    ("freedom", "freedom", "Freedom", "freedom.pl", "https://freedom.pl"),
    ("fb", "facebook", "Facebook", "facebook.com", "https://www.facebook.com"),
]
PORTAL_PREFIXES = [p[0] for p in PORTALS]
PORTAL_KEYS = [p[1] for p in PORTALS]
PORTAL_LABELS = [p[2] for p in PORTALS]
PORTAL_HOSTS = [p[3] for p in PORTALS]
DEFAULT_PORTAL_KEY = "otodom"
DEFAULT_PORTAL_LABEL = "Otodom"

# --- FIXED VALUES: search defaults.
DEFAULT_MAX_PRICE = 750000.0
DEFAULT_MIN_SQM = 30.0
DEFAULT_MIN_ROOMS = 2
DEFAULT_MATCH_COUNT = 500
DEFAULT_MATCH_THRESHOLD = 0.10
DEFAULT_PAGE_SIZE = 20
DEFAULT_NEW_WITHIN_DAYS = 3
DEFAULT_EXCLUDED_DISTRICTS = ["białołęka", "bialoleka", "rembertów", "rembertow"]

# --- FIXED VALUES: agency / developer phrases (lower-case substrings of
# --- "title description").
AGENCY_PHRASES = [
    "stan deweloperski", "od dewelopera", "rynek pierwotny",
    "agencja nieruchomości", "biuro nieruchomości", "pobieramy prowizję",
]

# --- FIXED VALUES: highlight keywords for the report snippet.
GREEN_KEYWORDS = ["park", "las", "zielon", "drzewa", "skwer", "spacer", "balkon", "metro"]
SNIPPET_CHARS = 65
NO_SNIPPET = "No details snippet"

# --- FIXED VALUES: social post pre-filter terms (rental vs sale).
RENTAL_TERMS = ["do wynajęcia", "wynajmę", "wynajem", "najem", "odstąpię najem",
                "opłaty + najem", "kaucja"]
SALE_TERMS = ["sprzedam", "na sprzedaż", "sprzedaż", "kupię", "cena sprzedaż"]

# --- FIXED VALUES: imputation defaults and text/length limits.
IMPUTED_SQM = 42.0
IMPUTED_ROOMS = 2
POST_MIN_CHARS = 20
EXTRACT_MIN_CHARS = 15
PARAGRAPH_MIN_CHARS = 20
EXTRACT_TEXT_CAP = 2500
POSTS_PER_PAGE = 15
VECTOR_DIM = 1536

# --- FIXED VALUES: default titles.
DEFAULT_TITLE_CITY = "Warszawa"
FB_TITLE_PREFIX = "[FB] "
FB_DEFAULT_TITLE = "Mieszkanie z Grupy FB Warszawa"

# --- FIXED VALUES: district stop words (a location part equal to one of these
# --- is a city / voivodeship, not a district).
DISTRICT_STOP = ["warszawa", "mazowieckie"]
SLUG_NOT_DISTRICT = ["mieszkanie", "sprzedaz"]
# --- FIXED VALUES: the characters of a district in a url or a page's text.
SLUG_CHARS = r"[a-zA-Z\-żółćęśąźńZÓŁĆĘŚĄŹŃ]+"

# --- FIXED VALUES: labels introducing a posting date, per portal family.
DATE_LABELS_TEXTUAL = {
    "olx": ["Dodane", "Odświeżono", "Dodano"],
    "no": ["Dodano", "Dodany", "Data dodania", "Zaktualizowano"],
}
DATE_LABELS_DOTTED = {
    "morizon": ["Data dodania", "Aktualizacja", "Dodano"],
    "freedom": ["Opublikowano", "Dodano", "Aktualizacja"],
}

# --- FIXED VALUES: report header.
REPORT_HEADER = ["#", "Date Posted", "Portal", "District", "Price (PLN)", "Area (m²)",
                 "Rooms", "Price / m²", "Details", "Direct Link"]
# the answer of a search without rows
REPORT_EMPTY = "No apartments were found for '{label}' strictly meeting all requirements."
