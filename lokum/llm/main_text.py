"""Main text of web pages by the distribution of text over line blocks.

1. Markup is stripped: every block element's text is a line, white space in it is
   one space, character references are decoded. Scripts, styles, forms, menus,
   page headers, footers, asides and elements whose class, id or role names a
   menu, advert, notice, sidebar or reader comment leave a line of length 0.
2. Lines have a length: their characters, without those of links where the page
   does not mark its article. If it does (article or main element with a third of
   the text or more), lines outside have length 0.
3. Lengths are summed over windows of ``WINDOW`` lines. A window at or above the
   threshold starts a surge; from it the text reaches back to the surge point and
   on to the dive point, where the length is 0 again. Inside one marked article
   any text is over the threshold; otherwise it is ``SURGE`` characters, or half of
   the page's longest window if that is less.
4. The lines between surge and dive points are the text, in page order.

Defined cases: null, empty and text-free pages give an empty text; broken markup
(unclosed or stray tags, cut-off references) is read as far as it goes; white space
is Unicode's; pages are read whole, at any length and nesting; repeated rows and
null ids are ordinary rows; other columns are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lokum.llm.common import by_bytes, col

WINDOW = 3
SURGE = 80

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
MARK = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

BLOCKS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p
pre search section summary table tbody tfoot thead tr ul""".split())
SPACED = {"br", "td", "th", "img", "wbr"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
# a start tag of the key closes an open element of these
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
KEEP_P = {"html", "body", "br", "option", "tr", "tbody", "thead", "tfoot", "caption", "legend", "head"}
DROPPED = set("""head script style noscript template nav footer aside form button select textarea input iframe
object svg canvas audio video menu dialog search""".split())
DROPPED_WORDS = set("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion
banner cookie cookies consent gdpr notice notices newsletter subscribe popup modal overlay nav navbar navigation
menu breadcrumb breadcrumbs sidebar aside related recommended recommendations share sharing social comment
comments disqus reply replies footer masthead toolbar pagination pager login signup search alert complementary
contentinfo dialog""".split())
OUTER_WORDS = {"header"}
NEGATED = {"has", "no", "with", "without", "not"}
MARKED_ARTICLE = {"article", "main"}


def named_words(attributes: str) -> Iterator[str]:
    for m in MARK.finditer(attributes):
        for name in references.unescape(m.group(2).strip("\"'")).split():
            words = [w.lower() for w in NAME.findall(name)]
            if words and words[0] not in NEGATED:
                yield from words
                if m.group(1).lower() == "role" and name.lower() == "main":
                    yield "role-main"


class Lines:
    """The lines of a page: text, characters outside links, article, main."""

    def __init__(self, page: str):
        self.rows: list[tuple[str, int, int, bool]] = []
        self.text: list[str] = []
        self.plain = 0
        self.stack: list[tuple[str, int]] = []  # name and what the element is
        self.open: Counter = Counter()
        self.dropped = self.links = self.articles = self.mains = 0
        self.article = 0  # number of the outermost article
        self.hidden = False  # the line so far holds dropped text
        at = 0
        while at < len(page):
            m = TOKEN.search(page, at)
            self.add(page[at:m.start() if m else len(page)])
            if not m:
                break
            at = m.end()
            name = (m.group(2) or m.group(5) or "").lower()
            if not name:
                continue
            if m.group(1) or m.group(4):
                self.end(name)
                continue
            self.start(name, m.group(3) or m.group(6) or "")
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>]|\\Z)", re.I).search(page, at)
                at = close.start() if close else len(page)
        self.line()

    def add(self, raw: str) -> None:
        if not raw:
            return
        if self.dropped:
            self.hidden = self.hidden or not raw.isspace()
            return
        text = references.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if not self.links:
            self.plain += len("".join(text.split()))

    def line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text or self.hidden:
            self.rows.append((text, self.plain, self.article if self.articles else 0, self.mains > 0))
        self.text, self.plain, self.hidden = [], 0, False

    DROP, LINK, ARTICLE, MAIN = 1, 2, 4, 8

    def kind(self, name: str, attributes: str) -> int:
        out = self.LINK if name == "a" else 0
        words = set(named_words(attributes)) if "=" in attributes else set()
        inside = self.articles or self.mains
        if name not in ("html", "body", "main") and (
                name in DROPPED or words & DROPPED_WORDS or not inside and (name == "header" or words & OUTER_WORDS)):
            return out | self.DROP
        if name == "article":
            out |= self.ARTICLE
        if name == "main" or "role-main" in words:
            out |= self.MAIN
        return out

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            if self.open["p"] and name not in KEEP_P:
                self.end("p")
            self.line()
        elif name in SPACED and not self.dropped:
            self.text.append(" ")
        for other in CLOSES.get(name, ()):
            if self.open[other] and self.stack[-1][0] == other:
                self.end(other)
        if name in VOID:
            return
        kind = self.kind(name, attributes)
        if kind & self.DROP and not self.dropped and name in BLOCKS:
            self.line()
        self.stack.append((name, kind))
        self.open[name] += 1
        self.count(kind, 1)

    def count(self, kind: int, by: int) -> None:
        if not kind:
            return
        self.dropped += by * bool(kind & self.DROP)
        self.links += by * bool(kind & self.LINK)
        self.mains += by * bool(kind & self.MAIN)
        if kind & self.ARTICLE:
            self.article += by > 0 and not self.articles
            self.articles += by

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.line()
        if not self.open[name]:
            return
        while self.stack:
            top, kind = self.stack[-1]
            if top in BLOCKS:
                self.line()
            self.stack.pop()
            self.open[top] -= 1
            self.count(kind, -1)
            if top == name:
                break


def lengths(rows: list[tuple[str, int, int, bool]]) -> tuple[list[int], bool]:
    """The lines' lengths, and whether they are those of one marked article."""
    total = sum(len(r[0]) for r in rows)
    for inside in (lambda r: r[2] > 0, lambda r: r[3]):
        if total and 3 * sum(len(r[0]) for r in rows if inside(r)) >= total:
            return [len(r[0]) if inside(r) else 0 for r in rows], len({r[2] for r in rows if inside(r)}) == 1
    return [r[1] for r in rows], False


def between(sizes: list[int], least: int, window: int = WINDOW) -> list[bool]:
    """Which lines lie between a surge and its dive."""
    n = len(sizes)
    keep = [False] * n
    sums = [0] * (n + 1)
    for i, s in enumerate(sizes):
        sums[i + 1] = sums[i] + s
    upto = 0  # lines before this one are settled
    for i in range(max(1, n - window + 1)):
        hi = min(n, i + window)
        if sums[hi] - sums[i] < least or hi <= upto:
            continue
        surge, dive = i, hi
        while not sizes[surge]:
            surge += 1
        while not sizes[dive - 1]:
            dive -= 1
        while surge > 0 and sizes[surge - 1] and not keep[surge - 1]:
            surge -= 1
        while dive < n and sizes[dive]:
            dive += 1
        keep[surge:dive] = [True] * (dive - surge)
        upto = max(upto, dive)
    return keep


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    rows = Lines(page or "").rows
    sizes, one = lengths(rows)
    most = max((sum(sizes[i:i + window]) for i in range(len(sizes))), default=0)
    if not most:
        return ""
    least = 1 if one else max(1, min(surge, most // 2))
    return "\n".join(r[0] for r, kept in zip(rows, between(sizes, least, window)) if kept and r[0])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(col(id_col).alias("page_id"), col(url_col).alias("url"), col(html_col).alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]

    def run(batches):
        for b in batches:
            for part in by_bytes(b, 2):
                out = [main_text(h, window, surge) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
