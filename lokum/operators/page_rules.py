"""Where portals put what: tables of (portal, field, ordered selectors), read by
the one walker in ``extract_html``.

A selector is a path of steps, outermost first: ``tag``, ``.class``, ``#id``,
``[attr]``, ``[attr=value]``, ``[attr*=part]`` (``i``: in any case), joined
without blanks; a comma inside a step means either. Of a field's selectors the
first that finds anything counts.
"""

from __future__ import annotations

import re
from functools import cache
from typing import Callable, NamedTuple, Sequence

from .html_dom import Node

_ONE = re.compile(r"""(?P<tag>^[a-z]\w*) | \.(?P<cls>[\w-]+) | \#(?P<id>[\w-]+)
                      | \[(?P<attr>[\w-]+)(?:(?P<op>\*?=)(?P<value>[^\]]*?)(?P<fold>\si)?)?\]""", re.X)


def _condition(m: re.Match) -> Callable[[Node], bool]:
    if m["tag"]:
        tag = m["tag"]
        return lambda n: n.tag == tag
    if m["cls"]:
        cls = m["cls"]
        return lambda n: cls in (n.attrs.get("class") or "") and cls in n.attrs["class"].split()
    name, op, value = (m["attr"], m["op"], m["value"]) if m["attr"] else ("id", "=", m["id"])
    if op is None:
        return lambda n: name in n.attrs
    if op == "=":
        return lambda n: n.attrs.get(name) == value
    if m["fold"]:
        return lambda n: value in (n.attrs.get(name) or "").lower()
    return lambda n: value in (n.attrs.get(name) or "")


def _all(conditions: list[Callable[[Node], bool]]) -> Callable[[Node], bool]:
    if len(conditions) == 1:
        return conditions[0]
    if len(conditions) == 2:
        one, two = conditions
        return lambda n: one(n) and two(n)
    return lambda n: all(c(n) for c in conditions)


def _step(text: str) -> Callable[[Node], bool]:
    either = []
    for one in text.split(","):
        conditions, at = [], 0
        while at < len(one):
            m = _ONE.match(one, at)
            if m is None:
                raise ValueError(f"selector step {one!r}")
            conditions.append(_condition(m))
            at = m.end()
        either.append(conditions)
    met = [_all(conditions) for conditions in either]
    return met[0] if len(met) == 1 else lambda n: any(one(n) for one in met)


@cache
def step_texts(selector: str) -> tuple[str, ...]:
    return tuple(re.findall(r"(?:\[[^\]]*\]|[^\s\[])+", selector))


@cache
def steps(selector: str) -> tuple[Callable[[Node], bool], ...]:
    return tuple(_step(s) for s in step_texts(selector))


def first(node: Node, selectors: Sequence[str]) -> Node | None:
    """First match of the first selector that has one; each step looks below the
    previous step's first match."""
    for s in selectors:
        at: Node | None = node
        for step in steps(s):
            at = at.find(step)
            if at is None:
                break
        if at is not None:
            return at
    return None


def every(node: Node, selectors: Sequence[str]) -> list[Node]:
    """All matches of the first selector that has one, each once, in page order."""
    for s in selectors:
        level = [node]
        for step in steps(s):
            level = (level[0].find_all(step) if len(level) == 1 else
                     list({id(m): m for n in level for m in n.find_all(step)}.values()))
        if level:
            return level
    return []


# How a field is read: the first match's text; the texts of all matches; the same
# with blanks between nested elements (values and their units).
TEXT, TEXTS, VALUES = "text", "texts", "values"


class Field(NamedTuple):
    name: str
    selectors: Sequence[str]
    read: str = TEXT


class Cards(NamedTuple):
    cards: Sequence[str]     # the cards of a result page
    link: Sequence[str]      # a card's link: the card itself or below it
    fields: Sequence[Field]


# --- FIXED VALUES: result pages. One entry per portal, fields in output order.
CARDS = {
    "olx": Cards(
        cards=["div[data-cy=l-card]", "a[href*=/d/oferta/]"],
        link=["a[href]"],
        fields=[Field("title", ["h6", "h3", "strong", "h2"]),
                Field("price", ["p[data-testid=ad-price]", "p[class*=price i]"]),
                Field("location", ["p[data-testid=location-date]"])]),
    "adresowo": Cards(
        cards=["div[data-offer-card]", "div.result-item,div.offer-box"],
        link=["a[href]"],
        fields=[Field("tags", ["div.items-center p", "p"], VALUES),
                Field("heads", ["h2,h3 a span"], TEXTS)]),
    "no": Cards(
        cards=["div.tertiary", "div.tertiary__box", "div.tile-holder"],
        link=["a[href]"],
        fields=[Field("title", ["a[href]"]),
                Field("location", ["p[class*=province] a"]),
                Field("price", ["p[class*=primary-display]", "span[class*=price i]"]),
                Field("area", ["span[class*=area]"])]),
    "morizon": Cards(
        cards=["div[class*=card__outer]"],
        link=["a.property-card[href]", "a[href*=/oferta/]"],
        fields=[Field("title", ["[data-cy=propertyCardTitle]"]),
                Field("location", ["[data-cy=propertyCardLocation]"]),
                Field("price", ["[data-cy=propertyCardPrice]"]),
                Field("price_m2", ["[data-cy=offerPricePerM2]"]),
                Field("area", ["[data-cy=cardPropertyInfoArea]"]),
                Field("rooms", ["[data-cy=cardPropertyInfoRooms]"])]),
    "freedom": Cards(
        cards=["div[class*=offert]"],
        link=["a.offert-box-ctn-link[href]", "a[href*=/oferta/]"],
        fields=[Field("location", ["address"]),
                Field("price", ["div.price strong"]),
                Field("price_m2", ["div.price p strong"]),
                Field("details", ["div.details strong"], TEXTS),
                Field("date", ["div.bottom small"])]),
}

# --- FIXED VALUES: description containers of detail pages, tried in order.
DESCRIPTION = {
    "otodom": ["div[data-cy=adPageAdDescription]"],
    "olx": ["div[data-cy=ad_description]", "div[data-testid=ad_description]"],
    "adresowo": ["div[class*=description i]", "section[class*=description i]", "div[itemprop=description]"],
    "no": ["div[class*=box-description]", "div[class*=offer-description]", "div#description",
           "div[class*=description i]"],
    "morizon": ["div[class*=details-description]", "div[data-cy=offerDescription]", "div[class*=description i]"],
    "freedom": ["div[class*=description i]"],
}
# --- FIXED VALUES: containers whose paragraphs come before the description.
PARAGRAPHS = {"freedom": ["div.left-page", "div.article-page"]}

# Pages of no known portal: every portal's containers from the narrowest on, then
# the page's own <article>.
ANY_DESCRIPTION = ["div[data-cy=ad_description]", "div[data-testid=ad_description]",
                   "div[data-cy=adPageAdDescription]", "div[class*=details-description]",
                   "div[data-cy=offerDescription]", "div[class*=box-description]",
                   "div[class*=offer-description]", "div#description", "div[class*=description i]",
                   "section[class*=description i]", "div[itemprop=description]", "article"]
ANY_PARAGRAPHS = ["div.left-page", "div.article-page", "article"]
