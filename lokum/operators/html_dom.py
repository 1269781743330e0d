"""A small DOM, used inside the HTML-walking batch hook only (no bs4 here).

Tree rules: void elements never open; a new ``<p>`` (or a block start)
closes an open ``<p>``; an end tag closes up to its nearest open match and is
ignored when nothing matches. Text of ``script`` / ``style`` and comments is
not page text.

A page is two flat lists in document order, its elements and its texts; an
element knows its span in both, so what lies below it is a slice of them. Plain
markup (quoted attributes without references, no comments, no script) is cut at
its angle brackets; any other page goes through the standard library's
``html.parser``, whose result is the same for plain markup.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from typing import Callable, Iterator

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
CLOSES_P = {"p", "div", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol",
            "table", "header", "footer", "nav", "address", "form", "pre", "blockquote"}
NON_TEXT = {"script", "style"}


class Node:
    """An element: the nodes below it are ``page.nodes[at + 1:end]``, the texts
    ``page.strings[first:last]``."""
    __slots__ = ("tag", "attrs", "parent", "page", "at", "end", "first", "last")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None", page: "_Page", at: int):
        self.tag, self.attrs, self.parent, self.page, self.at = tag, attrs, parent, page, at
        self.first = len(page.strings)

    # --- navigation -----------------------------------------------------
    def iter(self) -> Iterator["Node"]:
        return iter(self.page.nodes[self.at + 1:self.end])

    def find(self, pred: Callable[["Node"], bool]) -> "Node | None":
        for n in self.page.nodes[self.at + 1:self.end]:
            if pred(n):
                return n
        return None

    def find_all(self, pred: Callable[["Node"], bool]) -> list["Node"]:
        return [n for n in self.page.nodes[self.at + 1:self.end] if pred(n)]

    def strings(self) -> list[str]:
        page = self.page
        if not page.hidden:
            return page.strings[self.first:self.last]
        # the texts of a script are its own, not those of the elements around it
        return [page.strings[k] for k in range(self.first, self.last) if page.hidden.get(k, -1) <= self.at]

    def text(self, sep: str = "", strip: bool = True) -> str:
        if not strip:
            return sep.join(self.strings())
        return sep.join([p for p in map(str.strip, self.strings()) if p])

    def get(self, name: str, default=None):
        return self.attrs.get(name, default)


class _Page:
    """A page that is being read: elements and texts arrive in document order."""

    def __init__(self):
        self.nodes: list[Node] = []
        self.strings: list[str] = []
        self.hidden: dict[int, int] = {}   # texts in a script or style: that element's place
        self.scripts = False
        self.root = self.cur = Node("#root", {}, None, self, -1)

    def _close(self, node: Node) -> None:
        """Closes ``node`` and all that is open in it."""
        end, last = len(self.nodes), len(self.strings)
        n, up = self.cur, node.parent
        while n is not up:
            n.end, n.last = end, last
            n = n.parent
        self.cur = up

    def _open(self, tag: str) -> Node | None:
        """The nearest open element of that name."""
        n, root = self.cur, self.root
        while n is not root:
            if n.tag == tag:
                return n
            n = n.parent
        return None

    def start(self, tag: str, attrs: dict, empty: bool) -> None:
        if not empty and tag in CLOSES_P:
            p = self._open("p")
            if p is not None:
                self._close(p)
        node = Node(tag, attrs, self.cur, self, len(self.nodes))
        self.nodes.append(node)
        if empty or tag in VOID:
            node.end, node.last = node.at + 1, node.first
        else:
            self.cur = node
            self.scripts = self.scripts or tag in NON_TEXT

    def stop(self, tag: str) -> None:
        node = self._open(tag)
        if node is not None:
            self._close(node)

    def data(self, text: str) -> None:
        if self.scripts:
            n = self.cur
            while n is not None and n.tag not in NON_TEXT:
                n = n.parent
            if n is not None:
                self.hidden[len(self.strings)] = n.at
        self.strings.append(text)

    def done(self) -> Node:
        self._close(self.root)
        return self.root


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = _Page()

    def handle_starttag(self, tag, attrs):
        self.page.start(tag, {k: (v if v is not None else "") for k, v in attrs}, False)

    def handle_startendtag(self, tag, attrs):
        self.page.start(tag, {k: (v if v is not None else "") for k, v in attrs}, True)

    def handle_endtag(self, tag):
        self.page.stop(tag)

    def handle_data(self, data):
        self.page.data(data)


# What stands between two angle brackets of plain markup.
_TAG = re.compile(r'(/?)([a-z][a-z0-9]*)((?: [a-z][a-z0-9-]*(?:="[^"<>&]*")?)*)( ?/)?')
_ATTR = re.compile(r' ([a-z][a-z0-9-]*)(?:="([^"]*)")?')
# Elements whose content has rules of its own.
_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext",
        "svg", "math"}
_MOST_TAGS = 4096    # distinct tags kept by a worker, of at most 100 characters; then it begins anew
_tags: dict[str, tuple] = {}


def _tag(inner: str) -> tuple | None:
    """(closing, name, attributes, empty) of a plain tag, else None."""
    m = _TAG.fullmatch(inner)
    if m is None or m[2] in _RAW or (m[1] and (m[3] or m[4])):
        return None
    made = (bool(m[1]), m[2], dict(_ATTR.findall(m[3])), m[4] is not None)
    if len(inner) <= 100:
        # links are all different: kept for good, they would leave no room for the tags
        # of the pages that a worker reads later
        if len(_tags) >= _MOST_TAGS:
            _tags.clear()
        _tags[inner] = made
    return made


def plain_tag(inner: str) -> tuple | None:
    """(closing, name, attributes, empty) of what stands between two angle brackets, if
    that is plain, else None."""
    return _tags.get(inner) or _tag(inner)


def _plain(html: str) -> Node | None:
    """The tree of plain markup, None for any other."""
    page = _Page()
    root, nodes, strings, known = page.root, page.nodes, page.strings, _tags.get
    pieces = html.split("<")
    if pieces[0]:
        strings.append(unescape(pieces[0]))
    for piece in pieces[1:]:
        inner, found, text = piece.partition(">")
        if not found:
            return None
        tag = known(inner) or _tag(inner)
        if tag is None:
            return None
        closing, name, attrs, empty = tag
        if not closing:
            page.start(name, attrs, empty)
        elif (cur := page.cur).tag == name and cur is not root:  # what ``stop`` does, mostly
            cur.end, cur.last, page.cur = len(nodes), len(strings), cur.parent
        else:
            page.stop(name)
        if text:
            strings.append(unescape(text) if "&" in text else text)
    return page.done()


def parse(html: str | None) -> Node:
    plain = _plain(html or "")
    if plain is not None:
        return plain
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:  # malformed markup: keep what was built
        pass
    return b.page.done()


# --- predicates ---------------------------------------------------------------

def tag(name: str, **attrs) -> Callable[[Node], bool]:
    def pred(n: Node) -> bool:
        return n.tag == name and all(n.attrs.get(k) == v for k, v in attrs.items())
    return pred


def attr_eq(name: str, value: str) -> Callable[[Node], bool]:
    return lambda n: n.attrs.get(name) == value


def class_has(tag_name: str | None, sub: str, lower: bool = False) -> Callable[[Node], bool]:
    """A class token containing ``sub`` (case-folded when ``lower``)."""
    def pred(n: Node) -> bool:
        if tag_name and n.tag != tag_name:
            return False
        cls = n.attrs.get("class") or ""
        toks = cls.split() or [cls]
        return any(sub in (t.lower() if lower else t) for t in toks if t)
    return pred


def has_class(tag_name: str, cls: str) -> Callable[[Node], bool]:
    return lambda n: n.tag == tag_name and cls in (n.attrs.get("class") or "").split()


def href_has(sub: str) -> Callable[[Node], bool]:
    return lambda n: n.tag == "a" and sub in (n.attrs.get("href") or "")
