"""HTML walking hook (X5-X12): one pass per page inside ``mapInArrow``, a
slice of a batch at a time (``_slices``); Python only collects raw strings from the DOM. Every field
rule after that (numbers, dates, districts, ids, urls) is a JVM Column
expression applied to the hook's output.

Two hooks, both driven by the tables in ``page_rules``:
* ``page_parts``: title, whole-page text, first link, description container
  text and paragraph list of detail pages.
* ``card_fields``: one row per search-result card with the raw text of each
  field; plain pages a slice at a time (``html_batch``), any other by the walker,
  the same for all portals.
"""

from __future__ import annotations

from typing import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import html_batch as B
from . import html_dom as H
from . import page_rules as R

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("page_text", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("paragraphs", T.ArrayType(T.StringType())),
    T.StructField("first_href", T.StringType()),
    T.StructField("parsed", T.BooleanType()),
])


SLICE_BYTES, SLICE_ROWS = 1 << 20, 1024


def _slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``SLICE_BYTES`` of text in column ``at`` (a
    longer page comes alone): what a slice's pages become is handed on before the
    next one is read."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).tolist()
        lo, held = 0, 0
        for k, size in enumerate(sizes):
            if k > lo and (held + size > SLICE_BYTES or k - lo >= SLICE_ROWS):
                yield batch.slice(lo, k - lo)
                lo, held = k, 0
            held += size
        if lo < len(sizes):
            yield batch.slice(lo)


def _arrow(schema: T.StructType) -> pa.Schema:
    plain = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.BooleanType(): pa.bool_(),
             T.StringType(): pa.string(), T.ArrayType(T.StringType()): pa.list_(pa.string())}
    return pa.schema([(f.name, plain[f.dataType]) for f in schema.fields])


def _page_row(page_id, html, portal: str | None) -> dict:
    if not isinstance(html, str):
        return {"page_id": page_id, "title": None, "page_text": None, "description": None,
                "paragraphs": None, "first_href": None, "parsed": False}
    root = H.parse(html)
    t = root.find(H.tag("title"))
    known = portal in R.DESCRIPTION
    desc = R.first(root, R.DESCRIPTION[portal] if known else R.ANY_DESCRIPTION)
    box = R.first(root, R.PARAGRAPHS.get(portal, []) if known else R.ANY_PARAGRAPHS)
    paras = [p.text("", True) for p in box.find_all(H.tag("p"))] if box is not None else []
    a = R.first(root, ["a[href]"])
    return {"page_id": page_id,
            "title": t.text("", True) if t is not None else None,
            "page_text": root.text(" ", True),
            "description": desc.text("\n", True) if desc is not None else None,
            "paragraphs": paras,
            "first_href": a.get("href") if a is not None else None,
            "parsed": True}


def page_parts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
               keep: Sequence[str] = (), portal: Column | None = None) -> DataFrame:
    """X10-X12 raw parts, one row per page (null html -> nulls, row kept). The
    ``keep`` columns go through the hook, so nothing has to be joined back.
    ``portal`` (an id prefix) selects the portal's own containers; pages of a
    portal without any are read like pages of no portal."""
    own = pages.select(pages[id_col].cast("long").alias("page_id"), pages[html_col].alias("html"),
                       (F.lit(None).cast("string") if portal is None else portal).alias("_portal"), *keep)
    schema = T.StructType(PAGE_SCHEMA.fields + [own.schema[c] for c in keep])
    names = [f.name for f in PAGE_SCHEMA.fields]
    made = _arrow(PAGE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, 1):
            rows = [_page_row(*r) for r in zip(*(part.column(k).to_pylist() for k in range(3)))]
            arrays = [pa.array([r[n] for r in rows], made.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(arrays + [part.column(3 + k) for k in range(len(keep))], [*names, *keep])

    return own.mapInArrow(run, schema)


# --- cards ---------------------------------------------------------------------

CARD_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("portal", T.StringType()),
    T.StructField("card_no", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("price_m2", T.StringType()),
    T.StructField("area", T.StringType()),
    T.StructField("rooms", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("heads", T.ArrayType(T.StringType())),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("details", T.ArrayType(T.StringType())),
    T.StructField("card_text", T.StringType()),
])


def _value(card: H.Node, field: R.Field):
    if field.read == R.TEXT:
        found = R.first(card, field.selectors)
        return found.text("", True) if found is not None else None
    sep = " " if field.read == R.VALUES else ""
    return [n.text(sep, True) for n in R.every(card, field.selectors)]


def _card_rows(root: H.Node, rules: R.Cards) -> Iterator[dict]:
    """A page's cards that have a link, by the portal's table; of the cards of one
    link the first (W2: promoted results are on the page twice)."""
    seen = set()
    for card in R.every(root, rules.cards):
        itself = any(R.steps(s)[-1](card) for s in rules.link)
        link = card if itself else R.first(card, rules.link)
        href = link.get("href") if link is not None else None
        if not href or href.split("?")[0] in seen:
            continue
        seen.add(href.split("?")[0])
        row = {f.name: _value(card, f) for f in rules.fields}
        yield {**row, "href": href, "card_no": len(seen) - 1, "card_text": card.text(" ", True)}


def card_fields(pages: DataFrame, portal: str, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per link on each page (its first card), with raw field text.
    ``portal``: the id prefix of the pages' portal. Null html gives no row."""
    rules = R.CARDS[portal]
    made = _arrow(CARD_SCHEMA)

    def batch(ids: pa.Array, columns: dict[str, list]) -> pa.RecordBatch:
        columns |= {"page_id": ids, "portal": pa.repeat(portal, len(ids))}
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(ids), f.type) for f in made],
            schema=made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches, 1):
            part = part.filter(part.column(1).is_valid())
            ids, html = part.column(0), part.column(1)
            at, columns, others = B.cards(html, portal)
            if at:
                yield batch(ids.take(pa.array(at)), columns)
            found = [(k, row) for k in others for row in _card_rows(H.parse(html[k].as_py()), rules)]
            if found:
                yield batch(ids.take(pa.array([k for k, _ in found])), {n: [r[n] for _, r in found] for n in found[0][1]})

    return pages.select(pages[id_col].cast("long").alias("page_id"),
                        pages[html_col].alias("html")).mapInArrow(run, CARD_SCHEMA)
