"""Extraction jobs: landed pages to rows.  Each takes any number of pages and is map-side only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.functions import html as H
from vigilframe.operators.lines import items_until


def _unfold(pages: DataFrame, keys: Sequence[str], items: Column, item: str) -> DataFrame:
    return pages.select(*keys, F.posexplode(items).alias("pos", item))


def _clean(body: str) -> Column:
    return H.drop_noise(F.col(body))


def first_cells(rows_html: Column) -> Column:
    """Text of the first data cell of every table row that has data cells."""
    rows = F.filter(H.cells(rows_html, "tr"), lambda r: r.rlike(r"(?i)<td[\s>/]"))
    return F.transform(rows, lambda r: H.inner_text(H.first_cell(r)))


def first_column(
    pages: DataFrame,
    keys: Sequence[str],
    *,
    table_class: str | None = None,
    after_header: str | None = None,
    body: str = "body",
) -> DataFrame:
    """X-01, X-02: (keys, pos, name) of the first column of one table per page.

    The first table of a class, or the first table body after a header cell that contains a text
    (any case).  Rows with header cells only have no first data cell and are left out.
    """
    clean = _clean(body)
    if after_header is not None:
        rest = H.after_element(clean, "th", after_header, part=True)
        table = H.first_element(rest, "tbody")
    else:
        table = H.first_element(clean, "table", cls=table_class)
    return _unfold(pages, keys, first_cells(table), "name")


def definition(html: Column, label: str) -> Column:
    """X-03: struct (has_term, value) of a term/definition pair.

    ``has_term``: the term occurs; ``value``: text of the first definition after it, NULL when
    there is none.
    """
    rest = H.after_element(html, "dt", label)
    return F.struct(
        rest.isNotNull().alias("has_term"), H.inner_text(H.first_element(rest, "dd")).alias("value")
    )


def definitions(pages: DataFrame, keys: Sequence[str], labels: dict[str, str], *, body: str = "body") -> DataFrame:
    """X-03: pages with one ``definition`` struct per output column (``{column: term}``)."""
    clean = pages.select(*keys, _clean(body).alias("__html"))
    return clean.select(*keys, *[definition(F.col("__html"), t).alias(c) for c, t in labels.items()])


def bold_headings(pages: DataFrame, keys: Sequence[str], tag: str = "h3", *, body: str = "body") -> DataFrame:
    """X-04: bold text of every heading that has some."""
    bold = F.transform(H.elements(_clean(body), tag), lambda h: H.inner_text(H.first_element(h, "b")))
    return _unfold(pages, keys, F.array_compact(bold), "name")


def paragraph_after(
    pages: DataFrame, keys: Sequence[str], tag: str, text: str, *, cls: str | None = None, body: str = "body"
) -> DataFrame:
    """X-05: text of the first paragraph after the first heading with exactly this text."""
    rest = H.after_element(_clean(body), tag, text, cls=cls)
    found = pages.select(*keys, H.inner_text(H.first_element(rest, "p")).alias("text"))
    return found.where(F.col("text").isNotNull())


def bold_spans(html: Column, p_class: str, bold_class: str) -> Column:
    """X-07: array of the first bold span of every paragraph of a class that has one."""
    spans = F.transform(
        H.elements(html, "p", cls=p_class),
        lambda p: H.inner_text(H.first_element(p, "span", cls=bold_class)),
    )
    return F.array_compact(spans)


def bold_items(
    pages: DataFrame,
    keys: Sequence[str],
    p_class: str,
    bold_class: str,
    *,
    anchor_id: str | None = None,
    stop: str | None = None,
    body: str = "body",
) -> DataFrame:
    """X-06, X-07: bold spans of paragraphs, after an anchor paragraph, until one contains ``stop``."""
    html = _clean(body)
    if anchor_id is not None:
        html = H.after(html, H.open_tag("p", id=anchor_id))
    items = bold_spans(html, p_class, bold_class)
    if stop is not None:
        items = items_until(items, lambda i: i.contains(stop))
    return _unfold(pages, keys, items, "text")


def links(pages: DataFrame, keys: Sequence[str], *, after: tuple[str, str] | None = None, body: str = "body") -> DataFrame:
    """X-08: link targets of whole pages, or of the paragraph after a heading.

    ``after`` is (heading tag, text it contains).
    """
    html = _clean(body)
    if after is not None:
        tag, text = after
        html = H.first_element(H.after_element(html, tag, text, part=True), "p")
    return _unfold(pages, keys, H.attribute_values(html, "a", "href"), "href")


def list_items(pages: DataFrame, keys: Sequence[str], *, body: str = "body") -> DataFrame:
    """X-09 without its anchors: text of every list item."""
    items = F.transform(H.cells(_clean(body), "li"), H.inner_text)
    return _unfold(pages, keys, items, "text")


def _lists_after(section: Column, phrase: str) -> Column:
    """Item texts of the first list after each heading of a section that contains a phrase."""

    def found(pieces: Column) -> Column:
        def items(piece: Column, i: Column) -> Column:
            # A piece starts inside a heading tag; what follows the heading may span later pieces.
            opened = F.regexp_extract(piece, r"(?is)^(.*?)</h[1-6]\s*>", 1)
            heading = H.inner_text(F.concat(F.lit("<h"), opened))
            rest = F.array_join(F.slice(pieces, i + 1, F.size(pieces)), "<h")
            listed = H.first_element(F.regexp_extract(rest, r"(?is)^.*?</h[1-6]\s*>(.*)", 1), "ul")
            return F.when((i > 0) & heading.contains(phrase), H.cells(listed, "li"))

        return F.flatten(F.array_compact(F.transform(pieces, items)))

    pieces = F.split(section, r"(?i)<h[1-6](?=[\s>])", -1)
    return F.transform(H.once(pieces, found), H.inner_text)


def list_items_after(
    pages: DataFrame, keys: Sequence[str], section_class: str, phrase: str, *, body: str = "body"
) -> DataFrame:
    """X-09: items of the list that follows a heading (h1 to h6) with a phrase, in sections of a class."""
    sections = pages.select(
        *keys, F.posexplode(H.elements(_clean(body), "section", cls=section_class)).alias("section", "__html")
    )
    items = _lists_after(F.col("__html"), phrase)
    return sections.select(*keys, "section", F.posexplode(items).alias("pos", "text"))


def link_titles(pages: DataFrame, keys: Sequence[str], block_class: str, contains: str, *, body: str = "body") -> DataFrame:
    """X-10: text of the first link of every block of a class, if it contains a phrase."""
    titles = F.transform(
        H.elements(_clean(body), "div", cls=block_class), lambda d: H.inner_text(H.first_element(d, "a"))
    )
    return _unfold(pages, keys, F.filter(titles, lambda t: t.contains(contains)), "text")
