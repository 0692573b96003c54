"""Pieces of landed web pages as Column expressions.

Pages are cut with regular expressions over the whole body: attributes may come in any order
and tags in any case; comments, scripts and style sheets are removed first.  Where an element of a
kind stands inside another of its kind, the tags of that kind become a stream with a running depth,
and each element ends at its own end tag.  Elements whose end tag may be left out (p, dd) end at
the first.  A ``>`` inside an attribute value ends the tag.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from vigilframe.functions.names import strip

NOISE = (
    r"(?is)<(?:!--.*?-->|!doctype[^>]*>|script\b[^>]*>.*?</script\s*>|style\b[^>]*>.*?</style\s*>)"
)


def drop_noise(html: Column) -> Column:
    """Remove comments, scripts and style sheets, whose text must never match."""
    return F.regexp_replace(html, NOISE, "")


def open_tag(tag: str, *, cls: str | None = None, id: str | None = None) -> str:
    """Pattern of an opening tag, optionally with a class (one of several) or an id."""
    wanted = ""
    if cls is not None:
        wanted = rf"""(?=[^>]*\sclass\s*=\s*(?:"(?:[^">]*\s)?{re.escape(cls)}[\s"]|'(?:[^'>]*\s)?{re.escape(cls)}[\s']|{re.escape(cls)}[\s>]))"""
    if id is not None:
        wanted += rf"""(?=[^>]*\sid\s*=\s*["']?{re.escape(id)}["'\s>])"""
    return rf"<{tag}(?=[\s>/]){wanted}[^>]*>"


def up_to(ends: str) -> str:
    """Group of everything before a tag (after its ``<``) that matches ``ends``, or to the end.

    Possessive, so it runs in one pass without backtracking or recursion on pages of any size.
    """
    return rf"((?:[^<]++|<(?!{ends}))*+)"


def _nested(tag: str) -> str:
    """Pattern of an element that opens within another of its kind."""
    return rf"(?i)<{tag}(?=[\s>/])(?:[^<]++|<(?!/?{tag}[\s>/]))*+<{tag}[\s>/]"


def _holding(tag: str, container: str) -> str:
    """Pattern of an item or cell that a container opens in."""
    return rf"(?i)<{tag}(?=[\s>/])(?:[^<]++|<(?!/?(?:{tag}|{container})[\s>/]))*+<{container}[\s>/]"


_MARKS = "array<struct<depth:int,at:int,size:int,opens:boolean>>"


def _tag_marks(html: Column, tag: str) -> Column:
    """Tags of a kind with their depth, place and size.  End tags without a beginning are left out."""
    pieces = F.split(html, rf"(?i)(?=</?{tag}[\s>/])", -1)
    start = F.struct(F.lit(1).alias("at"), F.lit(0).alias("depth"), F.array().cast(_MARKS).alias("marks"))

    def step(state: Column, piece: Column) -> Column:
        depth, marks = state["depth"], state["marks"]
        # An empty element in one tag opens nothing.
        opens = piece.rlike(rf"(?i)^<{tag}[\s>/]") & ~piece.rlike(r"^<[^>]*/>")
        ends = piece.rlike(rf"(?i)^</{tag}[\s>/]") & (depth > 0)
        size = F.length(F.regexp_extract(piece, "^<[^>]*>", 0))
        at_depth = F.when(opens, depth).otherwise(depth - 1)
        mark = F.struct(at_depth.alias("depth"), state["at"].alias("at"), size.alias("size"), opens.alias("opens"))
        return F.struct(
            (state["at"] + F.length(piece)).alias("at"),
            F.when(opens, depth + 1).when(ends, depth - 1).otherwise(depth).alias("depth"),
            F.when(opens | ends, F.array_append(marks, mark)).otherwise(marks).alias("marks"),
        )

    return F.aggregate(pieces, start, step, lambda state: state["marks"])


def balanced(html: Column, tag: str, *, cls: str | None = None) -> Column:
    """As ``elements``, at all depths: each element ends at its own end tag, or with the page.

    In order of depth, an element's beginning and end are neighbours.
    """

    def spans(marks: Column) -> Column:
        def span(mark: Column, i: Column) -> Column:
            following = F.get(marks, i + 1)
            closed = ~following["opens"] & (following["depth"] == mark["depth"])
            end = F.when(closed, following["at"]).otherwise(F.length(html) + 1)
            inner = mark["at"] + mark["size"]
            return F.when(mark["opens"], F.struct(mark["at"].alias("at"), inner.alias("inner"), end.alias("end")))

        return F.array_sort(F.array_compact(F.transform(marks, span)))

    found = once(F.array_sort(_tag_marks(html, tag)), spans)
    if cls is not None:
        wanted = "(?i)^" + open_tag(tag, cls=cls)
        found = F.filter(found, lambda s: F.substr(html, s["at"], s["inner"] - s["at"]).rlike(wanted))
    return F.transform(found, lambda s: F.substr(html, s["inner"], s["end"] - s["inner"]))


# Elements whose end tag may be left out: the next one of the kind doesn't stand inside them.
_OPTIONAL_END = ("p", "li", "dd", "dt")


def elements(html: Column, tag: str, *, cls: str | None = None) -> Column:
    """Array of the inner HTML of every such element, at any depth, in document order."""
    end = rf"/{tag}\s*>"
    pattern = F.lit(rf"(?is){open_tag(tag, cls=cls)}{up_to(end)}<{end}")

    def found(page: Column) -> Column:
        flat = F.regexp_extract_all(page, pattern, F.lit(1))
        return F.when(page.rlike(_nested(tag)), balanced(page, tag, cls=cls)).otherwise(flat)

    return F.regexp_extract_all(html, pattern, F.lit(1)) if tag in _OPTIONAL_END else once(html, found)


# Tags whose end tag may be left out, and the containers that close them.
_CONTAINERS = {"li": "ul|ol|menu", "tr": "table|tbody|thead|tfoot", "td": "tr|table|tbody"}
# Containers that start anew inside an item or cell.
_INSIDE = {"li": "(?:ul|ol|menu)", "tr": "table", "td": "table"}


def _cell(tag: str) -> str:
    end = rf"/(?:{tag}|{_CONTAINERS[tag]})\s*>|{tag}[\s>/]"
    return rf"(?is){open_tag(tag)}{up_to(end)}"


def cells(html: Column, tag: str) -> Column:
    """As ``elements`` for rows, cells and list items, whose end tag may be left out.

    Where one holds a table or list of its own, all of them end at their own end tags.
    """

    def found(page: Column) -> Column:
        flat = F.regexp_extract_all(page, F.lit(_cell(tag)), F.lit(1))
        return F.when(page.rlike(_holding(tag, _INSIDE[tag])), balanced(page, tag)).otherwise(flat)

    return once(html, found)


def first_cell(html: Column, tag: str = "td") -> Column:
    """The first of ``cells``, empty when there is none."""

    def found(page: Column) -> Column:
        inside = F.coalesce(F.get(balanced(page, tag), F.lit(0)), F.lit(""))
        return F.when(page.rlike(_holding(tag, _INSIDE[tag])), inside).otherwise(F.regexp_extract(page, _cell(tag), 1))

    return once(html, found)


def first_element(html: Column, tag: str, *, cls: str | None = None) -> Column:
    """Inner HTML of the first such element, NULL when there is none."""
    end = rf"/{tag}\s*>"
    pattern = rf"(?is){open_tag(tag, cls=cls)}{up_to(end)}"

    def found(page: Column) -> Column:
        inside = F.get(balanced(page, tag, cls=cls), F.lit(0))
        return F.when(page.rlike(_nested(tag)), inside).otherwise(_first_group(page, pattern))

    return _first_group(html, pattern) if tag in _OPTIONAL_END else once(html, found)


def _first_group(html: Column, pattern: str) -> Column:
    """First group of a pattern's first match, NULL (not empty) when it does not match.

    The argument is written once, so long chains of these stay short expressions.
    """
    return F.regexp_extract(F.regexp_substr(html, F.lit(pattern)), pattern, 1)


def after(html: Column, anchor: str) -> Column:
    """Everything after the first match of an anchor pattern, NULL when it does not occur."""
    return _first_group(html, rf"(?is){anchor}(.*)")


def after_element(html: Column, tag: str, text: str, *, cls: str | None = None, part: bool = False) -> Column:
    """Everything after the first element whose text is ``text`` (any case), or contains it when ``part``.

    Texts are compared as they are read: without tags, references decoded.  NULL when there is none.
    """
    wanted = text.lower()
    # What stands between the last tag that opens such an element and its end tag.
    content = rf"(?is){open_tag(tag, cls=cls)}((?:[^<]++|<(?!{tag}[\s>/]))*+)$"

    def is_it(piece: Column) -> Column:
        own = F.lower(plain_text(F.regexp_extract(piece, content, 1)))
        return own.contains(wanted) if part else own == wanted

    def rest(pieces: Column) -> Column:
        # The last piece has no end tag.
        n = F.size(pieces)
        hits = F.transform(F.slice(pieces, F.lit(1), n - 1), is_it)
        after_it = lambda i: F.when(i > 0, F.array_join(F.slice(pieces, i.cast("int") + 1, n), f"</{tag}>"))
        return once(F.coalesce(F.array_position(hits, True), F.lit(0)), after_it)

    return once(F.split(html, rf"(?i)</{tag}\s*>", -1), rest)


_ENTITY_TEXT = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}


def decode_entities(text: Column) -> Column:
    """Named and numeric character references to characters; anything else stays as written."""
    # Two literals that Spark folds to one constant map; no reference stands for a plain space.
    names = F.map_from_arrays(
        F.split(F.lit(" ".join(_ENTITY_TEXT)), " "), F.split(F.lit(" ".join(_ENTITY_TEXT.values())), " ")
    )

    reference = r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[0-9a-zA-Z]{2,8});"
    pieces = F.transform(
        F.split(text, "&", -1),
        lambda p, i: F.struct(
            p.alias("text"), F.when(i > 0, F.regexp_extract(p, reference, 1)).otherwise(F.lit("")).alias("ref"), i.alias("i")
        ),
    )

    def character(ref: Column) -> Column:
        digits = F.when(ref.rlike("^#[xX]"), F.conv(F.substr(ref, F.lit(3)), 16, 10)).otherwise(F.substr(ref, F.lit(2)))
        code = F.when(ref.startswith("#"), digits).cast("long")
        valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        numeric = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.coalesce(numeric, F.try_element_at(names, ref))

    def decoded(piece: Column) -> Column:
        ref, own = piece["ref"], piece["text"]
        char = F.when(ref != "", F.concat(character(ref), F.substr(own, F.length(ref) + F.lit(2))))
        return F.when(piece["i"] == 0, own).otherwise(F.coalesce(char, F.concat(F.lit("&"), own)))

    return F.array_join(F.transform(pieces, decoded), "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# The references nearly all text is content with, ``&amp;`` last so that nothing is decoded twice.
_COMMON = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "amp": "&"}
_UNCOMMON = rf"&(?!(?:{'|'.join(_COMMON)});)[#0-9A-Za-z]"


def _decoded(text: Column) -> Column:
    """``decode_entities`` that pays only for what a text contains; names its argument often."""
    simple = text
    for name, char in _COMMON.items():
        simple = F.replace(simple, F.lit(f"&{name};"), F.lit(char))
    return (
        F.when(~text.contains("&"), text).when(text.rlike(_UNCOMMON), decode_entities(text)).otherwise(simple)
    )


def plain_text(html: Column) -> Column:
    """Text of an HTML fragment: tags removed, references decoded."""
    return once(F.regexp_replace(html, r"<[^>]*+>", ""), _decoded)


def inner_text(html: Column) -> Column:
    """``plain_text`` without white space at its ends."""
    return strip(plain_text(html))


def attribute_values(html: Column, tag: str, attribute: str) -> Column:
    """Array of one attribute's values over all tags of a kind that carry it."""
    pattern = rf"""(?is)<{tag}(?=\s)[^>]*?\s{attribute}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    whole = F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    value = rf"""(?is)\s{attribute}\s*=\s*["']?(.*?)["']?$"""
    return F.transform(whole, lambda t: decode_entities(F.regexp_extract(t, value, 1)))
