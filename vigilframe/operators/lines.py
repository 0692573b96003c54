"""Documents as lines: block openers, carried entities, measure tags, take-until."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.html import once
from vigilframe.functions.names import fold_name
from vigilframe.operators.carry import BLOCK_ROWS, carry_before, carry_forward

Measures = Sequence[tuple[str, str]]


def document_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """S-05: (doc, pos, line) of whole texts; map-side only."""
    return docs.select(doc, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))


def page_lines(
    pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text", *, separator: str = "\n"
) -> DataFrame:
    """S-05 for documents that come as pages: (doc, pos, line), ``pos`` growing in reading order.

    With a newline between pages (the default) each page is cut by itself.  With nothing between
    them (``''``) the last line of a page and the first of the next are one line.  A document's
    pages are never gathered: a line is put together from its own pieces only.
    """
    if separator not in ("", "\n"):
        raise ValueError("pages are joined by a newline or by nothing")
    numbered = pages.select(doc, F.col(page).cast("long").alias("__page"), F.split(text, "\n", -1).alias("__pieces"))
    pieces = numbered.select(doc, "__page", F.posexplode("__pieces").alias("__p", "line"))
    own = _reading_order(F.col("__page"), F.col("__p"))
    if separator == "\n":
        return pieces.select(doc, own.alias("pos"), "line")
    # A page's first piece continues the line that the last newline before the page has started;
    # pages without a newline only pass it on.
    last = F.size("__pieces") - 1
    starts = numbered.select(
        doc, "__page", F.when(last > 0, _reading_order(F.col("__page"), last)).alias("__opened")
    )
    starts = carry_before(starts, [doc], "__page", "__opened", "__start", rows=BLOCK_ROWS, depth=1)
    first = pieces.where(F.col("__p") == 0).join(starts.drop("__opened"), [doc, "__page"])
    first = first.select(doc, F.coalesce("__start", F.lit(0).cast("long")).alias("pos"), "__page", "line")
    rest = pieces.where(F.col("__p") > 0).select(doc, own.alias("pos"), "__page", "line")
    parts = F.array_sort(F.collect_list(F.struct("__page", "line")))
    whole = first.unionByName(rest).groupBy(doc, "pos").agg(parts.alias("__parts"))
    return whole.select(doc, "pos", F.array_join(F.col("__parts.line"), "").alias("line"))


def _reading_order(page: Column, line: Column) -> Column:
    """One long that orders lines by page, then by line; pages are numbered from 1."""
    return (page * F.lit(1 << 32) + line).cast("long")


def measure_mask(text: Column, measures: Measures, flags: Mapping[str, int]) -> Column:
    """X-12: bit mask of the flags whose pattern occurs in a text.

    The pattern table is a handful of constants, so it is an expression and not a join.
    """
    mask = F.lit(0).cast("long")
    for pattern, flag in measures:
        hit = F.when(text.rlike(pattern), F.lit(1 << flags[flag])).otherwise(F.lit(0)).cast("long")
        mask = mask.bitwiseOR(hit)
    return mask


def tag_measures(texts: DataFrame, keys: Sequence[str], text: str, measures: Measures) -> DataFrame:
    """X-12, A-02: (keys, flag, status) with YES when any text of the keys matches the flag.

    Every flag of the table is reported, NO included.  Masks are merged before the shuffle.
    """
    flags = {flag: i for i, flag in enumerate(dict.fromkeys(f for _, f in measures))}
    masks = texts.select(*keys, measure_mask(F.col(text), measures, flags).alias("__mask"))
    merged = masks.groupBy(*keys).agg(F.bit_or("__mask").alias("__mask"))
    rows = F.array(
        *[
            F.struct(
                F.lit(flag).alias("flag"),
                F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0, "YES").otherwise("NO").alias("status"),
            )
            for flag, i in flags.items()
        ]
    )
    return merged.select(*keys, F.inline(rows))


def attribute_lines(
    lines: DataFrame, keys: Sequence[str], pos: str, opener: Column, out: str, *, rows: int = BLOCK_ROWS, depth: int = 1
) -> DataFrame:
    """X-11: each line with the last opener at or before it; NULL before the first.

    ``opener`` is the value that a line opens a block with (NULL for other lines).  State starts
    anew in every document, and a document of any length is scanned in blocks.
    """
    marked = lines.withColumn("__opener", opener)
    carried = carry_forward(marked, keys, pos, "__opener", out, rows=rows, depth=depth)
    return carried.drop("__opener")


def attribute_doc_lines(
    docs: DataFrame, opens: Callable[[Column], Column], doc: str = "doc_id", text: str = "text", out: str = "open_pos"
) -> DataFrame:
    """X-11 for texts that are one row each: (doc, pos, line, out), without any shuffle.

    The row's lines are cut at the lines that open a block, and the pieces are unfolded.
    """
    lines = docs.select(doc, F.split(text, "\n", -1).alias("__lines"))
    opener = F.transform("__lines", lambda line, i: F.when(opens(line), i))
    lines = lines.withColumn("__open", F.array_compact(opener))
    first = F.get("__open", F.lit(0))
    head = F.when(first == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(0)))
    lines = lines.withColumn("__starts", F.concat(head, "__open"))
    blocks = F.transform(
        "__starts",
        lambda start, k: F.struct(
            start.alias("start"),
            F.slice(
                "__lines",
                start + 1,
                F.coalesce(F.get("__starts", k + 1), F.size("__lines")) - start,
            ).alias("lines"),
        ),
    )
    cut = lines.select(doc, first.alias("__first"), F.explode(blocks).alias("__block"))
    rows = cut.select(
        doc,
        F.col("__block.start").alias("__start"),
        F.when(F.col("__block.start") >= F.col("__first"), F.col("__block.start")).alias(out),
        F.posexplode("__block.lines").alias("__p", "line"),
    )
    return rows.select(doc, (F.col("__start") + F.col("__p")).alias("pos"), "line", out)


def items_until(items: Column, stops: Callable[[Column], Column]) -> Column:
    """X-06 for an array: the items before the first one that stops, all when none does."""

    def cut(all_items: Column) -> Column:
        stop = F.array_position(F.transform(all_items, lambda i: F.coalesce(stops(i), F.lit(False))), True)
        return F.when(stop > 0, F.slice(all_items, F.lit(1), (stop - 1).cast("int"))).otherwise(all_items)

    return once(items, cut)


def take_until(items: DataFrame, keys: Sequence[str], pos: str, stops: Column) -> DataFrame:
    """X-06, W-02 for a long table: rows before the first stop of their group.

    Stop positions are aggregated (one row per group, merged before the shuffle) and joined back,
    so no group is gathered in one task.
    """
    first = items.where(stops).groupBy(*keys).agg(F.min(pos).alias("__stop"))
    joined = items.join(first, list(keys), "left")
    return joined.where(F.col("__stop").isNull() | (F.col(pos) < F.col("__stop"))).select(*items.columns)


def entity_lines(
    lines: DataFrame, entities: DataFrame, measures: Measures, flags: Mapping[str, int], doc: str = "doc_id",
    raw_aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """Lines that matter to attribution: (doc, pos, entity, mask).

    A line that equals an entity opens a block; any other line counts only if a measure occurs in
    it.  All other lines are dropped here, and the text with them, before anything is sorted:
    carrying an entity over a line that says nothing has no effect.  ``entities(name)`` holds
    folded names of any length.
    """
    folded = lines.select(doc, "pos", fold_name(F.col("line"), raw_aliases).alias("line"))
    tagged = folded.select(doc, "pos", "line", measure_mask(F.col("line"), measures, flags).alias("mask"))
    names = entities.select(F.col("name").alias("entity")).distinct()
    joined = tagged.where(F.col("line") != "").join(names, F.col("line") == F.col("entity"), "left")
    return joined.where(F.col("entity").isNotNull() | (F.col("mask") != 0)).select(
        doc, "pos", "entity", F.when(F.col("entity").isNull(), F.col("mask")).otherwise(F.lit(0).cast("long")).alias("mask")
    )


def entity_measures(
    lines: DataFrame, entities: DataFrame, measures: Measures, doc: str = "doc_id",
    raw_aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """X-11, X-12, A-01: (name, flag, status) of every entity that opens a block anywhere.

    A flag is YES when a line of any of the entity's blocks, in any document, matches; else NO.
    """
    flags = {flag: i for i, flag in enumerate(dict.fromkeys(f for _, f in measures))}
    marked = entity_lines(lines, entities, measures, flags, doc, raw_aliases)
    carried = carry_forward(marked, [doc], "pos", "entity", "name")
    merged = (
        carried.where(F.col("name").isNotNull()).groupBy("name").agg(F.bit_or("mask").alias("__mask"))
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(flag).alias("flag"),
                F.when(F.col("__mask").bitwiseAND(F.lit(1 << i)) != 0, "YES").otherwise("NO").alias("status"),
            )
            for flag, i in flags.items()
        ]
    )
    return merged.select("name", F.inline(rows))
