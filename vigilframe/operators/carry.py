"""Prefix scans that never put one whole group into one task.

A document, conversation or register may hold a third of all rows, so an ordinary running window
over it would be one task's work.  Both scans here cut a group into blocks of the order column,
scan each block by itself, scan the far smaller table of block summaries, and add the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 1 << 16


def _block(pos: str, rows: int):
    return F.floor(F.col(pos) / F.lit(rows)).cast("long")


def carry_before(
    df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str, *, rows: int, depth: int
) -> DataFrame:
    """Adds ``out``: the last non-null value at a smaller position of the same group."""
    if depth == 0:
        window = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(window))
    block, carried = f"{pos}__block", f"{out}__carried"
    blocked = df.withColumn(block, _block(pos, rows))
    group = [*keys, block]
    set_at = F.when(F.col(value).isNotNull(), F.col(pos))
    summary = blocked.groupBy(*group).agg(F.max_by(value, set_at).alias(value))
    summary = carry_before(summary, keys, block, value, carried, rows=rows, depth=depth - 1)
    window = Window.partitionBy(*group).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    local = blocked.withColumn(out, F.last(value, ignorenulls=True).over(window))
    joined = local.join(summary.drop(value), group, "left")
    return joined.select(*df.columns, F.coalesce(out, carried).alias(out))


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    value: str,
    out: str,
    *,
    rows: int = BLOCK_ROWS,
    depth: int = 1,
) -> DataFrame:
    """W-01: adds ``out``, the last non-null value at or before each position of its group.

    Positions are non-negative integers, unique in a group.  One level of blocks keeps every
    window below ``rows`` rows, and below ``rows`` summaries, for groups of up to ``rows**2``
    (four thousand million) rows; ``depth`` adds levels beyond that.
    """
    before = carry_before(df, keys, pos, value, out, rows=rows, depth=depth)
    return before.withColumn(out, F.coalesce(value, out))


def with_dense_ids(
    df: DataFrame, key: str, ties: Sequence[str], out: str, *, start=1, rows: int = BLOCK_ROWS, levels: int = 2
) -> DataFrame:
    """A-06: consecutive ids in the order of a long key (and ties) without a global window.

    Rows of a block of ``rows`` keys are numbered by themselves; the ids before a block come from
    row counts per block, which are summed level by level, ``rows`` blocks at a time.  A key must
    have a bounded number of ties (an audited entity has at most one row per column).  ``start``
    is a number or a one-value column such as ``max(id) + 1`` of the table appended to.  ``df`` is
    read more than once: pass a stored table.
    """
    block = "__block"
    numbered = df.withColumn(block, _block(key, rows))
    sizes = numbered.groupBy(block).agg(F.count(F.lit(1)).alias("__n"))
    offsets = _offsets(sizes, block, "__n", "__before", rows=rows, levels=levels)
    local = F.row_number().over(Window.partitionBy(block).orderBy(key, *ties))
    start = F.lit(start) if isinstance(start, int) else start
    return numbered.withColumn("__row", local).join(offsets, block).select(
        (start + F.col("__before") + F.col("__row") - 1).cast("long").alias(out), *df.columns
    )


def _offsets(sizes: DataFrame, block: str, n: str, out: str, *, rows: int, levels: int) -> DataFrame:
    """Per block, the number of rows in all blocks before it."""
    preceding = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    if levels == 0:
        # With the defaults no more than 2**64 / 2**48 blocks of 64-bit keys are left here.
        one = sizes.withColumn("__all", F.lit(0)).withColumn(
            out,
            F.coalesce(F.sum(n).over(preceding.partitionBy("__all")), F.lit(0)),
        )
        return one.select(block, out)
    upper, above = f"{block}_up", f"{out}_up"
    grouped = sizes.withColumn(upper, _block(block, rows))
    sums = grouped.groupBy(upper).agg(F.sum(n).alias(n))
    tops = _offsets(sums, upper, n, above, rows=rows, levels=levels - 1)
    inside = F.coalesce(F.sum(n).over(preceding.partitionBy(upper)), F.lit(0))
    return (
        grouped.withColumn("__inside", inside)
        .join(tops, upper)
        .select(block, (F.col("__inside") + F.col(above)).alias(out))
    )
