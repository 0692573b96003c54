"""Listings: long tables of (source, name, flag, status) and what is counted over them.

Memberships travel as bit masks: bit ``i`` of ``yes`` is set when flag ``i`` is YES for the name,
bit ``i`` of ``seen`` when the listing mentions it at all.  One hash aggregate with two long
buffers replaces an 18-way pivot, and partial aggregation absorbs names that occur millions of
times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.operators.ladder import quoted
from vigilframe.schema import FLAGS

LISTING_COLUMNS = ("source", "name", "flag", "status")


def apply_aliases(names: DataFrame, aliases: DataFrame, *, name: str = "name", source: str = "source") -> DataFrame:
    """N-16: published names to register names, identity by default.

    ``aliases(source, from_name, to_name)`` is joined on source and name; two alias rows with one
    published name give two rows.  No join hint: Spark broadcasts the alias table when its size
    allows and shuffles otherwise.
    """
    alias = aliases.select(
        F.col("source").alias("__source"), F.col("from_name").alias("__from"), "to_name"
    ).distinct()
    matched = names.join(
        alias, (F.col(source) == F.col("__source")) & (F.col(name) == F.col("__from")), "left"
    )
    resolved = F.coalesce("to_name", name).alias(name)
    return matched.select(*[resolved if c == name else F.col(c) for c in names.columns])


def map_names(name: Column, mapping: Mapping[str, str]) -> Column:
    """N-16 for a handful of one-to-one constants: a CASE expression, no join."""
    mapped = name
    for old, new in reversed(mapping.items()):
        mapped = F.when(name == old, F.lit(new)).otherwise(mapped)
    return mapped


def distinct_names(listing: DataFrame, *columns: str) -> DataFrame:
    """A-03: distinct names; a listing must be distinct before it is joined."""
    return listing.select(*(columns or ("name",))).distinct()


def bit(flag_no: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), flag_no.cast("int"))


def flag_number(flag: Column, flags: Sequence[str] = FLAGS) -> Column:
    """Position of a flag name, NULL for an unknown one."""
    position = F.array_position(F.split(F.lit(",".join(flags)), ","), flag).cast("int")
    return F.when(position > 0, position - 1)


def mask_of(flag: Column, flags: Sequence[str] = FLAGS) -> Column:
    return bit(flag_number(flag, flags))


def or_merge(listing: DataFrame, keys: Sequence[str] = ("name", "flag"), status: str = "status") -> DataFrame:
    """A-01: YES when any row of a (name, flag) says YES."""
    merged = listing.groupBy(*keys).agg(F.bool_or(F.col(status) == "YES").alias("__yes"))
    return merged.select(*keys, F.when(F.col("__yes"), "YES").otherwise("NO").alias(status))


def listing_masks(listing: DataFrame, keys: Sequence[str], flags: Sequence[str] = FLAGS) -> DataFrame:
    """One row per name with its ``yes`` and ``seen`` masks: A-01, A-03 and A-04 in one aggregate."""
    marked = listing.select(*keys, mask_of(F.col("flag"), flags).alias("__bit"), "status")
    yes = F.when(F.col("status") == "YES", F.col("__bit"))
    return marked.groupBy(*keys).agg(
        F.coalesce(F.bit_or(yes), F.lit(0).cast("long")).alias("yes"),
        F.coalesce(F.bit_or("__bit"), F.lit(0).cast("long")).alias("seen"),
    )


def has_bit(mask: str, flag_no: int) -> str:
    """SQL condition: a flag's bit is set in a mask."""
    return f"({mask} & {1 << flag_no}L) <> 0"


def unpack_flags(masks: DataFrame, keys: Sequence[str], flags: Sequence[str], *, mask: str = "yes") -> DataFrame:
    """Mask to one YES/NO column per flag."""
    columns = [f"if({has_bit(mask, i)}, 'YES', 'NO') as {quoted(flag)}" for i, flag in enumerate(flags)]
    return masks.selectExpr(*[quoted(k) for k in keys], *columns)


def listing_pivot(listing: DataFrame, flags: Sequence[str] = FLAGS, keys: Sequence[str] = ("name",)) -> DataFrame:
    """A-04: one row per name, one YES/NO column per flag, NO by default."""
    return unpack_flags(listing_masks(listing, keys, flags), keys, flags)


def listing_rows(wide: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """One row per (row, flag) of a wide register: the inverse of ``listing_pivot``."""
    return wide.unpivot(list(keys), list(flags), "flag", "status")


def names_per_flag(listing: DataFrame) -> DataFrame:
    """A-05: every distinct name under a flag, with the number of names under that flag.

    One row per name instead of one list per flag: a list would have to fit one row of one task.
    Counts are one row per flag, and flags are columns of the register (64 at most): they are
    broadcast, so that names aren't shuffled by a few hot flags.
    """
    names = listing.select("flag", "name").distinct()
    counts = F.broadcast(listing_counts(names))
    return names.join(counts, "flag").select("flag", "n_names", "name")


def listing_counts(names: DataFrame) -> DataFrame:
    """A-08: number of names per flag of a distinct listing (one row per flag)."""
    return names.groupBy("flag").agg(F.count("name").alias("n_names"))


def flag_summary(register: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """F-06: rows whose flag is YES, one row per flag and entity."""
    listed = listing_rows(register, keys, flags)
    return listed.where(F.col("status") == "YES").select("flag", *keys)


def union_listings(*listings: DataFrame) -> DataFrame:
    """O-01: all rows of several listings."""
    first, *rest = listings
    for listing in rest:
        first = first.unionByName(listing)
    return first


def common_names(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("name",)) -> DataFrame:
    """O-02: names in both listings; one aggregate over the union, no join."""
    both = left.select(*keys, F.lit(1).alias("__side")).unionByName(
        right.select(*keys, F.lit(2).alias("__side"))
    )
    sides = both.groupBy(*keys).agg(F.bit_or("__side").alias("__sides"))
    return sides.where(F.col("__sides") == 3).select(*keys)


def dedupe_last_wins(df: DataFrame, key: Column, order: str, *, key_name: str = "name") -> DataFrame:
    """A-09: per folded key the greatest order value; partial aggregation, no window."""
    return df.groupBy(key.alias(key_name)).agg(F.max(order).alias(order))


def latest_snapshot(df: DataFrame, keys: Sequence[str], order: Sequence[str], as_of: Column) -> DataFrame:
    """W-03: the last row per key up to a date.

    ``order`` is the date column and tie breakers.  The winners are found by aggregating order
    columns only (each source is one row, however often it was published), then their rows are
    fetched by a semi join on key and order, so bodies are neither sorted nor grouped.
    """
    before = df.where(F.col(order[0]) <= as_of)
    last = before.groupBy(*keys).agg(F.max(F.struct(*order)).alias("__last"))
    winners = last.select(*keys, *[F.col(f"__last.{c}").alias(c) for c in order])
    return before.join(winners, [*keys, *order], "left_semi")
