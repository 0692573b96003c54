"""Matching register rows to listings: membership, look-ups, theta matches, page addresses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.functions.names import quote_norm


def register_names(register: DataFrame, name: str) -> DataFrame:
    """S-02, F-01: the one name column; the scan reads nothing else."""
    return register.select(name)


def where_name(register: DataFrame, column: str, name: str) -> DataFrame:
    """F-02: rows with a name; the predicate reaches the scan."""
    return register.where(F.col(column) == name)


def members(register: DataFrame, listing: DataFrame, on: str, name: str = "name") -> DataFrame:
    """J-01, F-03: register rows whose name is listed."""
    listed = listing.select(F.col(name).alias(on)).distinct()
    return register.join(listed, on, "left_semi")


def non_members(register: DataFrame, listing: DataFrame, on: str, name: str = "name") -> DataFrame:
    """J-02, F-04: register rows whose name is known and not listed; NULL names are left out."""
    listed = listing.select(F.col(name).alias(on)).distinct()
    return register.where(F.col(on).isNotNull()).join(listed, on, "left_anti")


def status_for_all(
    register: DataFrame, listing: DataFrame, on: str, name: str = "name", status: str = "status"
) -> DataFrame:
    """J-03: every register row with YES when its name is listed and NO otherwise."""
    listed = listing.select(F.col(name).alias(on)).distinct().withColumn("__hit", F.lit(True))
    joined = register.join(listed, on, "left")
    return joined.select(*register.columns, F.when(F.col("__hit"), "YES").otherwise("NO").alias(status))


def split_matched(listing: DataFrame, register: DataFrame, on: str, name: str = "name") -> tuple[DataFrame, DataFrame]:
    """F-05: listed names that the register knows, and those it does not.

    The register is reduced to listed names first (its large side is then only streamed past the
    listing); the difference is taken between two tables no larger than the listing.
    """
    listed = listing.select(name).distinct()
    known = register.select(F.col(on).alias(name)).join(listed, name, "left_semi").distinct()
    return listed.join(known, name, "left_semi"), listed.join(known, name, "left_anti")


def unmatched_names(listing: DataFrame, register: DataFrame, on: str, name: str = "name") -> DataFrame:
    """F-05: report of listed names that no register row has."""
    return split_matched(listing, register, on, name)[1]


def current_flags(register: DataFrame, names: DataFrame, on: str, flags: Sequence[str], name: str = "name") -> DataFrame:
    """S-03: current flags of all asked names in one join."""
    asked = names.select(F.col(name).alias("__asked")).distinct()
    known = register.select(quote_norm(F.col(on)).alias(name), *flags)
    return known.join(asked, F.col(name) == F.col("__asked"), "left_semi")


def name_keys(register: DataFrame, key: str, keys: Sequence[tuple[str, Column]]) -> DataFrame:
    """Long table (key, kind, name) of every form of name a register row is matched by.

    Only the key and the names are read.  Rows without a name of some kind have no entry, so a
    large share of NULL names never meets in one shuffle partition.
    """
    forms = F.array(*[F.struct(F.lit(kind).alias("kind"), c.alias("name")) for kind, c in keys])
    long = register.select(F.col(key), F.inline(forms))
    return long.where(F.col("name").isNotNull())


def resolve_hits(keys: DataFrame, masks: DataFrame, key: str) -> DataFrame:
    """Listing masks per register key: ``(key, yes, seen)`` for rows that are listed at all.

    ``keys`` is the table of ``name_keys``, ``masks`` one row per (kind, name).  A row listed
    under several of its names is merged.  Inner join on the slim table: nothing is shuffled when
    the listing is small, and AQE splits hot names when it is not.
    """
    hits = keys.join(masks, ["kind", "name"])
    return hits.groupBy(key).agg(F.bit_or("yes").alias("yes"), F.bit_or("seen").alias("seen"))


def pattern_keys(name: Column, patterns: Mapping[str, str]) -> list[Column]:
    """J-04: the listed names that a register name matches, one column each, NULL for no match.

    A listed name in ``patterns`` is matched by its regular expression only, all others by
    equality.  The theta join thus becomes an equi join on a derived key.
    """
    own = F.when(~name.isin(*patterns), name) if patterns else name
    return [own, *[F.when(name.rlike(p), F.lit(listed)) for listed, p in patterns.items()]]


def match_names(
    register: DataFrame, listing: DataFrame, key: str, on: str, patterns: Mapping[str, str], name: str = "name"
) -> DataFrame:
    """J-04: register keys matched by equality or by the pattern of a special listed name."""
    keys = F.array_compact(F.array(*pattern_keys(F.col(on), patterns)))
    candidates = register.select(key, F.explode(keys).alias(name))
    listed = listing.select(name).distinct()
    return candidates.join(listed, name, "left_semi").select(key).distinct()


def reachable(register: DataFrame, links: DataFrame, slug: Column, base: str = "", link: str = "link") -> DataFrame:
    """J-05: register rows whose page address is among extracted links."""
    wanted = links.select(F.col(link).alias("__url")).distinct()
    addressed = register.withColumn("__url", F.concat(F.lit(base), slug))
    return addressed.join(wanted, "__url", "left_semi").drop("__url")


def attach_page(register: DataFrame, pages: DataFrame, slug: Column, base: str = "", url: str = "url") -> DataFrame:
    """J-06: each register row with the columns of its page; a missing page leaves them NULL."""
    addressed = register.withColumn("__url", F.concat(F.lit(base), slug))
    landed = pages.withColumnRenamed(url, "__url")
    return addressed.join(landed, "__url", "left").drop("__url")


def before_after(before: DataFrame, after: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """J-09, J-10: two snapshots side by side, ``old`` and ``new`` structs per key."""
    old = before.select(on, F.struct(*columns).alias("old"))
    new = after.select(on, F.struct(*columns).alias("new"))
    return old.join(new, on)
