"""Update policies: how a listing changes the three-state flags of a register.

All flags are set in one pass over the register.  A row's memberships arrive as two bit masks
(``operators.listing``), joined once by register key; "is there anything listed at all" and "did
any register row match" are one-row aggregates used as scalar subqueries, so nothing is decided
on the driver and no row is cross joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe import schema as S
from vigilframe.operators.ladder import flag_mask, quoted
from vigilframe.operators.listing import has_bit, listing_masks
from vigilframe.schema import FLAGS, RegisterLayout


@dataclass(frozen=True)
class Policy:
    """How one flag reacts to its listing.

    ``kind`` is U-1 ... U-5; ``name`` says which of the register's names decides "name unknown";
    ``require_match`` also wants a matching register row before anything is set to NO.
    """

    kind: str
    name: str = "eng"
    require_match: bool = False


U1, U2, U3, U4, U5 = "U-1", "U-2", "U-3", "U-4", "U-5"

# The policy of every flag.
POLICIES: dict[str, Policy] = {
    **{flag: Policy(U5, "fr") for flag in S.FR_MEASURE_FLAGS},
    **{flag: Policy(U4) for flag in S.EU_MEASURE_FLAGS},
    S.EU_AML: Policy(U1),
    S.US_PROGRAMMES: Policy(U3),
    S.FATF_CALL: Policy(U1),
    S.FATF_MONITORING: Policy(U2),
    S.EU_TAX: Policy(U3),
    S.FR_TAX: Policy(U2, "fr", require_match=True),
    S.UK: Policy(U2, require_match=True),
}


def _flags_where(policies: Mapping[str, Policy], layout: RegisterLayout, test) -> str:
    """SQL literal: the bits of all flags whose policy passes a test."""
    return f"{sum(1 << layout.number(flag) for flag, policy in policies.items() if test(policy))}L"


def active_flags(
    policies: Mapping[str, Policy], layout: RegisterLayout, masks: DataFrame, hits: DataFrame
) -> Column:
    """One value, by scalar subquery: the flags that anything happens to.

    That is a flag whose list is not empty; for U-4, and where a policy asks for it, one that
    some register row was found for.
    """
    falling = _flags_where(policies, layout, lambda p: p.kind == U4)
    by_list = _flags_where(policies, layout, lambda p: p.kind != U4 and not p.require_match)
    by_both = _flags_where(policies, layout, lambda p: p.kind != U4 and p.require_match)
    seen = masks.selectExpr("seen as listed", "0L as matched")
    if (falling, by_both) != ("0L", "0L"):
        seen = seen.unionByName(hits.selectExpr("0L as listed", "yes as matched"))
    found = seen.selectExpr("coalesce(bit_or(listed), 0L) as listed", "coalesce(bit_or(matched), 0L) as matched")
    return found.selectExpr(
        f"(listed & {by_list}) | (listed & matched & {by_both}) | (matched & {falling})"
    ).scalar()


def policy_masks(
    policies: Mapping[str, Policy], layout: RegisterLayout, *, old_yes: str, hit: str, seen: str, active: str
) -> tuple[str, str]:
    """SQL for the flags that a row's memberships set to YES and to NO, for all policies at once.

    The arguments name columns with bit masks over flag numbers, never NULL.  ``hit``: listed with
    YES; ``seen``: listed with any status; ``active``: see ``active_flags``.  A row without a name
    can never be listed.

    * U-1, U-2: listed YES, others NO, unknown names as before; nothing happens to an empty list.
    * U-3: listed YES, all others NO, unknown names too.
    * U-4: listed YES, former YES to NO, all else as before; only where something matched.
      (An update by name cannot reach a row without a name, so such a row keeps its YES.)
    * U-5: the listing's own YES or NO, others NO, unknown names as before.
    """
    for policy in policies.values():
        if policy.kind not in (U1, U2, U3, U4, U5):
            raise ValueError(f"unknown policy {policy.kind}")
    falling = _flags_where(policies, layout, lambda p: p.kind == U4)
    resetting = _flags_where(policies, layout, lambda p: p.kind != U4)
    own_status = _flags_where(policies, layout, lambda p: p.kind == U5)
    kept = [
        f"if({quoted(column)} is null, {_flags_where(policies, layout, lambda p, n=n: p.kind != U3 and p.name == n)}, 0L)"
        for n, column in (("eng", layout.name_eng), ("fr", layout.name_fr))
    ]
    unnamed = f"(({' | '.join(kept)}) & ~({seen} & {own_status}))"
    resettable = f"({resetting} | ({old_yes} & {falling}))"
    return f"{active} & {hit}", f"{active} & {resettable} & ~{unnamed} & ~{hit}"


SET_YES, SET_NO, OLD_YES, OLD_NO = "__set_yes", "__set_no", "__old_yes", "__old_no"


def proposed(
    register: DataFrame,
    hits: DataFrame,
    masks: DataFrame,
    layout: RegisterLayout,
    policies: Mapping[str, Policy] | None = None,
) -> DataFrame:
    """The register with masks of the flags that are YES, that are NO, and that would be set.

    ``hits`` is ``(key, yes, seen)`` for listed rows, ``masks`` the listing itself with its
    ``yes`` and ``seen`` masks over any keys.
    """
    policies = POLICIES if policies is None else policies
    columns = [quoted(c) for c in register.columns]
    joined = register.join(hits.select(layout.key, "yes", "seen"), layout.key, "left")
    guarded = joined.select("*", active_flags(policies, layout, masks, hits).alias("__active"))
    marked = guarded.selectExpr(
        *columns,
        f"{flag_mask(layout, 'YES')} as {OLD_YES}",
        f"{flag_mask(layout, 'NO')} as {OLD_NO}",
        "coalesce(yes, 0L) as __hit",
        "coalesce(seen, 0L) as __seen",
        "__active",
    )
    set_yes, set_no = policy_masks(
        policies, layout, old_yes=OLD_YES, hit="__hit", seen="__seen", active="__active"
    )
    return marked.selectExpr(*columns, OLD_YES, OLD_NO, f"{set_yes} as {SET_YES}", f"{set_no} as {SET_NO}")


def new_flag(column: str, number: int) -> str:
    """SQL for a flag of a ``proposed`` register after the update."""
    return (
        f"case when {has_bit(SET_YES, number)} then 'YES' when {has_bit(SET_NO, number)} then 'NO' "
        f"else {quoted(column)} end"
    )


def settle(pending: DataFrame, layout: RegisterLayout, columns: Sequence[str], policies: Mapping[str, Policy] | None = None) -> DataFrame:
    """The register a ``proposed`` one becomes, under its own column names."""
    numbers = [layout.number(f) for f in (POLICIES if policies is None else policies)]
    new = {layout.flags[i]: new_flag(layout.flags[i], i) for i in numbers}
    for value in (layout.score, layout.rank):
        if f"new__{value}" in pending.columns:
            new[value] = quoted(f"new__{value}")
    return pending.selectExpr(*[f"{new.get(c, quoted(c))} as {quoted(c)}" for c in columns])


def apply_masks(
    register: DataFrame,
    hits: DataFrame,
    masks: DataFrame,
    layout: RegisterLayout,
    policies: Mapping[str, Policy] | None = None,
) -> DataFrame:
    """Register after its flags have been updated from resolved listing masks."""
    pending = proposed(register, hits, masks, layout, policies)
    return settle(pending, layout, register.columns, policies)


def apply_listing(
    register: DataFrame,
    listing: DataFrame,
    layout: RegisterLayout,
    policies: Mapping[str, Policy] | None = None,
    *,
    key: Column | None = None,
    flags: Sequence[str] = FLAGS,
) -> DataFrame:
    """U-1 to U-5 for one listing matched by one key (the English name by default)."""
    masks = listing_masks(listing, ["name"], flags)
    named = register.select(layout.key, (F.col(layout.name_eng) if key is None else key).alias("name"))
    hits = named.where(F.col("name").isNotNull()).join(masks, "name").select(layout.key, "yes", "seen")
    return apply_masks(register, hits, masks, layout, policies)


def update_cells(
    register: DataFrame, listing: DataFrame, layout: RegisterLayout, key: Column, flags: Sequence[str] = FLAGS
) -> DataFrame:
    """J-08: sets exactly the (name, flag) cells a listing mentions, to the status it gives."""
    masks = listing_masks(listing, ["name"], flags)
    named = register.withColumn("__name", key)
    joined = named.join(masks, F.col("__name") == F.col("name"), "left")
    cells = {
        column: f"case when {has_bit('yes', i)} then 'YES' when {has_bit('seen', i)} then 'NO' "
        f"else {quoted(column)} end as {quoted(column)}"
        for i, column in enumerate(layout.flags)
    }
    return joined.selectExpr(*[cells.get(c, quoted(c)) for c in register.columns])


def update_values(
    register: DataFrame, updates: DataFrame, key: str, columns: Sequence[str], *, error: str | None = None
) -> DataFrame:
    """U-6, J-07: overwrites columns for the keys in ``updates``, NULL values included.

    Absent keys, and keys whose ``error`` column is true, keep what they have.  ``updates`` has
    one row per key.
    """
    usable = updates if error is None else updates.where(~F.col(error))
    fetched = usable.select(
        key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__fetched")
    )
    joined = register.join(fetched, key, "left")
    new = {c: F.when(F.col("__fetched"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in columns}
    return joined.select(*[new.get(c, F.col(c)) for c in register.columns])
