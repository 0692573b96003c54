"""Ordered rule ladders and the three level columns that are derived from the flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe import schema as S
from vigilframe.schema import LEVELS, RegisterLayout

MEASURES = (*S.FR_MEASURE_FLAGS, *S.EU_MEASURE_FLAGS)
LISTS = (S.EU_AML, S.FATF_MONITORING, S.EU_TAX, S.FR_TAX)

# Outcomes of rules 1 to 6 for risk, vigilance and list.
OUTCOMES = (
    ("PROHIBITED", "PROHIBITED", "PROHIBITED"),
    ("HIGH", "ENHANCED", "RED"),
    ("HIGH", "ENHANCED", "RED"),
    ("STANDARD", "STANDARD", "GREEN"),
    ("STANDARD", "ENHANCED UK/US", "GREEN"),
    ("MEDIUM", "ENHANCED", "AMBER"),
)


def quoted(column: str) -> str:
    """A column name as it is written inside a SQL expression."""
    return "`" + column.replace("`", "``") + "`"


def first_match(conditions: Sequence[str]) -> Column:
    """Number (from 1) of the first SQL condition that is true; one past the last when none is.

    NULL conditions do not match.
    """
    branches = " ".join(f"when {c} then {i}" for i, c in enumerate(conditions, start=1))
    return F.expr(f"case {branches} else {len(conditions) + 1} end")


def with_ladder(
    df: DataFrame, rules: Sequence[str], outputs: Sequence[str], outcomes: Sequence[Sequence[str]]
) -> DataFrame:
    """R-03: appends output columns chosen by the first rule (a SQL condition) that holds.

    ``outcomes`` has one row per rule and a last one for "otherwise".  The rule number is computed
    once; outcomes are then literals looked up by it.
    """
    if len(outcomes) != len(rules) + 1:
        raise ValueError("a ladder needs one outcome per rule and one for otherwise")
    numbered = df.withColumn("__rule", first_match(rules))
    picked = []
    for i, name in enumerate(outputs):
        values = ", ".join("'" + row[i].replace("'", "\\'") + "'" for row in outcomes)
        picked.append(f"element_at(array({values}), __rule) as {quoted(name)}")
    return numbered.selectExpr(*[quoted(c) for c in df.columns], *picked)


def flag_mask(layout: RegisterLayout, status: str) -> str:
    """SQL for a bit mask of a row's flags that have a status (YES and NO both unset: NULL)."""
    bits = " | ".join(
        f"if({quoted(c)} = '{status}', {1 << i}L, 0L)" for i, c in enumerate(layout.flags)
    )
    return f"({bits})"


def bits_of(layout: RegisterLayout, flags: Sequence[str]) -> int:
    return sum(1 << layout.number(f) for f in flags)


def level_rules(layout: RegisterLayout, yes: str, no: str, score: str | None = None) -> list[str]:
    """The five conditions above "otherwise", three-valued as in the register.

    ``yes`` and ``no`` are SQL for the flag masks.  A NULL flag satisfies neither YES nor NO: it
    can only drop a row to a later rule.  A listed UK flag cancels rule 3, so an entity with
    measures and UK = YES ends at rule 4 or 6.
    """

    def some(mask: str, *flags: str) -> str:
        return f"({mask} & {bits_of(layout, flags)}L) <> 0"

    def every(mask: str, *flags: str) -> str:
        wanted = bits_of(layout, flags)
        return f"({mask} & {wanted}L) = {wanted}L"

    return [
        f"{some(yes, S.FATF_CALL)} or {quoted(layout.name_eng)} = 'CUBA'",
        f"{some(yes, *LISTS)} and {every(no, S.FATF_CALL)}",
        f"{some(yes, *MEASURES)} and {every(no, *LISTS, S.UK)}",
        f"{quoted(score or layout.score)} >= 50",
        f"{some(yes, S.UK, S.US_PROGRAMMES)} and {every(no, *MEASURES, *LISTS)}",
    ]


def _masked(register: DataFrame, layout: RegisterLayout) -> DataFrame:
    return register.selectExpr(
        "*", f"{flag_mask(layout, 'YES')} as __yes", f"{flag_mask(layout, 'NO')} as __no"
    )


def with_rule_no(register: DataFrame, layout: RegisterLayout, out: str = "rule_no") -> DataFrame:
    """R-01: number of the rule that decides a row's levels."""
    masked = _masked(register, layout)
    numbered = masked.withColumn(out, first_match(level_rules(layout, "__yes", "__no")))
    return numbered.drop("__yes", "__no")


def with_levels(register: DataFrame, layout: RegisterLayout) -> DataFrame:
    """R-02: the register with its three derived columns (recomputed if present)."""
    masked = _masked(register.drop(*LEVELS), layout)
    rules = level_rules(layout, "__yes", "__no")
    return with_ladder(masked, rules, LEVELS, OUTCOMES).drop("__yes", "__no")
