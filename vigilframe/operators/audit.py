"""Change detection: cell-level differences, transitions, sentinel, audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe.functions.names import flags_differ
from vigilframe.operators.carry import with_dense_ids
from vigilframe.operators.ladder import quoted
from vigilframe.operators.listing import has_bit
from vigilframe.schema import AUDIT_SCHEMA

# Fixed values of the row that says nothing changed.
SENTINEL_KEY = -1
SENTINEL_COLUMN = "None"
SENTINEL_VALUE = "No changes detected"


def changed_cells(df: DataFrame, key: str, cells: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows (key, column, old, new) for every cell whose two values differ, NULLs being equal.

    ``cells`` gives SQL for the old and the new value of each column.  Both sit in one row, so
    nothing is joined.  Callers drop rows without any change first.
    """
    rows = ", ".join(
        f"struct('{c}' as `column`, cast({old} as string) as old, cast({new} as string) as new)"
        for c, (old, new) in cells.items()
    )
    unfolded = df.selectExpr(quoted(key), f"inline(array({rows}))")
    return unfolded.where("not (old <=> new)")


def diff_snapshots(
    old: DataFrame, new: DataFrame, key: str, columns: Sequence[str] | None = None, *, added_removed: bool = False
) -> DataFrame:
    """C-01: cell-level difference of two snapshots over all shared columns, values as text.

    The snapshots are joined by key once and compared row against row; unequal rows alone are
    unfolded into cells.  ``added_removed`` also reports keys that only one snapshot has.
    """
    columns = [c for c in old.columns if c != key and c in new.columns] if columns is None else columns
    values = ", ".join(quoted(c) for c in columns)
    left = old.selectExpr(quoted(key), f"struct({values}) as __old")
    right = new.selectExpr(quoted(key), f"struct({values}) as __new")
    both = left.join(right, key, "full" if added_removed else "inner")
    changed = both.where("not (__old <=> __new)")
    return changed_cells(changed, key, {c: (f"__old.{quoted(c)}", f"__new.{quoted(c)}") for c in columns})


def with_sentinel(changes: DataFrame, key: str = "id") -> DataFrame:
    """C-03, A-07: one marker row when there are no changes.

    The existence test is a scalar subquery that stops at the first change.
    """
    types = dict(changes.dtypes)
    marker = changes.sparkSession.range(1).select(
        F.lit(SENTINEL_KEY).cast(types[key]).alias(key),
        F.lit(SENTINEL_COLUMN).alias("column"),
        F.lit(SENTINEL_VALUE).alias("old"),
        F.lit(SENTINEL_VALUE).alias("new"),
    )
    return changes.unionByName(marker.where(~changes.exists()))


def change_count(changes: DataFrame) -> DataFrame:
    """A-07: number of changes as a one-row table."""
    return changes.agg(F.count(F.lit(1)).alias("n_changes"))


def transitions_of(changes: DataFrame, old: str, new: str) -> DataFrame:
    """F-07: changes from one status to another."""
    return changes.where((F.col("old") == old) & (F.col("new") == new))


def transitions(changes: DataFrame) -> DataFrame:
    """C-05: number of changes per column and direction, YES to NO and NO to YES."""
    moved = changes.where(
        ((F.col("old") == "YES") & (F.col("new") == "NO"))
        | ((F.col("old") == "NO") & (F.col("new") == "YES"))
    )
    direction = F.concat_ws("->", "old", "new").alias("direction")
    return moved.groupBy("column", direction).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class CheckVariant:
    """How one source compares proposed with current values (C-02)."""

    null_as_no: bool = False
    ignore_case: bool = False
    all_rows: bool = False


# The comparison each source makes.
CHECKS = {
    R.CPI: CheckVariant(),
    R.EU_AML: CheckVariant(null_as_no=True),
    R.EU_MEASURES: CheckVariant(),
    R.EU_TAX: CheckVariant(null_as_no=True),
    R.FATF_CALL: CheckVariant(null_as_no=True, all_rows=True),
    R.FATF_MONITORING: CheckVariant(null_as_no=True),
    R.FR_MEASURES: CheckVariant(),
    R.FR_TAX: CheckVariant(null_as_no=True, ignore_case=True, all_rows=True),
    R.UK: CheckVariant(null_as_no=True, ignore_case=True, all_rows=True),
}


def check_changes(
    register: DataFrame, hits: DataFrame, key: str, flags: Mapping[int, str], variant: CheckVariant
) -> DataFrame:
    """C-02: (key, column, old, new) of what a listing would change, before it is applied.

    ``flags`` maps flag numbers to register columns.  Listed rows only, unless the variant looks
    at the whole register, where a row that is not listed proposes NO.
    """
    how = "left" if variant.all_rows else "inner"
    joined = register.select(key, *flags.values()).join(hits.select(key, "yes", "seen"), key, how)

    def compared(i: int, column: str) -> str:
        old = f"coalesce({quoted(column)}, 'NO')" if variant.null_as_no else quoted(column)
        new = f"if({has_bit('coalesce(yes, 0L)', i)}, 'YES', 'NO')"
        asked = "true" if variant.all_rows else has_bit("seen", i)
        return f"struct('{column}' as `column`, {old} as old, {new} as new, {asked} as asked)"

    rows = ", ".join(compared(i, column) for i, column in flags.items())
    unfolded = joined.selectExpr(quoted(key), f"inline(array({rows}))").where("asked").drop("asked")
    return unfolded.where(flags_differ(F.col("old"), F.col("new"), ignore_case=variant.ignore_case))


def check_values(register: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """C-06: (key, column, old, new) of fetched values that differ from the register's."""
    fetched = updates.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = register.select(key, *columns).join(fetched, key)
    return changed_cells(joined, key, {c: (quoted(c), quoted(f"__{c}")) for c in columns})


def audit_rows(changes: DataFrame, key: str, at: datetime | Column, *, first_id: int | Column | None = 1) -> DataFrame:
    """C-04, A-06: changes as audit rows with one fixed time stamp and, optionally, dense ids.

    ``first_id`` None leaves ``AuditID`` NULL (ids are then given when the log is read or merged).
    """
    stamp = at if isinstance(at, Column) else F.lit(at)
    rows = changes.select(
        F.col(key).cast("long").alias("SanctionsMapId"),
        F.col("column").alias("ColumnName"),
        F.col("old").alias("OldValue"),
        F.col("new").alias("NewValue"),
        stamp.cast("timestamp").alias("UpdatedAt"),
    )
    if first_id is None:
        numbered = rows.withColumn("AuditID", F.lit(None).cast("long"))
    else:
        numbered = with_dense_ids(rows, "SanctionsMapId", ["ColumnName"], "AuditID", start=first_id)
    return numbered.select(*AUDIT_SCHEMA.fieldNames())
