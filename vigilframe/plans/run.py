"""P-11: a whole run from landed publications to a new snapshot, its audit rows and exports."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.operators.audit import audit_rows, changed_cells, with_sentinel
from vigilframe.operators.ladder import OUTCOMES, level_rules, quoted, with_ladder, with_levels
from vigilframe.operators.lineage import exists, landed
from vigilframe.operators.listing import mask_of
from vigilframe.operators.match import name_keys, resolve_hits
from vigilframe.operators.update import OLD_NO, OLD_YES, SET_NO, SET_YES, Policy, new_flag, proposed, settle
from vigilframe.plans.updaters import SOURCES, Inputs, Source, cpi_values, latest_issues, register_keys
from vigilframe.schema import FLAGS, LEVELS, LISTING_SCHEMA, RegisterLayout
from vigilframe.sources import sinks

log = logging.getLogger(__name__)


def changes_of(pending: DataFrame, columns: Sequence[str], layout: RegisterLayout) -> DataFrame:
    """C-01 within one run: old and new values share a row, so no snapshot is joined.

    Rows are first filtered by their masks; levels, which follow from flags and score, are then
    derived on both sides and compared like any other column.
    """
    values = [c for c in (layout.score, layout.rank) if c and f"new__{c}" in pending.columns]
    moved = [f"(({SET_YES} & ~{OLD_YES}) | ({SET_NO} & ~{OLD_NO})) <> 0"]
    moved += [f"not ({quoted(c)} <=> {quoted(f'new__{c}')})" for c in values]
    changed = pending.where(" or ".join(moved)).selectExpr(
        "*",
        f"({OLD_YES} & ~{SET_NO}) | {SET_YES} as __new_yes",
        f"({OLD_NO} & ~{SET_YES}) | {SET_NO} as __new_no",
    )
    new_score = f"new__{layout.score}" if layout.score in values else layout.score
    levelled = with_ladder(changed, level_rules(layout, OLD_YES, OLD_NO), LEVELS, OUTCOMES)
    after = level_rules(layout, "__new_yes", "__new_no", new_score)
    levelled = with_ladder(levelled, after, [f"new__{c}" for c in LEVELS], OUTCOMES)
    cells = {c: (quoted(c), new_flag(c, i)) for i, c in enumerate(layout.flags) if c in columns}
    cells |= {c: (quoted(c), quoted(f"new__{c}")) for c in (*values, *LEVELS)}
    return changed_cells(levelled, layout.key, cells)


def kind_masks(listing: DataFrame, sources: Sequence[Source], layout: RegisterLayout) -> DataFrame:
    """Listing rows of all sources as one row of masks per (kind of key, name)."""
    kind, trigger = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s in sources:
        here = F.col("source") == s.name
        kind = F.when(here, F.lit(s.key)).otherwise(kind)
        trigger = F.when(here, F.lit(s.trigger)).otherwise(trigger)
    # Canonical flag names come first, so added flag columns keep the positions of the layout.
    flag = F.coalesce("flag", trigger)
    numbered = tuple(_canonical(layout))
    marked = listing.select(kind.alias("kind"), "name", mask_of(flag, numbered).alias("__bit"), "status")
    yes = F.when(F.col("status") == "YES", F.col("__bit"))
    zero = F.lit(0).cast("long")
    return marked.where(F.col("__bit").isNotNull()).groupBy("kind", "name").agg(
        F.coalesce(F.bit_or(yes), zero).alias("yes"), F.bit_or("__bit").alias("seen")
    )


def _canonical(layout: RegisterLayout) -> list[str]:
    return [*FLAGS, *layout.flags[len(FLAGS) :]]


def policies_of(sources: Sequence[Source]) -> dict[str, Policy]:
    return {flag: policy for s in sources for flag, policy in s.policies.items()}


def propose(
    register: DataFrame,
    masks: DataFrame,
    hits: DataFrame,
    values: DataFrame | None,
    sources: Sequence[Source],
    layout: RegisterLayout,
) -> DataFrame:
    """The register with every new value beside its old one, from all sources at once."""
    pending = proposed(register, hits, masks, layout, policies_of(sources))
    if values is None:
        return pending
    columns = [c for c in (layout.score, layout.rank) if c]
    fetched = values.where(~F.col("error")).select(
        layout.key, *[F.col(c).alias(f"__{c}") for c in columns], F.lit(True).alias("__fetched")
    )
    joined = pending.join(fetched, layout.key, "left")
    kept = [F.when(F.col("__fetched"), F.col(f"__{c}")).otherwise(F.col(c)).alias(f"new__{c}") for c in columns]
    return joined.select(*pending.columns, *kept)


@dataclass(frozen=True)
class RunResult:
    """Where a run's tables are, and which sources failed (with the message)."""

    register: str
    audit: str
    listing: str
    export: str | None
    failures: dict[str, str]


def run(
    spark: SparkSession,
    inputs: Inputs,
    out: str,
    run_id: str,
    *,
    sources: Sequence[Source] = SOURCES,
    fold_keys: bool = False,
    export_to: str | None = None,
) -> RunResult:
    """P-11: all sources, one pass over the register, audit and export.

    Each source's listing is written first and by itself: a source that fails is reported and
    leaves its flags as they are.  Names are then resolved to register keys once; the new snapshot
    and the changed cells are two passes over the old snapshot that read the same landed
    memberships, so they agree whatever is retried, and ids are given to changed cells only.  Every table is written under the run's id
    and replaced when the run is repeated.

    ``out`` is shared storage.  ``inputs.register`` must be a stored snapshot other than this
    run's own.
    """
    layout, register = inputs.layout, inputs.register
    work = f"{out}/work/run_id={run_id}"
    failures: dict[str, str] = {}

    def attempt(name: str, make, path: str) -> DataFrame | None:
        try:
            made = make()
            return None if made is None else landed(made, path)
        except Exception as error:  # a broken publication must not stop the others
            log.exception("source %s failed", name)
            failures[name] = str(error)
            return None

    if inputs.pages is not None and inputs.issues is None:
        inputs = replace(inputs, issues=landed(latest_issues(inputs.pages, inputs.at), f"{work}/issues"))
    values = attempt("CPI", lambda: cpi_values(inputs), f"{work}/values")
    listings = [attempt(s.name, lambda s=s: s.extract(inputs), f"{work}/listing/{s.name}") for s in sources]
    listing = spark.createDataFrame([], LISTING_SCHEMA)
    for one in listings:
        if one is not None:
            listing = listing.unionByName(one)

    masks = landed(kind_masks(listing, sources, layout), f"{work}/masks")
    keys = name_keys(register, layout.key, register_keys(layout, fold=fold_keys))
    hits = landed(resolve_hits(keys, masks, layout.key), f"{work}/hits")
    pending = propose(register, masks, hits, values, sources, layout)

    snapshot = sinks.write_register(settle(pending, layout, register.columns, policies_of(sources)), f"{out}/register", run_id)
    audit_path = f"{out}/audit"
    changes = landed(changes_of(pending, register.columns, layout), f"{work}/changes")
    audit = audit_rows(
        with_sentinel(changes, layout.key), layout.key, inputs.at, first_id=next_audit_id(spark, audit_path, run_id)
    )
    sinks.append_audit(audit, audit_path, run_id)
    exported = None
    if export_to is not None:
        log_table = spark.read.parquet(audit_path).drop("run_date", "run_id")
        exported = sinks.export_table(log_table, "audit", export_to, inputs.at)
        matrix = with_levels(spark.read.parquet(snapshot), layout)
        sinks.export_table(matrix, "matrix", export_to, inputs.at)
    return RunResult(snapshot, audit_path, f"{work}/listing", exported, failures)


def next_audit_id(spark: SparkSession, path: str, run_id: str) -> Column:
    """One past the greatest id of other runs, as a scalar subquery; 1 for a new log."""
    if not exists(spark, path):
        return F.lit(1)
    logged = spark.read.parquet(path)
    others = logged.where(F.col("run_id").cast("string") != run_id)
    return others.agg(F.coalesce(F.max("AuditID"), F.lit(0)) + 1).scalar()
