"""E-02: re-runs as publications land, by Structured Streaming over the landing folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vigilframe.operators.lineage import landed
from vigilframe.plans.run import RunResult, run
from vigilframe.plans.updaters import SOURCES, Inputs, Source
from vigilframe.schema import PAGE_SCHEMA, REGISTER, RegisterLayout
from vigilframe.sources.sinks import snapshot_path
from vigilframe.streaming.state import PageState


def batch_run_id(batch_id: int) -> str:
    return f"batch-{batch_id:012d}"


def apply_batch(
    batch: DataFrame,
    batch_id: int,
    out: str,
    register: str,
    *,
    sources: Sequence[Source] = SOURCES,
    layout: RegisterLayout = REGISTER,
    documents: DataFrame | None = None,
    programmes: DataFrame | None = None,
    fold_keys: bool = False,
    buckets: int = 64,
) -> RunResult:
    """One batch of pages: its state, then a run over the current pages."""
    session = batch.sparkSession
    own, before = batch_run_id(batch_id), batch_run_id(batch_id - 1) if batch_id else None
    previous = register if before is None else snapshot_path(f"{out}/register", before)
    state = PageState(session, f"{out}/state", buckets)
    at = state.merge(landed(batch, f"{out}/pages/run_id={own}"), own, before)
    inputs = Inputs(
        register=session.read.parquet(previous),
        at=at or session.range(1).select(F.timestamp_seconds(F.lit(0))).first()[0],
        pages=state.read(own),
        documents=documents,
        programmes=programmes,
        layout=layout,
    )
    # A source that fails is logged by the run and keeps its flags; the batch goes on.
    return run(session, inputs, out, own, sources=sources, fold_keys=fold_keys)


def refresh(
    spark: SparkSession,
    landing: str,
    out: str,
    register: str,
    checkpoint: str,
    *,
    format: str = "parquet",
    sources: Sequence[Source] = SOURCES,
    layout: RegisterLayout = REGISTER,
    documents: Callable[[], DataFrame | None] = lambda: None,
    programmes: Callable[[], DataFrame | None] = lambda: None,
    fold_keys: bool = False,
    buckets: int = 64,
) -> StreamingQuery:
    """Runs P-11 on everything that has landed since the last call, then stops.

    Scheduling is the caller's: each call handles what is new (``availableNow``).  A batch turns
    the snapshot of the batch before (``register`` for the first) into its own; all its tables
    carry the batch's id and are replaced when a failed batch is repeated, so each publication
    takes effect once.  Sources of many pages (scores, one page per entity) may land bit by bit:
    a batch reads its own pages and the state of the batch before, the current page of every
    address, and never older pages.  The time of a run is that of the youngest page so far, so a
    repeated batch writes the same audit rows.
    """
    stream = spark.readStream.schema(PAGE_SCHEMA).format(format).load(landing)

    def handle(batch: DataFrame, batch_id: int) -> None:
        apply_batch(
            batch, batch_id, out, register, sources=sources, layout=layout, documents=documents(),
            programmes=programmes(), fold_keys=fold_keys, buckets=buckets,
        )

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
