"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_near(rows: DataFrame, most: int, by: str | None = None, seed: int = 11) -> DataFrame:
    """About ``most`` rows (of each value of ``by``), those with the smallest hash of doc_id; all if there are fewer.

    The number is a bound in expectation; which rows are taken doesn't depend on partitions.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("u")
    if by is None:
        counts = rows.agg(F.count(F.lit(1)).alias("__n"))
        return rows.crossJoin(F.broadcast(counts)).where(u * F.col("__n") < most).drop("__n")
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(counts, by).where(u * F.col("__n") < most).drop("__n")


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int) -> DataFrame:
    """(doc_id, text, label) of a bounded sample of the labelled rows that ``keep`` admits.

    Null labels are left out; a doc_id labelled more than once has its largest label.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & keep)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = sample_near(known, most)
    return docs.select("doc_id", "text").join(known, "doc_id")
