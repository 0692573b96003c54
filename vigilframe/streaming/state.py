"""The latest pages of every address as a versioned state table, merged batch by batch.

A version is a small manifest: which version wrote each bucket of addresses last, and the time of
the youngest page so far.  A batch rewrites the buckets its pages fall into, and no others; it
reads its own pages and those buckets.  Versions are never changed: a batch that is repeated
builds the same version from the same predecessor, and a reader of an older version isn't
disturbed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe.operators.lineage import remove
from vigilframe.plans.updaters import BY_ADDRESS
from vigilframe.schema import PAGE_SCHEMA

MANIFEST = "bucket int, written_by string, at timestamp"


def address() -> Column:
    """What a page replaces: the page of the same address, or all earlier pages of its source."""
    return F.when(F.col("source").isin(R.CPI, *BY_ADDRESS), F.col("url")).otherwise("")


def relevant() -> Column:
    """Pages that can be current: delivered ones, and score pages of any status (a missing one counts)."""
    return (F.col("status") == 200) | (F.col("source") == R.CPI)


def latest_pages(pages: DataFrame) -> DataFrame:
    """Pages of the last time of each address; several may share it.

    Times are compared without the bodies; pages are then filtered by a semi join.
    """
    keyed = pages.where(relevant()).withColumn("__address", address())
    last = keyed.groupBy("source", "__address").agg(F.max("fetched_at").alias("fetched_at"))
    return keyed.join(last, ["source", "__address", "fetched_at"], "left_semi").select(*PAGE_SCHEMA.fieldNames())


@dataclass(frozen=True)
class PageState:
    """Versions under ``path``; addresses are dealt to a fixed number of buckets.

    Choose ``buckets`` so that one holds some hundred MB of current pages; it can't change later.
    """

    spark: SparkSession
    path: str
    buckets: int = 64

    def _manifest(self, version: str) -> str:
        return f"{self.path}/manifest/version={version}"

    def _pages(self, version: str) -> str:
        return f"{self.path}/pages/version={version}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("source", address()), F.lit(self.buckets)).cast("int")

    def manifest(self, version: str | None) -> tuple[dict[int, str], datetime | None]:
        """Who wrote each bucket last (at most ``buckets`` rows), and the time of the youngest page."""
        if version is None:
            return {}, None
        rows = self.spark.read.schema(MANIFEST).parquet(self._manifest(version)).collect()
        times = [r["at"] for r in rows if r["at"] is not None]
        return {r.bucket: r.written_by for r in rows if r.bucket is not None}, max(times, default=None)

    def _read(self, writers: dict[int, str]) -> DataFrame:
        if not writers:
            return self.spark.createDataFrame([], PAGE_SCHEMA)
        paths = [f"{self._pages(v)}/bucket={b}" for b, v in sorted(writers.items())]
        return self.spark.read.schema(PAGE_SCHEMA).parquet(*paths)

    def read(self, version: str | None) -> DataFrame:
        """Current pages as of a version."""
        return self._read(self.manifest(version)[0])

    def merge(self, pages: DataFrame, version: str, previous: str | None) -> datetime | None:
        """Writes a version from its predecessor and a batch of stored pages; returns its youngest page's time.

        Pages older than the current ones, pages that weren't delivered, and batches without pages
        leave every bucket as it is.
        """
        writers, at = self.manifest(previous)
        youngest = pages.agg(F.max("fetched_at").alias("at")).first()["at"]
        times = [t for t in (at, youngest) if t is not None]
        own = pages.where(relevant()).withColumn("bucket", self._bucket())
        touched = [r.bucket for r in own.select("bucket").distinct().collect()]
        if touched:
            old = self._read({b: v for b, v in writers.items() if b in touched})
            merged = latest_pages(old.unionByName(own.select(*PAGE_SCHEMA.fieldNames()))).withColumn("bucket", self._bucket())
            # A bucket of many pages goes to several tasks.
            dealt = merged.hint("rebalance", "bucket")
            dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._pages(version))
            writers = writers | dict.fromkeys(touched, version)
        last = max(times, default=None)
        rows = [(b, v, last) for b, v in sorted(writers.items())] or [(None, None, last)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest(version))
        return last

    def vacuum(self, version: str, gone: list[str]) -> list[str]:
        """Removes older versions ``gone`` that ``version`` doesn't need; returns those removed."""
        needed = set(self.manifest(version)[0].values())
        old = [v for v in gone if v != version and v not in needed]
        for v in old:
            remove(self.spark, self._pages(v))
        for v in gone:
            if v != version:
                remove(self.spark, self._manifest(v))
        return old
