"""Register versions that share unchanged key ranges, with a tree of digests over the ranges.

A version is a tree: level 0 has one row per key range (rows, two digests, the version whose files
hold it), each level above sums up ``FAN`` nodes of the one below.  Writing a version writes the
files of ranges that differ from its base; comparing two versions goes down the trees and reads
the rows of ranges that differ, so both cost what changed and not what is stored.

    path/data/stored_in=<version>/key_range=<n>/*.parquet     path/tree/version=<version>/level=<l>
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilframe.operators.audit import diff_snapshots
from vigilframe.operators.ladder import quoted
from vigilframe.operators.lineage import landed

FAN = 64
LEVELS = 4
#: So many ranges are read as a list of folders; beyond that ranges are joined, with the same rows.
LISTED = 1000
_DIGEST = ["n_rows", "d1", "d2"]
_NODES = "level int, node long, n_rows long, d1 decimal(38,0), d2 decimal(38,0), stored_in string"
#: The level of the row that holds a version's column types, as JSON in ``stored_in``.
_SCHEMA_LEVEL = -1


def _parent(node: str, fan: int = FAN) -> Column:
    return F.expr(f"({node} - pmod({node}, {fan}L)) div {fan}L")


class VersionedTable:
    """Versions of a table with a unique integer key.

    ``width`` keys make a range: choose it so that a range holds some hundred MB.  Rows without a
    key raise an error.  Digests are sums of two 64-bit row hashes, NULL being told from absent
    values, so row order and files don't matter.  A version may be written again (after a failed
    run) as long as no later one is based on it; it exists once its tree is stored.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, *, width: int = 1 << 20):
        self.spark, self.path, self.key, self.width = spark, path.rstrip("/"), key, width

    def _ranged(self, df: DataFrame) -> DataFrame:
        if clash := {"key_range", "stored_in"} & set(df.columns):
            raise ValueError(f"columns of versioned tables can't be named {sorted(clash)}")
        missing = F.raise_error(F.lit(f"a row without {self.key}"))
        key = F.coalesce(F.col(quoted(self.key)).cast("long"), missing.cast("long"))
        return df.withColumn("__key", key).withColumn("key_range", _parent("__key", self.width)).drop("__key")

    def _leaves(self, ranged: DataFrame) -> DataFrame:
        """node, n_rows, d1, d2 per key range."""
        cells = [x for c in sorted(ranged.columns) if c != "key_range" for x in (F.col(quoted(c)), F.col(quoted(c)).isNull())]
        row = [F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)") for seed in (1, 2)]
        slim = ranged.select(F.col("key_range").alias("node"), row[0].alias("r1"), row[1].alias("r2"))
        return slim.groupBy("node").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("r1").cast("decimal(38,0)").alias("d1"),
            F.sum("r2").cast("decimal(38,0)").alias("d2"),
        )

    def tree(self, version: str) -> DataFrame:
        return self.spark.read.schema(_NODES).parquet(f"{self.path}/tree/version={version}")

    def leaves(self, version: str) -> DataFrame:
        """node, n_rows, d1, d2, stored_in of a version's key ranges."""
        return self.tree(version).where("level = 0").drop("level")

    def schema(self, version: str) -> T.StructType:
        row = self.tree(version).where(F.col("level") == _SCHEMA_LEVEL).select("stored_in").first()
        return T.StructType.fromJson(json.loads(row.stored_in))

    def _store_rows(self, ranged: DataFrame, version: str) -> None:
        # One task writes a range, and a range is bounded by ``width`` keys.
        target = f"{self.path}/data/stored_in={version}"
        ranged.repartition("key_range").write.mode("overwrite").partitionBy("key_range").parquet(target)

    def _store_tree(self, leaves: DataFrame, schema: T.StructType, version: str) -> None:
        level = landed(leaves.select(F.lit(0).alias("level"), "node", *_DIGEST, "stored_in"))
        nodes = level
        for n in range(1, LEVELS):
            child = [F.xxhash64(F.lit(seed), "node", *_DIGEST).cast("decimal(20,0)") for seed in (1, 2)]
            level = level.select(_parent("node").alias("node"), "n_rows", child[0].alias("d1"), child[1].alias("d2"))
            level = level.groupBy("node").agg(
                F.sum("n_rows").alias("n_rows"), *[F.sum(d).cast("decimal(38,0)").alias(d) for d in ("d1", "d2")]
            )
            nodes = nodes.unionByName(level.withColumn("level", F.lit(n)), allowMissingColumns=True)
        about = [(_SCHEMA_LEVEL, 0, 0, None, None, json.dumps(schema.jsonValue()))]
        nodes = nodes.unionByName(self.spark.createDataFrame(about, _NODES))
        nodes.write.mode("overwrite").partitionBy("level").parquet(f"{self.path}/tree/version={version}")

    def _against(self, leaves: DataFrame, base: str | None) -> DataFrame:
        """Key ranges with ``stored_in`` of the base's equal range, NULL where there is none."""
        if base is None:
            return leaves.withColumn("stored_in", F.lit(None).cast("string"))
        return leaves.join(self.leaves(base), ["node", *_DIGEST], "left").select("node", *_DIGEST, "stored_in")

    def write(self, df: DataFrame, version: str, base: str | None = None) -> None:
        """Stores a whole snapshot; files are written for ranges that the base doesn't hold as they are.

        ``df`` is read twice, for the digests and for the rows of changed ranges.
        """
        if version == base:
            raise ValueError("a version can't be its own base")
        if base is not None and self.schema(base) != df.schema:
            base = None  # other columns or types: every range is new
        ranged = self._ranged(df)
        found = landed(self._against(self._leaves(ranged), base))
        new = found.where("stored_in IS NULL").select(F.col("node").alias("key_range"))
        self._store_rows(ranged.join(new, "key_range", "left_semi"), version)
        self._store_tree(found.withColumn("stored_in", F.coalesce("stored_in", F.lit(version))), df.schema, version)

    def apply(self, version: str, base: str, rows: DataFrame, gone: DataFrame | None = None) -> None:
        """A version that is its base with ``rows`` put in place by key and the keys of ``gone`` taken out.

        Only key ranges of those keys are read and written.  A key is at most once in ``rows``; one
        that is also in ``gone`` stays.
        """
        if version == base:
            raise ValueError("a version can't be its own base")
        schema = self.schema(base)
        rows = landed(rows.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema]))
        keys = rows.select(self.key)
        if gone is not None:
            keys = keys.unionByName(gone.select(F.col(quoted(self.key)).cast(schema[self.key].dataType).alias(self.key)))
        keys = landed(keys.distinct())
        touched = landed(self._ranged(keys).select("key_range").distinct())
        old = self.read(base, touched)
        self._store_rows(self._ranged(old.join(keys, self.key, "left_anti").select(*rows.columns).unionByName(rows)), version)
        made = self._against(self._leaves(self._files(version, schema)), base)
        rest = self.leaves(base).join(touched.withColumnRenamed("key_range", "node"), "node", "left_anti")
        leaves = rest.unionByName(made.withColumn("stored_in", F.coalesce("stored_in", F.lit(version))))
        self._store_tree(leaves, schema, version)

    def _files(self, stored_in: str, schema: T.StructType) -> DataFrame:
        kind = T.StructType([*schema.fields, T.StructField("key_range", T.LongType())])
        return self.spark.read.schema(kind).parquet(f"{self.path}/data/stored_in={stored_in}")

    def read(self, version: str, ranges: DataFrame | None = None) -> DataFrame:
        """A version's rows, or those of some key ranges (column ``key_range``)."""
        schema = self.schema(version)
        places = self.leaves(version).select("stored_in", F.col("node").alias("key_range"))
        if ranges is not None:
            places = places.join(ranges, "key_range", "left_semi")
        some = places.limit(LISTED + 1).collect()
        if not some:
            return self.spark.createDataFrame([], schema)
        if len(some) <= LISTED:
            folders = [f"{self.path}/data/stored_in={p.stored_in}/key_range={p.key_range}" for p in some]
            return self.spark.read.schema(schema).parquet(*folders)
        kind = T.StructType([*schema.fields, T.StructField("stored_in", T.StringType()), T.StructField("key_range", T.LongType())])
        stored = self.spark.read.schema(kind).parquet(f"{self.path}/data")
        return stored.join(places, ["stored_in", "key_range"], "left_semi").select(*schema.names)

    def changed_ranges(self, old: str, new: str) -> DataFrame:
        """key_range of every range whose rows differ: from the top of both trees, below differing nodes only."""
        below = None
        for n in reversed(range(LEVELS)):
            left, right = (self.tree(v).where(F.col("level") == n).select("node", *_DIGEST) for v in (old, new))
            if below is not None:
                left, right = (t.join(below, _parent("node") == F.col("above"), "left_semi") for t in (left, right))
            both = left.select("node", F.struct(*_DIGEST).alias("a")).join(right.select("node", F.struct(*_DIGEST).alias("b")), "node", "full")
            below = both.where("NOT (a <=> b)").select(F.col("node").alias("above"))
        return below.withColumnRenamed("above", "key_range")

    def diff(self, old: str, new: str, columns: Sequence[str] | None = None, *, added_removed: bool = False) -> DataFrame:
        """C-01, J-09: as ``diff_snapshots`` of the two versions, from the rows of changed ranges alone."""
        changed = landed(self.changed_ranges(old, new))
        return diff_snapshots(self.read(old, changed), self.read(new, changed), self.key, columns, added_removed=added_removed)
