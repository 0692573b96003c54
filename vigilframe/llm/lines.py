"""Line dedup that can be taken back: sharded cuckoo filters over exact reference counts.

``LineIndex`` keeps, in a shared folder, which documents hold which line keys.  Tables are
versioned: each change writes a new version.  The exact tables decide; the filters, one small
cuckoo table per shard of keys, tell which keys of a new batch were certainly never seen, so only
the others are looked up.  Deleting documents lowers the counts and takes keys that no document
holds any more out of the filters, after which lines that were dropped can come back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilframe.llm.ship import ship
from vigilframe.llm.text import free_names, mixed
from vigilframe.operators.lineage import landed, scratch_path

LEAST_CHARS = 20
LEAST_DOCS = 3
_SPACE = "[\\x20\\x09-\\x0D]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLOTS = 4
KEYS_PER_SHARD = 1_000_000
BATCHES = 2


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Without white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), _UPPER, _LOWER)


def _hash(key: Column) -> list[Column]:
    """A key as two 64-bit hashes of different seeds (128 bits)."""
    return [F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(7), key).alias("k2")]


def occurrences(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Distinct (k1, k2, doc_id) of lines long enough to count."""
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key), lambda k: F.length(k) >= least_chars))
    exploded = docs.select("doc_id", F.explode(keys).alias("key"))
    return exploded.select(*_hash(F.col("key")), "doc_id").distinct()


# --- cuckoo tables: int32 fingerprints, 0 = free, SLOTS per bucket, two buckets per key ---


def _places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    h = mixed(keys.view(np.uint64))
    print_ = (h >> np.uint64(32)).astype(np.uint32)
    print_[print_ == 0] = 1
    return print_, (h & np.uint64(buckets - 1)).astype(np.int64)


def _other(bucket: np.ndarray, print_: np.ndarray, buckets: int) -> np.ndarray:
    return bucket ^ (mixed(print_.astype(np.uint64)) & np.uint64(buckets - 1)).astype(np.int64)


def cuckoo_insert(table: np.ndarray, keys: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The table (buckets x SLOTS) with keys added; one of twice the buckets can be needed (ValueError)."""
    table = table.copy()
    buckets = len(table)
    prints, at = _places(keys, buckets)
    rng = np.random.default_rng(1)
    for n in range(rounds):
        if not len(prints):
            return table
        order = np.argsort(at, kind="stable")
        prints, at = prints[order], at[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        free_sorted = np.argsort(table[at] != 0, axis=1, kind="stable")
        room = (table[at] == 0).sum(1)
        fits = rank < room
        slot = free_sorted[np.flatnonzero(fits), rank[fits]]
        table[at[fits], slot] = prints[fits]
        prints, at = prints[~fits], at[~fits]
        if n % 2 == 1 and len(at):  # kick one out of each full bucket
            first = np.concatenate([[True], at[1:] != at[:-1]])
            victims = rng.integers(0, SLOTS, first.sum())
            out = table[at[first], victims].copy()
            table[at[first], victims] = prints[first]
            prints = np.concatenate([prints[~first], out])
            at = np.concatenate([at[~first], at[first]])
        at = _other(at, prints, buckets)
    raise ValueError("the cuckoo table is full")


def cuckoo_contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    prints, at = _places(keys, len(table))
    two = np.concatenate([table[at], table[_other(at, prints, len(table))]], axis=1)
    return (two == prints[:, None]).any(1)


def cuckoo_delete(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Takes one fingerprint per key out; keys must be in the table."""
    table = table.copy()
    prints, at = _places(keys, len(table))
    for p, a, b in zip(prints, at, _other(at, prints, len(table)), strict=True):
        for bucket in (a, b):
            if len(hit := np.flatnonzero(table[bucket] == p)):
                table[bucket, hit[0]] = 0
                break
    return table


def cuckoo_build(keys: np.ndarray) -> np.ndarray:
    """A table for these keys, at most some 80 % full."""
    buckets = 1 << max(1, int(np.ceil(np.log2(max(1, len(keys)) / (SLOTS * 0.8)))))
    while True:
        try:
            return cuckoo_insert(np.zeros((buckets, SLOTS), np.uint32), keys)
        except ValueError:
            buckets *= 2


def _packed(shard: int, table: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "filter": pa.array([table.tobytes()], pa.binary())})


def _loaded(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint32).reshape(-1, SLOTS)


def _keys(table: pa.Table) -> np.ndarray:
    return table.column("k1").to_numpy() ^ table.column("k2").to_numpy()


class LineIndex:
    """Line keys with exact counts: ``postings(k1, k2, doc_id)``, ``refs(k1, k2, n_docs, last_doc)``, ``filters(shard, filter)``.

    A filter holds 1 / 2**shard_bits of all keys in one task.  The bits grow with the number of
    distinct keys, so that a shard has a million at most on average (5 MB), and all filters are
    then built anew from the exact table.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, *, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, shard_bits: int = 8):
        self.spark, self.path, self.version = spark, path or scratch_path(spark, "lines"), 0
        self.least_chars, self.least_docs, self.shard_bits = least_chars, least_docs, shard_bits
        ship(spark)

    def table(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}-{self.version if version is None else version}")

    def _shard(self) -> Column:
        return F.pmod(F.col("k1"), F.lit(1 << self.shard_bits)).cast("int").alias("shard")

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        return landed(df, f"{self.path}/{name}-{self.version + 1}")

    def _refs(self, postings: DataFrame) -> DataFrame:
        return postings.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))

    def _filters(self, refs: DataFrame) -> DataFrame:
        def build(key, table):
            return pa.Table.from_batches([_packed(key[0].as_py(), cuckoo_build(_keys(table)))])

        return refs.select(self._shard(), "k1", "k2").groupBy("shard").applyInArrow(build, "shard int, filter binary")

    def _grow(self, refs: DataFrame) -> bool:
        """Whether the keys need more shards than there are, which are set then."""
        needed = max(0, -(-refs.count() // KEYS_PER_SHARD) - 1).bit_length()
        grows = needed > self.shard_bits
        self.shard_bits = max(self.shard_bits, needed)
        return grows

    def insert(self, docs: DataFrame) -> DataFrame:
        """Adds documents and returns their keys (k1, k2, doc_id); documents that are in it already add nothing.

        Null or empty texts have no keys.  Rows of one doc_id are one document; a null doc_id is one too.
        """
        new = occurrences(docs, self.least_chars)
        if self.version == 0:
            postings = self._store("postings", new)
            refs = self._store("refs", self._refs(postings))
            self._grow(refs)
            self._store("filters", self._filters(refs))
            self.version += 1
            return postings
        new = landed(new)
        seen = landed(self.maybe_seen(new.select("k1", "k2").distinct()))
        old = self.table("postings")
        # Only keys that a filter may hold are looked up in the exact table.
        asked = landed(new.join(seen.where("seen").select("k1", "k2"), ["k1", "k2"], "left_semi"))
        fresh = new.join(seen.where("NOT seen").select("k1", "k2"), ["k1", "k2"], "left_semi")
        same = (asked["k1"] == old["k1"]) & (asked["k2"] == old["k2"]) & asked["doc_id"].eqNullSafe(old["doc_id"])
        added = landed(fresh.unionByName(asked.join(old, same, "left_anti")))
        postings = self._store("postings", old.unionByName(added))
        before = self.table("refs")
        refs = self._store("refs", before.unionByName(self._refs(added)).groupBy("k1", "k2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc")))
        if self._grow(refs):
            self._store("filters", self._filters(refs))
        else:
            born = added.select("k1", "k2").distinct().join(before, ["k1", "k2"], "left_anti")
            self._store("filters", self._changed(born, insert=True))
        self.version += 1
        return new

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes documents out; counts and last documents are as if they had never been there."""
        gone, old = doc_ids.select(F.col("doc_id").alias("gone")).distinct(), self.table("postings")
        hit = old["doc_id"].eqNullSafe(gone["gone"])
        touched = landed(old.join(gone, hit, "left_semi").select("k1", "k2").distinct())
        postings = self._store("postings", old.join(gone, hit, "left_anti"))
        before = self.table("refs")
        again = self._refs(postings.join(touched, ["k1", "k2"], "left_semi"))
        self._store("refs", before.join(touched, ["k1", "k2"], "left_anti").unionByName(again))
        dead = touched.join(postings, ["k1", "k2"], "left_anti")
        self._store("filters", self._changed(dead, insert=False))
        self.version += 1

    def maybe_seen(self, keys: DataFrame) -> DataFrame:
        """k1, k2, seen: False is certain, True is to be looked up."""

        def probe(key, asked, stored):
            found = cuckoo_contains(_loaded(stored.column("filter")[0].as_py()), _keys(asked)) if stored.num_rows else np.zeros(asked.num_rows, bool)
            return asked.select(["k1", "k2"]).append_column("seen", pa.array(found))

        asked = keys.select(self._shard(), "k1", "k2").groupBy("shard")
        return asked.cogroup(self.table("filters").groupBy("shard")).applyInArrow(probe, "k1 long, k2 long, seen boolean")

    def _changed(self, keys: DataFrame, *, insert: bool) -> DataFrame:
        """The filters with keys added or taken out; one that gets too full is built anew from the exact table."""

        def change(key, some, stored):
            shard, values = key[0].as_py(), _keys(some)
            table = _loaded(stored.column("filter")[0].as_py()) if stored.num_rows else np.zeros((2, SLOTS), np.uint32)
            try:
                table = cuckoo_insert(table, values) if insert else cuckoo_delete(table, values)
            except ValueError:
                return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([None], pa.binary())})
            return pa.Table.from_batches([_packed(shard, table)])

        some = keys.select(self._shard(), "k1", "k2").groupBy("shard")
        made = landed(some.cogroup(self.table("filters").groupBy("shard")).applyInArrow(change, "shard int, filter binary"))
        refs = self.table("refs", self.version + 1).withColumn("shard", self._shard())
        full = self._filters(refs.join(made.where("filter IS NULL").select("shard"), "shard", "left_semi"))
        return made.where("filter IS NOT NULL").unionByName(full)

    def dropped(self, postings: DataFrame | None = None) -> DataFrame:
        """(doc_id, k1, k2): keys that this document loses, since they are in enough documents and not for the last time here."""
        often = self.table("refs").where(F.col("n_docs") >= self.least_docs)
        held = self.table("postings") if postings is None else postings
        return held.join(often, ["k1", "k2"]).where(~F.col("doc_id").eqNullSafe(F.col("last_doc"))).select("doc_id", "k1", "k2")

    def dedup(self, docs: DataFrame, postings: DataFrame | None = None) -> DataFrame:
        """Adds n_lines, n_dropped and kept_text to the rows of ``docs``, which must have been inserted.

        The text of a document that loses nothing is its own, a null one becomes empty.  Columns of
        these three names are replaced, others handed on.
        """
        gone, of, cut, left = free_names(docs, "gone", "of", "lines", "kept")
        per_doc = self.dropped(postings).groupBy(F.col("doc_id").alias(of)).agg(F.collect_list(F.struct("k1", "k2")).alias(gone))
        # A document's list is bounded by its own lines.
        joined = docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col(of)), "left").withColumn(cut, lines_of(F.col("text")))

        def stays(line: Column) -> Column:
            key = line_key(line)
            # Lines too short to count, or of no listed key, stay.
            return (F.length(key) < self.least_chars) | ~F.array_contains(F.col(gone), F.struct(*_hash(key)))

        kept = F.when(F.col(gone).isNull(), F.col(cut)).otherwise(F.filter(cut, stays))
        out = joined.withColumn(left, kept)
        n = F.size(cut).cast("long")
        others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped", "kept_text")]
        return out.select(*others, n.alias("n_lines"), (n - F.size(left)).cast("long").alias("n_dropped"), F.array_join(left, "\n").alias("kept_text"))


def dedup_lines(docs: DataFrame, *, batches: int = BATCHES, **how) -> DataFrame:
    """The documents without their repeated lines, through an index into which they go in batches.

    Batches are divided by a hash of doc_id.  From the second on, the filters tell which keys of a
    batch are certainly new; the others are looked up in the exact tables, which decide.  The
    result is the same for any number of batches.
    """
    index = LineIndex(docs.sparkSession, **how)
    slim = docs.select("doc_id", "text")
    for k in range(batches):
        index.insert(slim.where(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    return index.dedup(docs)
