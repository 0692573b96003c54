"""Near-duplicate documents by BagMinHash: weighted-Jaccard signatures of shingle bags, banding, exact verification.

A document is the bag of its five-word shingles.  Each shingle has a Poisson process of points in
time over its weight, divided into dyadic pieces [0, 1), [1, 2), [2, 4), ... so that a shingle of
weight w meets the same points in every document, and only those below its weight count; log2(w)
pieces are looked at instead of w.  A point falls on one of ``registers`` places; a document keeps
the first point of each.  Two documents agree on a place with the probability of their weighted
Jaccard similarity.  Agreement on all rows of a band makes a bucket.

Buckets aren't paired out.  Each document is compared with that one of some members of its buckets
(hubs, drawn at random) whose signature is most like its own, and the hubs of a large bucket with
one another.  Nearly all copies of a group come together so.  If ``HUBS`` names further rounds, what is left outside the bucket's largest component
meets other hubs of that component, and hubs drawn from what is outside.  Every round is linear in
the rows of the buckets.

What the rounds leave outside meets all other members of its buckets, however large, but those of
its own component and those that a proof rules out: what two documents have in common is at most
what either has in common with any document of another component.  A near copy with too many words
of its own thus goes by one count over the shingles, whatever the size of its group.  Of the others
both sides are dealt into groups of a bounded number of words, and the texts of a group are compared
all with all, so that a text moves once for a group of others, not once for each.  Signatures and
rounds only spare comparisons: every two documents of a bucket end up compared, in one component, or
proven to be less alike.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.components import components
from vigilframe.llm.text import hashed, mixed, seeded, shingles, slices, words
from vigilframe.operators.lineage import landed

SHINGLE = 5
BANDS, ROWS = 40, 5
THRESHOLD = 0.8
#: Bytes of text whose points are drawn at a time.
BATCH_BYTES = 2 << 20
#: Hubs of a bucket in each round, and hubs drawn from the documents outside its largest component.
HUBS, OUTSIDE_HUBS = (32,), 8
#: Buckets of up to so many members are not worth meetings of hubs and further rounds: all their members meet at last.
SMALL = 16
#: Documents and shingles of a group whose texts are compared all with all.
GROUP, GROUP_SHINGLES = 256, 150_000
_LOW32 = np.uint64(0xFFFFFFFF)


def bags(hashes: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, weight) of all distinct shingles of each document."""
    doc = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return doc[at], hashes[at], np.diff(np.append(at, len(doc)))


def _nodes(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray):
    """The dyadic pieces that each weight reaches: document, hash, lower end, length, weight."""
    depth = np.ceil(np.log2(weight)).astype(np.int64)  # pieces beyond the first
    which = np.repeat(np.arange(len(doc)), depth + 1)
    level = np.arange(len(which)) - np.repeat(np.cumsum(depth + 1) - (depth + 1), depth + 1)
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    node = mixed(shingle[which] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return doc[which], node, low, np.maximum(low, 1.0), weight[which].astype(float)


def signatures(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """n x registers hashes of first points; documents without shingles have zeros."""
    first = np.full(n * registers, np.inf)
    points = np.zeros(n * registers, np.uint64)
    total = np.bincount(doc, weights=weight, minlength=n)
    # Points later than this rarely matter; documents for which they do are gone through again.
    until = registers * (np.log(registers) + 3) / np.maximum(total, 1)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        chosen = np.zeros(n, bool)
        chosen[todo] = True
        mine = chosen[doc]
        owner, node, low, length, most = _nodes(doc[mine], shingle[mine], weight[mine])
        time, k, block = np.zeros(len(node)), 0, 1
        while len(node):
            for step in range(block):
                point = mixed(node + np.uint64((k + step + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
                time = time - np.log(((point >> np.uint64(32)).astype(np.float64) + 1) * 2.0**-32) / length
                use = time <= until[owner]
                partial = low + length > most
                if partial.any():
                    where = low + length * ((mixed(point) >> np.uint64(11)).astype(np.float64) * 2.0**-53)
                    use &= where < most
                at = owner[use] * registers + ((point[use] & _LOW32) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
                np.minimum.at(first, at, time[use])
                won = first[at] == time[use]
                points[at[won]] = point[use][won]
            k += block
            block = min(2 * block, 16)
            alive = time <= until[owner]
            owner, node, low, length, most, time = owner[alive], node[alive], low[alive], length[alive], most[alive], time[alive]
        todo = todo[np.isinf(first.reshape(n, registers)[todo]).any(1)]
        until[todo] *= 2
    return points.reshape(n, registers)


def features(batches, n_words: int, bands: int, rows: int):
    """doc_id, two fingerprints of the whole word sequence, weight, band keys, one bit per register."""
    for batch in slices(batches, 1, BATCH_BYTES):
        made = words(batch.column(1))
        hashes = hashed(made.vocabulary)[made.codes]
        place = (np.arange(len(hashes)) - np.repeat(made.bounds[:-1], made.counts)).astype(np.uint64)
        parts = [mixed(seeded(hashes, s) + place * np.uint64(0x9E3779B97F4A7C15)) for s in (1, 2)]
        running = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(p, dtype=np.uint64)]) for p in parts]
        prints = [(r[made.bounds[1:]] - r[made.bounds[:-1]]).view(np.int64) for r in running]
        shingle, edges = shingles(hashes, made.bounds, n_words)
        n = batch.num_rows
        sig = signatures(*bags(shingle, edges), n, bands * rows).reshape(n, bands, rows)
        key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
        key = np.broadcast_to(mixed(key), (n, bands)).copy()
        for r in range(rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[:, :, r])
        bits = ((mixed(sig.reshape(n, -1)) & np.uint64(1)).astype(np.uint8))
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64)))
        longs = np.packbits(bits, axis=1).view(np.int64)
        weight = np.diff(edges)
        lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64()))
        none = pa.array(weight == 0)
        null = lambda x: pc.if_else(none, pa.scalar(None, pa.int64()), pa.array(x))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), null(prints[0]), null(prints[1]), pa.array(weight), lists(key.view(np.int64)), lists(longs)],
            names=["doc_id", "f1", "f2", "weight", "bands", "bits"],
        )


def tokens(texts: pa.Array, n_words: int) -> list[np.ndarray]:
    """Shingles of each text as a set: the k-th repeat of a shingle is a token of its own."""
    made = words(texts)
    shingle, edges = shingles(hashed(made.vocabulary)[made.codes], made.bounds, n_words)
    doc, shingle, weight = bags(shingle, edges)
    which = np.repeat(np.arange(len(doc)), weight)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(weight) - weight, weight)
    parts = np.where(nth == 0, shingle[which], mixed(shingle[which] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.split(parts, np.cumsum(np.bincount(doc[which], minlength=len(texts)))[:-1])


def overlaps(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Weighted Jaccard similarity of every two of some texts, from their ``tokens``."""
    n, size = len(sets), np.array([len(x) for x in sets], np.float64)
    low = np.zeros((n, n))
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only tokens that several texts have count; some thousands of them at a time.
    shared = times > 1
    place = np.cumsum(shared) - 1
    kept = shared[token]
    owner, place = np.repeat(np.arange(n), size.astype(np.int64))[kept], place[token[kept]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for first in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(place, [first, first + columns])
        has = np.zeros((n, columns), np.float32)
        has[owner[a:b], place[a:b] - first] = 1
        low += has @ has.T
    high = size[:, None] + size[None, :] - low
    return np.where(high > 0, low / np.maximum(high, 1), 0.0)


def linked(similar: np.ndarray) -> np.ndarray:
    """For each row the first row that its links reach."""
    label = np.arange(len(similar))
    while True:
        least = np.minimum(label, np.where(similar, label[None, :], len(label)).min(1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def met(groups: DataFrame, docs: DataFrame, n_words: int, threshold: float) -> DataFrame:
    """(a, b): links that hold the similar texts of each group of ``groups(g, x, name)`` together, by name.

    All texts of a group are compared.  What they link is one star, not all its pairs.
    """
    # Stored, the groups have a known size: texts that are in none aren't moved if it is small.
    groups = landed(groups.select("g", "x", "name").distinct())
    texts = docs.select(F.col("doc_id").alias("x"), "text")
    rows = groups.join(texts, "x").select("g", "name", "text").repartition("g").sortWithinPartitions("g")

    def star(ids: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        if len(ids) == 2:
            low = len(np.intersect1d(*sets, assume_unique=True))
            high = len(sets[0]) + len(sets[1]) - low
            return [(ids[0], ids[1])] if high and low / high >= threshold else []
        label = linked(overlaps(sets) >= threshold)
        return [(ids[i], ids[k]) for i, k in enumerate(label) if i != k]

    def check(batches):
        now, ids, sets = None, [], []

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in slices(batches, 2, BATCH_BYTES):
            found = []
            for g, x, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), tokens(batch.column(2), n_words), strict=True):
                if g != now:
                    found += star(ids, sets) if len(ids) > 1 else []
                    now, ids, sets = g, [], []
                ids.append(x)
                sets.append(own.copy())
            yield batch_of(found)
        yield batch_of(star(ids, sets) if len(ids) > 1 else [])

    return rows.mapInArrow(check, "a long, b long").where("a <> b")


def lonely(docs: DataFrame, rooted: DataFrame, n_words: int) -> DataFrame:
    """(x, lonely): a number of ``tokens`` that x has and no document of another root in ``rooted(x, root)``.

    It may be less than there are: a token that several documents of one root share counts for one
    of them.  Rows of one doc_id are not told apart, so those with several are left out.
    """
    own = landed(rooted.select("x", "root").distinct())
    several = docs.groupBy(F.col("doc_id").alias("x")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x")
    rows = own.join(docs.select(F.col("doc_id").alias("x"), "text"), "x").select("x", "root", "text")

    def cut(batches):
        for batch in slices(batches, 2, BATCH_BYTES):
            sets = tokens(batch.column(2), n_words)
            which = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            token = pa.array(np.concatenate(sets).view(np.int64)) if sets else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(which), batch.column(1).take(which), token], names=["x", "root", "token"])

    held = rows.mapInArrow(cut, "x long, root long, token long")
    one = held.groupBy("token").agg(F.min("x").alias("x"), F.min("root").alias("least"), F.max("root").alias("most")).where("least = most")
    return one.groupBy("x").agg(F.count(F.lit(1)).alias("lonely")).join(several, "x", "left_anti")


def _parts(size: Column, weight: Column) -> Column:
    """Into how many groups so many documents of so many shingles are dealt."""
    return F.ceil(F.greatest(size / GROUP, weight / GROUP_SHINGLES)).cast("long")


def _around(near: DataFrame) -> DataFrame:
    """Groups (g, x, name), named by themselves, of hubs with the documents nearest to them, from (x, weight, hub)."""
    sizes = near.groupBy("hub").agg(_parts(F.count(F.lit(1)), F.sum("weight")).alias("parts"))
    g = F.xxhash64("hub", F.pmod(F.xxhash64("x"), F.col("parts")))
    return near.join(sizes, "hub").select(g.alias("g"), F.explode(F.array("x", "hub")).alias("x")).withColumn("name", F.col("x"))


def _differing(a: Column, b: Column, longs: int) -> Column:
    """In how many registers two signatures differ, by one bit of each."""
    return functools.reduce(Column.__add__, [F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(longs)])


def _hubs(members: DataFrame, n: int, seed: int) -> DataFrame:
    """(key, hubs, n): up to ``n`` members of each bucket, one of each slot that ids are dealt to.

    Buckets of four groups share their order, so that a document meets the same hub in many of
    them and is compared with it once; no document is a hub of all.  ``n`` is the bucket's size.
    """
    order = F.struct(F.xxhash64(F.lit(seed), F.pmod("key", F.lit(4)), "x"), "x")
    slot = F.pmod(F.xxhash64(F.lit(seed + 1), "x"), F.lit(n)).alias("slot")
    one = members.groupBy("key", slot).agg(F.min_by(F.struct("x", "weight", "bits"), order).alias("hub"), F.count(F.lit(1)).alias("n"))
    return one.groupBy("key").agg(F.collect_list("hub").alias("hubs"), F.sum("n").alias("n"))


def _outside(members: DataFrame, found: DataFrame) -> DataFrame:
    """Bucket members with their component's root, and whether it is the bucket's largest."""
    root = found.select(F.col("node").alias("x"), "root")
    rooted = members.join(root, "x", "left").withColumn("root", F.coalesce("root", "x"))
    sizes = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("n_roots"), F.sum("n").alias("n"))
    return rooted.join(largest.where("n_roots > 1"), "key")


def near_duplicates(docs: DataFrame, *, n_words: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, kept) for each row of ``docs``: class_id is the least doc_id that links reach.

    Texts of the same words (but for A-Z and white space) are one class from the start, and only
    one of them takes part in the search.  Null, empty and blank texts link with nothing.  Texts
    of fewer than five words are one shingle.  Rows with a null doc_id are their own class (null)
    and are kept.  Rows of one doc_id are one node, linked by any of their texts.  A pair at the
    threshold meets in no band with a probability of 1e-7.  ``kept`` marks doc_id = class_id.
    """
    known = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    feats = landed(
        known.mapInArrow(
            lambda b: features(b, n_words, bands, rows),
            "doc_id long, f1 long, f2 long, weight long, bands array<long>, bits array<long>",
        )
    )
    with_words = feats.where("f1 IS NOT NULL")
    classes = landed(with_words.groupBy("f1", "f2").agg(F.min_by(F.struct("doc_id", "weight", "bands", "bits"), "doc_id").alias("rep")).select("f1", "f2", "rep.*"))
    copies = with_words.select("f1", "f2", F.col("doc_id").alias("a")).join(classes.select("f1", "f2", F.col("doc_id").alias("b")), ["f1", "f2"]).select("a", "b").where("a <> b")
    # One bit a register differs with half the dissimilarity; six deviations are allowed for.
    n_bits, differ = bands * rows, (1 - threshold) / 2
    most = n_bits * differ + 6 * (n_bits * differ * (1 - differ)) ** 0.5

    longs = -(-n_bits // 64)

    def may_link(a: Column, b: Column) -> Column:
        alike = F.least(a["weight"], b["weight"]) >= F.lit(threshold) * F.greatest(a["weight"], b["weight"])
        return (a["x"] != b["x"]) & alike & (_differing(a["bits"], b["bits"], longs) <= F.lit(most))

    def nearest_hub(rows: DataFrame, hubs: DataFrame, *per: str) -> DataFrame:
        """(x, weight, hub): the most similar hub in all buckets of a document (and each of ``per``), if any may link."""
        own = F.struct("x", "weight", "bits")
        near = F.transform(F.filter("hubs", lambda h: may_link(own, h)), lambda h: F.struct(_differing(F.col("bits"), h["bits"], longs).alias("differ"), h["x"].alias("x")))
        found = rows.join(hubs.select("key", "hubs"), "key").select("x", "weight", *per, F.array_min(near).alias("near")).where("near IS NOT NULL")
        return found.groupBy("x", "weight", *per).agg(F.min("near")["x"].alias("hub")).select("x", "weight", "hub")

    buckets = classes.select(F.explode("bands").alias("key"), F.col("doc_id").alias("x"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    marks = classes.select(F.col("doc_id").alias("x"), "weight", "bits")
    members = landed(buckets.join(shared, "key").join(marks, "x"))
    # Of the texts only those that share a bucket are read again.
    known = landed(known.join(landed(members.select(F.col("x").alias("doc_id")).distinct()), "doc_id", "left_semi"))
    hubs = landed(_hubs(members, HUBS[0], 0))
    meet = hubs.where(F.col("n") > SMALL).select(F.xxhash64(F.lit("hubs"), "key").alias("g"), F.explode("hubs.x").alias("x")).withColumn("name", F.col("x"))
    first = landed(met(_around(nearest_hub(members, hubs)).unionByName(meet), known, n_words, threshold))
    # Without further rounds copies are linked at once.
    found = landed(components(first if HUBS[1:] else first.unionByName(copies)))
    for step, n in enumerate(HUBS[1:], 1):
        rooted = landed(_outside(members, found).where(F.col("n") > SMALL))
        strays = rooted.where("root <> main")
        new = nearest_hub(strays, _hubs(rooted.where("root = main"), n, 4 * step), "main")
        new = new.unionByName(nearest_hub(strays, _hubs(strays, OUTSIDE_HUBS, 4 * step + 2))).distinct()
        first = landed(first.unionByName(met(_around(new), known, n_words, threshold)))
        found = landed(components(first if step + 1 < len(HUBS) else first.unionByName(copies)))
    # What is still outside meets all members that may link; both sides are dealt into groups.
    rooted = landed(_outside(members, found).select("key", "x", "weight", "root", "main", (F.col("root") == F.col("main")).alias("within")))
    common = F.col("weight") - F.coalesce("lonely", F.lit(0))
    able = rooted.join(lonely(known, rooted, n_words), "x", "left").withColumn("common", common)
    # A link needs that share of the larger of two in common; some more for rounding.
    able = able.where(F.col("common") + 1e-6 >= F.lit(threshold) * F.col("weight")).drop("lonely")
    apart = able.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key")
    able = landed(able.join(apart, "key"))
    sizes = able.select("main", "within", "x", "weight").distinct().groupBy("main", "within").agg(_parts(F.count(F.lit(1)), F.sum("weight")).alias("parts"))
    part = F.struct("within", F.pmod(F.xxhash64("x"), F.col("parts")).alias("part"))
    dealt = able.join(sizes, ["main", "within"]).select("main", "key", "x", "weight", "common", "root", "within", part.alias("part"))
    all_of = dealt.groupBy("key", F.col("part").alias("met")).agg(F.collect_list(F.struct("weight", "common", "root")).alias("others"))

    def not_ruled_out(o: Column) -> Column:
        enough = F.lit(1 + threshold) * F.least(F.col("common"), o["common"]) + 1e-6 >= F.lit(threshold) * (F.col("weight") + o["weight"])
        return (o["root"] != F.col("root")) & enough

    # Both sides ask, so that a group has those of either that may link with some of the other.
    asked = dealt.join(all_of, "key").where("NOT (within AND met.within)").where(F.exists("others", not_ruled_out))
    groups = asked.select(F.xxhash64("main", F.least("part", "met"), F.greatest("part", "met")).alias("g"), "x", F.col("root").alias("name"))
    # What links now are components, by their roots: the least of the roots is that of all.
    second = met(groups, known, n_words, threshold).distinct()
    over = components(second).select(F.col("node").alias("__above"), F.col("root").alias("__over"))
    below = found.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    joined = docs.select("doc_id").join(below, F.col("doc_id") == F.col("__node"), "left").withColumn("__above_of", F.coalesce("__root", "doc_id"))
    joined = joined.join(over, F.col("__above_of") == F.col("__above"), "left")
    class_id = F.coalesce("__over", "__above_of")
    return joined.select("doc_id", class_id.alias("class_id"), F.coalesce(class_id == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each class (all rows of its doc_id)."""
    name = "gone"
    while name in docs.columns:
        name += "_"
    gone = near_duplicates(docs, **how).where("NOT kept").select(F.col("doc_id").alias(name))
    return docs.join(gone, docs["doc_id"] == F.col(name), "left_anti")
