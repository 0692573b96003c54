"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank.

A bounded sample trains coarse centres and, for residuals to them, a codebook for each group of
components.  Every vector is indexed: in the list of its nearest centre, as one code per group
and the length of what the codes leave out.  A vector probes its own list and all lists whose
centre is nearly as near.  How nearly is measured when the index is fitted: vectors of the sample
are moved to exactly the linking distance in random directions, and the margin is the largest by
which the list of the moved vector then lay behind; a vector between many centres probes many
lists, one close to its centre few.  Both vectors of a pair probe, so a link between them is lost
only if neither finds the other.  In a list, distances come from tables of the query's distances
to the codes; since a vector is at most its leftover away from its code, those whose table
distance is above the linking distance plus leftover are safely skipped, and the others compared
exactly.

Neighbouring lists make a cell, to which a query is sent once with the lists it probes there.  A
task sees one block of queries and one block of a cell.  It counts links, and hands on only edges
that keep the linked together: no pairs of a group are listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.components import components
from vigilframe.operators.lineage import landed

THRESHOLD = 0.95
BLOCK = 1024
#: Vectors of a cell and queries for it that a task sees.
CELL, QUERIES = 4096, 16384
#: What rounding can add to a distance.
SLACK = 1e-5


@dataclass
class Index:
    centres: np.ndarray  # lists x components
    codebooks: np.ndarray  # groups x codes x components of a group
    margin: float  # lists whose score lies at most so far behind are probed

    def lists(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.centres.T - 0.5 * (self.centres**2).sum(1)).argmax(1)

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals to the centres, and the length of what they leave out."""
        left = x - self.centres[own]
        groups, _, width = self.codebooks.shape
        codes = np.empty((len(x), groups), np.uint8)
        rest = np.zeros(len(x))
        for g in range(groups):
            part = left[:, g * width : (g + 1) * width]
            book = self.codebooks[g]
            codes[:, g] = (part @ book.T - 0.5 * (book**2).sum(1)).argmax(1)
            rest += ((part - book[codes[:, g]]) ** 2).sum(1)
        return codes, np.sqrt(rest)

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) of all lists to look into."""
        return np.nonzero(self._behind(x) <= self.margin)

    def _behind(self, x: np.ndarray) -> np.ndarray:
        score = x @ self.centres.T - 0.5 * (self.centres**2).sum(1)
        return score.max(1, keepdims=True) - score


def _margin(index: Index, x: np.ndarray, threshold: float, rng) -> float:
    """How far behind the list of a vector at the linking distance can lie, by the sample."""
    if x.shape[1] < 2:
        return float("inf")
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1, keepdims=True) * x
    away /= np.sqrt((away**2).sum(1, keepdims=True))
    moved = threshold * x + np.sqrt(1 - threshold**2) * away
    return float(index._behind(x)[np.arange(len(x)), index.lists(moved)].max()) + SLACK


def _means(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    x = np.unique(x, axis=0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = (x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)
        n = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres[n > 0] = total[n > 0] / n[n > 0][:, None]
    return centres


def train(x: np.ndarray, lists: int, groups: int, threshold: float = THRESHOLD, codes: int = 256, seed: int = 1) -> Index:
    rng = np.random.default_rng(seed)
    groups = next(g for g in range(min(groups, x.shape[1]), 0, -1) if x.shape[1] % g == 0)
    centres = _means(x, lists, 8, rng)
    left = x - centres[(x @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)]
    width = x.shape[1] // groups
    books = [_means(left[:, g * width : (g + 1) * width], codes, 8, rng) for g in range(groups)]
    size = max(map(len, books))
    index = Index(centres, np.stack([np.concatenate([b, np.repeat(b[:1], size - len(b), axis=0)]) for b in books]), 0.0)
    # Several directions for each vector of a small sample.
    index.margin = max(_margin(index, x, threshold, rng) for _ in range(max(1, min(20, 20_000 // len(x)))))
    return index


def _forest(hits: np.ndarray) -> np.ndarray:
    """(row, column) edges that connect what the true cells of ``hits`` connect, fewer than rows plus columns."""
    rows, columns = hits.shape
    root = np.arange(rows + columns)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    # The first column of each row and the first row of each column come first; few cells are left after them.
    some = np.flatnonzero(hits.any(1))
    edges = [np.stack([some, hits[some].argmax(1)], axis=1)]
    some = np.flatnonzero(hits.any(0))
    edges.append(np.stack([hits[:, some].argmax(0), some], axis=1))
    for a, b in np.concatenate(edges):
        root[find(a)] = find(rows + b)
    label = np.array([find(i) for i in range(rows + columns)])
    a, b = np.nonzero(hits & (label[:rows, None] != label[None, rows:]))
    more = []
    for i, j in zip(a, b, strict=True):
        p, q = find(i), find(rows + j)
        if p != q:
            root[p] = q
            more.append((i, j))
    return np.concatenate([*edges, np.array(more, np.int64).reshape(-1, 2)])


def compare(q: np.ndarray, b: np.ndarray, own: int, codes: np.ndarray, rest: np.ndarray, index: Index, threshold: float) -> np.ndarray:
    """Which of q link with which of b (one list's vectors): table distances first, then exact cosine."""
    reach = np.sqrt(2 - 2 * threshold)
    groups, _, width = index.codebooks.shape
    left = q - index.centres[own]
    distance = np.zeros((len(q), len(b)), np.float32)
    for g in range(groups):
        part, book = left[:, g * width : (g + 1) * width], index.codebooks[g]
        table = ((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)).astype(np.float32)
        distance += np.take(table, codes[:, g], axis=1)
    i, j = np.nonzero(distance <= ((reach + rest + SLACK) ** 2 + SLACK).astype(np.float32))
    hits = np.zeros(distance.shape, bool)
    for a in range(0, len(i), 1 << 18):
        p, r = i[a : a + (1 << 18)], j[a : a + (1 << 18)]
        hits[p, r] = np.einsum("nd,nd->n", q[p], b[r]) >= threshold
    return hits


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that can link: v has length 1 in double precision."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    known = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), length.alias("n"), F.coalesce(fine, F.lit(False)).alias("fine"))
    usable = known.where(F.col("id").isNotNull() & F.col("fine") & (F.size("v") > 0) & (F.col("n") > 0) & (F.col("n") < F.lit(float("inf"))))
    return usable.select("id", F.transform("v", lambda x: x / F.col("n")).alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(n, -1)


def _one_width(units: DataFrame, *, threshold: float, lists: int | None, groups: int, sample: int):
    """(id, n_links) and (a, b) edges among distinct vectors of one length.  ``units`` has (id, copies, v)."""
    spark = units.sparkSession
    n = units.count()
    lists = lists or int(max(1, min(4096, round(n**0.5))))
    u = F.pmod(F.xxhash64(F.lit(17), "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    seen = units.where(u * n < sample).select("id", "v").limit(2 * sample).toPandas().sort_values("id")
    if len(seen) == 0:
        seen = units.select("id", "v").limit(1).toPandas()
    index = train(np.stack(seen["v"]), lists, groups, threshold)
    # Neighbouring lists make a cell.
    cells = _means(index.centres, max(1, n // CELL), 8, np.random.default_rng(2))
    cell_of = (index.centres @ cells.T - 0.5 * (cells**2).sum(1)).argmax(1)
    # At most 4096 centres, 256 codes a group and a number a list.
    shared = spark.sparkContext.broadcast((index.centres, index.codebooks, index.margin, cell_of))

    def assign(batches):
        *made, cell = shared.value
        index = Index(*made)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2), batch.num_rows)
                own = index.lists(x)
                codes, rest = index.encode(x, own)
                code = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell[own].astype(np.int32)), pa.array(own.astype(np.int32)), code, pa.array(rest)],
                    names=["id", "copies", "v", "cell", "list", "code", "rest"],
                )

    indexed = landed(units.mapInArrow(assign, "id long, copies long, v array<double>, cell int, list int, code binary, rest double"))

    def probe(batches):
        *made, cell = shared.value
        index = Index(*made)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                some = batch.slice(a, 1024)
                who, where = index.probes(_matrix(some.column(1), some.num_rows))
                order = np.lexsort((where, cell[where], who))
                who, where = who[order], where[order].astype("<i4")
                first = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (cell[where][1:] != cell[where][:-1])]))
                last = np.append(first[1:], len(who))
                taken = some.take(pa.array(who[first]))
                lists_ = pa.array([where[x:y].tobytes() for x, y in zip(first, last, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array(cell[where[first]].astype(np.int32)), lists_], names=["id", "v", "cell", "lists"])

    asked = landed(indexed.select("id", "v").mapInArrow(probe, "id long, v array<double>, cell int, lists binary"))
    # Cells and their queries are cut into as many blocks as they ask for; every block of the one meets every block of the other.
    parts = indexed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).cast("int").alias("parts"))
    q_groups = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).cast("int").alias("q_groups"))
    shape = landed(parts.join(q_groups, "cell"))
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n).cast("long")).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = asked.join(shape, "cell").withColumn("q_group", dealt(29, "q_groups")).select("cell", all_of("parts").alias("part"), "q_group", "id", "v", "lists")
    stored = indexed.join(shape, "cell").withColumn("part", dealt(23, "parts"))
    stored = stored.select("cell", "part", all_of("q_groups").alias("q_group"), "id", "copies", "v", "list", "code", "rest")

    def link(key, queries, members):
        *made, _ = shared.value
        index = Index(*made)
        if not queries.num_rows or not members.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        probed = [np.frombuffer(x, "<i4") for x in queries.column("lists").to_pylist()]
        who, where = np.repeat(np.arange(len(probed)), [len(x) for x in probed]), np.concatenate(probed)
        order = np.argsort(where, kind="stable")
        who, where = who[order], where[order]
        members = members.sort_by("list")
        own = members.column("list").to_numpy()
        q_id, b_id = queries.column("id").to_numpy(), members.column("id").to_numpy()
        q, b = _matrix(queries.column("v"), queries.num_rows), _matrix(members.column("v"), members.num_rows)
        codes = np.frombuffer(b"".join(members.column("code").to_pylist()), np.uint8).reshape(len(b), -1)
        rest, copies = members.column("rest").to_numpy(), members.column("copies").to_numpy()
        out = []
        for number in np.unique(own):
            mine = slice(*np.searchsorted(own, [number, number + 1]))
            asking = who[slice(*np.searchsorted(where, [number, number + 1]))]
            for s in range(0, len(asking), BLOCK):
                some = asking[s : s + BLOCK]
                hits = compare(q[some], b[mine], number, codes[mine], rest[mine], index, threshold)
                ids = q_id[some]
                hits &= ids[:, None] != b_id[mine][None]
                links = hits @ copies[mine]
                found = np.flatnonzero(links)
                if len(found):
                    out.append((ids[found], np.full(len(found), -1), links[found]))
                    e = _forest(hits)
                    out.append((ids[e[:, 0]], b_id[mine][e[:, 1]], np.zeros(len(e), np.int64)))
        a, b_, n_ = (np.concatenate(x) if out else np.empty(0, np.int64) for x in (zip(*out, strict=True) if out else ([], [], [])))
        edge = b_ != -1
        return pa.table({"a": pa.array(a), "b": pa.array(np.where(edge, b_, 0), mask=~edge), "links": pa.array(n_.astype(np.int64))})

    by = ("cell", "part", "q_group")
    return landed(asked.groupBy(*by).cogroup(stored.groupBy(*by)).applyInArrow(link, "a long, b long, links long"))


def near_vectors(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, lists: int | None = None, groups: int = 16, sample: int = 20_000) -> DataFrame:
    """(id, n_links, component_id, kept) for each row: links are other rows of cosine ``threshold`` or more.

    Equal vectors are searched for once and linked with each other.  Vectors that are null, empty,
    zero or hold a null or non-finite component link with nothing; so do rows with a null id, whose
    component is null.  Vectors of different lengths never link.  A repeated id counts as separate
    rows in n_links, and is one node of its component.  The index is fitted on about ``sample``
    vectors; every vector is indexed and is a query.  -1 can't be an id.
    """
    units = landed(unit_vectors(rows, id_col, vector_col))
    # Equal directions up to rounding in the last places needn't be caught here: they link below.
    classes = landed(units.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    widths = [r.w for r in classes.select(F.size("v").alias("w")).distinct().orderBy("w").collect()]
    made = None
    for w in widths:
        some = landed(classes.where(F.size("v") == w).select("id", "copies", "v"))
        one = _one_width(some, threshold=threshold, lists=lists, groups=groups, sample=sample)
        made = one if made is None else made.unionByName(one)
    ids = rows.select(F.col(id_col).alias("__id"))
    if made is None:
        return ids.select(F.col("__id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("__id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    classed = units.withColumnRenamed("id", "member").join(classes, "v").select("member", "id", "copies")
    counts = made.where("b IS NULL").groupBy("a").agg(F.sum("links").alias("links"))
    per_class = classes.select("id", "copies").join(counts, F.col("id") == F.col("a"), "left")
    per_class = per_class.select(F.col("id").alias("rep"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    edges = made.where("b IS NOT NULL").select("a", "b")
    found = components(landed(edges)).select(F.col("node").alias("rep"), "root")
    per_class = per_class.join(found, "rep", "left").select("rep", "n_links", F.coalesce("root", "rep").alias("root"))
    members = landed(classed.join(per_class, F.col("id") == F.col("rep")).select("member", "n_links", "root"))
    members = members.groupBy("member").agg(F.max("n_links").alias("n_links"), F.min("root").alias("root"))
    joined = ids.join(members, F.col("__id") == F.col("member"), "left")
    component = F.coalesce("root", F.col("__id").cast("long"))
    return joined.select(
        F.col("__id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("__id"), F.lit(True)).alias("kept"),
    )
