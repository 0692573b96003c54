"""Vector code compression: codebooks of integer parts, searched by a geometric near-neighbour access tree.

Vectors become integers, are cut into equal parts, and each part becomes the index of its nearest
codebook entry.  Codebooks are learned in rounds of assignment and means.  Only entries' sums and
counts reach the driver: a fixed number of integers, whatever the number of vectors.

The tree (GNAT) stands over the entries of one part position.  A node has some split points far
from each other; every other entry belongs to the nearest of them, and for each split point and
each subtree the node keeps the range of distances between them.  If a query's distance to a split
point is so far outside that range that the triangle inequality puts the whole subtree strictly
farther than the best entry so far, the subtree is left out.  Roots are rounded against leaving
out; squared distances are integers, and equal ones go to the lower index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.ship import ship
from vigilframe.operators.lineage import landed

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
SPLITS = 4
#: Integer components up to this size keep squared distances of parts of up to 64 components within 64 bits.
LARGEST = 1 << 27
#: Relative error that an integer's conversion to a double and its root stay well below.
_ROUNDING = 2.0**-50
_FARTHEST = np.iinfo(np.int64).max
_SALTS = 16


def _squares(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return ((x - entry) ** 2).sum(-1)


def _down(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 - _ROUNDING)


def _up(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + _ROUNDING)


@dataclass
class Gnat:
    """The tree over ``entries[numbers]``; ``low`` and ``high`` are [split point, subtree]."""

    entries: np.ndarray
    numbers: np.ndarray
    splits: np.ndarray = field(init=False)
    subtrees: list = field(init=False)
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self):
        x = self.entries[self.numbers]
        chosen = [0]
        near = _squares(x, x[0])
        # Each next split point is the entry farthest from those chosen.
        while len(chosen) < min(SPLITS, len(x)):
            nearest = near.copy()
            nearest[chosen] = -1
            chosen.append(int(nearest.argmax()))
            near = np.minimum(near, _squares(x, x[chosen[-1]]))
        self.splits = self.numbers[chosen]
        apart = np.stack([_squares(x, x[c]) for c in chosen])
        home = apart.argmin(0)
        home[chosen] = -1
        self.subtrees = [Gnat(self.entries, self.numbers[home == j]) if (home == j).any() else None for j in range(len(chosen))]
        inside = [apart[:, home == j] for j in range(len(chosen))]
        none = np.zeros(len(chosen))
        self.low = np.stack([_down(d.min(1)) if d.shape[1] else none for d in inside], axis=1)
        self.high = np.stack([_up(d.max(1)) if d.shape[1] else none for d in inside], axis=1)

    def search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, number: np.ndarray) -> int:
        """Improves ``best`` and ``number`` of the queries ``rows``; returns how many distances it took."""
        apart = np.stack([_squares(x[rows], self.entries[s]) for s in self.splits], axis=1)
        for j, s in enumerate(self.splits):
            better = (apart[:, j] < best[rows]) | ((apart[:, j] == best[rows]) & (s < number[rows]))
            best[rows[better]], number[rows[better]] = apart[better, j], s
        from_below, from_above = _down(apart), _up(apart)
        taken = apart.size
        for j, subtree in enumerate(self.subtrees):
            if subtree is None:
                continue
            reach = _up(best[rows])[:, None]
            # Strictly farther by any split point: above its range or below it.
            beyond = (from_below - self.high[:, j]) * (1 - _ROUNDING) > reach
            short = (self.low[:, j] - from_above) * (1 - _ROUNDING) > reach
            alive = rows[~(beyond | short).any(1)]
            if len(alive):
                taken += subtree.search(x, alive, best, number)
        return taken


def nearest(entries: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's nearest entry (the lowest of equally near ones) and the squared distance."""
    best, number = np.full(len(x), _FARTHEST), np.full(len(x), len(entries))
    if len(x):
        Gnat(entries, np.arange(len(entries))).search(x, np.arange(len(x)), best, number)
    return number, best


def _cut(column: pa.Array, n: int, parts: int, width: int) -> np.ndarray:
    """Rows x parts x width; missing components at the end are zeros."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)
    return np.pad(x, ((0, 0), (0, parts * width - x.shape[1]))).reshape(n, parts, width)


def integers(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, v): integer vectors of the rows without null or non-finite components."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))

    def whole(c):
        scaled = c.cast("double") * scale
        return F.when(F.abs(scaled) <= LARGEST, F.floor(scaled).cast("int")).otherwise(F.raise_error("a vector component is too large").cast("int"))

    kept = rows.where(x.isNotNull() & (F.size(x) > 0) & F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.transform(x, whole).alias("v"))


@dataclass
class Codebooks:
    """parts x entries x components."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _sums(batches, books: np.ndarray):
    """Per task, the counts and sums of each entry's parts, as (cell, value) rows."""
    parts, size, width = books.shape
    total = np.zeros((parts, size, width + 1), np.int64)
    for batch in batches:
        x = _cut(batch.column(0), batch.num_rows, parts, width)
        for p in range(parts):
            number, _ = nearest(books[p], x[:, p])
            np.add.at(total[p], number, np.concatenate([np.ones((len(x), 1), np.int64), x[:, p]], axis=1))
    cells = np.flatnonzero(total.ravel())
    yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total.ravel()[cells])], names=["cell", "value"])


def train(vectors: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of integer ``vectors(id, v)`` of one length: they start with those of the least ids.

    Rows without an id come last, rows of one id in order of their components.  An entry that
    nothing is nearest to stays.  Fewer rows than entries make smaller codebooks.
    """
    first = vectors.select("id", "v").orderBy(F.asc_nulls_last("id"), "v").limit(entries).collect()
    width = -(-len(first[0].v) // parts) if first else 0
    seeds = pa.array([r.v for r in first], pa.list_(pa.int32()))
    books = _cut(seeds, len(first), parts, width).transpose(1, 0, 2).copy() if first else np.zeros((parts, 0, 0), np.int64)
    for _ in range(rounds if first else 0):
        made = vectors.select("v").mapInArrow(lambda b, now=books: _sums(b, now), "cell long, value long")
        total = np.zeros((parts, len(first), width + 1), object)
        # One row for each entry and component.
        for row in made.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
            total.reshape(-1)[row.cell] = int(row.value)
        for p, e in zip(*np.nonzero(total[:, :, 0]), strict=True):
            books[p, e] = [s // total[p, e, 0] for s in total[p, e, 1:]]
    return Codebooks(books)


def encoded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, codes, error) of integer ``vectors(id, label, v)``; codes are bytes in order of the parts."""

    def assign(batches):
        parts, _, width = books.entries.shape
        for batch in batches:
            x = _cut(batch.column(2), batch.num_rows, parts, width)
            found = [nearest(books.entries[p], x[:, p]) for p in range(parts)]
            codes = np.stack([n for n, _ in found], axis=1).astype(np.uint8)
            error = sum((d for _, d in found), np.zeros(len(x), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)], names=["id", "label", "codes", "error"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("id", "label", "v").mapInArrow(assign, f"id long, label {kind}, codes binary, error long")


def decoded(codes: DataFrame, books: Codebooks, *, scale: int = SCALE) -> DataFrame:
    """(id, v): the vectors that ``codes(id, codes)`` stand for, with an error of up to the parts' distances."""

    def restore(batches):
        parts, _, width = books.entries.shape
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, parts)
            v = books.entries[np.arange(parts)[None], code].reshape(batch.num_rows, parts * width) / scale
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(v), pa.list_(pa.float64()))], names=["id", "v"])

    return codes.select("id", "codes").mapInArrow(restore, "id long, v array<double>")


def compressed(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(id, label, codes, error, label_error) of each row that has a usable vector, and the codebooks.

    Rows whose vector is null, empty or holds null or non-finite components are left out, and so are
    vectors of another length than that of the least id; a length that the parts don't divide is
    filled up with zeros.  Components beyond ``LARGEST / scale`` raise an error.  Rows with a null or
    repeated id are rows of their own.  ``label_error`` is the error of all rows of the label,
    nulls together.  An empty table has no rows and empty codebooks.  Other columns are ignored.
    """
    ship(rows.sparkSession)
    whole = landed(integers(rows, id_col, vector_col, label_col, scale))
    first = whole.orderBy(F.asc_nulls_last("id"), "v").limit(1).select(F.size("v").alias("n")).collect()
    whole = whole.where(F.size("v") == (first[0].n if first else 0))
    books = train(whole, parts=parts, entries=entries, rounds=rounds)
    made = landed(encoded(whole, books))
    per_label = made.groupBy("label").agg(F.sum("error").alias("label_error"))
    # A label may hold a third of all rows: its total goes to several tasks, its rows are dealt to them.
    per_label = per_label.select(F.col("label").alias("__label"), "label_error", F.explode(F.array(*map(F.lit, range(_SALTS)))).alias("__salt"))
    salted = made.withColumn("__own", F.pmod(F.xxhash64("id", "codes"), F.lit(_SALTS)).cast("int"))
    joined = salted.join(per_label, F.col("label").eqNullSafe(F.col("__label")) & (F.col("__own") == F.col("__salt")))
    return joined.select("id", "label", "codes", "error", "label_error"), books
