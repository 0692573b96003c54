"""Packing token sequences by exact complements: full sequences first, best fit for what is left.

Texts are encoded and cut into pieces of at most ``size`` tokens.  What fits with what depends on
lengths only, so the plan is made from the number of pieces of each length: ``size`` numbers, for
any corpus.  Sums of one, two and three lengths are looked up by the gap that a longer piece
leaves; a combination that fills it exactly is used as often as all its lengths are available, in
one step.  What no combination fills goes by best fit: the longest piece that still fits, closed
by an exact combination as soon as there is one.

A plan has a bounded number of patterns.  Pieces find their place in it by their rank among those
of their length; ranks come from counts per block of pieces, so neither a pattern, nor a length
that a third of all pieces have, nor the pieces of one sequence meet in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm.ship import ship
from vigilframe.llm.text import slices, words
from vigilframe.operators.lineage import landed

SIZE = 2048
END_ID = 0
#: What a worker's cache of encoded words may hold.
CACHED_WORDS, CACHED_CHARS = 400_000, 16 << 20
_MARK = "\x01"


# --- encoding ---

_encoders: dict[str, WordEncoder] = {}


@dataclass
class WordEncoder:
    """A tokenizer file that drops white space and never joins what it divides: distinct words are encoded once."""

    path: str
    _made: object = field(default=None, repr=False)

    @staticmethod
    def of_worker(path: str) -> WordEncoder:
        if path not in _encoders:
            _encoders.clear()
            _encoders[path] = WordEncoder(path)
        return _encoders[path]

    def _load(self) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._made = Tokenizer.from_file(self.path)
        self._special = [t.content for t in self._made.get_added_tokens_decoder().values()]
        self._mark = self._made.encode(_MARK, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._chars = 0
        self._ids, self._ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _joined(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row and the end of each; many words a call, a mark behind each."""
        flat = [np.empty(0, np.uint32)]
        for a in range(0, len(some), 1000):
            text = f" {_MARK} ".join(some[a : a + 1000]) + f" {_MARK}"
            flat.append(np.array(self._made.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(flat)
        marks = np.flatnonzero(ids == self._mark[0])
        return np.delete(ids, marks), marks - np.arange(len(marks))

    def _single(self, some: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [np.array(x.ids, np.uint32) for x in self._made.encode_batch_fast(some, add_special_tokens=False)]
        return np.concatenate([np.empty(0, np.uint32), *made]), np.cumsum([len(x) for x in made], dtype=np.int64)

    def _numbers(self, vocabulary: pa.Array) -> np.ndarray:
        """Where each word's ids are kept."""
        if self._made is None:
            self._load()
        if len(self._known) > CACHED_WORDS or self._chars > CACHED_CHARS:
            self._forget()
        listed = vocabulary.to_pylist()
        at = np.array([self._known.get(w, -1) for w in listed], np.int64)
        # Words with control characters or parts of a special token are encoded by themselves.
        odd = pc.match_substring_regex(vocabulary, r"[\x00-\x1f\x7f]").to_numpy(zero_copy_only=False)
        for special in self._special:
            odd |= pc.match_substring(vocabulary, special).to_numpy(zero_copy_only=False)
        if len(self._mark) != 1:
            odd[:] = True
        for encode, mine in ((self._joined, ~odd), (self._single, odd)):
            new = np.flatnonzero((at < 0) & mine)
            if not len(new):
                continue
            some = [listed[i] for i in new]
            ids, ends = encode(some)
            first = len(self._ends) - 1
            self._ids = np.concatenate([self._ids, ids])
            self._ends = np.concatenate([self._ends, ends + self._ends[-1]])
            at[new] = np.arange(first, first + len(new))
            self._known.update(zip(some, range(first, first + len(new)), strict=True))
            self._chars += sum(map(len, some))
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, the end id behind each, and the bounds.  Null texts are empty."""
        made = words(texts, lower=None)
        number = self._numbers(made.vocabulary)[made.codes]
        ids, ends = self._ids, self._ends
        length = ends[number + 1] - ends[number]
        before = np.concatenate([[0], np.cumsum(length)])
        size = before[made.bounds[1:]] - before[made.bounds[:-1]]
        edges = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(edges[-1], END_ID, np.uint32)
        inner = np.ones(edges[-1], bool)
        inner[edges[1:] - 1] = False
        out[inner] = ids[np.arange(before[-1]) + np.repeat(ends[number] - before[:-1], length)]
        return out, edges


# --- the plan ---


@dataclass
class Complements:
    """Sums of one, two and three lengths, looked up by the gap they fill.

    ``left[n]`` pieces of length n are available.  Pairs are kept by their sum, the longest first;
    as lengths only ever run out, a pair that can't be had any more is passed for good.
    """

    left: np.ndarray

    def __post_init__(self):
        size = len(self.left) - 1
        have = np.flatnonzero(self.left)
        self.have = have.tolist()
        a, b = np.tril_indices(len(have))
        a, b = have[a], have[b]
        fits = a + b <= size
        a, b = a[fits], b[fits]
        order = np.lexsort((-a, a + b))
        self.long = a[order].tolist()
        edges = np.searchsorted((a + b)[order], np.arange(size + 2))
        self.first, self.last = edges[:-1].tolist(), edges[1:].tolist()
        self.left = self.left.tolist()

    def free(self, used: Counter) -> bool:
        return all(self.left[n] >= k for n, k in used.items())

    def pair(self, gap: int, used: Counter, *third: int) -> Counter | None:
        """``used`` with ``third`` and two lengths whose sum is the gap."""
        if gap < 2 or self.first[gap] == self.last[gap]:
            return None
        left = self.left
        i, last = self.first[gap], self.last[gap]
        while i < last and not (left[a := self.long[i]] and left[b := gap - a] and (a != b or left[a] > 1)):
            i += 1
        self.first[gap] = i
        for j in range(i, last):
            a = self.long[j]
            b = gap - a
            if left[a] and left[b]:
                found = used + Counter((a, b, *third))
                if self.free(found):
                    return found
        return None

    def filled(self, gap: int, used: Counter, most: int) -> Counter | None:
        """``used`` with up to ``most`` (three at most) more lengths that fill the gap exactly."""
        if gap == 0:
            return used
        if most >= 1 and self.left[gap] > used[gap]:
            return used + Counter((gap,))
        found = self.pair(gap, used) if most >= 2 else None
        if found or most < 3:
            return found
        first, last, left = self.first, self.last, self.left
        for i in range(bisect_right(self.have, gap - 2) - 1, -1, -1):
            c = self.have[i]
            if first[gap - c] < last[gap - c] and left[c] > used[c]:
                found = self.pair(gap - c, used, c)
                if found:
                    return found
        return None

    def take(self, used: Counter) -> int:
        """Takes the lengths of a pattern as often as they last; says how often."""
        times = min(self.left[n] // k for n, k in used.items())
        for n, k in used.items():
            self.left[n] -= times * k
        self.have = [n for n in self.have if self.left[n]] if any(not self.left[n] for n in used) else self.have
        return times


def _plan(counts: Sequence[int], most: int) -> list[tuple[int, dict[int, int]]]:
    size = len(counts) - 1
    index = Complements(np.array(counts, np.int64))
    out = []
    for k in range(most + 1):
        for n in reversed(index.have.copy()):
            # k + 1 pieces of at most n can't fill a sequence below this.
            if (k + 1) * n < size:
                break
            while index.left[n]:
                found = index.filled(size - n, Counter((n,)), k)
                if found is None or not index.free(found):
                    break
                out.append((index.take(found), dict(found)))
    while index.have:
        n = index.have[-1]
        used, gap = Counter((n,)), size - n
        while gap:
            found = index.filled(gap, used, most)
            if found is not None and index.free(found):
                used = found
                break
            i = bisect_right(index.have, gap) - 1
            while i >= 0 and index.left[index.have[i]] <= used[index.have[i]]:
                i -= 1
            if i < 0:
                break
            used[index.have[i]] += 1
            gap -= index.have[i]
        out.append((index.take(used), dict(used)))
    return out


def plan(counts: Sequence[int]) -> list[tuple[int, dict[int, int]]]:
    """Patterns (times, {length: pieces}) that hold ``counts[n]`` pieces of each length n = 0..size.

    Every step uses up at least one length, so the number of patterns doesn't grow with the counts.
    Short pieces spent on exact triples can be missing later; so plans with combinations of up to
    three, two, one and no lengths are made, and the one of fewest sequences is taken.
    """
    size = len(counts) - 1
    least, best = -(-sum(n * k for n, k in enumerate(counts)) // size), None
    for most in (3, 2, 1, 0):
        made = _plan(counts, most)
        total = sum(times for times, _ in made)
        if best is None or total < best[0]:
            best = total, made
        if total == least:
            break
    return best[1]


@dataclass
class Places:
    """The plan turned round: for ranks of each length, the sequence and the offset in it."""

    key: np.ndarray  # length << 44 | first rank
    per: np.ndarray  # pieces of this length in a sequence
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(patterns: list[tuple[int, dict[int, int]]], size: int) -> Places:
        rank, rows, sequence = [0] * (size + 1), [], 0
        for times, used in patterns:
            offset = 0
            for n, k in sorted(used.items(), reverse=True):
                rows.append((n << 44 | rank[n], k, sequence, offset))
                rank[n] += times * k
                offset += n * k
            sequence += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return Places(*table.T)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) | rank, side="right") - 1
        nth = rank - (self.key[at] & ((1 << 44) - 1))
        return self.sequence[at] + nth // self.per[at], self.offset[at] + nth % self.per[at] * length


# --- Spark ---


def nth_of_equal(x: np.ndarray) -> np.ndarray:
    """How many equal values stand before each value."""
    order = np.argsort(x, kind="stable")
    new = np.ones(len(x), bool)
    new[1:] = x[order][1:] != x[order][:-1]
    start = np.flatnonzero(new)
    out = np.empty(len(x), np.int64)
    out[order] = np.arange(len(x)) - np.repeat(start, np.diff(np.append(start, len(x))))
    return out


def _cut(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    mine, part, n = WordEncoder.of_worker(path), TaskContext.get().partitionId(), 0
    for batch in slices(batches, 1):
        ids, edges = mine.encode(batch.column(1))
        total = np.diff(edges)
        pieces = -(-total // size)
        doc = np.repeat(np.arange(batch.num_rows), pieces)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * size
        length = np.minimum(total[doc] - start, size)
        # Pieces follow each other as the ids do.
        ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
        data = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), data,
                pa.array(np.full(len(doc), part << 32 | n, np.int64)), pa.array(nth_of_equal(length)),
            ],
            names=["doc_id", "piece", "start", "length", "ids", "block", "nth"],
        )
        n += 1


def cut(docs: DataFrame, tokenizer: str, *, size: int = SIZE) -> DataFrame:
    """The pieces of every text, stored: doc_id, piece, start, length, ids, ids_crc32, block, nth.

    Ids are little-endian unsigned 32-bit integers.  A null or empty text is the end id alone.
    Rows with a null or repeated doc_id are separate documents.  An empty table has no pieces.
    ``nth`` numbers the pieces of a length within a block.  Other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = rows.mapInArrow(lambda b: _cut(b, tokenizer, size), "doc_id long, piece int, start long, length long, ids binary, block long, nth long")
    return landed(made.withColumn("ids_crc32", F.crc32("ids")))


def placed(pieces: DataFrame, columns: Sequence[str] = ("doc_id", "piece", "start", "length", "ids_crc32"), *, size: int = SIZE) -> DataFrame:
    """``columns`` of each piece of ``cut``, with its sequence_id and its offset there.

    Sequences are numbered from 0 without gaps; none holds more than ``size`` tokens.  Repeated
    rows are places of their own.
    """
    # Counts per block and length: what ranks, the plan and its bounds are made from.
    counted = landed(pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")))
    counts = [0] * (size + 1)
    for row in counted.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``size`` rows
        counts[row.length] = row.n
    shared = pieces.sparkSession.sparkContext.broadcast(Places.of(plan(counts), size))  # bounded by ``size``
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")
    bases = counted.select(F.col("length").alias("__length"), F.col("block").alias("__block"), before.alias("__before"))
    here = (F.col("length") == F.col("__length")) & (F.col("block") == F.col("__block"))
    ranked = pieces.join(bases, here).select(F.col("length").alias("__n"), (F.col("__before") + F.col("nth")).alias("__rank"), *columns)

    def find(batches):
        for batch in batches:
            length, rank = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1))
            sequence, offset = shared.value.find(length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns)
    return ranked.mapInArrow(find, f"{kinds}, sequence_id long, offset long")


def sequences(pieces: DataFrame, *, size: int = SIZE) -> DataFrame:
    """(sequence_id, length, n_pieces, ids): the packed sequences themselves, ids as little-endian 32-bit integers."""
    rows = placed(pieces, ("length", "ids"), size=size)
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("listed", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    packed = rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.count(F.lit(1)).alias("n_pieces"), listed.alias("listed"))
    return packed.select("sequence_id", "length", "n_pieces", joined.alias("ids"))
