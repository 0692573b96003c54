"""Alignment of two tokenizers' tokens by merge-path partitioning of their byte ends.

The ends of all tokens of a batch of texts are two sorted lists, one a tokenizer.  Merging them
tells which tokens share bytes.  The merge is divided into pieces of equal work: a binary search
on each diagonal of the merge grid finds how many ends of either list the pieces before it take,
so every piece runs by itself, and numpy runs all pieces of a batch step by step together.  Each
piece emits the overlaps it meets, (A token, B token) with common bytes, and marks those after
which both tokens end.  Counting marks over the pieces stitches overlaps that a piece's edge
divides into groups: a group ends where both tokenizers end.

How many documents hold a pair of ids linked is counted over all documents: a block of texts
asks with its distinct pairs, once each, and only answers go back to the blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.ship import ship
from vigilframe.llm.text import slices
from vigilframe.operators.lineage import landed

PIECE = 64
#: Bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: What a worker's cache of encoded units may hold.
CACHED_UNITS, CACHED_CHARS = 300_000, 16 << 20
#: Groups of more links than this are counted by distinct ids.
WIDE = 256
#: A single space between characters that no tokenizer counts as white space: both end a token there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_PLAIN = r"^[^\x00-\x20\x7f-\x{a0}\p{Z}](?:[^\x00-\x09\x0b-\x20\x7f-\x{a0}\p{Z}]*[^\x00-\x20\x7f-\x{a0}\p{Z}])?$"


# --- merging ---


@dataclass
class Overlaps:
    """Pairs of tokens that share bytes, in order, and whether both end with them."""

    a: np.ndarray
    b: np.ndarray
    together: np.ndarray


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of a and of b come before each multiple of ``piece`` in the merge; equal ends of a come first."""
    d = np.arange(0, len(a) + len(b), piece)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        of_a, of_b = a[np.minimum(mid, len(a) - 1)], b[np.clip(d - 1 - mid, 0, len(b) - 1)]
        before = open_ & (of_a <= of_b)
        low = np.where(before, mid + 1, low)
        high = np.where(open_ & ~before, mid, high)
    return low, d - low


def overlaps(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> Overlaps:
    """Overlaps of tokens with the ends ``a`` and ``b``, sorted, without repeats, and with one last end."""
    if not len(a) or not len(b):
        none = np.empty(0, np.int64)
        return Overlaps(none, none, np.empty(0, bool))
    i, j = diagonals(a, b, piece)
    steps = min(piece, len(a) + len(b))
    made_a, made_b = np.empty((len(i), steps), np.int64), np.empty((len(i), steps), np.int64)
    kept, together = np.zeros((len(i), steps), bool), np.zeros((len(i), steps), bool)
    # Ends beyond the last are never taken.
    top = np.iinfo(np.int64).max
    a, b = np.append(a, top), np.append(b, top)
    before = np.concatenate([[-1], a[:-1]])
    for k in range(steps):
        of_a, of_b = a[i], b[j]
        from_a = of_a <= of_b
        made_a[:, k], made_b[:, k] = i, j
        # An end of b that an end of a came with has no bytes left.
        kept[:, k] = np.where(from_a, of_a < top, of_b > before[i])
        together[:, k] = of_a == of_b
        last = len(a) - 1
        i = np.minimum(i + from_a, last)
        j = np.minimum(j + ~from_a, len(b) - 1)
    # The last piece may be shorter than the others.
    rest = len(a) + len(b) - 2 - (len(made_a) - 1) * piece
    kept[-1, rest:] = False
    return Overlaps(made_a[kept], made_b[kept], together[kept])


def groups(found: Overlaps, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token."""
    group = np.cumsum(found.together) - found.together
    of_a, of_b = np.empty(n_a, np.int64), np.empty(n_b, np.int64)
    of_a[found.a], of_b[found.b] = group, group
    return of_a, of_b


# --- encoding ---


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, all others as characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [x for x in range(256) if x not in set(printable)]
    return {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(others)}


@dataclass
class Batch:
    """Tokens of a batch of texts: ids, and the bounds of each text; texts that have none are empty."""

    a: np.ndarray
    a_bounds: np.ndarray
    b: np.ndarray
    b_bounds: np.ndarray


_pairs: dict[tuple[str, str], Pair] = {}


@dataclass
class Pair:
    """A byte-level tokenizer file (A) and a sentencepiece model (B).

    Texts are cut at single spaces, where neither tokenizer joins what the space divides, and
    distinct units are encoded once.  If B has a token with a space behind other characters, texts
    are encoded whole.
    """

    a_path: str
    b_path: str
    _ready: bool = field(default=False, repr=False)

    @staticmethod
    def of_worker(a_path: str, b_path: str) -> Pair:
        if (a_path, b_path) not in _pairs:
            _pairs.clear()
            _pairs[a_path, b_path] = Pair(a_path, b_path)
        return _pairs[a_path, b_path]

    def load(self) -> Pair:
        if self._ready:
            return self
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.of_a, self.of_b = Tokenizer.from_file(self.a_path), SentencePieceProcessor(model_file=self.b_path)
        self.of_a.encode_special_tokens = True
        byte = _byte_of_char()
        a_size, b_size = self.of_a.get_vocab_size(), self.of_b.vocab_size()
        self.a_bytes = [bytes(byte.get(c, 0x3F) for c in self.of_a.id_to_token(i) or "") for i in range(a_size)]
        pieces = [self.of_b.id_to_piece(i) for i in range(b_size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.of_b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.by_units = not any(re.search("[^▁]▁", p) for p in pieces)
        # Decimal ids followed by nothing or a separator, in rows of equal width filled up with zero bytes.
        written = np.array([f"{i}{s}".encode() for i in range(max(a_size, b_size)) for s in ("", ",", "|", ";")])
        self.written = written.view(np.uint8).reshape(len(written), -1)
        self.width = (self.written != 0).sum(1)
        self._forget()
        self._ready = True
        return self

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._chars = 0
        self._a: list[int] = []
        self._b: list[int] = []
        self._a_ends, self._b_ends, self._whole = [0], [0], []

    def _numbers(self, units: list[str]) -> np.ndarray:
        """Where each unit's tokens are kept."""
        if len(self._known) > CACHED_UNITS or self._chars > CACHED_CHARS:
            self._forget()
        new = list(dict.fromkeys(u for u in units if u not in self._known))
        for s in range(0, len(new), 4096):
            some = new[s : s + 4096]
            of_a = self.of_a.encode_batch_fast([" " + u for u in some], add_special_tokens=False)
            for unit, x, y in zip(some, of_a, self.of_b.encode(some, num_threads=1), strict=True):
                self._known[unit] = len(self._whole)
                self._chars += len(unit)
                wanted, x = b" " + unit.encode(), x.ids
                self._whole.append(b"".join([self.a_bytes[i] for i in x]) == wanted == b"".join([self.b_bytes[i] for i in y]))
                self._a += x
                self._b += y
                self._a_ends.append(len(self._a))
                self._b_ends.append(len(self._b))
        return np.array([self._known[u] for u in units], np.int64)

    def _units(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Units, their numbers in order of the texts, and the text of each."""
        n = len(texts)
        if not self.by_units:
            return texts.to_pylist(), np.arange(n), np.arange(n)
        pieces = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pieces.flatten().dictionary_encode()
        codes, owner = coded.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(n), counts)
        plain = pc.match_substring_regex(coded.dictionary, _PLAIN).to_numpy(zero_copy_only=False)
        odd = np.zeros(n, bool)
        odd[owner[~plain[codes]]] = True
        units = coded.dictionary.to_pylist()
        at = np.flatnonzero(odd)
        if not len(at):
            return units, codes, owner
        cut = [_CUT.split(t) for t in texts.take(pa.array(at)).to_pylist()]
        more = pa.array([u for x in cut for u in x], pa.string()).dictionary_encode()
        kept = ~odd[owner]
        codes = np.concatenate([codes[kept], more.indices.to_numpy(zero_copy_only=False) + len(units)])
        owner = np.concatenate([owner[kept], np.repeat(at, [len(x) for x in cut])])
        order = np.argsort(owner, kind="stable")
        return units + more.dictionary.to_pylist(), codes[order], owner[order]

    def encode(self, texts: pa.Array) -> Batch:
        """Tokens of space + text, for texts that both tokenizers give back byte by byte."""
        self.load()
        texts = pc.fill_null(texts, "")
        n = len(texts)
        units, codes, owner = self._units(texts)
        used = np.zeros(len(units), bool)
        used[codes] = True
        number = np.zeros(len(units), np.int64)
        number[used] = self._numbers([u for u, x in zip(units, used, strict=True) if x])
        number = number[codes]
        wrong = np.bincount(owner, weights=~np.array(self._whole, bool)[number], minlength=n) > 0
        empty = pc.binary_length(texts).to_numpy(zero_copy_only=False) == 0
        good = ~wrong & ~empty
        for i in np.flatnonzero(wrong & ~empty):
            # Units that don't come back may still do so together.
            mine, wanted = number[owner == i], b" " + texts[i].as_py().encode()
            good[i] = all(b"".join(t[x] for u in mine for x in ids[e[u] : e[u + 1]]) == wanted for t, ids, e in ((self.a_bytes, self._a, self._a_ends), (self.b_bytes, self._b, self._b_ends)))
        number, owner = number[good[owner]], owner[good[owner]]
        out = []
        for ids, ends in ((self._a, self._a_ends), (self._b, self._b_ends)):
            ids, ends = np.array(ids, np.int32), np.array(ends, np.int64)
            length = ends[number + 1] - ends[number]
            before = np.concatenate([[0], np.cumsum(length)])
            flat = ids[np.arange(before[-1]) + np.repeat(ends[number] - before[:-1], length)]
            out += [flat.astype(np.int64), np.concatenate([[0], np.cumsum(np.bincount(owner, weights=length, minlength=n))]).astype(np.int64)]
        return Batch(*out)


# --- what a batch of texts gives ---


@dataclass
class Aligned:
    """A batch with the group of each token; texts never share a group."""

    tokens: Batch
    of_a: np.ndarray
    of_b: np.ndarray

    @staticmethod
    def of(tokens: Batch, pair: Pair) -> Aligned:
        ends = np.cumsum(pair.a_length[tokens.a]), np.cumsum(pair.b_length[tokens.b])
        return Aligned(tokens, *groups(overlaps(*ends), len(tokens.a), len(tokens.b)))

    def __post_init__(self):
        n = int(self.of_a[-1]) + 1 if len(self.of_a) else 0
        self.n_a, self.n_b = np.bincount(self.of_a, minlength=n), np.bincount(self.of_b, minlength=n)
        self.first_a, self.first_b = np.cumsum(self.n_a) - self.n_a, np.cumsum(self.n_b) - self.n_b
        # Groups of each text: those before its first token.
        self.bounds = np.searchsorted(self.first_a, self.tokens.a_bounds)
        self.text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def links(self) -> np.ndarray:
        """How many links each text has."""
        total = np.concatenate([[0], np.cumsum(self.n_a * self.n_b)])
        return np.diff(total[self.bounds])

    def pairs(self, b_size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, id pair (a * b_size + b) and number of links of each distinct pair of each text, in that order."""
        size = self.n_a * self.n_b
        narrow = np.flatnonzero(size <= WIDE)
        whose = np.repeat(narrow, size[narrow])
        k = np.arange(len(whose)) - np.repeat(np.cumsum(size[narrow]) - size[narrow], size[narrow])
        a = self.tokens.a[self.first_a[whose] + k // self.n_b[whose]]
        b = self.tokens.b[self.first_b[whose] + k % self.n_b[whose]]
        text, key, times = [self.text[whose]], [a * b_size + b], [np.ones(len(whose), np.int64)]
        for g in np.flatnonzero(size > WIDE):
            a, m = np.unique(self.tokens.a[self.first_a[g] : self.first_a[g] + self.n_a[g]], return_counts=True)
            b, n = np.unique(self.tokens.b[self.first_b[g] : self.first_b[g] + self.n_b[g]], return_counts=True)
            key.append((a[:, None] * b_size + b).ravel())
            times.append((m[:, None] * n).ravel())
            text.append(np.full(len(key[-1]), self.text[g]))
        text, key, times = map(np.concatenate, (text, key, times))
        both = text << 40 | key
        order = np.argsort(both)
        both, times = both[order], times[order]
        new = np.ones(len(both), bool)
        new[1:] = both[1:] != both[:-1]
        at = np.flatnonzero(new)
        return both[at] >> 40, both[at] & ((1 << 40) - 1), np.add.reduceat(times, at) if len(at) else times

    def written(self, pair: Pair) -> list[memoryview]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        a, b = self.tokens.a, self.tokens.b
        sep_a, sep_b = np.ones(len(a), np.int64), np.ones(len(b), np.int64)
        sep_a[self.first_a + self.n_a - 1] = 2
        sep_b[self.first_b + self.n_b - 1] = 3
        last = self.tokens.b_bounds[1:][np.diff(self.tokens.b_bounds) > 0] - 1
        sep_b[last] = 0
        code = np.empty(len(a) + len(b), np.int64)
        # Tokens in order: the A tokens of a group, then its B tokens.
        code[np.arange(len(a)) + self.first_b[self.of_a]] = a * 4 + sep_a
        code[np.arange(len(b)) + (self.first_a + self.n_a)[self.of_b]] = b * 4 + sep_b
        chars = pair.written[code].ravel()
        chars = chars[chars != 0]
        ends = np.concatenate([[0], np.cumsum(pair.width[code])])[self.tokens.a_bounds + self.tokens.b_bounds]
        view = memoryview(chars)
        return [view[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]


# --- Spark ---


def written_groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups): each text's groups as ``a1,a2|b1;a3|b2,b3``, ids in order; texts without tokens have ''."""
    ship(docs.sparkSession)

    def align(batches):
        pair = Pair.of_worker(a_path, b_path).load()
        for batch in slices(batches, 1, BLOCK_BYTES):
            made = Aligned.of(pair.encode(batch.column(1)), pair)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([bytes(x).decode() for x in made.written(pair)], pa.string())], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(align, "doc_id long, groups string")


def _pack(x: np.ndarray, kind: str) -> bytes:
    """Integers by planes of bytes, compressed."""
    plain = np.ascontiguousarray(x.astype(kind))
    return zstandard.compress(np.ascontiguousarray(plain.view(np.uint8).reshape(-1, plain.itemsize).T), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel().astype(np.int64)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, sha array<string>, n_pairs array<long>, pairs binary, docs binary, place binary, times binary"


def _blocks(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    """A row for each slice of texts: figures of its texts, its distinct pairs, and which text has which how often."""
    pair, part = Pair.of_worker(a_path, b_path).load(), TaskContext.get().partitionId()
    for n, batch in enumerate(slices(batches, 1, BLOCK_BYTES)):
        made = Aligned.of(pair.encode(batch.column(1)), pair)
        tokens = made.tokens
        shas = [hashlib.sha256(x).hexdigest() if len(x) else "" for x in made.written(pair)]
        text, key, times = made.pairs(len(pair.b_bytes))
        distinct, place = np.unique(key, return_inverse=True)
        figures = [np.diff(tokens.a_bounds), np.diff(tokens.b_bounds), np.diff(made.bounds), made.links()]
        lists = [batch.column(0), *map(pa.array, figures), pa.array(shas, pa.string()), pa.array(np.bincount(text, minlength=batch.num_rows))]
        packed = [_pack(np.diff(distinct, prepend=0), "<u8"), _pack(np.bincount(place, minlength=len(distinct)), "<u4"), _pack(place, "<u4"), _pack(times, "<u4")]
        row = [pa.array([part << 32 | n], pa.int64()), *(pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), x) for x in lists), *(pa.array([x], pa.binary()) for x in packed)]
        yield pa.RecordBatch.from_arrays(row, names=[c.split()[0] for c in _BLOCK.split(", ")])


def _questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs, docs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            key = np.cumsum(_unpack(pairs, "<u8"))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), block)), pa.array(key), pa.array(_unpack(docs, "<u4"))], names=["block", "pair", "n"])


def _evaluate(key, stored: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of a block, with the counts of their pairs."""
    row = {c: stored.column(c).combine_chunks() for c in stored.column_names}
    pairs, place, times = (_unpack(row[c][0].as_py(), kind) for c, kind in (("pairs", "<u8"), ("place", "<u4"), ("times", "<u4")))
    order = np.argsort(answers.column("pair").to_numpy())
    if len(order) != len(pairs):
        raise ValueError(f"block {key[0]}: {len(pairs)} pairs asked, {len(order)} answered")
    count = answers.column("n_docs").to_numpy()[order]
    best = answers.column("best").to_numpy()[order].astype(np.int64)
    edges = np.concatenate([[0], np.cumsum(row["n_pairs"].flatten().to_numpy())])
    of = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[place] * times)])[edges])
    lists = {c: row[c].flatten() for c in ("doc_id", *_COUNTS)}
    return pa.table({**lists, "n_best": pa.array(of(best)), "count_sum": pa.array(of(count)), "groups_sha256": row["sha"].flatten()})


@dataclass
class Alignment:
    """Stored blocks of aligned texts, and (a, b, n_docs, best) of every id pair: how many documents hold it linked, and whether its A id has no pair in more."""

    blocks: DataFrame
    pairs: DataFrame
    b_size: int

    def documents(self) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each text."""
        asked = self.blocks.select("block", "pairs", "docs").mapInArrow(_questions, "block long, pair long, n long").select("block", "pair")
        known = self.pairs.select((F.col("a") * self.b_size + F.col("b")).alias("pair"), "n_docs", "best")
        answers = asked.join(known, "pair").select("block", "pair", "n_docs", "best")
        schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        stored = self.blocks.drop("docs")
        return stored.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_evaluate, schema)


def align(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """Aligns the tokens of ``a_path`` (byte-level) and ``b_path`` (sentencepiece) in every text.

    Texts that are null, empty, or that a tokenizer doesn't give back byte by byte have no tokens,
    groups or links.  Rows with a null or repeated doc_id are documents of their own.  An empty
    table has no blocks and no pairs.  Other columns are ignored.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = landed(rows.mapInArrow(lambda b: _blocks(b, a_path, b_path), _BLOCK))
    b_size = len(Pair.of_worker(a_path, b_path).load().b_bytes)
    asked = blocks.select("block", "pairs", "docs").mapInArrow(_questions, "block long, pair long, n long")
    a, b = F.floor(F.col("pair") / b_size).cast("long").alias("a"), F.pmod("pair", F.lit(b_size)).alias("b")
    counts = landed(asked.groupBy("pair").agg(F.sum("n").alias("n_docs")).select(a, b, "n_docs"))
    most = counts.groupBy(F.col("a").alias("__a")).agg(F.max("n_docs").alias("__most"))
    judged = counts.join(most, F.col("a") == F.col("__a")).select("a", "b", "n_docs", (F.col("n_docs") == F.col("__most")).alias("best"))
    return Alignment(blocks, landed(judged), b_size)
