"""Benchmark decontamination by latent semantic retrieval and common subsequences.

Documents are read once: of each text the words that the benchmark uses are kept as term numbers
in order, with their count in each run of ``CHUNK`` words.  A randomised SVD of the TF-IDF matrix
of all passages follows from that: each task multiplies its rows with a random matrix and back,
and the sums, one row per term, span the latent space.  Windows of a document and benchmark items
meet there by cosine.  Whatever is close enough is checked word by word: the longest common
subsequence of item and surroundings must cover the item, and the item's last sentence, its
answer, must be there as well.  Reordered or partly reworded copies are found where an exact
match fails; words that the benchmark does not use can't be part of a common subsequence, so the
check loses nothing by their absence.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.ship import ship
from vigilframe.llm.text import free_names, slices, words
from vigilframe.operators.lineage import landed

CHUNK = 16
PASSAGE = 4  # chunks
RANK, COMMON, EXTRA = 96, 40, 4
#: So many of the most frequent terms, which make up most words, are multiplied as a dense matrix.
DENSE = 256
COSINE, OVERLAP, ANSWER = 0.5, 0.7, 0.5
PIECE_WORDS = 96
PIECES_AT_ONCE = 4000
MOST_BYTES, MOST_TERMS = 256 << 20, 1_000_000
_EDGES = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’…¡¿–—·"


def plain(vocabulary: pa.Array) -> pa.Array:
    """Words in lower case without punctuation at their ends."""
    return pc.utf8_trim(pc.utf8_lower(vocabulary), characters=_EDGES)


def word_lists(texts: pa.Array) -> list[list[str]]:
    made = words(texts, lower=None)
    stem = plain(made.vocabulary).to_pylist()
    listed = [[stem[c] for c in made.codes[a:b]] for a, b in zip(made.bounds[:-1], made.bounds[1:], strict=True)]
    return [[w for w in x if w] for x in listed]


def answer(text: str) -> str:
    """The last sentence or line of an item."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n", text.strip()) if p.strip()]
    return parts[-1] if parts else ""


@dataclass
class Queries:
    """Pieces of items: an item of many words is looked for piece by piece."""

    item_ids: list
    pieces: list[np.ndarray]  # term numbers
    answers: list[np.ndarray]  # of the last piece of an item, else empty
    terms: list[str]

    @classmethod
    def of(cls, items: pd.DataFrame, most: int = PIECE_WORDS) -> Queries:
        texts = [t or "" for t in items["text"]]
        lists = word_lists(pa.array(texts, pa.string()))
        ends = word_lists(pa.array([answer(t) for t in texts], pa.string()))
        terms = sorted({w for x in lists for w in x})
        number = {w: i for i, w in enumerate(terms)}
        ids, pieces, answers = [], [], []
        for item, listed, end in zip(items["item_id"], lists, ends, strict=True):
            n = max(1, -(-len(listed) // most))
            for k in range(n):
                piece = listed[k * len(listed) // n : (k + 1) * len(listed) // n]
                if piece:
                    ids.append(item)
                    pieces.append(np.array([number[w] for w in piece]))
                    answers.append(np.array([number[w] for w in end] if k == n - 1 else [], np.int64))
        return cls(ids, pieces, answers, terms)

    def part(self, a: int, b: int) -> Queries:
        """Some of the pieces, with the terms of all."""
        return Queries(self.item_ids[a:b], self.pieces[a:b], self.answers[a:b], self.terms)


def _terms(batches, terms: list[str]):
    """doc_id, term numbers of known words (+1, 0 closes nothing), and how many each chunk has."""
    known = pa.array(terms, pa.string())
    kind = np.uint16 if len(terms) < 1 << 16 else np.uint32
    for batch in slices(batches, 1):
        made = words(batch.column(1), lower=None)
        index = pc.fill_null(pc.index_in(plain(made.vocabulary), value_set=known), -1).to_numpy(zero_copy_only=False)
        term = index[made.codes]
        hit = term >= 0
        chunks = -(-made.counts // CHUNK)
        edges = np.concatenate([[0], np.cumsum(chunks)])
        place = np.arange(len(term)) - np.repeat(made.bounds[:-1], made.counts)
        chunk = np.repeat(edges[:-1], made.counts) + place // CHUNK
        held = np.bincount(chunk[hit], minlength=edges[-1]).astype(np.uint8)
        kept = np.concatenate([[0], np.cumsum(hit)])[made.bounds]
        term = term[hit].astype(kind)
        lists = [[x[a:b].tobytes() for a, b in zip(e[:-1], e[1:], strict=True)] for x, e in ((term, kept), (held, edges))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.binary()) for x in lists)], names=["doc_id", "terms", "chunks"])


def _joined(batch: pa.RecordBatch, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All terms, the chunk of each, the bounds of chunks in terms, and of documents in chunks."""
    texts, chunks = batch.column(1).to_pylist(), batch.column(2).to_pylist()
    term = np.frombuffer(b"".join(texts), kind).astype(np.int64)
    held = np.frombuffer(b"".join(chunks), np.uint8).astype(np.int64)
    docs = np.concatenate([[0], np.cumsum([len(c) for c in chunks])]).astype(np.int64)
    return term, np.repeat(np.arange(len(held)), held), np.concatenate([[0], np.cumsum(held)]), docs


class Product:
    """Counts of terms by row (chunks or passages), times a matrix, or transposed times one."""

    def __init__(self, term: np.ndarray, row: np.ndarray, n_rows: int, slot: np.ndarray):
        at = slot[term]
        often = at >= 0
        self.dense = np.bincount(row[often] * DENSE + at[often], minlength=n_rows * DENSE).reshape(n_rows, DENSE).astype(np.float32)
        self.term, self.row, self.n_rows, self.slot = term[~often], row[~often], n_rows, slot
        self.starts = np.flatnonzero(np.diff(self.row, prepend=-1))

    @staticmethod
    def slots(df: np.ndarray) -> np.ndarray:
        slot = np.full(len(df), -1, np.int64)
        slot[np.argsort(-df, kind="stable")[:DENSE]] = np.arange(min(DENSE, len(df)))
        return slot

    def _often(self, columns: np.ndarray) -> np.ndarray:
        table = np.zeros((DENSE, len(columns)), np.float32)
        some = np.flatnonzero(self.slot >= 0)
        table[self.slot[some]] = columns[:, some].T
        return table

    def times(self, columns: np.ndarray) -> np.ndarray:
        """Rows x width, for a matrix given by its columns."""
        out = self.dense @ self._often(columns)
        if len(self.term):
            at = self.row[self.starts]
            for c in range(len(columns)):
                out[at, c] += np.add.reduceat(columns[c][self.term], self.starts)
        return out

    def transposed(self, y: np.ndarray, total: np.ndarray) -> None:
        """Adds the columns of terms x width to ``total``."""
        some = np.flatnonzero(self.slot >= 0)
        total[:, some] += (self.dense.T @ y)[self.slot[some]].T
        for c in range(y.shape[1]):
            total[c] += np.bincount(self.term, weights=np.ascontiguousarray(y[:, c])[self.row], minlength=total.shape[1])


def document_frequencies(stored: DataFrame, n_terms: int, kind) -> tuple[int, np.ndarray]:
    """The number of documents, and of those that hold each term."""

    def count(batches):
        total, n = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            if batch.num_rows:
                term, chunk, _, docs = _joined(batch, kind)
                doc = np.repeat(np.arange(batch.num_rows), np.diff(docs))[chunk]
                total += np.bincount(np.unique(doc * n_terms + term) % n_terms, minlength=n_terms)
                n += batch.num_rows
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[some], n))], names=["term", "n"])

    rows = stored.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(n_terms)
    real = rows[rows["term"] >= 0]
    df[real["term"].to_numpy(int)] = real["n"].to_numpy(float)
    return int(rows.loc[rows["term"] < 0, "n"].sum()), df


def latent_space(stored: DataFrame, idf: np.ndarray, kind, *, rank: int, common: int, extra: int, seed: int = 9) -> np.ndarray:
    """Terms x rank: the leading right singular vectors of TF-IDF passages, without the ``common`` first.

    The first ones only tell languages and filler apart, which all passages share.
    """
    n, width = len(idf), min(rank + common + extra, len(idf))
    rng_of = lambda: np.random.default_rng(seed).normal(size=(width, n)).astype(np.float32)
    weight, slot = idf.astype(np.float32), Product.slots(-idf)

    def multiply(batches):
        omega, total = rng_of() * weight, np.zeros((width, n))
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                some = batch.slice(a, 500)
                term, chunk, _, docs = _joined(some, kind)
                if not len(term):
                    continue
                # Passages are runs of chunks that don't cross documents.
                of_doc = np.repeat(np.arange(some.num_rows), np.diff(docs))
                inside = np.arange(docs[-1]) - docs[:-1][of_doc]
                fresh = np.ones(docs[-1], bool)
                fresh[1:] = (of_doc[1:] != of_doc[:-1]) | (inside[1:] % PASSAGE == 0)
                passage = (np.cumsum(fresh) - 1)[chunk]
                fresh = np.concatenate([[True], passage[1:] != passage[:-1]])
                row = np.cumsum(fresh) - 1
                product = Product(term, row, int(row[-1]) + 1, slot)
                product.transposed(product.times(omega), total)
        total = total.T
        some = np.flatnonzero(np.abs(total).sum(1))
        for a in range(0, len(some), 4096):
            at = some[a : a + 4096]
            data = [total[i].astype(np.float32).tobytes() for i in at]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(data, pa.binary())], names=["term", "part"])

    def add(key, parts):
        data = np.frombuffer(b"".join(parts.column("part").to_pylist()), np.float32).reshape(-1, width)
        return pa.table({"term": [key[0].as_py()], "part": pa.array([data.sum(0, dtype=np.float64).tobytes()], pa.binary())})

    made = stored.mapInArrow(multiply, "term long, part binary").groupBy("term").applyInArrow(add, "term long, part binary").toPandas()
    b = np.zeros((n, width))
    for i, part in zip(made["term"], made["part"], strict=True):
        b[i] = np.frombuffer(part)
    u, _, _ = np.linalg.svd(b * idf[:, None], full_matrices=False)
    # With few terms nothing is left beyond the common ones; then all of the space is used.
    return u[:, common : common + rank] if u.shape[1] > common + 1 else u


def common_subsequence(piece: np.ndarray, masks: dict[int, int], other: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over the piece."""
    full = (1 << len(piece)) - 1
    v = full
    for m in [masks[w] for w in other.tolist() if w in masks]:
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(piece) - bin(v).count("1")


def find(stored: DataFrame, queries: Queries, space: np.ndarray, idf: np.ndarray, kind, *, cosine: float, overlap: float, answer_share: float, id_kind: str) -> DataFrame:
    """(doc_id, piece, cosine, overlap) of the documents that hold a piece."""
    table = (space * idf[:, None]).astype(np.float32)
    latent = np.stack([table[p].sum(0) for p in queries.pieces])
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    latent = np.divide(latent, norm, out=np.zeros_like(latent), where=norm > 0)
    reach = np.array([-(-(len(p) + CHUNK - 1) // CHUNK) for p in queries.pieces])
    masks = []
    for p in queries.pieces:
        own: dict[int, int] = {}
        for i, w in enumerate(p.tolist()):
            own[w] = own.get(w, 0) | 1 << i
        masks.append(own)
    spark = stored.sparkSession
    shared = spark.sparkContext.broadcast((table, latent, reach, queries.pieces, queries.answers, masks))  # bounded by MOST_TERMS and PIECES_AT_ONCE

    def search(batches):
        table, latent, reach, pieces, answers, masks = shared.value
        columns, slot = np.ascontiguousarray(table.T), Product.slots(-idf)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                yield from one(batch.slice(a, 500), columns, slot, latent, reach, pieces, answers, masks)

    def one(batch, columns, slot, latent, reach, pieces, answers, masks):
        term, chunk, held, docs = _joined(batch, kind)
        n = int(docs[-1])
        if not n or not len(term):
            return
        vector = Product(term, chunk, n, slot).times(columns)
        of_doc = np.repeat(np.arange(batch.num_rows), np.diff(docs))
        last = docs[1:][of_doc]
        found: dict[tuple[int, int], tuple[float, float]] = {}
        for size in np.unique(reach):
            mine = np.flatnonzero(reach == size)
            # Windows of so many chunks, shorter at the end of a document.
            window = vector.copy()
            for k in range(1, size):
                fits = np.flatnonzero(np.arange(n) + k < last)
                window[fits] += vector[fits + k]
            window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
            for b in range(0, n, 4096):
                near = window[b : b + 4096] @ latent[mine].T
                for i, j in zip(*np.nonzero(near >= cosine), strict=True):
                    at, piece = b + int(i), int(mine[j])
                    doc = int(of_doc[at])
                    if (doc, piece) in found:
                        continue
                    around = term[held[max(docs[doc], at - 1)] : held[min(last[at], at + size + 1)]]
                    share = common_subsequence(pieces[piece], masks[piece], around) / len(pieces[piece])
                    if share >= overlap and (not len(answers[piece]) or np.isin(answers[piece], around).mean() >= answer_share):
                        found[doc, piece] = (float(near[i, j]), share)
        if found:
            ids = batch.column(0).take(pa.array([d for d, _ in found]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([p for _, p in found], pa.int64()), *(pa.array([v[k] for v in found.values()]) for k in (0, 1))],
                names=["doc_id", "piece", "cosine", "overlap"],
            )

    return stored.mapInArrow(search, f"doc_id {id_kind}, piece long, cosine double, overlap double")


def contaminated(docs: DataFrame, benchmark: DataFrame, *, rank: int = RANK, common: int = COMMON, extra: int = EXTRA, cosine: float = COSINE, overlap: float = OVERLAP, answer_share: float = ANSWER, pieces_at_once: int = PIECES_AT_ONCE) -> DataFrame:
    """(doc_id, item_id, cosine, overlap): documents that hold a benchmark item, or a piece of a long one.

    Null and empty texts and items hold nothing and are not looked for.  Rows of one doc_id give
    one result an item, with the largest figures of its pieces (a piece has those of the first window
    that passes); rows with a null doc_id are searched like others, those with a null item_id too.
    An empty table on either side gives no rows.  Pieces are searched ``pieces_at_once`` at a time,
    with the same result for any number.  A benchmark beyond ``MOST_BYTES`` of texts or ``MOST_TERMS``
    distinct words raises an error: what the driver and tasks hold grows with its words.
    """
    spark = docs.sparkSession
    ship(spark)
    id_kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    result = f"doc_id {id_kind}, item_id {item_kind}, cosine double, overlap double"
    items = landed(benchmark.select("item_id", "text").where("text IS NOT NULL").distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"{size} bytes of benchmark texts; more than {MOST_BYTES} are to be given in parts")
    queries = Queries.of(items.toPandas().sort_values(["item_id", "text"]))
    if len(queries.terms) > MOST_TERMS:
        raise ValueError(f"{len(queries.terms)} distinct words of benchmark texts; more than {MOST_TERMS} are to be given in parts")
    if not queries.pieces:
        return spark.createDataFrame([], result)
    # Terms, weights and space are those of all items; only the search takes them in blocks.
    kind = np.uint16 if len(queries.terms) < 1 << 16 else np.uint32
    sent = spark.sparkContext.broadcast(queries.terms)
    stored = landed(docs.select("doc_id", "text").mapInArrow(lambda b: _terms(b, sent.value), f"doc_id {id_kind}, terms binary, chunks binary"))
    n, df = document_frequencies(stored, len(queries.terms), kind)
    # Squared: what few documents hold should settle a match, not filler.
    idf = np.log((1.0 + n) / (1.0 + df)) ** 2 + 1e-3
    space = latent_space(stored, idf, kind, rank=rank, common=common, extra=extra)
    made = []
    for a in range(0, len(queries.pieces), pieces_at_once):
        some = queries.part(a, a + pieces_at_once)
        hits = find(stored, some, space, idf, kind, cosine=cosine, overlap=overlap, answer_share=answer_share, id_kind=id_kind)
        names = spark.createDataFrame(list(enumerate(some.item_ids)), f"piece long, item_id {item_kind}")
        made.append(landed(hits.join(F.broadcast(names), "piece").select("doc_id", "item_id", "cosine", "overlap")))
    found = functools.reduce(DataFrame.unionByName, made)
    return found.groupBy("doc_id", "item_id").agg(F.max("cosine").alias("cosine"), F.max("overlap").alias("overlap"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` whose doc_id holds nothing of the benchmark."""
    (of,) = free_names(docs, "gone")
    gone = contaminated(docs, benchmark, **how).select(F.col("doc_id").alias(of)).distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(of)), "left_anti")
