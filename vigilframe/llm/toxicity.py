"""A factorization machine over hashed terms for toxicity.

A text is the set of its terms: words, and runs of 4 and 5 characters of each, by which a learned
stem is known in new words.  Of all hashed terms the model keeps those that tell the classes apart
best in a bounded sample (chi-square).  The logit is a bias, a weight per term, and for each pair of terms
the product of two learned vectors, so that a pair can say more than its terms do.  All pairs are
summed at once: half of the squared sum of vectors less the sum of squares.  numpy fits it by
adaptive gradient steps on a bounded sample, in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vigilframe.llm.text import codepoints, grams, hashed, slices, sums, words

BUCKETS = 1 << 20
ORDERS = (4, 5)


def terms(texts: pa.Array, slot: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each text, in order, and the bounds; with ``slot`` only kept terms, as their numbers there."""
    made = words(texts, lower="unicode")
    stems = pc.replace_substring_regex(made.vocabulary, r"^[^\pL\pN]+|[^\pL\pN]+$", "").dictionary_encode()
    stem, code = stems.dictionary, stems.indices.to_numpy(zero_copy_only=False)[made.codes]
    real = pc.utf8_length(stem).to_numpy(zero_copy_only=False) > 0
    chars, bounds = codepoints(stem)
    parts = [(hashed(stem), np.arange(len(stem)))] + [grams(chars, bounds, n) for n in ORDERS]
    owner = np.concatenate([o for _, o in parts])
    term = (np.concatenate([h for h, _ in parts]) % np.uint64(BUCKETS)).astype(np.int64)
    kept = real[owner]
    if slot is not None:
        term = slot[term]
        kept &= term >= 0
    order = np.argsort(owner[kept], kind="stable")
    owner, term = owner[kept][order], term[kept][order]
    edges = np.searchsorted(owner, np.arange(len(stem) + 1))
    length = np.diff(edges)
    # Words without any kept term are left out before the texts are gone through.
    doc, some = made.documents(), length[code] > 0
    doc, code = doc[some], code[some]
    n = length[code]
    flat = np.repeat(edges[code] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(code) else np.empty(0, np.int64)
    pairs = np.unique(np.repeat(doc, n) * BUCKETS + term[flat])
    return pairs % BUCKETS, np.searchsorted(pairs // BUCKETS, np.arange(len(made.bounds)))


def _features(batches):
    for batch in slices(batches, 1):
        ids, bounds = terms(batch.column(1))
        rows = [ids[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, pa.binary())], names=["doc_id", "label", "ids"])


def telling(docs: list[tuple[np.ndarray, int]], most: int, least: int = 5) -> np.ndarray:
    """The ``most`` terms of the largest chi-square among those in ``least`` documents or more."""
    counts = np.zeros((2, BUCKETS))
    size = np.zeros(2)
    for ids, y in docs:
        counts[y, ids] += 1
        size[y] += 1
    total, n = counts.sum(0), max(1.0, size.sum())
    expected = total * size[1] / n
    spread = np.maximum(expected * (1 - size[1] / n) * (1 - total / n), 1e-9)
    chi = np.where(total >= least, (counts[1] - expected) ** 2 / spread, 0)
    best = np.argsort(-chi, kind="stable")[:most]
    return np.sort(best[chi[best] > 0])


def fit(rows: pd.DataFrame, *, most: int, dims: int, epochs: int, rate: float, decay: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The kept terms, and (weight, vector) of each; the last row holds the bias."""
    rng = np.random.default_rng(seed)
    docs = [(np.frombuffer(a, np.int32), int(y)) for a, y in zip(rows["ids"], rows["label"], strict=True)]
    kept = telling(docs, most)
    slot = np.full(BUCKETS, -1, np.int64)
    slot[kept] = np.arange(len(kept))
    docs = [(np.append(s[s >= 0], len(kept)), y) for s, y in ((slot[ids], y) for ids, y in docs)]
    table = np.concatenate([np.zeros((len(kept) + 1, 1)), rng.normal(0, 0.01, (len(kept) + 1, dims))], axis=1)
    table[-1] = 0
    mean = rows["label"].mean()
    table[-1, 0] = np.log((mean + 1e-3) / (1 - mean + 1e-3))
    seen = np.full(table.shape, 1e-2)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            ids, y = docs[i]
            mine = table[ids]
            total = mine[:, 1:].sum(0)
            logit = mine[:, 0].sum() + 0.5 * (total @ total - (mine[:, 1:] ** 2).sum())
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
            slope = np.empty_like(mine)
            slope[:, 0] = error
            slope[:, 1:] = error * (total - mine[:, 1:])
            slope[:-1] += decay * mine[:-1]
            slope[-1, 1:] = 0
            seen[ids] += slope**2
            table[ids] = mine - rate * slope / np.sqrt(seen[ids])
    return kept, table


def train(sample: DataFrame, *, most: int = 2048, dims: int = 6, epochs: int = 6, rate: float = 0.05, decay: float = 1e-3, seed: int = 3):
    """(kept terms, table) fitted on (doc_id, text, label) rows, a bounded sample, in one task.

    Without rows no term is kept and every score is 0.5.
    """
    kind = sample.schema["doc_id"].dataType.simpleString()
    made = sample.select("doc_id", "text", "label").mapInArrow(_features, f"doc_id {kind}, label int, ids binary")

    def one(batches):
        parts = [b.to_pandas() for b in batches]
        rows = pd.concat(parts).sort_values(["doc_id", "label"]) if parts else None
        if rows is not None and len(rows):
            kept, table = fit(rows, most=most, dims=dims, epochs=epochs, rate=rate, decay=decay, seed=seed)
            yield pa.RecordBatch.from_pydict({"kept": pa.array([kept.tobytes()], pa.binary()), "model": pa.array([table.tobytes()], pa.binary())})

    got = made.repartition(1).mapInArrow(one, "kept binary, model binary").collect()
    if not got:
        return np.empty(0, np.int64), np.zeros((1, dims + 1))
    return np.frombuffer(got[0].kept, np.int64), np.frombuffer(got[0].model).reshape(-1, dims + 1)


def logits(ids: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Bias, weights and all pairs of each text."""
    total = sums(table[ids, 0], bounds) + table[-1, 0]
    for d in range(1, table.shape[1]):
        column = table[:, d][ids].astype(float)
        total += 0.5 * (sums(column, bounds) ** 2 - sums(column**2, bounds))
    return total


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, score) for each row: the probability of label 1.

    Null and empty texts, and texts without letters or digits, have the bias alone.  Repeated
    terms count once; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of kept terms

    def predict(batches):
        kept, table = shared.value
        slot = np.full(BUCKETS, -1, np.int64)
        slot[kept] = np.arange(len(kept))
        for batch in slices(batches, 1):
            ids, bounds = terms(batch.column(1), slot)
            value = 1 / (1 + np.exp(-np.clip(logits(ids, bounds, table), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, score double")
