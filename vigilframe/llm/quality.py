"""Supervised subword embeddings for document quality.

A document is the mean of learned vectors of its words, of their character n-grams and of pairs of
equal neighbours, all hashed into one table; a softmax over classes follows.  numpy stochastic
gradient descent fits vectors and softmax together on a bounded sample, in one task.  Since both
steps are linear, a learned table of one number per class and bucket scores all texts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from vigilframe.llm.text import codepoints, grams, hashed, slices, sums, words

BUCKETS = 1 << 17
ORDERS = (3, 4)


def vocabulary_features(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams, and the word each belongs to (sorted)."""
    chars, bounds = codepoints(vocabulary)
    parts = [(hashed(vocabulary), np.arange(len(vocabulary)))] + [grams(chars, bounds, n) for n in ORDERS]
    owner = np.concatenate([o for _, o in parts])
    bucket = (np.concatenate([h for h, _ in parts]) % np.uint64(BUCKETS - 2)).astype(np.int64) + 2
    order = np.argsort(owner, kind="stable")
    return bucket[order], owner[order]


def repeats(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text, the number of words that equal the one before."""
    same = np.zeros(len(codes), bool)
    same[1:] = codes[1:] == codes[:-1]
    starts = bounds[:-1][bounds[:-1] < len(codes)]
    same[starts] = False
    return sums(same.astype(float), bounds)


def features(batches):
    """(doc_id, label, ids, counts): each text as its distinct buckets; bucket 0 is every text's own, 1 repeats."""
    for batch in slices(batches, 1):
        made = words(batch.column(1), lower=None)
        bucket, owner = vocabulary_features(made.vocabulary)
        edges = np.searchsorted(owner, np.arange(len(made.vocabulary) + 1))
        again = repeats(made.codes, made.bounds)
        ids, counts = [], []
        for i in range(batch.num_rows):
            unique, n = np.unique(made.codes[made.bounds[i] : made.bounds[i + 1]], return_counts=True)
            length = edges[unique + 1] - edges[unique]
            flat = np.repeat(edges[unique] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
            by = np.bincount(bucket[flat], weights=np.repeat(n, length), minlength=2) if len(flat) else np.zeros(2)
            by[:2] = 1, 8 * again[i]
            some = np.flatnonzero(by)
            ids.append(some.astype(np.int32).tobytes())
            counts.append(by[some].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], names=["doc_id", "label", "ids", "counts"]
        )


def fit(rows: pd.DataFrame, *, classes: int, dims: int, epochs: int, rate: float, seed: int) -> np.ndarray:
    """Logits per bucket and class (the embedding times the softmax weights)."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dims, 1 / dims, (BUCKETS, dims))
    out = np.zeros((classes, dims))
    docs = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.float32).astype(float), y) for a, b, y in zip(rows["ids"], rows["counts"], rows["label"], strict=True)]
    docs = [(ids, n / n.sum(), y) for ids, n, y in docs]
    for epoch in range(epochs):
        for k, i in enumerate(rng.permutation(len(docs))):
            step = rate * (1 - (epoch + k / len(docs)) / epochs)
            ids, share, y = docs[i]
            rows_ = table[ids]
            hidden = share @ rows_
            logit = out @ hidden
            odds = np.exp(logit - logit.max())
            error = odds / odds.sum()
            error[y] -= 1
            back = error @ out
            out -= step * np.outer(error, hidden)
            table[ids] = rows_ - (step * len(ids) ** 0.5) * np.outer(share, back)
    return table @ out.T


def train(sample: DataFrame, *, classes: int = 2, dims: int = 12, epochs: int = 8, rate: float = 0.5, seed: int = 5) -> np.ndarray:
    """Fits on (doc_id, text, label) rows, a bounded sample, in one task; the driver gets the table (BUCKETS x classes).

    Without rows all logits are 0, so that every class is equally likely.
    """
    kind = sample.schema["doc_id"].dataType.simpleString()
    made = sample.select("doc_id", "text", "label").mapInArrow(features, f"doc_id {kind}, label int, ids binary, counts binary")

    def one(batches):
        parts = [b.to_pandas() for b in batches]
        rows = pd.concat(parts).sort_values(["doc_id", "label"]) if parts else None
        if rows is not None and len(rows):
            logits = fit(rows, classes=classes, dims=dims, epochs=epochs, rate=rate, seed=seed)
            yield pa.RecordBatch.from_pydict({"logits": pa.array([logits.astype(np.float32).tobytes()], pa.binary())})

    got = made.repartition(1).mapInArrow(one, "logits binary").collect()
    return np.frombuffer(got[0].logits, np.float32).reshape(BUCKETS, classes) if got else np.zeros((BUCKETS, classes), np.float32)


def score(docs: DataFrame, logits: np.ndarray, positive: int = 1) -> DataFrame:
    """(doc_id, score): the probability of class ``positive`` for each row.

    Null and empty texts have the features that every text has, and so a score too.  Equal texts
    have equal scores; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(logits)  # of a fixed size

    def predict(batches):
        table = shared.value
        for batch in slices(batches, 1):
            made = words(batch.column(1), lower=None)
            bucket, owner = vocabulary_features(made.vocabulary)
            n = np.bincount(owner, minlength=len(made.vocabulary)).astype(float)
            again = 8 * repeats(made.codes, made.bounds)
            weight = sums(n[made.codes], made.bounds) + 1 + again
            logit = []
            for c in range(table.shape[1]):
                word = np.bincount(owner, weights=table[bucket, c], minlength=len(made.vocabulary))
                logit.append((sums(word[made.codes], made.bounds) + table[0, c] + again * table[1, c]) / weight)
            logit = np.stack(logit, axis=1)
            odds = np.exp(logit - logit.max(1, keepdims=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(odds[:, positive] / odds.sum(1))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, score double")
