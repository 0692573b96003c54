"""Language identification by words first, then ever shorter character n-grams.

A known word counts with its log frequency in each language.  A word that was never learned is
judged by its longest n-grams that were; if none of that length was, by shorter ones, down to
single characters.  Words and n-grams are known by their full 64-bit hashes: one that was never
seen is never taken for another.  The counts come from a bounded sample of documents of each
language; they are added up in Spark, with a column for each language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.sampling import sample_near
from vigilframe.llm.text import codepoints, grams, hashed, slices, sums, words
from vigilframe.operators.lineage import landed

UNKNOWN = "und"
ORDERS = (5, 4, 3, 2, 1)
#: Kind of the rows that count words; n-grams have their length.
WORD = 0


@dataclass
class LanguageModel:
    """Per kind (``WORD`` or a length of n-grams): sorted hashes of what is known, and its scores by language."""

    langs: list[str]
    keys: dict[int, np.ndarray]
    scores: dict[int, np.ndarray]

    def find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key stands, and whether it is known."""
        own = self.keys[kind]
        at = np.minimum(np.searchsorted(own, keys), max(0, len(own) - 1))
        return at, own[at] == keys if len(own) else np.zeros(len(keys), bool)


def letters(vocabulary: pa.Array) -> pa.Array:
    """Words in lower case without what isn't a letter."""
    return pc.replace_substring_regex(pc.utf8_lower(vocabulary), r"[^\pL]+", "")


def _counts(batches):
    """(lang, kind, key, n): kind 0 for words, an order for n-grams; counted per batch."""
    for batch in slices(batches, 1):
        langs = batch.column(0).to_pylist()
        made = words(batch.column(1), lower=None)
        stems = letters(made.vocabulary).dictionary_encode()
        codes, doc = stems.indices.to_numpy(zero_copy_only=False)[made.codes], made.documents()
        stem = stems.dictionary
        real = pc.utf8_length(stem).to_numpy(zero_copy_only=False) > 0
        chars, bounds = codepoints(stem)
        keys, pieces = hashed(stem), {}
        for order in ORDERS:
            h, owner = grams(chars, bounds, order)
            pieces[order] = (*np.unique(h, return_inverse=True), owner)
        place = np.array([sorted(set(langs)).index(x) for x in langs])
        for i, lang in enumerate(sorted(set(langs))):
            n = np.bincount(codes[place[doc] == i], minlength=len(stem)) * real
            some = np.flatnonzero(n)
            yield _rows(lang, WORD, keys[some].view(np.int64), n[some])
            for order, (distinct, at, owner) in pieces.items():
                by = np.bincount(at, weights=n[owner], minlength=len(distinct))
                some = np.flatnonzero(by)
                yield _rows(lang, order, distinct[some].view(np.int64), by[some].astype(np.int64))


def _rows(lang, kind, keys, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"lang": pa.array([lang] * len(keys), pa.string()), "kind": pa.array(np.full(len(keys), kind, np.int32)), "key": pa.array(keys, pa.int64()), "n": pa.array(n, pa.int64())}
    )


def train(docs: DataFrame, keep: Column, *, per_lang: int = 2000, least: int = 3) -> LanguageModel:
    """Learns from about ``per_lang`` documents of each language that ``keep`` admits.

    Words and n-grams are known from ``least`` occurrences in the sample on; all of them are kept,
    so the size of the model is bounded by that of the sample.  Rows without a language or without
    a doc_id aren't learned from.  Without any row it knows no language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & keep).select("doc_id", "lang")
    chosen = sample_near(rows.distinct(), per_lang, by="lang").select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    same = (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang"))
    sample = docs.select("doc_id", "lang", "text").join(chosen, same).select("lang", "text")
    # Texts are cut once; what follows reads their counts.
    counted = landed(sample.mapInArrow(_counts, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    totals = {(r.lang, r.kind): r.n for r in counted.groupBy("lang", "kind").agg(F.sum("n").alias("n")).collect()}  # a few rows a language
    langs = sorted({lang for lang, _ in totals})
    columns = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(langs)]
    keys, scores = {}, {}
    for kind in (WORD, *ORDERS):
        own, counts = np.empty(0, np.uint64), np.empty((0, len(langs)))
        if langs:
            by = counted.where(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("all"), *columns).where(F.col("all") >= least).drop("all").toArrow()
            own = by.column("key").to_numpy().view(np.uint64)
            counts = np.stack([by.column(f"n{i}").to_numpy() for i in range(len(langs))], axis=1).astype(float)
        order = np.argsort(own)
        total = np.array([totals.get((x, kind), 0) for x in langs], float)
        keys[kind] = own[order]
        scores[kind] = np.log((counts[order] + 0.05) / (total + 0.05 * (len(own) + 1))).astype(np.float32)
    return LanguageModel(langs, keys, scores)


def vocabulary_scores(model: LanguageModel, stem: pa.Array) -> np.ndarray:
    """Scores of each word for each language; words without letters, and of unknown letters alone, have 0."""
    out = np.zeros((len(stem), len(model.langs)))
    at, known = model.find(WORD, hashed(stem))
    out[known] = model.scores[WORD][at[known]]
    empty = pc.utf8_length(stem).to_numpy(zero_copy_only=False) == 0
    out[empty] = 0
    left = np.flatnonzero(~known & ~empty)
    for order in ORDERS:
        if not len(left):
            break
        chars, bounds = codepoints(stem.take(pa.array(left)))
        h, owner = grams(chars, bounds, order)
        at, seen = model.find(order, h)
        at, owner = at[seen], owner[seen]
        n = np.bincount(owner, minlength=len(left))
        edges = np.concatenate([[0], np.cumsum(n)])
        mean = sums(model.scores[order][at], edges) / np.maximum(n, 1)[:, None]
        out[left[n > 0]] = mean[n > 0]
        left = left[n == 0]
    return out


def predictions(texts: pa.Array, model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    made = words(texts, lower=None)
    stems = letters(made.vocabulary).dictionary_encode()
    codes = stems.indices.to_numpy(zero_copy_only=False)[made.codes]
    real = pc.utf8_length(stems.dictionary).to_numpy(zero_copy_only=False) > 0
    n = sums(real[codes].astype(float), made.bounds)
    names, score = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
    if model.langs:
        table = vocabulary_scores(model, stems.dictionary)
        total = np.stack([sums(table[:, i][codes], made.bounds) for i in range(len(model.langs))], axis=1)
        tempered = total / np.sqrt(np.maximum(n, 1))[:, None]
        odds = np.exp(tempered - tempered.max(1, keepdims=True))
        names, score = np.array(model.langs, dtype=object)[odds.argmax(1)], odds.max(1) / odds.sum(1)
    names[n == 0], score[n == 0] = UNKNOWN, 0.0
    return names, score


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) for each row of ``docs``.

    Null texts, texts without a letter, and all texts if no language is known, are ``und`` with
    score 0.  Ties go to the first language by name.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample it was learned from

    def predict(batches):
        for batch in slices(batches, 1):
            names, score = predictions(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, that have a language and a score of ``least`` or more.

    Rows stay where they are: nothing is shuffled.
    """
    shared, text = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def keep(batches):
        for batch in slices(batches, text):
            names, score = predictions(batch.column(text), shared.value)
            yield batch.filter(pa.array((names != UNKNOWN) & (score >= least)))

    return docs.mapInArrow(keep, docs.schema)
