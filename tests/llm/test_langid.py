"""Language identification: word scores, the fall to shorter n-grams, held-out accuracy, odd rows."""

import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigilframe.llm import langid
from vigilframe.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, lang_pred string, __id int, kind int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", 1, 1, 1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(1, "hallo hallo hallo welt welt welt strasse strasse strasse", "de"), (2, "hello hello hello world world world street street street", "en")]
    rows += [(3, None, "en"), (4, "no language here", None), (None, "without id", "en"), (5, "", "de")]
    return langid.train(frame(spark, rows), F.lit(True))


def test_known_words_count_by_log_frequency(model):
    assert model.langs == ["de", "en"]
    scores = langid.vocabulary_scores(model, pa.array(["hallo", "world"]))
    v = len(model.keys[langid.WORD])
    assert v == 6
    for row, (de, en) in zip(scores, ((3, 0), (0, 3))):
        for got, n in zip(row, (de, en)):
            assert math.isclose(got, math.log((n + 0.05) / (9 + 0.05 * (v + 1))), rel_tol=1e-5)


def test_unseen_words_fall_to_the_longest_known_grams(model):
    def by_hand(word, order):
        held = {"de": ["hallo", "welt", "strasse"], "en": ["hello", "world", "street"]}
        grams = lambda w: [f"<{w}>"[i : i + order] for i in range(len(w) + 3 - order)]
        counts = {x: {} for x in held}
        for x, ws in held.items():
            for w in ws:
                for g in grams(w):
                    counts[x][g] = counts[x].get(g, 0) + 3
        known = set(counts["de"]) | set(counts["en"])
        mine = [g for g in grams(word) if g in known]
        if not mine:
            return None
        return [sum(math.log((counts[x].get(g, 0) + 0.05) / (sum(counts[x].values()) + 0.05 * (len(known) + 1))) for g in mine) / len(mine) for x in ("de", "en")]

    words = ["streets", "welten", "worlt", "hexxo", "halm", "zor", "q"]
    got = langid.vocabulary_scores(model, pa.array(words)).tolist()
    fell = []
    for word, row in zip(words, got):
        order = next((n for n in langid.ORDERS if by_hand(word, n)), None)
        fell.append(order)
        expected = by_hand(word, order) if order else [0.0, 0.0]
        assert all(math.isclose(a, b, rel_tol=1e-4, abs_tol=1e-6) for a, b in zip(row, expected)), word
    # Words fall to n-grams of different lengths.
    assert len(set(fell)) >= 4


def test_odd_rows(spark, model):
    texts = ["hello world", "hallo welt", None, "", "12 ++ 34", "hello " * 30_000, "Ω"]
    rows = [(n, t, "en") for n, t in enumerate(texts)] + [(0, "hallo welt", None), (None, "world", None)]
    found = langid.identify(frame(spark, rows), model).collect()
    assert len(found) == len(rows)
    langs = sorted((r.doc_id if r.doc_id is not None else -1, r.lang_pred) for r in found)
    assert langs == [(-1, "en"), (0, "de"), (0, "en"), (1, "de"), (2, "und"), (3, "und"), (4, "und"), (5, "en"), (6, "de")]
    assert all(0 <= r.score <= 1 for r in found)
    kept = langid.accepted(frame(spark, rows), model)
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 0, 1, 5, 6]


def test_empty_tables(spark):
    none = langid.train(frame(spark, []), F.lit(True))
    assert none.langs == [] and langid.identify(frame(spark, []), none).collect() == []
    assert [r.lang_pred for r in langid.identify(frame(spark, [(1, "words", "en")]), none).collect()] == ["und"]


def test_held_out_accuracy(spark):
    found = QUERIES["op5_language"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = found.where("held_out").join(docs, "doc_id").where("lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)


def test_scrambled_words_are_still_told_apart(spark):
    """Words that no one has learned, made of the letters' habits of a language."""
    sound = {"aa": "aeiou", "bb": "mnlrs"}
    random.seed(1)
    word = lambda x: "".join(random.choice(sound[x]) + random.choice("tkp") for _ in range(4))
    learned = [(i, " ".join(word(x) for _ in range(300)), x) for i, x in enumerate(["aa", "bb"] * 5)]
    model = langid.train(frame(spark, learned), F.lit(True))
    asked = [(i, " ".join(word(x) for _ in range(5)), x) for i, x in enumerate(["aa", "bb"] * 50)]
    found = {r.doc_id: r.lang_pred for r in langid.identify(frame(spark, asked), model).collect()}
    assert all(found[i] == x for i, _, x in asked)
