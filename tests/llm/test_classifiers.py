"""Quality and toxicity: held-out order against the labels, and rows that are out of the ordinary."""

import pytest
from pyspark.sql import functions as F

from vigilframe.llm import quality, sampling, toxicity
from vigilframe.llm.queries import QUERIES
from vigilframe.llm.ship import ship

SF = "/root/testdata/sf0.01"
KINDS = {"quality": (quality, "op3_quality", 0.95), "toxic": (toxicity, "op7_toxicity", 0.85)}


def area(pairs):
    """Share of (label 1, label 0) pairs in the right order, ties half."""
    high, low = ([s for s, y in pairs if y == k] for k in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in high for b in low) / (len(high) * len(low))


@pytest.mark.parametrize("label", KINDS)
def test_held_out_order(spark, label):
    _, name, least = KINDS[label]
    rows = QUERIES[name](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert area([(r.score, truth[r.doc_id]) for r in rows if r.held_out and truth.get(r.doc_id) is not None]) >= least


@pytest.mark.parametrize("label", KINDS)
def test_unusual_rows(spark, label):
    """Null, empty, very long, repeated texts, null ids and clashing columns are scored; equal texts alike; no rows, no result."""
    module = KINDS[label][0]
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = sampling.labelled(docs, spark.read.parquet(f"{SF}/labels.parquet"), label, F.lit(True), 400)
    model = module.train(sample)
    rows = [(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (None, "some words here"), (4, "long " * 30_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score_of", F.lit("x")).withColumn("label", F.lit(7))
    found = module.score(odd, model).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in found)) == sorted((i is None, i or 0) for i, _ in rows)
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (3, None)}) == 1
    assert module.score(odd.limit(0), model).collect() == []
