"""Decontamination: planted passages, reworded ones, figures that don't depend on blocks, odd input."""

import random

import pytest

from vigilframe.llm import decontam

WORDS = [f"{a}{b}{c}" for a in ("bo", "ka", "li", "mu", "ne", "ro", "sa", "ti", "vu", "ze") for b in ("dan", "fir", "gol", "hum", "jek") for c in ("a", "ix", "or", "um")]
N_ITEMS = 20


def text(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def reworded(rng, passage, share):
    """With this share of its words replaced by others."""
    words = passage.split(" ")
    for i in rng.sample(range(len(words)), int(share * len(words))):
        words[i] = rng.choice(WORDS)
    return " ".join(words)


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(5)
    items = [(i, f"{text(rng, 40)}. {text(rng, 6)}") for i in range(N_ITEMS)]
    docs = [(i, text(rng, 150)) for i in range(200)]
    for at, share in ((1000, 0.0), (2000, 0.1), (3000, 0.2)):
        docs += [(at + i, f"{text(rng, 60)} {reworded(rng, item, share)} {text(rng, 60)}") for i, item in items]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark, planted):
    docs, items = planted
    odd = [(5000, None), (5001, ""), (None, f"before {items[0][1]} after"), (5002, text(random.Random(1), 30_000) + " " + items[1][1]), (5003, items[2][1]), (5003, items[2][1])]
    benchmark = [*items, items[3], (900, None), (901, ""), (902, "  ")]
    return spark.createDataFrame(docs + odd, "doc_id long, text string"), spark.createDataFrame(benchmark, "item_id long, text string")


def test_planted_passages(tables):
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(*tables).collect()}
    for at, least in ((1000, 1.0), (2000, 0.9), (3000, 0.9)):
        assert sum((at + i, i) in found for i in range(N_ITEMS)) >= least * N_ITEMS, at
    assert {(None, 0), (5002, 1), (5003, 2)} <= found
    right = {(at + i, i) for at in (1000, 2000, 3000) for i in range(N_ITEMS)} | {(None, 0), (5002, 1), (5003, 2)}
    assert found <= right


def test_figures_do_not_depend_on_blocks(tables):
    bags = [sorted((tuple(r) for r in decontam.contaminated(*tables, pieces_at_once=n).collect()), key=repr) for n in (4000, 7)]
    assert [b[:2] for b in bags[0]] == [b[:2] for b in bags[1]]
    for a, b in zip(*bags, strict=True):
        assert a[2:] == pytest.approx(b[2:], abs=1e-5)


def test_clean_rows_stay_and_columns_do_not_clash(spark, tables):
    docs = tables[0].selectExpr("doc_id", "text", "1 AS __gone", "2 AS _gone")
    kept = decontam.decontaminated(docs, tables[1])
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {*range(200), 5000, 5001} <= set(ids) and not {1000, 5002, 5003, None} & set(ids)


def test_empty_tables(spark, tables):
    none, items = tables[0].where("false"), tables[1].where("false")
    assert decontam.contaminated(none, tables[1]).count() == 0
    assert decontam.contaminated(tables[0], items).count() == 0
    assert decontam.decontaminated(tables[0], items).count() == tables[0].count()


def test_a_benchmark_beyond_its_bound_is_an_error(tables, monkeypatch):
    monkeypatch.setattr(decontam, "MOST_TERMS", 10)
    with pytest.raises(ValueError, match="distinct words"):
        decontam.contaminated(*tables)
