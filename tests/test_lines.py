import random

import pytest
from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe import schema as S
from vigilframe.operators import lines as L
from vigilframe.operators.carry import carry_forward, with_dense_ids


@pytest.mark.parametrize("block, depth", [(3, 1), (2, 3), (1000, 1)])
def test_carry_forward_equals_a_plain_scan(spark, rows, block, depth):
    """One document holds most rows; blocks must not show in the result."""
    pick = random.Random(7)
    data, expected = [], []
    for doc, size in ((1, 60), (2, 5), (3, 1)):
        last = None
        for pos in sorted(pick.sample(range(200), size)):
            value = f"v{pos}" if pick.random() < 0.15 else None
            last = value or last
            data.append((doc, pos, value))
            expected.append((doc, pos, value, last))
    pick.shuffle(data)
    df = spark.createDataFrame(data, "doc int, pos long, value string")
    out = carry_forward(df, ["doc"], "pos", "value", "last", rows=block, depth=depth)
    assert rows(out) == sorted(expected, key=repr)


def test_dense_ids_over_sparse_keys(spark):
    keys = [-1, 0, 1, 7, 8, 10**6, 10**12, 2**62]
    df = spark.createDataFrame([(k, c) for k in keys for c in ("b", "a")], "k long, c string")
    out = with_dense_ids(df, "k", ["c"], "id", start=5, rows=4).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(5, 5 + 2 * len(keys)))
    assert [(r["k"], r["c"]) for r in out] == [(k, c) for k in keys for c in ("a", "b")]


def test_pages_without_separator(spark, rows):
    pages = [(1, 1, "a\nb"), (1, 2, "c"), (1, 3, ""), (1, 4, "d\ne\n"), (1, 5, "f"), (2, 1, "x"), (2, 2, "y")]
    df = spark.createDataFrame(pages, "doc_id long, page_no long, text string")
    joined = L.page_lines(df, separator="")
    ordered = [(r["doc_id"], r["line"]) for r in joined.orderBy("doc_id", "pos").collect()]
    assert ordered == [(1, "a"), (1, "bcd"), (1, "e"), (1, "f"), (2, "xy")]
    assert L.page_lines(df).count() == 2 + 1 + 1 + 3 + 1 + 1 + 1


def test_attribution_in_row_equals_attribution_of_lines(spark, rows):
    docs = spark.createDataFrame([(1, "x\nAA\ny\n\nBB"), (2, "AA\nq"), (3, ""), (4, "z")], "doc_id long, text string")
    in_row = L.attribute_doc_lines(docs, lambda line: line.rlike("^[A-Z]+$"))
    opener = F.when(F.col("line").rlike("^[A-Z]+$"), F.col("pos"))
    long = L.attribute_lines(L.document_lines(docs), ["doc_id"], "pos", opener, "open_pos", rows=2)
    assert rows(in_row.select("doc_id", "pos", "line", "open_pos")) == rows(long.select("doc_id", "pos", "line", "open_pos"))


def test_take_until(spark, rows):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "stop"), (1, 2, "b"), (2, 0, "c")], "k int, pos int, t string")
    assert rows(L.take_until(df, ["k"], "pos", F.col("t") == "stop")) == [(1, 0, "a"), (2, 0, "c")]
    arrays = spark.createDataFrame([(["a", "stop", "b"],), (["a"],), ([],), (["stop"],)], "x array<string>")
    out = [r[0] for r in arrays.select(L.items_until(F.col("x"), lambda i: i == "stop")).collect()]
    assert out == [["a"], ["a"], [], []]


def test_measures_of_entities(spark, rows):
    docs = spark.createDataFrame(
        [
            (1, "Investments\nIran\nAsset freeze and prohibition to make funds available\n cuba \ninvestments here"),
            (2, "IRAN\nnothing\nCuba\nFinancial measures"),
            (3, "Bosnia & Herzegovina\nInvestments\nBOSNIA & HERZEGOVINA\nfinancial MEASURES\n" + "long " * 80 + "investments"),
        ],
        "doc_id long, text string",
    )
    names = spark.createDataFrame([("IRAN",), ("CUBA",), ("BOSNIA AND HERZEGOVINA",), ("MALI",)], "name string")
    out = L.entity_measures(L.document_lines(docs), names, R.EU_MEASURE_PATTERNS, raw_aliases=R.RAW_ALIASES)
    freeze, invest, money = S.EU_MEASURE_FLAGS
    found = {(n, f): s for n, f, s in rows(out)}
    assert len(found) == 9
    yes = {key for key, status in found.items() if status == "YES"}
    assert yes == {
        ("IRAN", freeze), ("CUBA", invest), ("CUBA", money),
        ("BOSNIA AND HERZEGOVINA", invest), ("BOSNIA AND HERZEGOVINA", money),
    }


@pytest.mark.parametrize(
    "text, flags",
    [
        ("embargos sectoriels et militaires", {1, 2}),
        ("equipements de repression interne", {3}),
        ("Repression interne", {4}),
        ("gels d'avoirs; interdictions de voyager", {0, 7}),
        ("restrictions financieres", {6}),
        ("rien", set()),
    ],
)
def test_french_measures(spark, text, flags):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    out = L.tag_measures(df, ["id"], "t", R.FR_MEASURE_PATTERNS).collect()
    assert len(out) == 8
    assert {S.FLAG_NO[r["flag"]] for r in out if r["status"] == "YES"} == flags


def test_entities_of_any_length_open_blocks(spark):
    from vigilframe.operators.lines import entity_measures

    long_name = "A" * 300
    lines = spark.createDataFrame([(1, 0, long_name), (1, 1, "asset freeze"), (1, 2, "nothing")], "doc_id long, pos long, line string")
    entities = spark.createDataFrame([(long_name,)], "name string")
    found = entity_measures(lines, entities, [("ASSET FREEZE", "F1"), ("EMBARGO", "F2")])
    assert sorted((r.name, r.flag, r.status) for r in found.collect()) == [(long_name, "F1", "YES"), (long_name, "F2", "NO")]
