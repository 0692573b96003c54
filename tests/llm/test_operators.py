"""Operators of llm against brute force on small tables with nulls, empty texts and repeated rows."""

import math
import re

import pytest
from pyspark.sql import functions as F

from vigilframe.llm import lines, mixing, neardup, vectors
from vigilframe.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, source string, lang string"
LONG = "a line of more than twenty characters"
DOCS = [
    (1, f"{LONG}\nonly here", "a", "en"),
    (2, f"  {LONG.upper()}\t\nshort", "a", "en"),
    (3, f"{LONG}\n{LONG}", "b", "en"),
    (4, None, "b", None),
    (5, "", None, "en"),
    (6, "short\nshort", "a", "en"),
]
WHITE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_lines(docs):
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in lines.dedup_lines(docs.select("doc_id", "text")).collect()}
    holders = {}
    for doc, text, *_ in DOCS:
        for line in (text or "").split("\n"):
            holders.setdefault(line.strip(WHITE).lower(), set()).add(doc)
    for doc, text, *_ in DOCS:
        all_lines = (text or "").split("\n")
        keys = [x.strip(WHITE).lower() for x in all_lines]
        kept = [x for x, k in zip(all_lines, keys) if not (len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != doc)]
        assert found[doc] == (len(all_lines), len(all_lines) - len(kept), "\n".join(kept))


def test_mix_keeps_within_three_times(docs):
    rows = mixing.mix(docs).collect()
    assert sorted(r.doc_id for r in rows) == [1, 2, 3, 4, 5, 6]
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, *_ in DOCS}
    for r in rows:
        assert r["size"] == sizes[r.doc_id]
        assert 0 <= r["whole"] * r["size"] + r["part"] <= 3 * r["size"]


def test_near_duplicates(spark):
    text = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    rows = [(1, text), (2, text), (3, text + " more"), (4, other), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x"))
    kept = {r.doc_id for r in neardup.deduplicated(df).collect()}
    assert {1, 4} <= kept and not {2, 3} & kept


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [2.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()}

    def cosine(a, b):
        ok = a and b and all(map(math.isfinite, a + b)) and any(a) and any(b)
        return sum(x * y for x, y in zip(a, b)) / math.hypot(*a) / math.hypot(*b) if ok else 0.0

    links = {i: {j for j, b in rows if j != i and cosine(a, b) >= 0.95} for i, a in rows}
    assert found == {i: (len(s), min(s | {i}), i == min(s | {i})) for i, s in links.items()}


def test_queries_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
