import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vigilframe.operators import asof, patterns

LITERALS = [
    (r"NORTH KOREA", "NORTH KOREA"), (r"^(DPRK|KOREA)$", ""), (r"KOREAN?", "KOREA"), (r"CO+NGO", "NGO"), (r"a.bcd.*ef", "bcd"),
    (r"\bIRAN\b", "IRAN"), (r"x\.yz12", "yz12"), (r"(?i)mali", ""), (r"[A-Z]{3}land", "land"), (r"abc{2,3}def", "def"), (r"(very )?long(er)*name", "name"),
    (r"((a)b)c", ""), (r"", ""), (r"abcd*", "abc"),
]


@pytest.mark.parametrize("pattern, literal", LITERALS)
def test_literal_part(spark, pattern, literal):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(patterns.literal_part(F.col("p"))).first()[0] == literal


def test_every_pattern_against_every_text(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(2, 6)))
    texts = [(i, " ".join(word() for _ in range(4))) for i in range(150)] + [(900, None), (901, ""), (902, "ab"), (0, "repeated id")]
    made = [(i, rng.choice(["{}", "^{}", "{}$", "{}?", "({})+", "{}|zz", "{}[ab]c", "{}.{}", "{}+b", r"\b{}\b", "[^a]{}"]).replace("{}", word())) for i in range(400)]
    made += [(990, None), (991, "."), (992, "^$")]
    df = spark.createDataFrame(texts, "id int, t string"), spark.createDataFrame(made, "pattern_id int, pattern string")
    found = sorted(map(tuple, patterns.match_patterns(*df, "id", "t").collect()))
    assert found == sorted({(i, j) for i, t in texts for j, p in made if t is not None and p is not None and re.search(p, t)})


RARE = [
    (r"(?:Customer|Supplier)#\d+1234$", "1234"), (r"(?=x|y)abc(?<z>d|e)", "abc"), (r"ab|cde", ""), (r"a(?i:b)cde", ""), (r"[ab]{100}x", "x"), (r"(ab){10,20}", ""), (r"[[ab]cde]f", ""),
]


@pytest.mark.parametrize("pattern, literal", RARE)
def test_literal_part_beside_groups_and_repeats(spark, pattern, literal):
    df = spark.createDataFrame([(pattern,)], "p string")
    assert df.select(patterns.literal_part(F.col("p"))).first()[0] == literal


def test_anchors_and_repeats(spark):
    texts = ["ab" * 50, "x" + "ab" * 60, "ends 12", "ends 12\n", "ends 12\r\n", "ends 12\n\n", "12 starts", "", "\n", "b" * 100 + "c", "\x02ab", "\u00e9\U0001f600end"]
    made = ["[ab]{100}", "(ab){10,50}", "12$", "^12", "^?12", "12$?", "^$", "(?:x|y)ab", "[[ab]xyz]ab", "b{100}c", "\U0001f600end$", "s 12\n$", "\\$|^1", "ends? 1(?:2|3)$"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string"), spark.createDataFrame(list(enumerate(made)), "pattern_id int, pattern string")
    found = {tuple(r) for r in patterns.match_patterns(*df, "id", "t").collect()}
    every = df[0].crossJoin(df[1]).where(F.regexp_like("t", F.col("pattern"))).select("id", "pattern_id")
    assert found == {tuple(r) for r in every.collect()}


def test_patterns_that_begin_alike_meet_few_texts(spark):
    """A literal part that all texts have isn't what they are joined by."""
    texts = spark.range(3000).select("id", F.format_string("Customer#%09d", "id").alias("t"))
    asked = spark.range(1000).select(F.col("id").alias("pattern_id"), F.format_string("^Customer#0*%04d$", "id").alias("pattern"))
    found = patterns.match_patterns(texts, asked, "id", "t")
    assert sorted(map(tuple, found.collect())) == [(i, i) for i in range(1000)]
    indexed = patterns.indexed_patterns(asked.select(F.col("pattern").alias("__pattern")), texts.select(patterns._marked(F.col("t")).alias("__marked")))
    assert indexed.agg(F.max("__n")).first()[0] <= 30


def test_plan_has_no_nested_loop(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, t string"), spark.createDataFrame([(1, "abc")], "pattern_id int, pattern string")
    plan = patterns.match_patterns(*df, "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_as_of(spark):
    rng = random.Random(5)
    start = datetime(1969, 12, 30)
    time = lambda: start + timedelta(hours=rng.randrange(200))
    # One key holds a third of all rows; keys and times may be null; times repeat.
    key = lambda: rng.choice([1, 1, 1, 2, 3, 4, 5, 6, None])
    rows = [(i, key(), time() if i % 17 else None) for i in range(300)]
    published = [(key(), time() if i % 13 else None, i % 7, f"v{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "id int, k int, at timestamp"), spark.createDataFrame(published, "k int, at timestamp, n int, v string")
    found = {r.id: (r.n, r.v) for r in asof.as_of(*df, ["k"], "at", ["n", "v"], block=64).collect()}
    for i, k, at in rows:
        past = [(t, n, v) for x, t, n, v in published if x is not None and x == k and t is not None and at is not None and t <= at]
        assert found[i] == (max(past)[1:] if past else (None, None))
    assert asof.as_of(df[0].limit(0), df[1], ["k"], "at", ["n"]).collect() == []
    assert {r.n for r in asof.as_of(df[0], df[1].limit(0), ["k"], "at", ["n"]).collect()} == {None}
