import itertools

import pytest
from pyspark.sql import functions as F

from vigilframe import schema as S
from vigilframe.operators.ladder import OUTCOMES, with_ladder, with_levels, with_rule_no
from vigilframe.schema import BOUND, FLAGS, LEVELS

VARIED = (S.FATF_CALL, S.EU_AML, S.EU_TAX, S.FR_MEASURE_FLAGS[0], S.EU_MEASURE_FLAGS[2], S.US_PROGRAMMES, S.UK)
L4 = (S.EU_AML, S.FATF_MONITORING, S.EU_TAX, S.FR_TAX)


def expected_rule(name, score, flags):
    """The rules as sentences, in plain Python with None as unknown."""
    measures = [flags[f] for f in (*S.FR_MEASURE_FLAGS, *S.EU_MEASURE_FLAGS)]
    lists = [flags[f] for f in L4]
    all_no = lambda xs: all(x == "NO" for x in xs)
    if flags[S.FATF_CALL] == "YES" or name == "CUBA":
        return 1
    if "YES" in lists and flags[S.FATF_CALL] == "NO":
        return 2
    if "YES" in measures and all_no(lists) and flags[S.UK] == "NO":
        return 3
    if score is not None and score >= 50:
        return 4
    if "YES" in (flags[S.UK], flags[S.US_PROGRAMMES]) and all_no(measures) and all_no(lists):
        return 5
    return 6


def test_every_combination(spark):
    data, want = [], []
    states = ("YES", "NO", None)
    for i, (combo, score, name) in enumerate(
        itertools.product(itertools.product(states, repeat=len(VARIED)), (None, 49, 50), ("CUBA", "OTHER", None))
    ):
        flags = {f: "NO" for f in FLAGS} | dict(zip(VARIED, combo, strict=True))
        data.append((i, name, score, *flags.values()))
        want.append(expected_rule(name, score, flags))
    schema = "id long, name_eng string, cpi_score int, " + ", ".join(f"{c} string" for c in BOUND.flags)
    register = spark.createDataFrame(data, schema)
    levelled = with_levels(with_rule_no(register, BOUND), BOUND).select("id", "rule_no", *LEVELS).collect()
    assert len(levelled) == len(want)
    for row in levelled:
        rule = want[row["id"]]
        assert row["rule_no"] == rule
        assert tuple(row[c] for c in LEVELS) == OUTCOMES[rule - 1]
    assert set(want) == {1, 2, 3, 4, 5, 6}


@pytest.mark.parametrize(
    "flags, score, risk",
    [
        ({S.FATF_CALL: None, S.EU_AML: "YES"}, 60, "STANDARD"),
        ({S.FR_MEASURE_FLAGS[0]: "YES", S.UK: "YES"}, 40, "MEDIUM"),
        ({S.US_PROGRAMMES: "YES"}, None, "STANDARD"),
        ({S.FR_MEASURE_FLAGS[0]: None}, 10, "MEDIUM"),
    ],
)
def test_single_cases(spark, flags, score, risk):
    values = {f: "NO" for f in FLAGS} | flags
    schema = "id long, name_eng string, cpi_score int, " + ", ".join(f"{c} string" for c in BOUND.flags)
    df = spark.createDataFrame([(1, "X", score, *values.values())], schema)
    assert with_levels(df, BOUND).first()["LEVEL_OF_RISK"] == risk


def test_ladder_of_ones_own(spark):
    df = spark.createDataFrame([(5,), (50,), (None,)], "x int")
    out = with_ladder(df, ["x > 40", "x > 4"], ["size", "mark"], [("big", "it's"), ("small", "b"), ("none", "c")])
    assert [tuple(r) for r in out.orderBy(F.col("x").desc_nulls_last()).collect()] == [
        (50, "big", "it's"), (5, "small", "b"), (None, "none", "c"),
    ]
    with pytest.raises(ValueError):
        with_ladder(df, ["x > 1"], ["a"], [("only one",)])
