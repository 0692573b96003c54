import itertools

import pytest
from pyspark.sql import functions as F

from vigilframe import schema as S
from vigilframe.operators import update as U
from vigilframe.operators.listing import listing_masks
from vigilframe.schema import BOUND, FLAGS

SCHEMA = "id long, name_eng string, cpi_score int, " + ", ".join(f"{c} string" for c in BOUND.flags)
KINDS = {
    "U-1": S.EU_AML, "U-2": S.FATF_MONITORING, "U-2m": S.FR_TAX, "U-3": S.US_PROGRAMMES, "U-4": S.EU_MEASURE_FLAGS[0],
    "U-5": S.FR_MEASURE_FLAGS[0],
}


def model(kind, old, name, listing, register_names):
    """One flag of one row; ``listing`` maps names to statuses."""
    if kind == "U-4":
        if not any(listing.get(n) == "YES" for n in register_names):
            return old
        if listing.get(name) == "YES":
            return "YES"
        return "NO" if old == "YES" and name is not None else old
    if not listing or (kind == "U-2m" and not any(listing.get(n) == "YES" for n in register_names)):
        return old
    if kind == "U-3":
        return "YES" if listing.get(name) == "YES" else "NO"
    if name is None:
        return old
    return "YES" if listing.get(name) == "YES" else "NO"


LISTINGS = (
    {},
    {"A": "YES"},
    {"A": "YES", "B": "NO"},
    {"Z": "YES"},
    {"B": "NO"},
)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("listing", LISTINGS, ids=str)
def test_policies(spark, kind, listing):
    flag = KINDS[kind]
    column = BOUND.flag(flag)
    rows = list(itertools.product(("A", "B", "C", None), ("YES", "NO", None)))
    data = [
        (i, name, None, *[old if f == flag else "kept" for f in FLAGS]) for i, (name, old) in enumerate(rows)
    ]
    register = spark.createDataFrame(data, SCHEMA)
    listed = [("S", n, flag, s) for n, s in listing.items() for _ in range(2)]
    table = spark.createDataFrame(listed, "source string, name string, flag string, status string")
    out = U.apply_listing(register, table, BOUND, {flag: U.POLICIES[flag]}).orderBy("id").collect()
    names = {name for name, _ in rows}
    assert [r[column] for r in out] == [model(kind, old, name, listing, names) for name, old in rows]
    others = [c for c in BOUND.flags if c != column]
    assert all(r[c] == "kept" for r in out for c in others)


def test_all_flags_in_one_pass_equal_one_by_one(spark, rows):
    data = [(i, n, None, *[("YES", "NO", None)[(i + j) % 3] for j in range(18)]) for i, n in enumerate(["A", "B", "C", None])]
    register = spark.createDataFrame(data, SCHEMA)
    listed = [("S", "ABCZ"[(3 * j) % 4], f, "YES") for j, f in enumerate(FLAGS)]
    table = spark.createDataFrame(listed, "source string, name string, flag string, status string")
    together = U.apply_listing(register, table, BOUND)
    one_by_one = register
    for flag in reversed(FLAGS):
        one_by_one = spark.createDataFrame(
            U.apply_listing(one_by_one, table, BOUND, {flag: U.POLICIES[flag]}).collect(), SCHEMA
        )
    assert rows(together) == rows(one_by_one)
    again = U.apply_listing(spark.createDataFrame(together.collect(), SCHEMA), table, BOUND)
    assert rows(again) == rows(together)


def test_values_overwrite_with_null_and_keep_on_error(spark, rows):
    register = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, "d")], "id long, v int, t string")
    fetched = spark.createDataFrame([(1, 11, False), (2, None, False), (3, 99, True)], "id long, v int, error boolean")
    out = U.update_values(register, fetched, "id", ["v"], error="error")
    assert out.columns == register.columns
    assert rows(out) == [(1, 11, "a"), (2, None, "b"), (3, 30, "c"), (4, 40, "d")]


def test_cells_set_only_what_is_mentioned(spark):
    register = spark.createDataFrame([(1, "A", None, *["old"] * 18), (2, "B", None, *["old"] * 18)], SCHEMA)
    listing = spark.createDataFrame(
        [("S", "A", FLAGS[3], "NO"), ("S", "A", FLAGS[5], "YES")], "source string, name string, flag string, status string"
    )
    out = U.update_cells(register, listing, BOUND, F.col("name_eng")).orderBy("id").collect()
    assert (out[0]["f3"], out[0]["f5"], out[0]["f0"], out[1]["f3"]) == ("NO", "YES", "old", "old")


def test_masks_merge_duplicates(spark, rows):
    listing = spark.createDataFrame(
        [("S", "A", FLAGS[1], "NO"), ("S", "A", FLAGS[1], "YES"), ("S", "A", FLAGS[17], "NO"), ("S", "A", None, "UNDER WAY")],
        "source string, name string, flag string, status string",
    )
    assert rows(listing_masks(listing, ["name"])) == [("A", 1 << 1, (1 << 1) | (1 << 17))]


def test_unknown_policy(spark):
    register = spark.createDataFrame([], SCHEMA)
    listing = spark.createDataFrame([], "source string, name string, flag string, status string")
    with pytest.raises(ValueError):
        U.apply_listing(register, listing, BOUND, {S.UK: U.Policy("U-9")})
