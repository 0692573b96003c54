from datetime import datetime

from pyspark.sql import functions as F

from vigilframe import reference_data as R
from vigilframe.operators import audit as A
from vigilframe.operators import listing as LS
from vigilframe.operators import match as M

AT = datetime(2024, 5, 1, 12, 0)


def snapshots(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, "c", 7), (4, "d", 1)], "id long, t string, n int")
    new = spark.createDataFrame([(3, "c", None), (1, "a", None), (2, "B", 6), (5, "e", 1)], "id long, t string, n int")
    return old, new


def test_diff_is_null_safe_and_keyed(spark, rows):
    old, new = snapshots(spark)
    assert rows(A.diff_snapshots(old, new, "id")) == [(2, "n", "5", "6"), (2, "t", "b", "B"), (3, "n", "7", None)]
    both = rows(A.diff_snapshots(old, new, "id", added_removed=True))
    assert (4, "t", "d", None) in both and (5, "t", None, "e") in both


def test_diff_replayed_on_old_gives_new(spark):
    old, new = snapshots(spark)
    state = {(r["id"], c): r[c] for r in old.collect() for c in ("t", "n")}
    for key, column, _, value in A.diff_snapshots(old, new, "id").collect():
        state[key, column] = value
    for r in new.collect():
        for c in ("t", "n"):
            if (r["id"], c) in state:
                assert (None if r[c] is None else str(r[c])) == (None if state[r["id"], c] is None else str(state[r["id"], c]))


def test_sentinel_only_without_changes(spark, rows):
    old, new = snapshots(spark)
    same = A.with_sentinel(A.diff_snapshots(old, old, "id"))
    assert rows(same) == [(-1, "None", "No changes detected", "No changes detected")]
    assert A.with_sentinel(A.diff_snapshots(old, new, "id")).count() == 3
    assert A.change_count(A.diff_snapshots(old, new, "id")).first()[0] == 3


def test_audit_rows_have_one_stamp_and_dense_ids(spark, rows):
    old, new = snapshots(spark)
    out = A.audit_rows(A.diff_snapshots(old, new, "id"), "id", AT, first_id=11).orderBy("AuditID").collect()
    assert [r["AuditID"] for r in out] == [11, 12, 13]
    assert {r["UpdatedAt"] for r in out} == {AT}
    assert [(r["SanctionsMapId"], r["ColumnName"]) for r in out] == [(2, "n"), (2, "t"), (3, "n")]


def test_transitions(spark, rows):
    changes = spark.createDataFrame(
        [(1, "f", "YES", "NO"), (2, "f", "NO", "YES"), (3, "f", "NO", "YES"), (4, "f", None, "NO"), (5, "t", "a", "b")],
        "id long, column string, old string, new string",
    )
    assert rows(A.transitions(changes)) == [("f", "NO->YES", 2), ("f", "YES->NO", 1)]
    assert rows(A.transitions_of(changes, "YES", "NO")) == [(1, "f", "YES", "NO")]


def test_check_variants(spark, rows):
    register = spark.createDataFrame([(1, None), (2, "yes"), (3, "YES"), (4, "NO")], "id long, f string")
    hits = spark.createDataFrame([(1, 0, 1), (2, 1, 1)], "id long, yes long, seen long")

    def check(source):
        return rows(A.check_changes(register, hits, "id", {0: "f"}, A.CHECKS[source]))

    assert check(R.FR_MEASURES) == [(1, "f", None, "NO"), (2, "f", "yes", "YES")]
    assert check(R.EU_AML) == [(2, "f", "yes", "YES")]
    assert check(R.FATF_CALL) == [(2, "f", "yes", "YES"), (3, "f", "YES", "NO")]
    assert check(R.UK) == [(3, "f", "YES", "NO")]


def test_check_values(spark, rows):
    register = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id long, v int")
    updates = spark.createDataFrame([(1, None), (2, None), (3, 8)], "id long, v int")
    assert rows(A.check_values(register, updates, "id", ["v"])) == [(1, "v", "5", None), (3, "v", "7", "8")]


def test_membership_with_null_names_and_duplicates(spark, rows):
    register = spark.createDataFrame([(1, "A"), (2, None), (3, "B")], "id long, n string")
    listing = spark.createDataFrame([("A",), ("A",), (None,)], "name string")
    assert rows(M.members(register, listing, "n").select("id")) == [(1,)]
    assert rows(M.non_members(register, listing, "n").select("id")) == [(3,)]
    assert rows(M.status_for_all(register, listing, "n").select("id", "status")) == [(1, "YES"), (2, "NO"), (3, "NO")]
    empty = listing.where("false")
    assert rows(M.non_members(register, empty, "n").select("id")) == [(1,), (3,)]


def test_unmatched_and_theta(spark, rows):
    register = spark.createDataFrame([(1, "A"), (2, "KOREA X"), (3, "B")], "id long, n string")
    listing = spark.createDataFrame([("A",), ("SPECIAL",), ("Z",)], "name string")
    assert rows(M.unmatched_names(listing, register, "n")) == [("SPECIAL",), ("Z",)]
    assert rows(M.match_names(register, listing, "id", "n", {"SPECIAL": "KOREA"})) == [(1,), (2,)]
    assert rows(M.match_names(register, listing.where("name <> 'SPECIAL'"), "id", "n", {"SPECIAL": "KOREA"})) == [(1,)]


def test_pages_by_address(spark, rows):
    register = spark.createDataFrame([(1, "A"), (2, "B")], "id long, n string")
    pages = spark.createDataFrame([("u/a", 200)], "url string, status int")
    slug = F.lower("n")
    assert rows(M.attach_page(register, pages, slug, "u/").select("id", "status")) == [(1, 200), (2, None)]
    links = pages.select(F.col("url").alias("link"))
    assert rows(M.reachable(register, links, slug, "u/").select("id")) == [(1,)]


def test_aliases_can_give_two_names(spark, rows):
    names = spark.createDataFrame([("S", "X"), ("S", "Y"), ("T", "X")], "source string, name string")
    aliases = spark.createDataFrame([("S", "X", "X1"), ("S", "X", "X2")], "source string, from_name string, to_name string")
    assert rows(LS.apply_aliases(names, aliases)) == [("S", "X1"), ("S", "X2"), ("S", "Y"), ("T", "X")]


def test_last_wins_and_latest(spark, rows):
    df = spark.createDataFrame([(1, "é"), (2, "E"), (3, "x")], "id long, n string")
    from vigilframe.functions.names import fold_name

    assert rows(LS.dedupe_last_wins(df, fold_name(F.col("n")), "id")) == [("E", 2), ("X", 3)]
    pages = spark.createDataFrame([("S", 1, "a"), ("S", 2, "b"), ("S", 9, "c"), ("T", 9, "d")], "source string, at int, body string")
    assert rows(LS.latest_snapshot(pages, ["source"], ["at"], F.lit(5)).select("body")) == [("b",)]


def test_common_and_counts(spark, rows):
    a = spark.createDataFrame([("A", "f"), ("A", "f"), ("B", "f")], "name string, flag string")
    b = spark.createDataFrame([("A", "f"), ("C", "g")], "name string, flag string")
    assert rows(LS.common_names(a, b, ["name", "flag"])) == [("A", "f")]
    assert rows(LS.names_per_flag(LS.union_listings(a, b))) == [("f", 2, "A"), ("f", 2, "B"), ("g", 1, "C")]
