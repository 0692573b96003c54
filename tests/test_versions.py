"""Versioned tables: what is written and read, and that it equals whole snapshots."""

import pytest
from pyspark.sql import functions as F

from vigilframe.operators.audit import diff_snapshots
from vigilframe.sources import versions
from vigilframe.sources.versions import VersionedTable

SCHEMA = "id long, flag string, score int"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path), "id", width=10)


def start(spark, n=180):
    return spark.range(-20, n).select("id", F.when(F.col("id") % 3 == 0, "YES").when(F.col("id") % 3 == 1, "NO").alias("flag"), F.col("id").cast("int").alias("score"))


def altered(df):
    """Two changed rows, one of them to NULL, in the ranges 5 and 15."""
    flag = F.when(F.col("id") == 55, F.lit("YES")).when(F.col("id") == 151, F.lit(None)).otherwise(F.col("flag"))
    return df.withColumn("flag", flag)


def test_a_version_writes_changed_ranges_only(spark, table, rows):
    one, two = start(spark), altered(start(spark))
    table.write(one, "1")
    table.write(two, "2", base="1")
    assert rows(table.read("1")) == rows(one) and rows(table.read("2")) == rows(two)
    stored = {r.node: r.stored_in for r in table.leaves("2").collect()}
    assert {n for n, v in stored.items() if v == "2"} == {5, 15} and len(stored) == 20


def test_difference_reads_changed_ranges_only(spark, table, rows):
    table.write(start(spark), "1")
    table.write(altered(start(spark)), "2", base="1")
    changed = table.changed_ranges("1", "2")
    assert rows(changed) == [(15,), (5,)]
    assert table.read("1", changed).count() == table.read("2", changed).count() == 20
    assert all("key_range=5/" in f or "key_range=15/" in f for f in table.read("2", changed).inputFiles())
    assert rows(table.diff("1", "2")) == rows(diff_snapshots(start(spark), altered(start(spark)), "id"))
    assert table.diff("1", "1").count() == 0


def test_rows_in_place_and_keys_taken_out(spark, table, rows):
    table.write(start(spark), "1")
    new = spark.createDataFrame([(55, "YES", None), (5000, None, 1), (-3, "NO", 2)], SCHEMA)
    gone = spark.createDataFrame([(i,) for i in [*range(100, 110), 131, 55, 99999]], "id long")
    table.apply("2", "1", new, gone)
    whole = start(spark).join(new.unionByName(gone.selectExpr("id", "'x' flag", "0 score")).select("id"), "id", "left_anti").unionByName(new)
    assert rows(table.read("2")) == rows(whole)
    kept = table.leaves("2").where("stored_in = '1'").count()
    assert kept == 20 - 4  # of -3, 55, 131 and the range 100 to 109, which is empty now
    assert table.leaves("2").where("node = 10").count() == 0
    # The tree is the one that the whole snapshot gets.
    table.write(whole, "3")
    assert table.changed_ranges("2", "3").count() == 0
    assert rows(table.diff("1", "2", added_removed=True)) == rows(diff_snapshots(start(spark), whole, "id", added_removed=True))


def test_a_repeated_version_and_one_that_changes_nothing(spark, table, rows):
    table.write(start(spark), "1")
    for _ in range(2):
        table.write(altered(start(spark)), "2", base="1")
    assert rows(table.read("2")) == rows(altered(start(spark)))
    table.apply("3", "2", altered(start(spark)).where("id < 40"))
    assert table.leaves("3").where("stored_in = '3'").count() == 0
    assert rows(table.read("3")) == rows(table.read("2"))
    with pytest.raises(ValueError):
        table.write(start(spark), "1", base="1")


def test_null_is_no_value_and_no_neighbour(spark, table):
    table.write(spark.createDataFrame([(1, None, None), (11, "7", None)], SCHEMA), "1")
    table.write(spark.createDataFrame([(1, "", None), (11, None, 7)], SCHEMA), "2", base="1")
    assert sorted(r.key_range for r in table.changed_ranges("1", "2").collect()) == [0, 1]


def test_empty_other_columns_and_missing_keys(spark, table, rows):
    none = spark.createDataFrame([], SCHEMA)
    table.write(none, "0")
    assert table.read("0").count() == 0 and table.read("0").columns == ["id", "flag", "score"]
    table.apply("1", "0", spark.createDataFrame([(7, "NO", 1)], SCHEMA))
    assert rows(table.read("1")) == [(7, "NO", 1)] and table.diff("0", "1", added_removed=True).count() == 2
    table.apply("2", "1", none, spark.createDataFrame([(7,)], "id long"))
    assert table.read("2").count() == 0
    wider = start(spark, 30).withColumn("extra", F.lit("x"))
    table.write(wider, "3", base="1")
    assert rows(table.read("3")) == rows(wider)
    with pytest.raises(Exception, match="a row without id"):
        table.write(spark.createDataFrame([(None, "NO", 1)], SCHEMA), "4")
    with pytest.raises(ValueError, match="key_range"):
        table.write(wider.withColumn("key_range", F.lit(1)), "5")


def test_many_ranges_are_joined_with_the_same_rows(spark, table, rows, monkeypatch):
    table.write(start(spark), "1")
    table.write(altered(start(spark)), "2", base="1")
    listed = rows(table.diff("1", "2")), rows(table.read("2"))
    monkeypatch.setattr(versions, "LISTED", 1)
    assert (rows(table.diff("1", "2")), rows(table.read("2"))) == listed
