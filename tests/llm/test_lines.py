"""Line dedup through its filters: batches, deletions and growth against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from vigilframe.llm import lines
from vigilframe.llm.lines import LineIndex

WHITE = " \t\n\x0b\x0c\r"


def brute(rows):
    """doc_id, number of lines, number dropped and kept text per row."""
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(line.strip(WHITE).lower(), set()).add(doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        keys = [x.strip(WHITE).lower() for x in all_lines]
        kept = [x for x, k in zip(all_lines, keys) if not (len(k) >= 20 and len(holders[k]) >= 3 and max(holders[k]) != doc)]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def made(n=120):
    rng = random.Random(3)
    pool = [f"line number {i} of all the shared lines" for i in range(60)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 6)) + [f"only document {i} has this line"])) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "\n".join(pool * 50)), (n + 3, "short\nshort"), (4, rows[5][1])]
    return rows


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_any_number_of_batches(spark, batches):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__gone", F.lit(1)).withColumn("_of", F.lit(2)).withColumn("n_lines", F.lit("x"))
    out = lines.dedup_lines(df, batches=batches)
    assert out.columns == ["doc_id", "text", "__gone", "_of", "n_lines", "n_dropped", "kept_text"]
    assert found(out) == brute(rows)


def test_deleted_documents_bring_lines_back(spark):
    rows = made(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = LineIndex(spark, shard_bits=2)
    index.insert(df.where("doc_id < 30"))
    index.insert(df.where("doc_id >= 30"))
    index.insert(df.where("doc_id < 10"))  # once more: adds nothing
    index.delete(df.where("doc_id % 3 = 0").select("doc_id"))
    left = df.where("doc_id % 3 <> 0")
    assert found(index.dedup(left)) == brute([r for r in rows if r[0] % 3])
    seen = index.maybe_seen(index.table("refs").select("k1", "k2")).where("NOT seen")
    assert seen.count() == 0
    index.insert(df.where("doc_id % 3 = 0"))
    assert found(index.dedup(df)) == brute(rows)


def test_shards_grow_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 20)
    rows = made(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = LineIndex(spark, shard_bits=0)
    index.insert(df.where("doc_id < 10"))
    few = index.shard_bits
    index.insert(df.where("doc_id >= 10"))
    assert index.shard_bits > few and index.table("filters").count() <= 1 << index.shard_bits
    assert found(index.dedup(df)) == brute(rows)


def test_empty_table(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
