"""Classes against brute force: planted pairs, one large group of near copies, odd rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from vigilframe.llm import components, neardup
from vigilframe.operators.lineage import scratch_paths

SCHEMA = "doc_id long, text string, key string, x string, n string, gone int, root int"
WHITE = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", "x", "x", 1, 1) for d, t in rows], SCHEMA).repartition(3)


def bag(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE:
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def similarity(a, b):
    low = sum((a & b).values())
    high = sum((a | b).values())
    return low / high if high else 0.0


def classes(rows):
    """The least doc_id that links of 0.8 or more reach."""
    bags = [(d, bag(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in bags}

    def find(d):
        while root[d] != d:
            root[d] = root[root[d]]
            d = root[d]
        return d

    for i, (a, x) in enumerate(bags):
        for b, y in bags[:i]:
            if x and y and min(x.total(), y.total()) >= 0.8 * max(x.total(), y.total()) and find(a) != find(b) and similarity(x, y) >= 0.8:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d in root}


def changed(words, n, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"n{rng.random()}"
    return out


def test_planted_pairs(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(120):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(40, 200))]
        # One changed word in 50 leaves about 0.82 of the shingles; one in 40 less than 0.8.
        for k in (0, len(words) // 50, len(words) // 60, len(words) // 35, len(words) // 8):
            rows.append((len(rows), " ".join(changed(words, k, rng))))
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    expected = classes(rows)
    assert sum(found[d] == c for d, c in expected.items()) >= 0.995 * len(rows)
    # Nothing is linked that isn't: members of a found class are in one true class.
    assert all(expected[d] == expected[found[d]] for d in found)


def test_one_large_group_of_copies_of_copies(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    rng = random.Random(7)
    texts = [[f"w{rng.randrange(500)}" for _ in range(150)]]
    while len(texts) < 500:
        texts.append(changed(rng.choice(texts), rng.randint(1, 3), rng))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(texts[i]).upper()) for i in range(50)]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    expected = classes(rows)
    assert sum(found[d] == c for d, c in expected.items()) >= 0.99 * len(rows)
    assert all(expected[d] == expected[found[d]] for d in found)


def test_odd_rows(spark):
    long = "very long text " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, long), (8, long + "end"), (None, "one two"), (9, "x"), (9, "one two")]
    found = sorted(((r.doc_id, r.class_id, r.kept) for r in neardup.near_duplicates(frame(spark, rows)).collect()), key=repr)
    expected = [(1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True), (8, 7, False), (9, 4, False), (9, 4, False), (None, None, True)]
    assert found == sorted(expected, key=repr)
    kept = neardup.deduplicated(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 2, 3, 4, 6, 7]


@pytest.mark.parametrize("rows", [[], [(1, "only one text here")], [(1, "a b c"), (2, "a b c")]])
def test_few_rows(spark, rows):
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert found == {d: 1 for d, _ in rows}


def test_large_buckets_are_compared_in_full(spark, monkeypatch):
    """Pairs among hundreds of others that are less alike, with one hub a bucket and no small bucket."""
    monkeypatch.setattr(neardup, "HUBS", (1,))
    monkeypatch.setattr(neardup, "GROUP", 40, raising=False)
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    while len(texts) < 240:
        one = changed(base, 12, rng)
        texts += [one, changed(one, 3, rng)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows), bands=5, rows=1).collect()}
    expected = classes(rows)
    assert len(set(expected.values())) <= 130
    # Two documents of 0.86 have no bucket in common with a probability of 5e-5.
    assert found == expected


def test_overlaps_of_bags():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.choice([3, 40, 60]))) for _ in range(30)] + ["", "x y z", None]
    sets = neardup.tokens(pa.array(texts), 5)
    for columns in (7, 4096):
        found = neardup.overlaps(sets, columns)
        assert all(found[i, j] == similarity(bag(a), bag(b)) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j)


def test_links_of_a_group_are_a_star():
    chain = np.eye(6, dtype=bool)
    for a, b in ((5, 3), (3, 1), (4, 2)):
        chain[a, b] = chain[b, a] = True
    assert neardup.linked(chain).tolist() == [0, 1, 2, 1, 2, 1]


def test_signatures_rule_nothing_out(spark, monkeypatch):
    """Even signatures that look unlike for all pairs of a bucket lose no link."""
    monkeypatch.setattr(neardup, "_differing", lambda a, b, longs: a[0] * 0 + 10_000)
    rng = random.Random(13)
    base = [f"w{i}" for i in range(150)]
    texts = [changed(base, rng.choice([1, 2, 3, 9, 30]), rng) for _ in range(120)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(3, "another text of doc three")]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert found == classes(rows[:-1])


def test_lonely_tokens(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e g"), (3, "a b c d x y z"), (4, "p q r s t u v"), (4, "a b"), (5, "p q r s t u w"), (6, None)]
    roots = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6)], "x long, root long")
    found = {r.x: r.lonely for r in neardup.lonely(frame(spark, rows).select("doc_id", "text"), roots, 5).collect()}
    # 4 has two texts; what 5 shares with 4 alone may count for either.
    assert found in ({1: 1, 2: 1, 3: 3, 5: 1}, {1: 1, 2: 1, 3: 3, 5: 3})


def test_one_large_group_takes_few_stored_tables(spark, monkeypatch):
    """Near copies and as many texts that are almost near copies, in the same buckets, go without many rounds."""
    stored = []
    for module in (neardup, components):
        monkeypatch.setattr(module, "landed", lambda df, real=module.landed: stored.append(df.columns) or real(df))
    rng = random.Random(17)
    base = [f"w{i}" for i in range(150)]
    texts = [changed(base, rng.choice([0, 1, 2, 7, 8, 12]), rng) for _ in range(150)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = {r.doc_id: r.class_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert found == classes(rows)
    assert len(stored) <= 24


def test_pipeline_stage_holds_few_tables(spark):
    """What the stage has on disk at once, in tables: it is released when the next stage begins."""
    before = set(scratch_paths(spark))
    rows = [(i, f"text number {i % 7} of a few with the same words") for i in range(30)]
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(7))
    assert len(set(scratch_paths(spark)) - before) <= 20
