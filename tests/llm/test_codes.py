"""Vector codes against plain loops: ties, nulls, non-finite components, few rows, empty tables."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vigilframe.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, codes string, error string, __label int"


def brute(rows, parts=8, entries=16, rounds=6):
    """(id, codes, error, label_error) rows and all entries, by loops over exact integers."""
    fine = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    if not fine:
        return [], []
    fine = [r for r in fine if len(r[1]) == len(fine[0][1])]
    w = -(-len(fine[0][1]) // parts)
    cut = [[(v + [0] * (parts * w - len(v)))[p * w : p * w + w] for p in range(parts)] for _, v, _ in fine]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def near(p, u):
        return min((sum((x - y) ** 2 for x, y in zip(u, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(p, c[p])[1] for c in cut]
            for k in range(len(books[p])):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, y), e in zip(fine, errors):
        total[y] = total.get(y, 0) + e
    return [(i, bytes(k for _, k in f), e, total[y]) for (i, _, y), f, e in zip(fine, found, errors)], books


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, y, "x", 1, "x", "x", 1) for i, v, y in rows], SCHEMA)
    made, books = codes.compressed(df, **how)
    return sorted(((r.id, bytes(r.codes), r.error, r.label_error) for r in made.collect()), key=repr), books


def test_equal_to_loops(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(60, 16)), 1).astype(np.float32)
    rows = [(100 - i, v.tolist(), int(i % 3)) for i, v in enumerate(x)]
    rows += [(1, None, 0), (2, [float("nan")] * 16, 0), (3, [float("inf")] + [0.0] * 15, 0), (4, [None] * 16, 0), (5, [], 0), (6, [0.5] * 8, 0)]
    rows += [(90, x[10].tolist(), 0), (90, x[10].tolist(), None), (None, x[3].tolist(), None), (50, [0.0] * 16, None)]
    made, books = run(spark, rows)
    # The vector of another length has the least id of all usable ones; without it the others count.
    assert len(made) == 1
    rows = [r for r in rows if r[0] != 6]
    made, books = run(spark, rows)
    expected, entries = brute(rows)
    assert made == sorted(expected, key=repr)
    flat = ",".join(str(x) for book in entries for e in book for x in e)
    assert books.digest() == hashlib.sha256(flat.encode()).hexdigest()
    assert len(made) == 64


@pytest.mark.parametrize("n, width", [(1, 8), (5, 12), (17, 3)])
def test_few_rows_and_odd_lengths(spark, n, width):
    rows = [(i, [float(i * k % 5) for k in range(width)], None) for i in range(n)]
    assert run(spark, rows)[0] == sorted(brute(rows)[0], key=repr)


def test_empty_table(spark):
    made, books = run(spark, [])
    assert made == [] and books.digest() == hashlib.sha256(b"").hexdigest()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        run(spark, [(1, [1e9] * 8, None)])


def test_decoded_is_as_far_as_the_error(spark):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(40, 16)).astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    made, books = codes.compressed(df)
    error = {r.id: r.error for r in made.collect()}
    for r in codes.decoded(made, books).collect():
        own = np.floor(4096 * np.array(rows[r.id][1], np.float64))
        assert ((own - np.array(r.v) * 4096) ** 2).sum() == error[r.id]


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_tree_finds_the_lowest_nearest_entry(data):
    width = data.draw(st.integers(1, 4))
    point = st.lists(st.one_of(st.integers(-3, 3), st.integers(-codes.LARGEST, codes.LARGEST)), min_size=width, max_size=width)
    entries = np.array(data.draw(st.lists(point, min_size=1, max_size=20)), np.int64)
    x = np.array(data.draw(st.lists(point, min_size=1, max_size=10)), np.int64)
    number, best = codes.nearest(entries, x)
    squares = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (best == squares.min(1)).all() and (number == squares.argmin(1)).all()


def test_tree_leaves_subtrees_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-100_000, 100_000, (16, 8))
    x = centres[rng.integers(0, 16, 500)] + rng.integers(-50, 50, (500, 8))
    tree = codes.Gnat(centres, np.arange(16))
    best, number = np.full(500, np.iinfo(np.int64).max), np.full(500, 16)
    assert tree.search(x, np.arange(500), best, number) < 0.8 * 500 * 16
