"""Links of planted clusters against brute force: recall, no false links, components, hot clusters."""

import numpy as np
import pytest

from vigilframe.llm import vectors


def planted(n, width, seed):
    """Random directions, pairs at 0.95 to 0.99, a chain, copies, and one cluster of a third of all rows."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.sqrt((x**2).sum(-1, keepdims=True))
    x = unit(rng.normal(size=(n, width)))

    def at(v, cosine):
        away = rng.normal(size=v.shape)
        away = unit(away - (away * v).sum(-1, keepdims=True) * v)
        return cosine * v + np.sqrt(1 - cosine**2) * away

    near = at(x[: n // 4], rng.uniform(0.951, 0.99, (n // 4, 1)))
    chain = [x[-1]]
    for _ in range(20):
        chain.append(at(chain[-1], 0.955))
    hot = at(np.repeat(x[-2:-1], n // 2, axis=0), 0.985)
    rows = np.concatenate([x, near, chain, hot, x[:50], 3 * x[50:100]]).astype(np.float32)
    return rows[rng.permutation(len(rows))]


@pytest.mark.parametrize("n, seed", [(1500, 1), (600, 2)])
def test_recall_and_components(spark, n, seed, monkeypatch):
    monkeypatch.setattr(vectors, "CELL", 300)
    monkeypatch.setattr(vectors, "QUERIES", 500)
    x = planted(n, 32, seed)
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, member int").repartition(3)
    found = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    assert len(found) == len(x)
    exact = x.astype(float)
    exact /= np.sqrt((exact**2).sum(1, keepdims=True))
    cosine = exact @ exact.T
    np.fill_diagonal(cosine, 0)
    links = (cosine >= 0.95).sum(1)
    got = np.array([found[i].n_links for i in range(len(x))])
    # No link is made up, and hardly any lost.
    assert (got <= links).all() and got.sum() >= 0.999 * links.sum()
    asked = np.arange(len(x)) % 50 == 0
    assert got[asked].sum() >= 0.99 * links[asked].sum()
    root = np.arange(len(x))
    while True:
        least = np.minimum(root, np.where(cosine >= 0.95, root[None], len(x)).min(1))
        if (least == root).all():
            break
        root = least
    same = sum(found[i].component_id == root[i] for i in range(len(x)))
    assert same >= 0.999 * len(x)
    assert all(r.kept == (r.component_id == i) for i, r in found.items())


def test_empty_table_and_unusable_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert vectors.near_vectors(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [float("inf"), 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [1.0]), (7, [2.0]), (7, [3.0])]
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(spark.createDataFrame(rows, schema)).collect()), key=repr)
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5)]
    assert found == sorted([*alone, (None, 0, None, True), (6, 2, 6, True), (7, 2, 6, False), (7, 2, 6, False)], key=repr)
