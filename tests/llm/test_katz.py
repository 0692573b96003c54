"""The language model against plain Python: figures, probabilities that add up to 1, cut histories."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vigilframe.llm import katz
from vigilframe.llm.ship import ship

SCHEMA = "doc_id long, text string, held boolean"


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.c = [Counter(), Counter(), Counter()]
        for text in texts:
            t = [*text.lower().split(), "</s>"]
            self.c[0].update((w,) for w in t)
            h = ["<s>", *t]
            self.c[1].update(zip(h, t))
            self.c[2].update(zip(h, t, t[1:]))
        self.of = Counter({("<s>",): len(texts)}) + self.c[0]
        self.n, self.v = sum(self.c[0].values()), len(self.c[0])
        self.d = [katz.discounts([sum(x == r for x in c.values()) for r in range(1, katz.LIMIT + 2)]) for c in self.c]
        self.after = defaultdict(list)
        for c in self.c[1:]:
            for g in c:
                self.after[g[:-1]].append(g[-1])

    def part(self, order, c):
        return (self.d[order][c] if c <= katz.LIMIT else 1.0) * c

    def p(self, h, w):
        if not h:
            if self.c[0][(w,)]:
                return self.part(0, self.c[0][(w,)]) / (self.n + 1)
            return 1 - sum(self.part(0, c) for c in self.c[0].values()) / (self.n + 1)
        before = self.of[h] if len(h) == 1 else self.c[1][h]
        if not before:
            return self.p(h[1:], w)
        seen = self.c[len(h)][(*h, w)]
        if seen:
            return self.part(len(h), seen) / (before + 1)
        left = 1 - sum(self.part(len(h), self.c[len(h)][(*h, x)]) for x in self.after[h]) / (before + 1)
        return left / (1 - sum(self.p(h[1:], x) for x in self.after[h])) * self.p(h[1:], w)

    def score(self, text):
        t = ["<s>", *(text or "").lower().split(), "</s>"]
        p = [self.p(tuple(t[max(0, i - 2) : i]), t[i]) for i in range(1, len(t))]
        base = [(self.c[0][(w,)] + 1) / (self.n + self.v + 1) for w in t[1:]]
        return len(p), sum(self.c[0][(w,)] > 0 for w in t[1:]), self.n, sum(map(math.log10, base)), sum(map(math.log10, p))


def made(n=300, seed=5):
    rng = random.Random(seed)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    rows = [(i, " ".join(word() for _ in range(rng.randrange(60))), rng.random() < 0.2) for i in range(n)]
    copy = rows[3][1]
    return [
        *rows, (n, copy, False), (n + 1, copy, True), (n + 2, None, False), (n + 3, "", True), (None, "A b\tw1\n w1 new new2", True), (3, "w1 w1 w1", False),
        (n + 4, " ".join(word() for _ in range(30_000)), True), (n + 5, "w1 w2 " * 400, False),
    ]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return spark.createDataFrame(made(), SCHEMA).repartition(5, "text").withColumn("block", F.lit("clashing")).withColumn("held_out", F.lit(1))


@pytest.mark.parametrize("limits", [{}, {"part_tokens": 2000, "hot_tokens": 40}])
def test_scores_equal_plain_ones(docs, limits):
    """Small limits cut frequent histories, of pairs and of triples, into many parts."""
    rows = made()
    model = Plain([t or "" for _, t, held in rows if not held])
    want = Counter()
    for i, text, held in rows:
        n, known, total, base, score = model.score(text)
        want[i, held, n, known, total, round(base, 6), round(score, 6)] += 1
    found = katz.score(docs, F.col("held"), **limits).collect()
    assert Counter((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in found) == want


def test_probabilities_add_up(docs):
    """The plain model that the figures are compared with: over all known words and all unknown ones together."""
    model = Plain([t or "" for _, t, held in made() if not held])
    words = [w for (w,) in model.c[0]]
    assert any(d < 1 for d in model.d[1][1:]) and any(d < 1 for d in model.d[2][1:])
    for h in [(), ("never",), ("<s>",), ("w1",), *random.Random(1).sample(sorted(model.c[1]), 40)]:
        if h[-1:] != ("</s>",):
            assert math.isclose(sum(model.p(h, w) for w in [*words, "unknown"]), 1, rel_tol=1e-9)


def test_empty_tables_and_no_training(spark):
    ship(spark)
    assert katz.score(spark.createDataFrame([], SCHEMA), F.col("held")).collect() == []
    rows = katz.score(spark.createDataFrame([(1, "a b", True), (2, None, True)], SCHEMA), F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [(1, 3, 0, 0, 0, 0), (2, 1, 0, 0, 0, 0)]


def test_blocks_are_not_moved(docs):
    """Only answers are shuffled: the blocks are read in their buckets."""
    plan = katz.score(docs, F.col("held"))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan


def test_order_of_words_counts(spark):
    """Learned sentences score above the same words in another order."""
    ship(spark)
    rng = random.Random(2)
    sentences = [" ".join(f"w{rng.randrange(60)}" for _ in range(8)) for _ in range(40)]
    texts = [" ".join(rng.choices(sentences, k=12)) for _ in range(200)]
    rows = [(i, t, i < 20) for i, t in enumerate(texts)]
    rows += [(1000 + i, " ".join(rng.sample(t.split(), len(t.split()))), True) for i, t in enumerate(texts[:20])]
    found = {r.doc_id: r.score for r in katz.score(spark.createDataFrame(rows, SCHEMA), F.col("held")).collect()}
    assert all(found[i] / 2 > found[1000 + i] for i in range(20))
