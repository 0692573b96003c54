"""Alignment against a plain merge of whole-text encodings."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from vigilframe.llm import alignment

A, B = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, block string, pair string, n_docs string, best string, n_a string, __a int"
TEXTS = [
    (1, "Unbelievable tokenization differs, doesn't it?"), (2, None), (3, ""), (4, " "), (5, "a  b   c\n\n d\t\te \r\n"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (7, "▁ replaced ▁ spaces"), (8, "日本語 Ελληνικά русский 🙂🙃 é"), (9, "word " * 4000), (10, "x" * 5000), (11, "=" * 300 + " " + " " * 300 + "z"),
    (12, " nbsp   em　ideographic \x1f sep"), (None, "no id"), (1, "same id"), (1, "same id"), (13, "the cat the cat"), (14, "NUL \x00 here"), (15, "trailing space "),
]


@pytest.fixture(scope="module")
def plain():
    a_made, b_made = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_made.encode_special_tokens = True
    pair = alignment.Pair(A, B).load()

    def one(text):
        """The groups of a text."""
        if not text:
            return []
        a, b, wanted = a_made.encode(" " + text, add_special_tokens=False).ids, b_made.encode(text), (" " + text).encode()
        if not b"".join(pair.a_bytes[x] for x in a) == wanted == b"".join(pair.b_bytes[x] for x in b):
            return []
        ends = [np.cumsum([len(t[x]) for x in ids]).tolist() for t, ids in ((pair.a_bytes, a), (pair.b_bytes, b))]
        common, out, i, j = sorted(set(ends[0]) & set(ends[1])), [], 0, 0
        for end in common:
            k, m = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            out.append((a[i:k], b[j:m]))
            i, j = k, m
        return out

    return one


def expected(texts, plain):
    made = [(d, plain(t)) for d, t in texts]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in made]
    docs = Counter(p for c in links for p in c)
    most = {}
    for (x, _), n in docs.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (d, g), c in zip(made, links):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        sha = hashlib.sha256(written.encode()).hexdigest() if g else ""
        best = sum(n for p, n in c.items() if docs[p] == most[p[0]])
        out.append((d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()), best, sum(n * docs[p] for p, n in c.items()), sha))
    return sorted(out, key=repr), docs, most, [written_of(g) for _, g in made]


def written_of(g):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)


def test_equal_to_a_plain_merge(spark, plain):
    df = spark.createDataFrame([(d, t, "x", "x", "x", "x", "x", 1) for d, t in TEXTS], SCHEMA).repartition(3)
    made = alignment.align(df, A, B)
    rows, docs, most, written = expected(TEXTS, plain)
    assert sorted((tuple(r) for r in made.documents().collect()), key=repr) == rows
    # The table of id pairs.
    assert {(r.a, r.b): (r.n_docs, r.best) for r in made.pairs.collect()} == {p: (n, n == most[p[0]]) for p, n in docs.items()}
    assert sorted(r.groups for r in alignment.written_groups(df, A, B).collect()) == sorted(written)
    # Some texts have no tokens, others have groups of several.
    zero = [r for r in rows if r[3] == 0]
    assert 3 <= len(zero) < len(rows) and any(r[4] > r[1] for r in rows)


def test_empty_table(spark):
    made = alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert made.documents().collect() == [] and made.pairs.collect() == []


def test_whole_texts_give_the_same(plain):
    import pyarrow as pa

    texts = pa.array([t for _, t in TEXTS])
    by_units, whole = alignment.Pair(A, B).load(), alignment.Pair(A, B).load()
    whole.by_units = False
    one, other = by_units.encode(texts), whole.encode(texts)
    assert all((x == y).all() for x, y in zip(vars(one).values(), vars(other).values()))


def test_wide_groups_by_distinct_ids(monkeypatch):
    import pyarrow as pa

    pair = alignment.Pair(A, B).load()
    made = alignment.Aligned.of(pair.encode(pa.array([t for _, t in TEXTS])), pair)
    narrow = made.pairs(len(pair.b_bytes))
    monkeypatch.setattr(alignment, "WIDE", 1)
    assert all((x == y).all() for x, y in zip(narrow, made.pairs(len(pair.b_bytes))))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.lists(st.integers(1, 4), max_size=60), st.integers(1, 9))
def test_pieces_of_any_size_merge_alike(a, b, piece):
    total = max(sum(a), sum(b))
    if not a or not b:
        return
    a, b = np.cumsum(a), np.cumsum(b)
    a, b = np.unique(np.append(a[a < total], total)), np.unique(np.append(b[b < total], total))
    found = alignment.overlaps(a, b, piece)
    starts_a, starts_b = np.concatenate([[0], a[:-1]]), np.concatenate([[0], b[:-1]])
    pairs = [(i, j) for i in range(len(a)) for j in range(len(b)) if min(a[i], b[j]) > max(starts_a[i], starts_b[j])]
    assert sorted(zip(found.a.tolist(), found.b.tolist())) == pairs
    of_a, of_b = alignment.groups(found, len(a), len(b))
    common = np.intersect1d(a, b)
    assert (of_a == np.searchsorted(common, a)).all() and (of_b == np.searchsorted(common, b)).all()


def test_pieces_do_equal_work():
    rng = np.random.default_rng(2)
    a, b = np.cumsum(rng.integers(1, 3, 1000)), np.cumsum(rng.integers(1, 9, 300))
    i, j = alignment.diagonals(a, b, 64)
    assert (i + j == np.arange(0, 1300, 64)).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
    merged = np.sort(np.concatenate([a, b]))
    assert all(sorted([*a[:x], *b[:y]]) == merged[: x + y].tolist() for x, y in zip(i, j))
