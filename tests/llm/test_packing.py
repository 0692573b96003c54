"""Packing against plain encoding; plans against their rules and a bound."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vigilframe.llm import packing

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, piece string, length string, block string, nth string, ids string, __n int, __before int"
TEXTS = [
    (1, "Plain words, it's MIXED\tcase\n\nand  more 12345 x́  nbsp  ﬁ"),
    (2, None), (3, ""), (4, " \n\t "), (5, "<|endoftext|> in<|startoftext|>side <|endoftext|>"), (6, "a\x01b \x01 \x00 \x1f x"),
    (7, "日本語のテキスト " * 50), (8, "long words " * 9000), (9, "x" * 30_000), (None, "no id"), (1, "same id"), (1, "same id"), (10, "Don't we'll I'm <|"),
]


def plain(texts):
    encoder = Tokenizer.from_file(PATH)
    out = []
    for doc, text in texts:
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out += [(doc, k // 2048, k, len(ids[k : k + 2048]), zlib.crc32(ids[k : k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    return sorted(out, key=repr)


def test_pieces_and_places(spark):
    df = spark.createDataFrame([(d, t, "x", "x", "x", "x", "x", 1, 1) for d, t in TEXTS], SCHEMA).repartition(3)
    pieces = packing.cut(df, PATH)
    rows = packing.placed(pieces).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == plain(TEXTS)
    place = {}
    for r in rows:
        place.setdefault(r.sequence_id, []).append((r.offset, r.length, r.ids_crc32))
    for used in place.values():
        used.sort()
        assert [o for o, _, _ in used] == np.cumsum([0] + [n for _, n, _ in used])[:-1].tolist()
        assert sum(n for _, n, _ in used) <= 2048
    assert len(place) == -(-sum(r.length for r in rows) // 2048)
    # The sequences themselves.
    for r in packing.sequences(pieces).collect():
        used, at = place[r.sequence_id], 0
        assert r.n_pieces == len(used) and r.length == sum(n for _, n, _ in used) == len(r.ids) // 4
        for _, n, crc in used:
            assert zlib.crc32(r.ids[4 * at : 4 * (at + n)]) == crc
            at += n


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    pieces = packing.cut(df, PATH)
    assert packing.placed(pieces).collect() == [] and packing.sequences(pieces).collect() == []


def test_cache_limits_change_nothing(monkeypatch):
    import pyarrow as pa

    texts = pa.array([t for _, t in TEXTS] * 3)
    ids, edges = packing.WordEncoder(PATH).encode(texts)
    monkeypatch.setattr(packing, "CACHED_WORDS", 1)
    small = packing.WordEncoder(PATH)
    for _ in range(2):
        again, same = small.encode(texts)
        assert (again == ids).all() and (same == edges).all()


@settings(max_examples=80, deadline=None)
@given(st.integers(4, 40), st.lists(st.tuples(st.integers(1, 40), st.integers(1, 30)), max_size=20))
def test_plan_holds_every_piece_once(size, pieces):
    counts = [0] * (size + 1)
    for n, k in pieces:
        counts[min(n, size)] += k
    made, used = packing.plan(counts), [0] * (size + 1)
    for times, pattern in made:
        assert times > 0 and sum(n * k for n, k in pattern.items()) <= size
        for n, k in pattern.items():
            used[n] += times * k
    assert used == counts
    total = sum(n * k for n, k in enumerate(counts))
    assert sum(t for t, _ in made) <= 11 / 9 * max(-(-total // size), sum(counts[size // 2 + 1 :])) + 2


@pytest.mark.parametrize("counts, sequences", [({10: 5}, 5), ({7: 4, 3: 4}, 4), ({5: 3, 4: 2, 1: 2}, 3), ({4: 2, 3: 4}, 2), ({}, 0)])
def test_exact_complements(counts, sequences):
    assert sum(t for t, _ in packing.plan([counts.get(n, 0) for n in range(11)])) == sequences


def test_many_pieces_make_few_patterns():
    counts = np.random.default_rng(0).integers(0, 10**9, 301)
    counts[0] = 0
    assert len(packing.plan(counts.tolist())) <= 3 * 300
