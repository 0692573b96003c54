"""Katz backoff language model of words: Good-Turing discounts, exactly normalised backoff weights.

Texts are turned once into blocks of word numbers, stored in buckets by block, so that they never
move again.  A block asks for the counts of its distinct words, then of its distinct pairs, then of
its distinct triples; each order is counted in tables partitioned by hash of the history, and only
the answers, in the order of the question, go back to the block.  So a token that occurs a thousand
times in a block is asked for once, and no count of the corpus is held in one place.  Words are
numbered by their counts within each part: frequent ones have small numbers, which take few bytes.

P(w | h), recursively, with counts c of the training texts and k = ``LIMIT``:
  h seen, w seen after it:  d(c(h w)) c(h w) / (c(h) + 1), d by Good-Turing of that order for counts
                            up to k, else 1;
  h seen, w not after it:   a(h) P(w | h without its first word);
  h never seen:             P(w | h without its first word);
  no history:               d(c(w)) c(w) / (N + 1), and what that leaves for all unknown words together.
a(h) is what seen words leave, over what the shorter history leaves to words not seen after h: exact
integer sums over all words, so probabilities add up to 1.  The 1 in the denominators leaves some
mass even where every count is above k.  The first word's history is the beginning of the text, a
word that is never predicted; the second's is the beginning and the first.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilframe.llm.text import hashed, mixed, slices, sums, words
from vigilframe.operators.lineage import landed, release, scratch_path

LIMIT = 5
BEGIN, END, UNKNOWN, FIRST = 0, 1, 2, 3
PART_TOKENS = 1_000_000
HOT_TOKENS = 2_000_000
BLOCK_BYTES = 4 << 20
#: Sums per history: how many words follow it 1..k times, counts above; the same of the words' counts one order below.
N_SUMS = 2 * (LIMIT + 1)


def _pack(x: np.ndarray) -> bytes:
    """Integers by planes of bytes, compressed: small numbers take little."""
    return zstandard.compress(np.ascontiguousarray(np.asarray(x).astype("<u8").view(np.uint8).reshape(-1, 8).T), 1)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def _joined(packed: list[bytes]) -> np.ndarray:
    return np.concatenate([_unpack(x) for x in packed]) if packed else np.empty(0, np.int64)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _cut(batches):
    """Per slice of texts: ids, held-out flags, words per text, word numbers (frequent first) and the words' hashes."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in slices(batches, 1, BLOCK_BYTES):
        made = words(batch.column(1))
        used = np.bincount(made.codes, minlength=len(made.vocabulary))
        order = np.argsort(-used, kind="stable")[: np.count_nonzero(used)]
        rank = np.empty(len(used), np.int64)
        rank[order] = np.arange(len(order))
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part << 32 | n], pa.int64()), pa.array([batch.column(0)], pa.list_(batch.column(0).type)), pa.array([held.tobytes()], pa.binary()),
                pa.array([made.counts.astype("<i4").tobytes()], pa.binary()), pa.array([_pack(rank[made.codes])], pa.binary()),
                pa.array([hashed(made.vocabulary)[order].tobytes()], pa.binary()), pa.array([len(made.codes) + batch.num_rows], pa.int64()),
                pa.array([int((held == 0).sum())], pa.int64()),
            ],
            names=["block", "ids", "held", "counts", "codes", "hashes", "tokens", "trained"],
        )
        n += 1


def _in_buckets(df: DataFrame, buckets: int, path: str) -> DataFrame:
    """Lands a table in buckets by block: grouping it by block needs no shuffle.  Its name goes at once, the files stay."""
    spark, name = df.sparkSession, f"blocks_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, "block").sortBy("block").option("path", path).saveAsTable(name, format="parquet")
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: batch.column(k)[i].as_py() for k in batch.schema.names}


def _row_of(table: pa.Table) -> dict:
    return {k: table.column(k)[0].as_py() for k in table.column_names}


def _table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


# ---- words ----------------------------------------------------------------------------------

WORD_ASK = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("seen", pa.binary())])
WORD_TELL = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("number", pa.binary()), ("count", pa.binary()), ("of_counts", pa.list_(pa.int64()))])


def _word_order(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    part = (mixed(hashes) % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((hashes, part))
    return order, part[order]


def _ask_words(parts: int):
    def ask(batches):
        for row in _rows(batches):
            hashes, code = np.frombuffer(row["hashes"], np.uint64), _unpack(row["codes"])
            train = np.repeat(np.frombuffer(row["held"], np.uint8) == 0, np.frombuffer(row["counts"], "<i4"))
            order, part = _word_order(hashes, parts)
            seen = np.bincount(code[train], minlength=len(hashes))[order]
            edges = np.append(_starts(part), len(part))
            asked = [
                {"part": int(part[a]), "block": row["block"], "keys": hashes[order[a:b]].tobytes(), "seen": _pack(seen[a:b])}
                for a, b in zip(edges[:-1], edges[1:], strict=True)
            ]
            yield from _table(asked, WORD_ASK).to_batches()

    return ask


def _count_words(parts: int):
    def count(key, asked):
        """Adds up one part of the word counts and numbers its words; answers every question in its order."""
        keys = [np.frombuffer(x, np.uint64) for x in asked.column("keys").to_pylist()]
        word, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=_joined(asked.column("seen").to_pylist()), minlength=len(word)).astype(np.int64)
        rank = np.empty(len(word), np.int64)
        rank[np.lexsort((word, -total))] = np.arange(len(word))
        part = key[0].as_py()
        number = np.where(total > 0, FIRST + rank * parts + part, UNKNOWN)
        edges = np.cumsum([len(k) for k in keys])[:-1]
        told = [
            {"block": b, "part": part, "number": _pack(x), "count": _pack(c)}
            for b, x, c in zip(asked.column("block").to_pylist(), np.split(number[at], edges), np.split(total[at], edges), strict=True)
        ]
        of = [int((total == r).sum()) for r in range(1, LIMIT + 2)]
        told.append({"part": part, "of_counts": [*of, int(total.sum()), int((total > 0).sum())]})
        return _table(told, WORD_TELL)

    return count


def _numbered(parts: int, begins: int, schema: pa.Schema):
    def number(key, stored, told):
        """A block whose words have their numbers and counts instead of hashes."""
        row = stored.to_pylist()[0]
        order, _ = _word_order(np.frombuffer(row.pop("hashes"), np.uint64), parts)
        by = sorted(zip(told.column("part").to_pylist(), told.column("number").to_pylist(), told.column("count").to_pylist(), strict=True))
        for name, at, more in (("number", 1, [BEGIN, END]), ("count", 2, [begins, begins])):
            values = np.empty(len(order), np.int64)
            values[order] = _joined([x[at] for x in by])
            row[name] = _pack(np.concatenate([values, more]))
        return _table([row], schema)

    return number


# ---- pairs and triples ----------------------------------------------------------------------


class Block:
    """A block's tokens: local words 0..n-3, then the beginning (n-2) and the end (n-1) of texts."""

    def __init__(self, row: dict):
        self.number, self.count = _unpack(row["number"]), _unpack(row["count"])
        n, code, counts = len(self.number), _unpack(row["codes"]), np.frombuffer(row["counts"], "<i4").astype(np.int64)
        edges = np.concatenate([[0], np.cumsum(counts + 1)])
        self.word = np.full(edges[-1], n - 1)
        inner = np.ones(edges[-1], bool)
        inner[edges[1:] - 1] = False
        self.word[inner] = code
        self.first = np.zeros(edges[-1], bool)
        self.first[edges[:-1]] = True
        self.bounds, self.n = edges, n
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.train = ~np.repeat(self.held, counts + 1)


class Level:
    """A block's distinct n-grams of one order, in order of part, history and word.

    ``token`` is the n-gram of each token, -1 where its history was never seen; ``a`` and ``b`` are
    the history's numbers and ``before`` its count, ``below`` that of the word one order lower.
    """

    def __init__(self, own: Block, inside: np.ndarray, history: np.ndarray, a, b, before, below, parts: int, hot: int):
        at, gram = pd.factorize(history[inside] * own.n + own.word[inside])
        some = np.empty(len(gram), np.int64)
        some[at] = np.flatnonzero(inside)
        # Histories and words in the order of the block's own numbers: frequent ones first.
        by = np.argsort(gram)
        some, rank = some[by], np.empty(len(gram), np.int64)
        rank[by] = np.arange(len(gram))
        w, local, before = own.number[own.word[some]], own.word[some], before[some]
        cuts = 1 + before // hot
        key = mixed(a[some].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mixed(b[some].astype(np.uint64) + np.uint64(1)))
        salt = np.where(cuts > 1, mixed(w.astype(np.uint64)) % cuts.astype(np.uint64), np.uint64(0))
        part = mixed(key + salt) % np.uint64(parts)
        order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint64), kind="stable")
        some = some[order]
        self.a, self.b, self.w, self.below, self.history = a[some], b[some], w[order], below[some], history[some]
        self.before, self.local, self.part, self.cut = before[order], local[order], part[order].astype(np.int64), cuts[order] > 1
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.token = np.full(len(own.word), -1)
        self.token[inside] = place[rank[at]]
        #: Each n-gram's place in the order of history and word.
        self.rank = order
        self.seen = np.bincount(self.token[inside & own.train], minlength=len(gram))
        self.starts = _starts(self.part, self.history)


def pairs_of(own: Block, parts: int, hot: int) -> Level:
    history = np.concatenate([[0], own.word[:-1]])
    history[own.first] = own.n - 2
    number = own.number[history]
    return Level(own, own.count[history] > 0, history, np.zeros_like(number), number, own.count[history], own.count[own.word], parts, hot)


def triples_of(own: Block, pairs: Level, counts: np.ndarray, parts: int, hot: int) -> Level:
    """``counts`` are those of the pairs; a text's first token has no triple."""
    of = np.append(counts, 0)
    last = np.concatenate([[-1], pairs.token[:-1]])
    inside = ~own.first & (of[last] > 0)
    numbers = lambda x: np.append(x, 0)[last]
    return Level(own, inside, numbers(pairs.rank), numbers(pairs.b), numbers(pairs.w), of[last], of[pairs.token], parts, hot)


ASK = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((k, pa.binary()) for k in ("a", "b", "runs", "w", "below", "seen", "cut"))])
ASK_SQL = "part int, block long, a binary, b binary, runs binary, w binary, below binary, seen binary, cut binary"
TELL = pa.schema(
    [("kind", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("answer", pa.binary()), ("left", pa.binary()),
     ("a", pa.int64()), ("b", pa.int64()), ("sums", pa.list_(pa.int64()))]
)
TELL_SQL = "kind int, block long, part int, answer binary, left binary, a long, b long, sums array<long>"


def _question(block: int, level: Level) -> pa.Table:
    """One row per part: histories, how many words each has, words, and their counts here."""
    asked = []
    edges = np.append(_starts(level.part), len(level.part))
    below = np.where(level.seen > 0, level.below, 0)
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        runs = level.starts[np.searchsorted(level.starts, s) : np.searchsorted(level.starts, e)]
        asked.append(
            {
                "part": int(level.part[s]), "block": block, "a": _pack(level.a[runs]), "b": _pack(level.b[runs]), "runs": _pack(np.diff(np.append(runs, e))),
                "w": _pack(level.w[s:e]), "below": _pack(below[s:e]), "seen": _pack(level.seen[s:e]), "cut": _pack(level.cut[runs]),
            }
        )
    return _table(asked, ASK)


def _classes(x: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per owner: how many counts are 1..k, and the sum of those above."""
    low = x <= LIMIT
    few = np.bincount(owner[low] * LIMIT + x[low] - 1, minlength=n * LIMIT).reshape(n, LIMIT)
    above = np.bincount(owner[~low], weights=x[~low], minlength=n).astype(np.int64)
    return np.concatenate([few, above[:, None]], axis=1)


def _dense(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Pairs of numbers from 0 as one number each, in the same order."""
    if len(x) and (int(x.max()) + 1) * (int(y.max()) + 1) >= 1 << 63:
        x, y = (np.unique(z, return_inverse=True)[1] for z in (x, y))
    return x * (y.max(initial=0) + 1) + y


def _count(key, asked):
    """Adds up one part of an order's counts.

    Kind 0 answers a block; 1 has this part's sums of a history that is cut into parts, 5 says that a
    block needs them; 2 has counts of counts.
    """
    lists = {k: [_unpack(x) for x in asked.column(k).to_pylist()] for k in ("a", "b", "runs", "cut")}
    runs, a, b = (np.concatenate(lists[k]) for k in ("runs", "a", "b"))
    histories, some, history = np.unique(_dense(a, b), return_index=True, return_inverse=True)
    w, below, seen = (_joined(asked.column(k).to_pylist()) for k in ("w", "below", "seen"))
    grams = _dense(np.repeat(history, runs), w)
    order = np.argsort(grams)
    first = _starts(grams[order])
    gram = np.empty(len(order), np.int64)
    gram[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    count, under = np.add.reduceat(seen[order], first), np.maximum.reduceat(below[order], first)
    owner, inside, n = np.repeat(history, runs)[order][first], count > 0, len(histories)
    by = np.concatenate([_classes(x[inside], owner[inside], n) for x in (count, under)], axis=1)
    del order, grams
    part = key[0].as_py()
    out, cut_at, edge, run = [], set(), 0, 0
    for i, block in enumerate(asked.column("block").to_pylist()):
        n = lists["runs"][i]
        mine, at = count[gram[edge : edge + n.sum()]], np.cumsum(n) - n
        whose = history[run : run + len(n)]
        edge, run = edge + int(n.sum()), run + len(n)
        # Only histories with a word never seen after them need their sums.
        lacks = np.add.reduceat((mine == 0).astype(np.int64), at) > 0
        out.append({"kind": 0, "block": block, "part": part, "answer": _pack(mine), "left": _pack(by[whose[lacks]].T.ravel())})
        for h in whose[lists["cut"][i] > 0].tolist():
            cut_at.add(h)
            out.append({"kind": 5, "block": block, "part": part, "a": int(a[some[h]]), "b": int(b[some[h]])})
    out += [{"kind": 1, "part": part, "a": int(a[some[h]]), "b": int(b[some[h]]), "sums": by[h].tolist()} for h in cut_at]
    out.append({"kind": 2, "part": part, "sums": [int((count == r).sum()) for r in range(1, LIMIT + 2)]})
    return _table(out, TELL)


def discounts(n: list[int]) -> np.ndarray:
    """d(r) for r = 0..k from counts of counts n_1..n_(k+1); 1 where Good-Turing's estimate isn't below 1, or there is none."""
    d = np.ones(LIMIT + 1)
    if n[0] > 0:
        rest = (LIMIT + 1) * n[LIMIT] / n[0]
        for r in range(1, LIMIT + 1):
            if n[r - 1] > 0 and rest < 1:
                value = ((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest)
                d[r] = value if 0 < value < 1 else 1.0
    return d


def _told(asked: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Answers to a question (kind 0, and 1 for histories in several parts), and the order's discounts."""
    told = landed(asked.groupBy("part").applyInArrow(_count, TELL_SQL))
    of = told.where("kind = 2").select([F.sum(F.col("sums")[r]) for r in range(LIMIT + 1)]).first()
    whole = told.where("kind = 1").groupBy("a", "b").agg(F.array(*[F.sum(F.col("sums")[r]) for r in range(N_SUMS)]).alias("sums"))
    need = told.where("kind = 5").select("block", "a", "b").distinct().join(whole, ["a", "b"])
    cut = need.select(F.lit(1).alias("kind"), "block", F.lit(0).alias("part"), F.lit(None).cast("binary").alias("answer"), F.lit(None).cast("binary").alias("left"), "a", "b", "sums")
    return told.where("kind = 0").unionByName(cut), discounts([x or 0 for x in of])


def _counts(told: pa.Table) -> np.ndarray:
    """Counts of a level's n-grams, from its answers."""
    plain = told.filter(pc.equal(told.column("kind"), 0))
    return _joined([x for _, x in sorted(zip(plain.column("part").to_pylist(), plain.column("answer").to_pylist(), strict=True))])


def _lacking(level: Level, counts: np.ndarray, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The runs of histories that some word asked for was never seen after, and their sums."""
    plain = told.filter(pc.equal(told.column("kind"), 0))
    left = [x for _, x in sorted(zip(plain.column("part").to_pylist(), plain.column("left").to_pylist(), strict=True))]
    if not left:
        return np.empty(0, np.int64), np.empty((0, N_SUMS), np.int64)
    lacks = np.flatnonzero(np.add.reduceat((counts == 0).astype(np.int64), level.starts) > 0)
    values = np.concatenate([_unpack(x).reshape(N_SUMS, -1) for x in left], axis=1).T
    cut = told.filter(pc.equal(told.column("kind"), 1))
    whole = {(x, y): z for x, y, z in zip(*(cut.column(k).to_pylist() for k in ("a", "b", "sums")), strict=True)}
    at = level.starts[lacks]
    for i in np.flatnonzero(level.cut[at]):
        values[i] = whole[int(level.a[at[i]]), int(level.b[at[i]])]
    return lacks, values


def _used(sums_: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts in all, from classes of counts."""
    return (sums_[:, :LIMIT] * (np.arange(1, LIMIT + 1) * d[1:])).sum(1) + sums_[:, LIMIT]


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= LIMIT, d[np.minimum(c, LIMIT)], 1.0) * c


def _probability(level: Level, told: pa.Table, counts, d, lower, d_lower, size_lower) -> np.ndarray:
    """P of each n-gram; ``lower`` is that of its word after the shorter history, whose counts add up to ``size_lower`` - 1."""
    runs, values = _lacking(level, counts, told)
    at = level.starts[runs]
    size, below = level.before[at] + 1.0, size_lower[at]
    left = (size - _used(values[:, : LIMIT + 1], d)) / size
    backoff = np.ones(len(level.starts))
    backoff[runs] = left / ((below - _used(values[:, LIMIT + 1 :], d_lower)) / below)
    backoff = np.repeat(backoff, np.diff(np.append(level.starts, len(counts))))
    return np.where(counts > 0, _discounted(counts, d) / (level.before + 1.0), backoff * lower)


def score(docs: DataFrame, held_out: Column, part_tokens: int = PART_TOKENS, hot_tokens: int = HOT_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) for each row of ``docs``.

    The model learns from the rows that ``held_out`` is not true for, and scores all.  A-Z are
    lower-cased; a text's tokens are its words and one end.  Null and empty texts are an end
    alone.  Rows with a null or repeated doc_id are separate texts.  Without training rows every
    token has probability 1.  Other columns are ignored.  A part of a table counts about
    ``part_tokens``; a history of more than ``hot_tokens`` is cut by word into several parts.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held"))
    schema = f"block long, ids array<{kind}>, held binary, counts binary, codes binary, hashes binary, tokens long, trained long"
    cut = rows.mapInArrow(_cut, schema)
    # Fewer buckets than shuffle partitions would be shuffled once more.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    early = [scratch_path(spark, "blocks"), scratch_path(spark, "words")]
    blocks = _in_buckets(cut, buckets, early[0])
    tokens, begins = (x or 0 for x in blocks.agg(F.sum("tokens"), F.sum("trained")).first())
    parts = max(12, -(-tokens // part_tokens))

    asked = blocks.select("block", "held", "counts", "codes", "hashes").mapInArrow(_ask_words(parts), "part int, block long, keys binary, seen binary")
    told = landed(asked.groupBy("part").applyInArrow(_count_words(parts), "block long, part int, number binary, count binary, of_counts array<long>"), early[1])
    of = told.where("block IS NULL").select([F.sum(F.col("of_counts")[r]) for r in range(LIMIT + 3)]).first()
    *of, total, vocabulary = (int(x or 0) for x in of)
    total += begins
    vocabulary += begins > 0
    if 0 < begins <= LIMIT + 1:
        of[begins - 1] += 1
    d1 = discounts(of)
    unknown = 1 + sum(r * of[r - 1] * (1 - d1[r]) for r in range(1, LIMIT + 1))

    ids_type = pa.list_(cut_type(docs))
    numbered_schema = pa.schema([("block", pa.int64()), ("ids", ids_type), *((k, pa.binary()) for k in ("held", "counts", "codes", "number", "count"))])
    answers = told.where("block IS NOT NULL").drop("of_counts")
    numbered = blocks.drop("tokens", "trained").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _numbered(parts, begins, numbered_schema), f"block long, ids array<{kind}>, held binary, counts binary, codes binary, number binary, count binary"
    )
    numbered = _in_buckets(numbered, buckets, scratch_path(spark, "numbered"))
    release(spark, early)
    slim = numbered.drop("ids")

    def ask_pairs(batches):
        for row in _rows(batches):
            yield from _question(row["block"], pairs_of(Block(row), parts, hot_tokens)).to_batches()

    pair_told, d2 = _told(slim.mapInArrow(ask_pairs, ASK_SQL))

    def ask_triples(key, stored, told):
        row = _row_of(stored)
        own = Block(row)
        pairs = pairs_of(own, parts, hot_tokens)
        return _question(row["block"], triples_of(own, pairs, _counts(told), parts, hot_tokens))

    triple_told, d3 = _told(slim.groupBy("block").cogroup(pair_told.where("kind = 0").groupBy("block")).applyInArrow(ask_triples, ASK_SQL))

    def evaluate(key, stored, told):
        own = Block(_row_of(stored.drop_columns(["ids"])))
        of = lambda order: told.filter(pc.equal(told.column("order"), order))
        size = total + 1.0
        base = (own.count + 1) / (total + vocabulary + 1.0)
        known = own.count > 0
        single = np.where(known, _discounted(own.count, d1), unknown) / size
        pairs = pairs_of(own, parts, hot_tokens)
        counts = _counts(of(2))
        p2 = _probability(pairs, of(2), counts, d2, single[pairs.local], d1, np.full(len(counts), size))
        p = np.where(pairs.token >= 0, np.append(p2, 0)[pairs.token], single[own.word])
        triples = triples_of(own, pairs, counts, parts, hot_tokens)
        inside = triples.token >= 0
        lower, after = np.empty(len(triples.w)), np.empty(len(triples.w))
        lower[triples.token[inside]] = p[inside]
        after[triples.token[inside]] = pairs.before[pairs.token[inside]]
        p3 = _probability(triples, of(3), _counts(of(3)), d3, lower, d2, after + 1.0)
        p[inside] = p3[triples.token[inside]]
        return pa.table(
            {
                "doc_id": stored.column("ids").combine_chunks().flatten(), "held_out": pa.array(own.held), "n_tokens": pa.array(np.diff(own.bounds)),
                "n_known": pa.array(sums(known[own.word].astype(float), own.bounds).astype(np.int64)), "train_tokens": pa.array(np.full(len(own.held), total, np.int64)),
                "base_score": pa.array(sums(np.log10(base)[own.word], own.bounds)), "score": pa.array(sums(np.log10(p), own.bounds)),
            }
        )

    both = pair_told.withColumn("order", F.lit(2)).unionByName(triple_told.withColumn("order", F.lit(3)))
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return numbered.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(evaluate, schema)


def cut_type(docs: DataFrame) -> pa.DataType:
    """The Arrow type of doc_id."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)
