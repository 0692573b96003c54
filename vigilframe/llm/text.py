"""Words, hashes and subword pieces of whole columns of text: Arrow kernels and numpy, no loop over words.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  A null text is an empty one.  Batches are cut so that a
task holds a bounded amount of text at a time, however large Spark's record batches are; a single
text is never cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """The words of several texts: ``vocabulary[codes[bounds[i]:bounds[i + 1]]]`` are those of text i."""

    codes: np.ndarray
    bounds: np.ndarray
    vocabulary: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def documents(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        edges = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def words(texts: pa.Array, lower: str | None = "ascii") -> Words:
    texts = pc.fill_null(texts, "")
    if lower == "ascii":
        texts = pc.ascii_lower(texts)
    elif lower == "unicode":
        texts = pc.utf8_lower(texts)
    pieces = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pieces.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    # Texts that begin or end with white space have an empty first or last piece.
    empty = pc.index(coded.dictionary, "").as_py()
    bounds = np.concatenate([[0], np.cumsum(counts)])
    if empty >= 0:
        kept = codes != empty
        bounds = np.concatenate([[0], np.cumsum(kept)])[bounds]
        codes = codes[kept]
    return Words(codes, bounds, coded.dictionary)


def hashed(values: pa.Array) -> np.ndarray:
    """64-bit hashes of strings (SipHash with a fixed key: equal in every task)."""
    if not len(values):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(values.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mixed(x ^ np.uint64((seed + 1) * int(_ODD) & 0xFFFFFFFFFFFFFFFF))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words in each text, and their bounds.

    A text of fewer than n words, but at least one, has one shingle of all its words.
    """
    counts = np.diff(bounds)
    made = np.where(counts == 0, 0, np.maximum(counts - n + 1, 1))
    edges = np.concatenate([[0], np.cumsum(made)])
    start = np.repeat(bounds[:-1] - edges[:-1], made) + np.arange(edges[-1])
    length = np.minimum(np.repeat(counts, made), n)
    out = np.zeros(edges[-1], np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    for k in range(n):
        step = mixed(out * _ODD + padded[start + k])
        out = step if n == 1 else np.where(k < length, step, out)
    return out, edges


def codepoints(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All characters of ``<value>`` for each value, and the bounds."""
    listed = values.to_pylist()
    chars = np.frombuffer("".join([f"<{x}>" for x in listed]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64) + 2 if listed else np.empty(0, int)
    return chars.astype(np.uint64), np.concatenate([[0], np.cumsum(lengths)])


def grams(chars: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n characters within each value, and the value each belongs to."""
    lengths = np.maximum(np.diff(bounds) - n + 1, 0)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    edges = np.concatenate([[0], np.cumsum(lengths)])
    start = np.repeat(bounds[:-1] - edges[:-1], lengths) + np.arange(edges[-1])
    out = np.full(len(start), np.uint64(n), np.uint64)
    for k in range(n):
        out = out * np.uint64(0x100000001B3) + chars[start + k]
    return mixed(out), owner


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each run ``values[bounds[i]:bounds[i + 1]]``, 0 for an empty one."""
    zero = np.zeros((1, *values.shape[1:]), np.float64)
    total = np.concatenate([zero, np.cumsum(values, axis=0, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def crc(data: bytes) -> int:
    return zlib.crc32(data)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    mark = "_"
    while any(f"{mark}{n}" in taken for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]
