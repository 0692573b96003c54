"""Token ids in binary shards, with a minimal perfect hash index from document keys to places.

Documents are dealt to shards by ranges of doc_id, in order.  A task writes one shard: ``.bin``
holds raw ids and nothing else, ``.idx`` the keys in order, where each document's ids begin, and
the index.  Tasks write under a name of their own and rename, so a lost or repeated task leaves
one whole file.

The index maps a key to a number below the number of keys without storing keys: at each level,
keys that share no bit with another key set one; the rest go to the next level; a key's number is
the rank of its bit.  A 32-bit fingerprint kept at that number tells strangers, but for one in
four thousand million.  A lookup reads one bit per level, one fingerprint and one place.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigilframe.llm.text import crc, seeded, slices
from vigilframe.operators.lineage import landed, scratch_path

END_ID = 0
#: Units whose ids a task keeps (some 250 bytes each).
CACHED_UNITS = 600_000
MAGIC = b"VFTOK001"
#: A unit between single spaces that has white space only inside, and only line feeds, encodes alone as in its text.
_PLAIN = r"^[^\x00-\x20\x7f-\x{a0}\p{Z}](?:[^\x00-\x09\x0b-\x20\x7f-\x{a0}\p{Z}]*[^\x00-\x20\x7f-\x{a0}\p{Z}])?$"
_MARK = "\r"


# --- encoding ---

_encoders: dict[tuple[str, bool], Encoder] = {}


@dataclass
class Encoder:
    """A tokenizer file.  ``by_units`` says that it never joins what a single space divides (byte-level BPE).

    Distinct units of a batch are then encoded once each; texts with other white space, control
    characters or special tokens are encoded whole.
    """

    path: str
    by_units: bool = True
    _made: object = field(default=None, repr=False)

    def tokenizer(self):
        if self._made is None:
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._made = Tokenizer.from_file(self.path)
            self._special = [t.content for t in self._made.get_added_tokens_decoder().values()]
            self._known, self._ids, self._starts = {}, np.empty(0, np.uint32), np.zeros(1, np.int64)
            self._mark = self._made.encode(_MARK, add_special_tokens=False).ids
        return self._made

    def __getstate__(self):
        return {"path": self.path, "by_units": self.by_units, "_made": None}

    @staticmethod
    def of_worker(path: str, by_units: bool) -> Encoder:
        """One encoder, and so one cache, for all tasks of a Python worker."""
        if (path, by_units) not in _encoders:
            _encoders.clear()
            _encoders[path, by_units] = Encoder(path, by_units)
        return _encoders[path, by_units]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        made = self.tokenizer().encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in made]

    def _units(self, units: list[str], prefix: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each of several plain units behind ``prefix``, from the cache if they are in it."""
        wanted = [prefix + u for u in units]
        at = [self._known.get(u, -1) for u in wanted]
        new = [u for u, i in zip(wanted, at, strict=True) if i < 0]
        ids, bounds = self._joined(new)
        at = np.array(at, np.int64)
        room = CACHED_UNITS - len(self._known)
        start = np.concatenate([self._starts, bounds[1:] + self._starts[-1]])
        flat = np.concatenate([self._ids, ids])
        at[at < 0] = np.arange(len(self._starts) - 1, len(start) - 1)
        if new and room > 0:
            keep = min(room, len(new))
            self._known.update(zip(new[:keep], range(len(self._starts) - 1, len(self._starts) - 1 + keep), strict=True))
            self._starts = start[: len(self._starts) + keep].copy()
            self._ids = flat[: self._starts[-1]].astype(np.uint32)
        length = np.diff(start)[at]
        edges = np.concatenate([[0], np.cumsum(length)])
        return flat[np.arange(edges[-1]) + np.repeat(start[at] - edges[:-1], length)], edges

    def _joined(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many units a call, told apart by a mark behind each."""
        flat = [np.empty(0, np.uint32)]
        for a in range(0, len(units), 500):
            joined = _MARK.join(units[a : a + 500]) + _MARK
            flat.append(np.array(self.tokenizer().encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32))
        ids = np.concatenate(flat)
        ends = np.flatnonzero(ids == self._mark[0])
        return np.delete(ids, ends), np.concatenate([[0], ends - np.arange(len(ends))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts in a row, each text's end id included, and the bounds."""
        texts = pc.fill_null(texts, "")
        self.tokenizer()
        n = len(texts)
        if not self.by_units or len(self._mark) != 1:
            return _row(self.whole(texts.to_pylist()))
        pieces = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        coded = pieces.flatten().dictionary_encode()
        codes, units = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
        plain = pc.match_substring_regex(units, _PLAIN).to_numpy(zero_copy_only=False)
        for special in self._special:
            plain &= ~pc.match_substring(units, special).to_numpy(zero_copy_only=False)
        odd = np.zeros(n, bool)
        odd[np.repeat(np.arange(n), counts)[~plain[codes]]] = True
        kept = ~np.repeat(odd, counts)
        first = np.zeros(len(codes), bool)
        first[bounds[:-1]] = True
        # First units stand without a space; they are numbered behind the others.
        slot = np.empty(len(codes), np.int32)
        ids, starts = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)]
        done, total = 0, 0
        for mine, prefix in ((kept & ~first, " "), (kept & first, "")):
            used = np.zeros(len(units), bool)
            used[codes[mine]] = True
            number = np.cumsum(used, dtype=np.int32) + (done - 1)
            slot[mine] = number[codes[mine]]
            some, edges = self._units(units.filter(pa.array(used)).to_pylist(), prefix)
            starts.append(edges[1:] + total)
            total += int(edges[-1])
            ids.append(some)
            done += len(edges) - 1
        ids, starts = np.concatenate(ids), np.concatenate(starts)
        slot = slot[kept]
        length = np.diff(starts)[slot]
        size = np.bincount(np.repeat(np.arange(n), counts)[kept], weights=length, minlength=n).astype(np.int64)
        direct = self.whole(texts.filter(pa.array(odd)).to_pylist()) if odd.any() else []
        size[odd] = [len(x) for x in direct]
        edges = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(edges[-1], END_ID, np.uint32)
        # Units follow each other, but for one end id behind each text and the texts encoded whole.
        free = np.ones(edges[-1], bool)
        free[edges[1:] - 1] = False
        for i, found in zip(np.flatnonzero(odd), direct, strict=True):
            out[edges[i] : edges[i] + len(found)] = found
            free[edges[i] : edges[i + 1]] = False
        total = int(length.sum())
        out[free] = ids[np.arange(total) + np.repeat(starts[slot] - (np.cumsum(length) - length), length)]
        return out, edges


def _row(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    end = np.array([END_ID], np.uint32)
    edges = np.concatenate([[0], np.cumsum([len(x) + 1 for x in found])]).astype(np.int64)
    return np.concatenate([y for x in found for y in (x, end)] or [end[:0]]), edges


# --- minimal perfect hashing ---


def key_hashes(keys: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """Keys are doc_ids with the number of the copy, for doc_ids that occur more than once."""
    return seeded(keys.astype(np.int64).view(np.uint64), 101) ^ seeded(copies.astype(np.uint64), 202)


@dataclass
class PerfectHash:
    sizes: list[int]
    bits: np.ndarray  # one byte per bit, all levels
    ranks: np.ndarray  # set bits before each

    @classmethod
    def build(cls, hashes: np.ndarray, room: float = 1.7) -> PerfectHash:
        sizes, levels = [], []
        left = hashes
        while len(left):
            size = int(len(left) * room) + 8
            at = (seeded(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        return cls.of(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    @classmethod
    def of(cls, sizes: list[int], bits: np.ndarray) -> PerfectHash:
        return cls(sizes, bits, np.concatenate([[0], np.cumsum(bits)]).astype(np.int64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of keys; -1 for hashes that reach no set bit (certainly strangers)."""
        out, left, start = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes):
            at = start + (seeded(hashes[left], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.ranks[at[hit]]
            left, start = left[~hit], start + size
        return out


# --- files ---


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (seeded(hashes, 999) >> np.uint64(32)).astype("<u4")


#: Stands for a missing key in the index; how many of a shard's first documents have none is in its head.
NO_KEY = np.iinfo(np.int64).min


def write_shard(path: str, name: str, parts: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]], kind: str, attempt: str) -> tuple[int, int]:
    """Writes (keys, ids, bounds) parts in order, missing keys first; returns documents and ids written."""
    store, folder = _store(path)
    keys, lengths, total, nulls = [], [], 0, 0
    store.create_dir(folder, recursive=True)
    own = f"{folder}/.{name}-{attempt}"
    with store.open_output_stream(f"{own}.bin") as out:
        for some, ids, bounds in parts:
            if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                raise ValueError(f"an id does not fit {kind}")
            out.write(ids.astype(kind).tobytes())
            nulls += some.null_count
            keys.append(pc.fill_null(some, NO_KEY).to_numpy(zero_copy_only=False))
            lengths.append(np.diff(bounds))
            total += len(ids)
    keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
    ends = np.cumsum(np.concatenate(lengths)) if lengths else np.empty(0, np.int64)
    starts = np.concatenate([[0], ends]).astype("<i8")
    first = np.searchsorted(keys, keys)  # keys come in order
    copies = np.arange(len(keys)) - first
    hashes = key_hashes(keys, copies)
    perfect = PerfectHash.build(hashes)
    number = perfect.find(hashes)
    place = np.empty(len(keys), "<i4")
    place[number] = np.arange(len(keys))
    prints = np.empty(len(keys), "<u4")
    prints[number] = _fingerprints(hashes)
    arrays = {"keys": keys.astype("<i8"), "starts": starts, "bits": np.packbits(perfect.bits), "prints": prints, "place": place}
    head = {"kind": kind, "n": len(keys), "nulls": nulls, "levels": perfect.sizes, "arrays": {k: [str(v.dtype), len(v)] for k, v in arrays.items()}}
    text = json.dumps(head).encode()
    with store.open_output_stream(f"{own}.idx") as out:
        out.write(MAGIC + len(text).to_bytes(8, "little") + text)
        for v in arrays.values():
            out.write(v.tobytes())
    for kind_of in ("bin", "idx"):
        store.move(f"{own}.{kind_of}", f"{folder}/{name}.{kind_of}")
    return len(keys), total


class Shard:
    """Keyed access to one shard; ids are read from the payload by place, not as a whole."""

    def __init__(self, path: str, name: str):
        store, folder = _store(path)
        with store.open_input_file(f"{folder}/{name}.idx") as file:
            data = file.read()
        if data[:8] != MAGIC:
            raise ValueError(f"{name}.idx is no index")
        size = int.from_bytes(data[8:16], "little")
        head, rest = json.loads(data[16 : 16 + size]), io.BytesIO(data[16 + size :])
        load = {k: np.frombuffer(rest.read(n * np.dtype(t).itemsize), t) for k, (t, n) in head["arrays"].items()}
        self.kind, self.n, self.nulls = np.dtype(head["kind"]), head["n"], head["nulls"]
        self.keys, self.starts, self.prints, self.place = load["keys"], load["starts"], load["prints"], load["place"]
        bits = np.unpackbits(load["bits"], count=sum(head["levels"])).astype(bool) if head["levels"] else np.zeros(0, bool)
        self.perfect = PerfectHash.of(head["levels"], bits)
        self.payload = store.open_input_file(f"{folder}/{name}.bin")

    def places(self, keys: np.ndarray, copies: np.ndarray | None = None) -> np.ndarray:
        """Where each key's document stands in the shard, -1 for keys that aren't in it."""
        hashes = key_hashes(keys, np.zeros(len(keys)) if copies is None else copies)
        number = self.perfect.find(hashes)
        known = number >= 0
        known[known] = self.prints[number[known]] == _fingerprints(hashes[known])
        out = np.full(len(keys), -1, np.int64)
        out[known] = self.place[number[known]]
        return out

    def ids(self, at: int) -> np.ndarray:
        a, b = int(self.starts[at]), int(self.starts[at + 1])
        self.payload.seek(a * self.kind.itemsize)
        return np.frombuffer(self.payload.read((b - a) * self.kind.itemsize), self.kind)


# --- Spark ---


def write_tokens(docs: DataFrame, encoder: Encoder, path: str | None = None, *, kind: str = "<u2", docs_per_shard: int = 4096) -> tuple[str, DataFrame]:
    """Encodes every text (null: empty) into shards under ``path``; returns it and a stored manifest.

    Manifest: shard, n_docs, n_ids, start (ids before the shard).  doc_id must be an integer; rows
    with a null doc_id come first.  Rows of one doc_id, or without one, are separate documents,
    ordered by a hash of the text and the text, and may lie in several shards.  An empty table has
    a manifest without rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = max(1, -(-docs.count() // docs_per_shard))
    # The hash divides a doc_id, or the lack of one, that many rows have.
    ranged = rows.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def write(batches):
        context, mine = TaskContext.get(), Encoder.of_worker(encoder.path, encoder.by_units)
        shard, wrote = context.partitionId(), []

        def parts():
            for batch in slices(batches, 1):
                ids, bounds = mine.encode(batch.column(1))
                yield batch.column(0), ids, bounds

        wrote = write_shard(path, f"shard-{shard:08d}", parts(), kind, str(context.taskAttemptId()))
        if wrote[0]:
            yield pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64()) for k, v in (("shard", shard), ("n_docs", wrote[0]), ("n_ids", wrote[1]))})

    manifest = landed(ranged.mapInArrow(write, "shard long, n_docs long, n_ids long"))
    # A row per shard: what is summed in order is as small as the list of files.
    before = F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")
    return path, landed(manifest.withColumn("start", before))


def read_tokens(path: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, each found through its shard's index.

    ``start`` counts the ids of all documents before it, ``ids_crc32`` is that of its ids as
    little-endian unsigned 32-bit integers.
    """

    def read(batches):
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Shard(path, f"shard-{shard:08d}")
                copies = np.arange(own.n) - np.searchsorted(own.keys, own.keys)
                at = own.places(own.keys, copies)
                if (at < 0).any():
                    raise ValueError(f"shard {shard}: a key is not found")
                sums = [crc(own.ids(i).astype("<u4").tobytes()) for i in at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.keys, mask=np.arange(own.n) < own.nulls), pa.array(start + own.starts[at]), pa.array(own.starts[at + 1] - own.starts[at]), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    n = max(1, manifest.count())
    dealt = manifest.select("shard", "start").repartitionByRange(n, "shard")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
