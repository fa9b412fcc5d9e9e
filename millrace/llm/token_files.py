"""Token ids in binary shards, with a minimal perfect hash index for access by document key.

A shard holds documents of one range of ascending keys, in one file::

    ids       unsigned 16- or 32-bit little-endian, all documents after one another
    keys      int64 per document, in file order
    ends      int64 per document: ids up to and including it
    slots     per distinct key, in hash order: uint32 fingerprint, int64 first document
    levels    bit sets of the hash: per level, a length and packed bits

A key's slot is found in constant time: on the first level whose bit at the key's place is set, the
number of set bits before it is the slot. The stored fingerprint tells keys that are not there.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import work_folder
from .common import shared_table, text_or_empty
from .token_ids import token_ids

SHARD = "file string, first_key long, last_key long, n_docs long, n_ids long, layout string"
READ = "shard string, doc_id long, at long, n_tokens long, ids_crc32 long"
_GAMMA = 2.0  # bits per key on a level
_LAST_LEVEL = 60


def mix64(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over keys, one function per seed."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys, 1_000) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Distinct 64-bit keys to 0 .. n-1 without storing the keys."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels  # boolean arrays
        self._before = np.cumsum([0, *[int(b.sum()) for b in levels]])
        self._rank = [np.concatenate([[0], np.cumsum(b)]) for b in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Keys alone at their place on a level stay there; the others go on to the next."""
        levels, rest = [], np.asarray(keys, np.int64)
        while len(rest):
            if len(levels) >= _LAST_LEVEL:
                raise ValueError("keys are not distinct")
            size = max(64, int(len(rest) * _GAMMA))
            at = (mix64(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot per key, -1 where no level has one; a key never stored may get any slot."""
        keys = np.asarray(keys, np.int64)
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = (mix64(keys[open_], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self._before[k] + self._rank[k][at[hit]]
            open_ = open_[~hit]
        return out

    def tobytes(self) -> bytes:
        return b"".join(np.int64(len(b)).tobytes() + np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def frombytes(cls, data: bytes) -> PerfectHash:
        levels, at = [], 0
        while at < len(data):
            n = int(np.frombuffer(data, "<i8", 1, at)[0])
            size = -(-n // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size, at + 8), count=n).astype(bool))
            at += 8 + size
        return cls(levels)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class Shard:
    """Reads one shard file by ranges; ``layout`` has the place of each section."""

    def __init__(self, path: str, layout: dict):
        store, name = _store(path)
        self._file, self._layout = store.open_input_file(name), layout
        self.keys = np.frombuffer(self._section("keys"), "<i8")
        self.ends = np.frombuffer(self._section("ends"), "<i8")
        slots = np.frombuffer(self._section("slots"), [("mark", "<u4"), ("doc", "<i8")])
        self._marks, self._docs = slots["mark"], slots["doc"]
        self._hash = PerfectHash.frombytes(self._section("levels"))

    def _section(self, name: str) -> bytes:
        at, size = self._layout[name]
        return self._file.read_at(size, at)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """First document of each key, -1 for keys that are not in this shard."""
        slot = self._hash.slots(keys)
        found = np.full(len(slot), -1, np.int64)
        ok = slot >= 0
        ok[ok] = self._marks[slot[ok]] == fingerprint(np.asarray(keys, np.int64)[ok])
        found[ok] = self._docs[slot[ok]]
        return found

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents ``first`` to ``last`` (exclusive) by one range read."""
        kind = np.dtype(self._layout["dtype"])
        begin = int(self.ends[first - 1]) if first else 0
        end = int(self.ends[last - 1]) if last else 0
        return np.frombuffer(self._file.read_at((end - begin) * kind.itemsize, begin * kind.itemsize), kind)

    def close(self) -> None:
        self._file.close()


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, dtype: str = "<u2") -> DataFrame:
    """Write documents in ascending order of ``doc_id``; one row per shard, which is its index.

    A NULL text is an empty one and holds the end id alone. A NULL ``doc_id`` comes first and is
    not found by key. Rows that repeat a key follow one another; the key leads to the first.
    Each task writes a file with a name of its own, and only the files of tasks that succeeded are
    in the index, so tasks may run again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer_path)
        store, root = _store(folder)
        keys: list[int | None] = []
        sizes: list[np.ndarray] = []
        out, path = None, f"{folder}/{uuid.uuid4().hex}.ids"
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                got = encode(part["text"].to_pylist())
                if out is None:
                    out = store.open_output_stream(f"{root}/{path.rsplit('/', 1)[1]}")
                end = np.uint32(end_id).tobytes()
                ids = np.frombuffer(b"".join([x for g in got for x in (g, end)]), "<u4")
                if len(ids) and ids.max() > np.iinfo(dtype).max:
                    raise ValueError(f"an id does not fit {dtype}")
                out.write(ids.astype(dtype).tobytes())
                sizes.append(np.array([len(g) // 4 + 1 for g in got], np.int64))
                keys += part["doc_id"].to_pylist()
        if out is None:
            return
        ends = np.cumsum(np.concatenate(sizes))
        nulls = sum(k is None for k in keys)  # they sort first
        known = np.array(keys[nulls:], np.int64)
        distinct, first = np.unique(known, return_index=True)
        table = PerfectHash.build(distinct)
        slots = np.empty(len(distinct), [("mark", "<u4"), ("doc", "<i8")])
        order = table.slots(distinct)
        slots["mark"][order], slots["doc"][order] = fingerprint(distinct), first + nulls
        sections = {
            "keys": np.concatenate([np.zeros(nulls, np.int64), known]).astype("<i8").tobytes(),
            "ends": ends.astype("<i8").tobytes(),
            "slots": slots.tobytes(),
            "levels": table.tobytes(),
        }
        layout: dict = {"dtype": dtype, "nulls": nulls}
        at = int(ends[-1]) * np.dtype(dtype).itemsize
        for name, data in sections.items():
            layout[name] = (at, len(data))
            out.write(data)
            at += len(data)
        out.close()
        row = [path, int(known[0]) if len(known) else None, int(known[-1]) if len(known) else None, len(keys), int(ends[-1]), json.dumps(layout)]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], ["file", "first_key", "last_key", "n_docs", "n_ids", "layout"]
        )

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    # Ties are spread by their text, so a key that many rows repeat is no single task.
    tie = F.xxhash64("text")
    ordered = rows.withColumn("tie", tie).repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie"))
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text")
    index = shared_table(ordered.mapInArrow(run, SHARD), "token-index")
    # One row per shard: a few dozen bytes for each output task.
    before = Window.orderBy(F.col("first_key").asc_nulls_first(), F.col("last_key").asc_nulls_first(), "file").rowsBetween(Window.unboundedPreceding, -1)
    return index.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def read_documents(index: DataFrame) -> DataFrame:
    """Every document of the shards: shard file, doc_id, place of its first id, size, checksum.

    Each shard is one row and one unit of work. The keys of the shard are looked up through its
    hash index; documents that repeat a key follow the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                layout = json.loads(row["layout"])
                shard, nulls = Shard(row["file"], layout), layout["nulls"]
                n = len(shard.keys)
                first = np.concatenate([np.arange(nulls), shard.find(shard.keys[nulls:])])
                if n and ((first < 0).any() or (first > np.arange(n)).any() or (shard.keys[first] != shard.keys).any()):
                    raise ValueError(f"index and payload of {row['file']} disagree")
                starts = np.concatenate([[0], shard.ends[:-1]]) if n else shard.ends
                lo = 0
                while lo < n:  # about four million ids at a time
                    hi = max(lo + 1, int(np.searchsorted(shard.ends, starts[lo] + 4_000_000, side="right")))
                    ids = shard.ids(lo, hi).astype("<u4").tobytes()
                    at = 4 * (np.concatenate([starts[lo:hi], [shard.ends[hi - 1]]]) - starts[lo])
                    view = memoryview(ids)
                    crc = [zlib.crc32(view[int(a) : int(b)]) for a, b in zip(at[:-1], at[1:], strict=True)]
                    keys = pa.array(shard.keys[lo:hi], pa.int64(), mask=np.arange(lo, hi) < nulls)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["file"]] * (hi - lo)), keys, pa.array(starts[lo:hi], pa.int64()), pa.array(shard.ends[lo:hi] - starts[lo:hi], pa.int64()), pa.array(crc, pa.int64())],
                        ["shard", "doc_id", "at", "n_tokens", "ids_crc32"],
                    )
                    lo = hi
                shard.close()

    shards = index.select("file", "layout", "base")
    # Numbered, so that shards are not merged into one task however short their rows are.
    found = shards.repartition(max(1, shards.count()), "file").mapInArrow(run, READ)
    return found.join(shards.select(F.col("file").alias("shard"), "base"), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )


def lookup_documents(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Ids of chosen documents: doc_id and its token ids; keys that are nowhere give no row.

    ``keys`` has a ``doc_id``. A key meets the shards whose range holds it and is looked up there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_file, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != open_file:
                    shard, open_file = Shard(row["file"], json.loads(row["layout"])), row["file"]
                at = int(shard.find(np.array([row["doc_id"]]))[0])
                out = []
                while 0 <= at < len(shard.keys) and shard.keys[at] == row["doc_id"]:
                    out.append(shard.ids(at, at + 1).astype(np.int64).tolist())
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array([row["doc_id"]] * len(out), pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "ids"])

    wanted = keys.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()
    near = wanted.join(index.select("file", "first_key", "last_key", "layout"), F.col("doc_id").between(F.col("first_key"), F.col("last_key")))
    return near.repartition("file").sortWithinPartitions("file").mapInArrow(run, "doc_id long, ids array<long>")


def write_and_read(docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Round trip of a table; ``folder`` defaults to a new one in the cluster's shared folder."""
    folder = folder or work_folder(docs.sparkSession, "tokens")
    return read_documents(write_shards(docs, folder, tokenizer_path, end_id))
