"""Word shingles as 64-bit hashes, and exact counts of the texts that have them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back

_M = np.uint64(0x9E3779B97F4A7C15)
_M_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
LOT = 8 << 20  # bytes of texts whose words are hashed together


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a number of words."""

    keep = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.keep:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def hashed_words(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of the words of each text, as ``WordHashes`` has them; each distinct word of a lot is
    hashed once. A NULL text has no words."""
    lots = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // LOT
    bounds = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), len(texts)] if len(texts) else []
    for lo, hi in zip(bounds, bounds[1:]):
        lot = texts.slice(lo, hi - lo).cast(pa.large_binary())
        # The kernel parts at the six characters of WHITE and takes any bytes, valid UTF-8 or not.
        split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.large_string(), len(lot), lot.buffers(), offset=lot.offset))
        numbered = split.flatten().dictionary_encode()
        words, number = numbered.dictionary, numbered.indices.to_numpy()
        words = pa.Array.from_buffers(pa.large_binary(), len(words), words.buffers(), offset=words.offset).to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum([0, *pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).tolist()])
        if b"" in words:  # before and after white space at the ends of a text
            kept = number != words.index(b"")
            ends, number = np.concatenate([[0], np.cumsum(kept)])[ends], number[kept]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))[number]
        yield from (hashes[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist()))


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, n: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of each run of ``n`` words, or of those that start at ``at``; none in a shorter text.

    A polynomial of the words' hashes over 64-bit numbers, from sums of prefixes: the cost of a
    window does not depend on its length.
    """
    k = len(words)
    if k < n:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(k + 1, np.uint64)
        np.cumsum(words * _powers(_M, k), out=sums[1:])
        back = _powers(_M_INVERSE, k - n + 1)
        if at is None:
            return mix((sums[n:] - sums[: k - n + 1]) * back)
        return mix((sums[at + n] - sums[at]) * back[at])


def _powers(base: np.uint64, k: int) -> np.ndarray:
    out = np.full(k, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def shingles(words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in ascending order and how often each occurs.

    A text of fewer than ``n`` words is one shingle; a text without words has none.
    """
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.unique(window_hashes(words, min(n, len(words))), return_counts=True)


def document_frequencies(texts: DataFrame, n: int, parts: int) -> DataFrame:
    """Per ``chunk`` of ``texts``: ``hashes`` of its shingles that two or more texts have, with
    ``counts`` of those texts (arrays of 64 and 32 bits).

    A chunk's shingles are counted where its texts lie, so a shingle that every text has moves once
    a chunk. ``parts``, a power of two, splits the space of hashes; a part is counted as a whole.
    """
    shift = np.uint64(64 - (parts.bit_length() - 1)) if parts > 1 else None

    def pieces(chunk: int, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes, counts = np.unique(np.concatenate(held), return_counts=True)
        counts = counts.astype(np.uint32)
        part = np.zeros(len(hashes), np.int64) if shift is None else (hashes >> shift).astype(np.int64)
        ends = np.searchsorted(part, np.arange(parts + 1))
        rows = [(k, lo, hi) for k, (lo, hi) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)) if hi > lo]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _, _ in rows], pa.int32()), pa.array([chunk] * len(rows), pa.int64()),
                pa.array([hashes[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()), pa.array([counts[lo:hi].tobytes() for _, lo, hi in rows], pa.binary()),
            ],
            ["part", "chunk", "hashes", "counts"],
        )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0
        for batch in batches:
            for chunk, words in zip(batch["chunk"].to_pylist(), hashed_words(batch["text"]), strict=True):
                if held and (chunk != at or size > 1 << 22):
                    yield from pieces(at, held)
                    held, size = [], 0
                at = chunk
                held.append(shingles(words, n)[0])
                size += len(held[-1])
        if held:
            yield from pieces(at, held)
            held.clear()
        give_back()

    def count(key: tuple, rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(h, np.uint64) for h in rows["hashes"].to_pylist()]
        ends = np.cumsum([0, *map(len, hashes)]).tolist()
        hashes = np.concatenate(hashes)
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint32)
        order = np.argsort(hashes)
        ranked = hashes[order]
        starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
        sums = np.add.reduceat(counts[order].astype(np.int64), starts)
        df = np.empty(len(hashes), np.int64)
        df[order] = np.repeat(sums, np.diff(np.r_[starts, len(hashes)]))
        several = df > 1
        out = {"chunk": [], "hashes": [], "counts": []}
        for chunk, lo, hi in zip(rows["chunk"].to_pylist(), ends[:-1], ends[1:], strict=True):
            keep = several[lo:hi]
            if keep.any():
                out["chunk"].append(chunk)
                out["hashes"].append(hashes[lo:hi][keep].tobytes())
                out["counts"].append(df[lo:hi][keep].astype(np.uint32).tobytes())
        return pa.table([pa.array(out["chunk"], pa.int64()), pa.array(out["hashes"], pa.binary()), pa.array(out["counts"], pa.binary())], names=list(out))

    found = texts.select("chunk", F.col("text").cast("binary").alias("text")).mapInArrow(split, "part int, chunk long, hashes binary, counts binary")
    return found.groupBy("part").applyInArrow(count, "chunk long, hashes binary, counts binary")
