"""Removal of lines that many documents share.

One pass fills two Bloom filters: hashes seen once and hashes seen again. Both have a fixed size,
so what is broadcast never grows. Only lines the second filter knows are written out, counted
exactly, and joined back. A filter that is too small for the input lets more lines through to the
exact count; it never changes the result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, shared_table, shuffle_partitions, text_or_empty

BLOOM_BITS = 1 << 28  # 32 MB a filter
HASHES = 4
SLICE_BITS = 1 << 20
_HELD = 1_000_000  # hashes a task holds before it writes them


def line_key(line: bytes) -> bytes:
    """White space stripped at both ends, A-Z lower-cased: what bytes methods do in UTF-8."""
    return line.strip().lower()


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """HASHES places of each 64-bit hash, as rows."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(HASHES)])


def _hash(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch["text"].cast(pa.binary()).to_pylist()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode("utf-8", "replace")) >= min_chars)


def seen_again(docs: DataFrame, min_chars: int = 1, bits: int = BLOOM_BITS) -> np.ndarray:
    """Packed bits of the second filter: places that hashes of two or more documents have hit."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            hit, times = np.unique(places(np.concatenate(held), bits), return_counts=True)
            ends = np.searchsorted(hit, np.arange(0, bits + 1, SLICE_BITS, dtype=np.uint64))
            part, once, again = [], [], []
            for k in np.flatnonzero(np.diff(ends)):
                own = (hit[ends[k] : ends[k + 1]] - np.uint64(k * SLICE_BITS)).astype("<u4")
                part.append(int(k))
                once.append(zlib.compress(np.diff(own, prepend=np.uint32(0)).tobytes(), 1))
                again.append(own[times[ends[k] : ends[k + 1]] > 1].tobytes())
            held.clear()
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(once, pa.binary()), pa.array(again, pa.binary())], ["slice", "once", "again"])

        for batch in batches:
            for text in _texts(batch):
                held.append(_hash([k for k in {line_key(x) for x in text.split(b"\n")} if _long_enough(k, min_chars)]))
            if sum(map(len, held)) >= _HELD:
                yield from flush()
        if held:
            yield from flush()
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, again = filters.setdefault(row["slice"], (np.zeros(SLICE_BITS, bool), np.zeros(SLICE_BITS, bool)))
                hit = np.cumsum(np.frombuffer(zlib.decompress(row["once"]), "<u4"), dtype=np.int64)
                again[hit[once[hit]]] = True
                again[np.frombuffer(row["again"], "<u4")] = True
                once[hit] = True
        for k, (_, again) in filters.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([np.packbits(again).tobytes()], pa.binary())], ["slice", "again"])

    filled = docs.select(text_or_empty().alias("text")).mapInArrow(fill, "slice int, once binary, again binary")
    merged = filled.repartition(shuffle_partitions(docs.sparkSession), "slice").mapInArrow(merge, "slice int, again binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():  # bits / SLICE_BITS rows at most
        at = row["slice"] * SLICE_BITS // 8
        out[at : at + SLICE_BITS // 8] = np.frombuffer(row["again"], np.uint8)
    return out


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, keep: str, bits: int) -> DataFrame:
    """Per document that has some: ``__id``, ``__h`` and the shared keys, with a line to keep or -1.

    A document is known by its id and the hash of its text, so NULL and repeated ids do no harm.
    """
    spark = docs.sparkSession
    bits = max(bits, SLICE_BITS)
    again = spark.sparkContext.broadcast(seen_again(docs, min_chars, bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = again.value
        for batch in batches:
            ids, hashes, keys, lines = [], [], [], []
            for doc, h, text in zip(batch["__id"].to_pylist(), batch["__h"].to_pylist(), _texts(batch), strict=True):
                first: dict[bytes, int] = {}
                for n, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if key not in first and _long_enough(key, min_chars):
                        first[key] = n
                if not first:
                    continue
                own = list(first)
                at = places(_hash(own), bits)
                hit = ((known[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1).all(axis=0)
                for k in np.flatnonzero(hit):
                    ids.append(doc)
                    hashes.append(h)
                    keys.append(own[k])
                    lines.append(first[own[k]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(keys, pa.binary()), pa.array(lines, pa.int64())],
                ["__id", "__h", "key", "line"],
            )
        give_back()

    rows = _identified(docs).select("__id", "__h", "text").mapInArrow(suspects, "__id long, __h long, key binary, line long")
    per_doc = shared_table(rows.groupBy("__id", "__h", "key").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("line")), "suspects")
    shared = (
        per_doc.groupBy("key")
        .agg(F.sum("n").alias("n"), F.min(F.struct("__id", "__h", "line")).alias("first"))
        .filter(F.col("n") >= min_docs)
    )
    kept = F.when((F.lit(keep) == "first") & F.col("__id").eqNullSafe(F.col("first.__id")) & (F.col("__h") == F.col("first.__h")), F.col("line")).otherwise(F.lit(-1))
    found = per_doc.drop("n").join(shared, "key").select("__id", "__h", "key", kept.alias("keep"))
    return found.groupBy("__id", "__h").agg(F.collect_list(F.struct("key", "keep")).alias("__shared"))


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64(text_or_empty()).alias("__h"), text_or_empty().alias("text"))


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", bits: int = BLOOM_BITS
) -> DataFrame:
    """Documents with the lines gone whose key stands in ``min_docs`` documents or more.

    Lines are parted at line breaks; a line's key is the line without white space at its ends and
    with A-Z in lower case. ``keep='first'`` leaves each shared line at its first place (smallest
    ``doc_id``, then line), ``'none'`` removes it everywhere. All columns stay; ``text`` holds what
    is left (lines joined by line breaks) and ``__lines`` and ``__dropped`` are added. A NULL or
    empty text is one empty line and stays empty; keys shorter than ``min_chars`` code points are
    never shared. Rows that agree in id and text count as two documents and get the same verdict.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"unknown choice: {keep}")
    columns = docs.columns
    shared = repeated_lines(docs, min_chars, min_docs, keep, bits)
    shared = shared.select(F.col("__id").alias("__id2"), F.col("__h").alias("__h2"), "__shared")
    rows = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__h": F.xxhash64(text_or_empty())})
    joined = rows.join(shared, (F.col("__h") == F.col("__h2")) & F.col("__id").eqNullSafe(F.col("__id2")), "left")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, dropped = [], [], []
            kind = batch.schema.field("text").type
            raw = batch["text"].cast(pa.binary()).to_pylist()
            for text, own in zip(raw, batch["__shared"].to_pylist(), strict=True):
                lines = (text or b"").split(b"\n")
                total.append(len(lines))
                if own:
                    gone = {s["key"]: s["keep"] for s in own}
                    left = [x for n, x in enumerate(lines) if gone.get(line_key(x), n) == n]
                    dropped.append(len(lines) - len(left))
                    text = b"\n".join(left) if dropped[-1] else text
                else:
                    dropped.append(0)
                texts.append(text)
            new = {"text": pa.array(texts, pa.binary()).cast(kind), "__lines": pa.array(total, pa.int64()), "__dropped": pa.array(dropped, pa.int64())}
            names = [*columns, "__lines", "__dropped"]
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch[c] for c in names], names)
        give_back()

    return joined.select(*[F.col(f"`{c}`") for c in columns], "__shared").mapInArrow(drop, f"{schema}, __lines long, __dropped long")
