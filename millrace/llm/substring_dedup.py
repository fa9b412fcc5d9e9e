"""Exact repeats of word passages: seed on winnowed anchors, extend both ways, keep maximal repeats.

A window of ``length`` words that stands at two places contains, at the same place in both, an
anchor: winnowing picks the smallest hash of each run of consecutive short grams, and a run that
lies inside the window is equal at both places. So only anchors that occur twice or more can be
part of a repeat. Around each occurrence of such a seed the match is extended left and right, one
window per placing of the seed in it. Equal extensions meet at their first occurrence; an
occurrence that is not the first is a repeat. Neighbouring windows join into maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from .common import give_back, release, shared_table, text_or_empty
from .sketches import hashed_words, mix, window_hashes

LOT = 200  # texts that are split and hashed together


@dataclass(frozen=True)
class Repeats:
    """``gram`` words make an anchor; ``length - gram + 1`` neighbouring grams choose one."""

    length: int = 20
    gram: int = 10

    @property
    def run(self) -> int:
        return self.length - self.gram + 1


def _sliding(best, x: np.ndarray, run: int) -> np.ndarray:
    """Minimum or maximum of each ``run`` neighbours, in steps that double the reach."""
    reach = 1
    while reach < run:
        step = min(reach, run - reach)
        x = best(x[: len(x) - step], x[step:])
        reach += step
    return x


def winnow(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places of the smallest hash of each run of ``run`` hashes; of equal ones, all.

    A hash is the smallest of some run that holds it if it equals the largest of their minima.
    """
    if len(hashes) < run:
        return np.empty(0, np.int64)
    least = np.zeros(len(hashes) + run - 1, np.uint64)
    least[run - 1 : len(hashes)] = _sliding(np.minimum, hashes, run)
    return np.flatnonzero(_sliding(np.maximum, least, run) == hashes)


def _second(hashes: np.ndarray) -> np.ndarray:
    """Another 64 bits from the same words: windows are compared by 128 bits in all."""
    return mix(hashes ^ np.uint64(0x5851F42D4C957F2D))


def _anchors(rows: DataFrame, config: Repeats) -> DataFrame:
    """Anchors of each document, once per hash, and whether it has them twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, LOT):
                part = batch.slice(lo, LOT)
                found, times, sizes = [], [], []
                for words in hashed_words(part["text"].cast(pa.binary())):
                    own = np.empty(0, np.uint64)
                    if len(words) >= config.length:
                        grams = window_hashes(words, config.gram)
                        own = grams[winnow(grams, config.run)]
                    distinct, n = np.unique(own, return_counts=True)
                    found.append(distinct.view(np.int64))
                    times.append(n)
                    sizes.append(len(distinct))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(found), pa.int64()),
                        pa.array(np.repeat(part["doc"].to_numpy(zero_copy_only=False), sizes), pa.int64()),
                        pa.array(np.concatenate(times) > 1, pa.bool_()),
                    ],
                    ["anchor", "doc", "twice"],
                )
        give_back()

    return rows.mapInArrow(run, "anchor long, doc long, twice boolean")


def _seeds(anchors: DataFrame) -> DataFrame:
    """Per document the anchors that occur again, there or in another document."""
    again = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")).filter("n > 1 or twice").select("anchor")
    return anchors.join(again, "anchor").groupBy("doc").agg(F.collect_list("anchor").alias("seeds"))


def _extended(rows: DataFrame, config: Repeats) -> DataFrame:
    """Every window that holds a seed: (a, b) its 128-bit hash, and where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, LOT):
                part = batch.slice(lo, LOT)
                docs, starts, hashes, seconds = [], [], [], []
                for doc, words, seeds in zip(part["doc"].to_pylist(), hashed_words(part["text"].cast(pa.binary())), part["seeds"], strict=True):
                    grams = window_hashes(words, config.gram)
                    at = np.flatnonzero(np.isin(grams, seeds.values.to_numpy(zero_copy_only=False).view(np.uint64)))
                    # Extend each seed left and right: all windows of the length that hold it.
                    size, before = len(words) + 2, np.maximum(at - (config.length - config.gram), 0)
                    reach = np.bincount(before, minlength=size) - np.bincount(at + 1, minlength=size)
                    at = np.flatnonzero(np.cumsum(reach)[: max(0, len(words) - config.length + 1)] > 0)
                    docs.append(np.full(len(at), doc, np.int64))
                    starts.append(at)
                    hashes.append(window_hashes(words, config.length, at))
                    seconds.append(window_hashes(_second(words), config.length, at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(hashes).view(np.int64), pa.int64()),
                        pa.array(np.concatenate(seconds).view(np.int64), pa.int64()),
                        pa.array(np.concatenate(docs), pa.int64()),
                        pa.array(np.concatenate(starts).astype(np.int32), pa.int32()),
                    ],
                    ["a", "b", "doc", "start"],
                )
        give_back()

    return rows.mapInArrow(run, "a long, b long, doc long, start int")


def repeats(rows: DataFrame, config: Repeats) -> DataFrame:
    """Maximal repeats per document (``doc``, ``text``): ``spans`` of words, as start and end.

    A span is a run of words each of which lies in a window that also starts earlier: in a
    document with a smaller ``doc``, or further to the front in the same one.
    """
    seeds = shared_table(_seeds(_anchors(rows, config)), "seeds").withColumnRenamed("doc", "__doc")
    # Not written: the windows are far more than the repeats among them, and cheap to make again.
    windows = _extended(lookup(rows, seeds, "doc", "__doc", ["seeds"], how="inner"), config)
    first = windows.groupBy("a", "b").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    first = shared_table(first, "first-windows")
    later = windows.join(first, ["a", "b"]).filter((F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start")))

    def join_up(starts):
        """Sorted starts to spans: a start within reach of the span before it extends that one."""
        begin = F.filter(starts, lambda x, k: F.coalesce(x > F.get(starts, k - 1) + config.length, F.lit(True)))
        end = F.filter(starts, lambda x, k: F.coalesce(F.get(starts, k + 1) > x + config.length, F.lit(True)))
        return F.zip_with(begin, end, lambda x, y: F.struct(x.alias("begin"), (y + config.length).alias("end")))

    gathered = later.groupBy("doc").agg(F.array_sort(F.collect_list("start")).alias("starts"))
    return gathered.select("doc", join_up(F.col("starts")).alias("spans"))


def numbered(docs: DataFrame) -> DataFrame:
    """Add ``__doc``: the place of each row in the order of ``doc_id``, ties by text.

    Where ids are present and distinct that is the id itself, which needs no shuffle. Else rows
    are numbered in order, NULL ids first, so that repeated ids stay apart.
    """
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"), F.countDistinct("doc_id").alias("ids")).first()
    if ids["n"] == ids["known"] == ids["ids"]:
        return docs.withColumn("__doc", F.col("doc_id").cast("long"))
    key = [F.col("doc_id").cast("long").asc_nulls_first(), F.xxhash64(text_or_empty())]
    # Partition numbers are the high bits, so numbers ascend over the sorted ranges.
    return shared_table(docs.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__doc", F.monotonically_increasing_id()), "numbered")


def remove_repeats(docs: DataFrame, config: Repeats | None = None) -> DataFrame:
    """All columns, ``text`` replaced by the kept words joined by one space, and ``__words``,
    ``__removed`` (numbers of words) and ``__spans`` (word spans removed).

    A NULL text becomes empty. The first occurrence of a passage stays: the one in the smallest
    ``doc_id``, then furthest to the front; NULL ids come first, and rows that repeat an id are
    ordered by their texts' hash. Passages shorter than ``length`` words are never removed.
    """
    config = config or Repeats()
    columns, rows = docs.columns, numbered(docs)
    texts = rows.select(F.col("__doc").alias("doc"), text_or_empty().alias("text"))
    # A copy of a whole text has no first occurrence of its own, so only the first text is searched.
    digests = texts.select("doc", F.md5("text").alias("digest"))
    firsts = digests.groupBy("digest").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copies = digests.join(firsts, "digest").filter("doc != first").select(F.col("doc").alias("__copy"), F.lit(True).alias("copy"))
    copies = shared_table(copies, "copies")
    searched = lookup(texts, copies, "doc", "__copy", ["copy"]).filter("copy is null").select("doc", "text")
    found = repeats(searched, config).withColumn("copy", F.lit(False))
    whole = copies.select(F.col("__copy").alias("doc"), F.lit(None).cast("array<struct<begin:int,end:int>>").alias("spans"), "copy")
    found = shared_table(found.unionByName(whole), "repeats")
    release(docs.sparkSession)
    joined = lookup(rows, found, "__doc", "doc", ["spans", "copy"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, removed, gone = [], [], [], []
            for text, spans, copy in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["spans"].to_pylist(), batch["copy"].to_pylist(), strict=True):
                words = (text or b"").split()
                total.append(len(words))
                if copy and len(words) >= config.length:
                    spans = [{"begin": 0, "end": len(words)}]
                gone.append(spans)
                for span in reversed(spans or []):
                    del words[span["begin"] : span["end"]]
                removed.append(total[-1] - len(words))
                texts.append(b" ".join(words))
            new = {
                "text": pa.array(texts, pa.binary()).cast(batch.schema.field("text").type), "__words": pa.array(total, pa.int64()),
                "__removed": pa.array(removed, pa.int64()), "__spans": pa.array(gone, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
            }
            names = [*columns, "__words", "__removed", "__spans"]
            yield pa.RecordBatch.from_arrays([new[c] if c in new else batch[c] for c in names], names)
        give_back()

    out = joined.select(*[F.col(f"`{c}`") for c in columns], "spans", "copy")
    return out.mapInArrow(cut, f"{schema}, __words long, __removed long, __spans array<struct<begin:int,end:int>>")
