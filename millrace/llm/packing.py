"""Best-fit packing of token sequences under several capacities at once."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_table, text_or_empty
from .token_ids import token_ids

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold. Attention cost is the sum of squared document lengths.

    ``max_documents`` and ``max_cost`` left out do not bind: a sequence of ``tokens`` tokens has at
    most that many documents and at most that squared cost.
    """

    tokens: int = 2048
    max_documents: int | None = None
    max_cost: int | None = None

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.max_documents or self.tokens, self.max_cost or self.tokens**2], dtype=np.float64)


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of the pieces of a document: only the first may be shorter than ``most``."""
    head = n % most
    return ([head] if head else []) + [most] * (n // most)


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int = 0, most: int = 2048) -> DataFrame:
    """One row per piece of each document: its place in the document, length and checksum.

    A NULL text is an empty one and becomes the single end id. Rows that repeat stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = token_ids(tokenizer_path), np.uint32(end_id).tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                out: list[tuple] = []
                for doc, ids in zip(part["doc_id"].to_pylist(), encode(part["text"].to_pylist()), strict=True):
                    ids, begin = memoryview(ids + end), 0
                    for k, n in enumerate(cut_lengths(len(ids) // 4, most)):
                        out.append((doc, k, begin, n, zlib.crc32(ids[4 * begin : 4 * (begin + n)])))
                        begin += n
                columns = list(zip(*out, strict=True)) if out else [()] * 5
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(run, PIECES)


def fit(lengths: Sequence[int], capacity: Capacity, rule: str = "norm") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector best-fit decreasing: bin of each item, place in its bin, and order of placement.

    Each item asks for (length, 1, length squared). Among the open bins that hold it under every
    capacity, ``norm`` takes the one whose residual has the smallest weighted norm afterwards, and
    ``dot`` the one whose residual has the largest weighted dot product with the item. Weights make
    a capacity's scarcity count: the items' total demand over the capacity. Ties go to the bin
    opened first. Items that only an empty bin can hold open one.
    """
    n, cap = len(lengths), capacity.vector()
    size = np.asarray(lengths, dtype=np.int64)
    want = np.stack([size, np.ones(n, np.int64), size * size], axis=1).astype(np.float64)
    if (want > cap).any():
        raise ValueError("an item is larger than an empty sequence")
    weight = want.sum(axis=0) / cap
    weight = weight / max(weight.max(), 1e-300)
    order = np.argsort(-size, kind="stable")
    free = np.empty((max(n, 1), 3))
    bins, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
    opened, live = 0, np.empty(0, np.int64)
    smallest = want.min(axis=0) if n else cap
    for at, i in enumerate(order):
        item = want[i]
        ask = item / cap
        room = free[live]
        able = np.flatnonzero((room >= item).all(axis=1))
        if len(able):
            left = room[able] / cap
            score = -((left - ask) ** 2 * weight).sum(axis=1) if rule == "norm" else (left * ask * weight).sum(axis=1)
            b = live[able[int(np.argmax(score))]]
        else:
            b, opened = opened, opened + 1
            free[b] = cap
            live = np.append(live, b)
        bins[i], place[i] = b, cap[0] - free[b, 0]
        free[b] -= item
        if (free[b] < smallest).any():
            live = live[live != b]
        elif at % 256 == 255:  # bins that not even the smallest item fits leave the search
            live = live[(free[live] >= smallest).all(axis=1)]
    return bins, place, order


def pack(
    pieces: DataFrame, capacity: Capacity | None = None, rule: str = "norm", group_pieces: int = 8_000
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length``; sequences have no gaps.

    A piece as long as a sequence is one by itself. The rest is dealt at random into groups of
    about ``group_pieces`` and each group is packed on its own, so no task grows with the input;
    only the last sequences of a group are left unfilled.
    """
    capacity = capacity or Capacity()
    n_groups = max(1, -(-pieces.filter(F.col("length") < capacity.tokens).count() // group_pieces))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, place, _ = fit(group["length"].to_numpy(), capacity, rule)
        out = group[kept].copy()
        out["sequence_id"] = group["__group"].to_numpy() * 2 * group_pieces * 1000 + bins * 2
        out["offset"] = place
        return out

    # Equal rows are told apart by a number of their own, so that copies are spread over groups.
    dealt = pieces.filter(F.col("length") < capacity.tokens).select(
        *kept, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(n_groups)).alias("__group")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in kept)
    packed = dealt.groupBy("__group").applyInPandas(run, f"{schema}, sequence_id long, offset long")
    full = pieces.filter(F.col("length") >= capacity.tokens).select(
        *kept, (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: Capacity | None = None, rule: str = "norm"
) -> DataFrame:
    """Documents to packed pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    NULL and empty texts become one piece with the end id alone. Repeated rows are packed as often
    as they occur. An empty table gives no rows. Columns other than ``doc_id`` and ``text`` are
    not read.
    """
    capacity = capacity or Capacity()
    most = int(min(capacity.tokens, (capacity.max_cost or capacity.tokens**2) ** 0.5))
    # Written once: tokenising is the costly part, and group numbers must not depend on a rerun.
    pieces = shared_table(tokenise(docs, tokenizer_path, end_id, most), "pieces")
    return pack(pieces, capacity, rule)
