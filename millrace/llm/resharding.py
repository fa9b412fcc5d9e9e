"""Resharding by minimum-cost flow: the fewest bytes move, and only affected files are written again.

A sharded table is a folder with one sub-folder per shard and block, a block being a bounded part of a
shard. Going to new shards with given capacities is a transport problem between old shards (what they
hold) and new ones (what they may hold): a byte that stays in its shard costs nothing, one that moves
costs one, or what a cost table says. The solution says how many bytes go from each shard to each other.
It is cut along the blocks of a shard in their order: a block that stays keeps its files where they are,
one that moves as a whole is copied, and one on a border is dealt out row by row, large rows first, so
that each new shard comes as near to its capacity as its smallest rows allow.

What passes through the driver is a size per shard and a range of blocks per transfer.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import lookup
from ..storage import work_folder
from .common import shared_table, text_or_empty

SHARD, BLOCK, AT, SIZE, ROW = "__shard", "__block", "__at", "__size", "__row"
_PIECE = f"{SHARD} int, {BLOCK} int, {AT} long, target int, place long"


# -- transfers -----------------------------------------------------------------------------------------


def transfers(
    old: Mapping[int, int], capacity: Mapping[int, int], cost: Callable[[int, int], int] | None = None
) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one, of least total cost.

    Shortest augmenting paths over the shards: each path takes the cheapest way from a shard that still
    holds bytes to one with room, also by turning back what an earlier path sent. ``cost`` of a byte
    is 0 inside a shard and 1 otherwise, unless given. Both sides have the same sum.
    """
    if sum(old.values()) != sum(capacity.values()):
        raise ValueError("the capacities must add up to what the old shards hold")
    cost = cost or (lambda i, j: int(i != j))
    left, right = sorted(old), sorted(capacity)
    price = np.array([[cost(i, j) for j in right] for i in left], np.float64).reshape(len(left), len(right))
    supply, room = np.array([old[i] for i in left], np.int64), np.array([capacity[j] for j in right], np.int64)
    flow = np.zeros(price.shape, np.int64)
    while supply.any():
        to_right, to_left = np.full(len(right), np.inf), np.where(supply > 0, 0.0, np.inf)
        came_right, came_left = np.full(len(right), -1), np.full(len(left), -1)
        while True:  # as many times as a path is long
            ways = to_left[:, None] + price
            best = ways.min(axis=0)
            nearer = best < to_right
            to_right[nearer], came_right[nearer] = best[nearer], ways.argmin(axis=0)[nearer]
            back = np.where(flow > 0, to_right[None, :] - price, np.inf)
            least = back.min(axis=1)
            shorter = least < to_left
            to_left[shorter], came_left[shorter] = least[shorter], back.argmin(axis=1)[shorter]
            if not (nearer.any() or shorter.any()):
                break
        end = int(np.where(room > 0, to_right, np.inf).argmin())
        path, j = [], end
        while True:
            i = int(came_right[j])
            path.append((i, j))
            if came_left[i] < 0:
                break
            j = int(came_left[i])
            path.append((i, j))
        forward, backward = path[::2], path[1::2]
        start = forward[-1][0]
        amount = min(int(supply[start]), int(room[end]), *[int(flow[p]) for p in backward])
        for p in forward:
            flow[p] += amount
        for p in backward:
            flow[p] -= amount
        supply[start] -= amount
        room[end] -= amount
    return {(left[i], right[j]): int(flow[i, j]) for i, j in zip(*np.nonzero(flow))}


def even(total: int, shards: Sequence[int]) -> dict[int, int]:
    """The same capacity for each shard, to the byte."""
    return {j: total // len(shards) + (k < total % len(shards)) for k, j in enumerate(shards)}


# -- sharded tables ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Sharded:
    """A table written by shard and block: its rows as they were, their sizes and their places."""

    rows: DataFrame
    blocks: DataFrame  # shard, block, rows, bytes


@dataclass(frozen=True)
class Blocks:
    """Bounds of a block; a shard has at least ``least`` of them."""

    bytes: int = 128 << 20
    rows: int = 1_000_000
    least: int = 8


def text_size(name: str = "text") -> Column:
    return F.octet_length(text_or_empty(name)).cast("long") + 1


def write_sharded(table: DataFrame, shard: Column, size: Column, blocks: Blocks = Blocks()) -> Sharded:
    """Write a table by shard, each in blocks of about even size.

    All columns are kept in one, so their names are free. Rows are dealt to blocks by their place in
    the scan, so that many equal rows or one long run do not meet in a block.
    """
    spark = table.sparkSession
    rows = table.select(shard.cast("int").alias(SHARD), size.alias(SIZE), F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias(ROW))
    sizes = rows.groupBy(SHARD).agg(F.sum(SIZE).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # One row per shard.
    counts = {
        r[SHARD]: max(blocks.least, -(-r["bytes"] // blocks.bytes), -(-r["rows"] // blocks.rows)) for r in sizes.collect()
    }
    n = F.lit(blocks.least)
    for s, count in counts.items():
        n = F.when(F.col(SHARD) == s, count).otherwise(n)
    at = F.monotonically_increasing_id()
    dealt = rows.withColumn(AT, at).withColumn(BLOCK, F.pmod(F.xxhash64(AT), n).cast("int"))
    # The shuffle by block serves the numbering and the write.
    dealt = dealt.repartition(max(1, sum(counts.values())), SHARD, BLOCK)
    order = Window.partitionBy(SHARD, BLOCK).orderBy(AT)
    numbered = dealt.withColumn(AT, (F.row_number().over(order) - 1).cast("long"))
    path = work_folder(spark, "sharded")
    numbered.write.partitionBy(SHARD, BLOCK).option("compression", "zstd").parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    found = stored.groupBy(SHARD, BLOCK).agg(F.count(F.lit(1)).alias("rows"), F.sum(SIZE).alias("bytes"))
    return Sharded(stored, shared_table(found, "blocks"))


def _ranges(moves: Mapping[tuple[int, int], int]) -> list[tuple[int, int, int, int]]:
    """Per transfer: old shard, new shard, and from and to which byte of the old shard; what stays is first."""
    out = []
    for i in sorted({i for i, _ in moves}):
        upto = 0
        for j in sorted((j for k, j in moves if k == i), key=lambda j: (j != i, j)):
            out.append((i, j, upto, upto + moves[i, j]))
            upto += moves[i, j]
    return out


def _deal_out(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block on a border to the pieces it is cut into, the largest first, each to the most room."""
    quota = dict(zip(group["targets"].iloc[0], group["quotas"].iloc[0]))
    targets, room = list(quota), np.array(list(quota.values()), np.int64)
    order = np.lexsort((group[AT].to_numpy(), -group[SIZE].to_numpy()))
    sizes, chosen = group[SIZE].to_numpy()[order], np.empty(len(group), np.int64)
    for k, size in enumerate(sizes):
        chosen[k] = t = int(room.argmax())
        room[t] -= size
    out = pd.DataFrame({SHARD: group[SHARD].to_numpy()[order], BLOCK: group[BLOCK].to_numpy()[order], AT: group[AT].to_numpy()[order]})
    out["target"] = np.array(targets, np.int64)[chosen]
    out = out.sort_values(AT)
    out["place"] = out.groupby("target").cumcount()
    return out


def reshard(old: Sharded, capacity: Mapping[int, int], cost: Callable[[int, int], int] | None = None) -> DataFrame:
    """Rows in new shards with these capacities, read back from the files.

    Returns the table's columns in ``__row``, their ``__size``, ``shard`` and ``slot`` (without gaps
    from 0 in each shard), and ``moved``, which says whether a file was written for the row.
    """
    spark = old.rows.sparkSession
    held = {r[SHARD]: r["bytes"] for r in old.blocks.groupBy(SHARD).agg(F.sum("bytes").alias("bytes")).collect()}
    ranges = _ranges(transfers(held, capacity, cost))
    # As many rows as there are transfers, which the numbers of shards bound.
    cuts = F.broadcast(spark.createDataFrame(ranges, f"{SHARD} int, target int, lo long, hi long"))
    upto = Window.partitionBy(SHARD).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = old.blocks.withColumn("end", F.sum("bytes").over(upto)).withColumn("start", F.col("end") - F.col("bytes"))
    share = F.least("end", "hi") - F.greatest("start", "lo")
    pieces = spans.join(cuts, SHARD).filter((F.col("lo") < F.col("end")) & (F.col("hi") > F.col("start"))).withColumn("share", share)
    per_block = shared_table(
        pieces.groupBy(SHARD, BLOCK).agg(
            F.sort_array(F.collect_list(F.struct("target", "share"))).alias("parts"), F.first("rows").alias("rows")
        ),
        "pieces",
    )
    whole = per_block.filter(F.size("parts") == 1).select(SHARD, BLOCK, F.col("parts")[0]["target"].alias("target"), "rows")
    cut = per_block.filter(F.size("parts") > 1).select(
        SHARD, BLOCK, F.col("parts")["target"].alias("targets"), F.col("parts")["share"].alias("quotas")
    )
    # At most one cut block per border of two transfers: again bounded by the shards.
    cut_blocks = [(r[SHARD], r[BLOCK]) for r in cut.select(SHARD, BLOCK).collect()]
    on_border = old.rows.filter(_any_block(cut_blocks)).select(SHARD, BLOCK, AT, SIZE).join(F.broadcast(cut), [SHARD, BLOCK])
    dealt = shared_table(on_border.groupBy(SHARD, BLOCK).applyInPandas(_deal_out, _PIECE), "dealt")
    parts = dealt.groupBy(SHARD, BLOCK, "target").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("target").orderBy(SHARD, BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = whole.select(SHARD, BLOCK, "target", "rows").unionByName(parts).withColumn("from", F.sum("rows").over(before) - F.col("rows"))
    placed = shared_table(placed.withColumn("key", F.concat_ws(":", SHARD, BLOCK)), "placed")

    # Whole blocks between the same two shards follow each other: ranges of folders, known to the reader.
    stays = placed.filter(F.col(SHARD) == F.col("target")).join(F.broadcast(cut.select(SHARD, BLOCK)), [SHARD, BLOCK], "left_anti")
    kept_ranges = [(r[SHARD], r["a"], r["b"]) for r in stays.groupBy(SHARD).agg(F.min(BLOCK).alias("a"), F.max(BLOCK).alias("b")).collect()]
    kept = reduce(or_, [(F.col(SHARD) == s) & F.col(BLOCK).between(a, b) for s, a, b in kept_ranges], F.lit(False))

    def with_place(rows: DataFrame, where: DataFrame) -> DataFrame:
        keyed = rows.withColumn("key", F.concat_ws(":", SHARD, BLOCK))
        return lookup(keyed, where.select("key", "target", "from"), "key", "key", ["target", "from"], how="inner")

    whole_placed = placed.join(F.broadcast(cut.select(SHARD, BLOCK)), [SHARD, BLOCK], "left_anti")
    going = with_place(old.rows.filter(~kept & ~_any_block(cut_blocks)), whole_placed).withColumn("slot", F.col("from") + F.col(AT))
    split = old.rows.filter(_any_block(cut_blocks)).join(dealt, [SHARD, BLOCK, AT]).join(
        F.broadcast(placed.select(SHARD, BLOCK, "target", "from")), [SHARD, BLOCK, "target"]
    ) if cut_blocks else None
    columns = [F.col("target").alias("shard"), "slot", SIZE, ROW]
    written = going.select(*columns)
    if split is not None:
        written = written.unionByName(split.withColumn("slot", F.col("from") + F.col("place")).select(*columns))
    path = work_folder(spark, "resharded")
    written.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    moved = spark.read.schema(written.schema).parquet(path).withColumn("moved", F.lit(True))
    stayed = with_place(old.rows.filter(kept), whole_placed).withColumn("slot", F.col("from") + F.col(AT))
    return moved.unionByName(stayed.select(*columns, F.lit(False).alias("moved")))


def _any_block(blocks: Sequence[tuple[int, int]]) -> Column:
    return reduce(or_, [(F.col(SHARD) == s) & (F.col(BLOCK) == b) for s, b in blocks], F.lit(False))


def grow(docs: DataFrame, before: int, after: int, blocks: Blocks = Blocks()) -> DataFrame:
    """Documents laid out by hash of their id in ``before`` shards, then resharded evenly to ``after``.

    A document weighs its text's UTF-8 bytes and one more; a NULL or empty text weighs one. Equal rows
    are rows of their own, a NULL id hashes like a value, and an empty table has no rows. A text longer
    than a shard's capacity takes its shard over it.
    """
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(before))
    old = write_sharded(docs, shard, text_size(), blocks)
    total = old.blocks.agg(F.sum("bytes")).first()[0] or 0
    return reshard(old, even(total, range(after)))
